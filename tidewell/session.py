"""Session helpers: a tuned session for tests and benches, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL: dict[str, str] = {}  # the folder of a local application that names none


def build_session(
    cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **settings: str
) -> SparkSession:
    """A local session for tests and benches. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewell")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the session names in ``spark.checkpoint.dir``.

    Every executor and a restarted driver must see what is written here, so a machine-local
    folder is accepted only when the whole application is one local process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL:
            _LOCAL[application] = tempfile.mkdtemp(prefix="tidewell-")
        base = _LOCAL[application]
    return f"{base.rstrip('/')}/tidewell/{label}-{uuid.uuid4().hex[:12]}"
