import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell import Lake, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # many small jobs: the quick compiler and few tasks save most of the time
    session = build_session(shuffle_partitions=4, **{"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"file://{tmp_path}/lake")
