"""Stored tables: parquet below one folder.

``commits/<n>.json``
    every write takes the next number by creating this file, which must be new. From then on it
    counts. The file lists the batches of the log as they are after the write, so a read or a write
    opens one file, however many there were before.
``log/_commit=<n>/_batch=<id>/period=/bucket=``
    the rows of the write, as one batch or several. They are written below ``staged/`` and moved here
    as a whole, so that streams over the log see no part of a write that breaks off. Whoever finds a
    commit that has not been moved yet moves it. Writing an id again replaces that batch by the one
    with the larger number; nothing is deleted for it. The number also decides between two rows with an
    equal key and order: the later one stays.
    Where tags are fixed and there are buckets, its ``_subtables`` list the sub-tables of the write, so
    that predicates on tags become sets of buckets.
``base/gen=<n>/period=/bucket=``
    what compaction made of the log: one row per key. Its ``_folded.json``, written last,
    names the batches it holds and the periods it replaces in older generations.

Rows with an equal key collapse when the table is read. Periods in the base alone, or in a single
batch without repeated keys, don't need that and are read as they are, without a shuffle. Topics
see every row that was written.

In a *numbered* table every row of the log has a position in its bucket: 0, 1, 2 and so on without a
gap. A file's name says where its first row stands, so that numbering moves no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import fs
from ..model import TBNAME, TableSpec, bucket_of, period_of
from ..operators.binding import RAW, bind_rows, check_rows
from ..operators.collapse import collapse_rows
from ..operators.slices import read_tables

MAX_ROWS_PER_FILE = 20_000_000
COMMIT = "_commit"  # the number of the write; NULL in the base, which is older than the log
BATCH = "_batch"
REJECTS = "_rejects"
SALTS = 8
#: Beside the files of a commit or a generation, where Spark's listings pass it over: its sub-tables.
SUB_TABLES = "_subtables"


class TableStore:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self._seen = 0  # a commit that is there for certain
        self._described: dict[str, dict] = {}

    @staticmethod
    def create(spark: SparkSession, path: str, spec: TableSpec) -> "TableStore":
        if fs.exists(spark, f"{path.rstrip('/')}/table.json"):
            raise ValueError(f"there is a table at {path} already")
        fs.write_json(spark, f"{path.rstrip('/')}/table.json", spec.to_json())
        fs.make_folder(spark, f"{path.rstrip('/')}/log")
        fs.make_folder(spark, f"{path.rstrip('/')}/commits")
        return TableStore(spark, path, spec)

    @staticmethod
    def open(spark: SparkSession, path: str) -> "TableStore":
        described = f"{path.rstrip('/')}/table.json"
        if not fs.exists(spark, described):
            raise ValueError(f"there is no table at {path}")
        return TableStore(spark, path, TableSpec.from_json(fs.read_json(spark, described)))

    # -- write ---------------------------------------------------------------------------

    def append(
        self,
        df: DataFrame,
        batch: str | None = None,
        fields: Sequence[str] | None = None,
        by: str = "name",
        writers: int | None = None,
    ) -> None:
        """Write rows as one batch. The same ``batch`` id again replaces what it wrote before; once
        a compaction has taken it into the base, that is an error."""
        batch = batch or uuid.uuid4().hex
        self._check_batches([batch])
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._write(bind_rows(df, self.spec, fields, by), f"{staged}/{BATCH}={batch}", writers)
        self._commit_batches(staged, [batch])

    def append_batches(
        self, df: DataFrame, batch_of: Column, batches: Sequence[str], writers: int | None = None
    ) -> None:
        """Write rows as several batches in one job and one commit. ``batch_of`` names the batch of each
        row; those of no listed batch are left out, and a listed batch may be empty."""
        self._check_batches(batches)
        marked = df.withColumn(BATCH, batch_of).where(F.col(BATCH).isNotNull())
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._write(bind_rows(marked, self.spec, kept=[BATCH]), staged, writers)
        self._commit_batches(staged, batches)

    def append_checked(
        self, df: DataFrame, rejects: str, batch: str | None = None, writers: int | None = None
    ) -> dict[str, int]:
        """Write the rows that convert as one batch, and the others as they came, with the names of the
        columns at fault, below the folder ``rejects``: one job, which reads the input once. Returns
        how many there are of both. The same id again replaces both outputs."""
        batch = batch or uuid.uuid4().hex
        self._check_batches([batch])
        told = Observation()
        bad = F.col(RAW).isNotNull()
        rows = check_rows(df, self.spec).observe(
            told, F.count_if(~bad).alias("written"), F.count_if(bad).alias("rejected")
        )
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._write(rows.withColumn(BATCH, F.when(bad, REJECTS).otherwise(batch)), staged, writers)
        place = f"{rejects.rstrip('/')}/{BATCH}={batch}"
        fs.delete(self.spark, place)
        fs.make_folder(self.spark, f"{staged}/{BATCH}={REJECTS}")
        fs.move(self.spark, f"{staged}/{BATCH}={REJECTS}", place)
        self._commit_batches(staged, [batch])
        try:
            return told.get
        except Py4JJavaError:  # rows that are known to be none are not run, so nothing is observed
            return {"written": 0, "rejected": 0}

    def read_rejects(self, rejects: str, schema: T.StructType, out: str = "rejected") -> DataFrame:
        """The rows that ``append_checked`` turned away, as they came (``schema``), with the columns at fault."""
        stored = T.StructType([T.StructField(RAW, schema), T.StructField(out, T.ArrayType(T.StringType()))])
        rows = self.spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(rejects)
        return rows.select(f"{RAW}.*", out)

    def _check_batches(self, batches: Sequence[str]) -> None:
        folded = self._folded()
        for batch in batches:
            if not re.fullmatch(r"[\w.-]+", batch):
                raise ValueError(f"a batch id has letters, digits, '_', '.' and '-' only, not {batch!r}")
            if batch in folded:
                raise ValueError(f"batch {batch!r} is part of the base and can no longer be replaced")

    def _commit_batches(self, staged: str, batches: Sequence[str]) -> None:
        for batch in batches:  # one without rows is a batch, too
            fs.make_folder(self.spark, f"{staged}/{BATCH}={batch}")
        repeating = self._with_repeated_keys(staged) if self.spec.key else set(batches)
        periods: dict[str, list[str]] = {batch: [] for batch in batches}
        if self.spec.layout:
            for path in fs.glob(self.spark, f"{staged}/{BATCH}=*/period=*"):
                batch, period = path.split("/")[-2:]
                periods[batch.removeprefix(f"{BATCH}=")].append(period.removeprefix("period="))
        else:
            periods = {batch: [""] for batch in batches}
        described = {b: {"periods": periods[b], "distinct": b not in repeating} for b in batches}
        self._list_sub_tables(staged)
        self._commit(staged, described)

    @property
    def _has_tag_index(self) -> bool:
        """Whether sub-tables are listed at each write: where tags are functions of the sub-table, and there
        are buckets to leave out."""
        return self.spec.super_table and self.spec.fixed_tags and bool(self.spec.tags) and self.spec.buckets > 1

    def _list_sub_tables(self, folder: str) -> None:
        """The sub-tables of what was written, with their tags and buckets, from these columns only."""
        if self._has_tag_index:
            rows = self.spark.read.schema(self._stored_schema).parquet(folder)
            listed = rows.groupBy(TBNAME, "bucket").agg(*[F.max(F.col(f"`{t}`")).alias(t) for t in self.spec.tags])
            listed.write.parquet(f"{folder}/{SUB_TABLES}")

    def _commit(self, staged: str, described: dict[str, dict]) -> None:
        """Take the next number for what is staged and move it into the log."""
        counts = self._rows_of_files(staged) if self.spec.numbered else {}
        folded = self._folded()
        while True:
            number, state = self._state()
            live = {b: of for b, of in state["live"].items() if b not in folded}
            live |= {b: {**of, "commit": number + 1} for b, of in described.items()}
            counts, ends = self._numbered_files(counts, state["ends"])
            commit = {"staged": staged, "live": live, "ends": ends}
            if fs.publish_json(self.spark, self._commit_file(number + 1), commit):
                break
        self._finish(number + 1, staged)

    def _commit_file(self, number: int) -> str:
        return f"{self.path}/commits/{number:012d}.json"

    def _commit_folder(self, number: int) -> str:
        return f"{COMMIT}={number:012d}"

    def _finish(self, number: int, staged: str) -> None:
        target = f"{self.path}/log/{self._commit_folder(number)}"
        if fs.exists(self.spark, staged):
            fs.move(self.spark, staged, target)

    def _last_commit(self) -> int:
        """The largest number taken. Numbers have no gaps, so a few looks find it."""
        low, step = self._seen, 1  # taken for certain
        while fs.exists(self.spark, self._commit_file(low + step)):
            low, step = low + step, step * 2
        while step > 1:
            step //= 2
            if fs.exists(self.spark, self._commit_file(low + step)):
                low += step
        self._seen = low
        return low

    def _state(self) -> tuple[int, dict]:
        """The last commit and what it says; one that was not moved into the log yet is moved now."""
        number = self._last_commit()
        if not number:
            return 0, {"live": {}, "ends": {}}
        state = fs.read_json(self.spark, self._commit_file(number))
        self._finish(number, state["staged"])
        return number, state

    def _with_repeated_keys(self, staged: str) -> set[str]:
        """Batches in which a key comes twice. Found out once for each write, from the key columns only,
        so that no read has to."""
        schema = T.StructType([*self._stored_schema.fields, T.StructField(BATCH, T.StringType())])
        keys = self.spark.read.schema(schema).parquet(staged).groupBy(BATCH, *self.spec.key).count()
        return {row[BATCH] for row in keys.where("count > 1").select(BATCH).distinct().collect()}

    def _rows_of_files(self, staged: str) -> dict[str, int]:
        """The files of a write and their rows, as their footers say."""
        files = self.spark.read.schema(self._stored_schema).parquet(staged).groupBy("_metadata.file_path").count()
        return {row["file_path"]: row["count"] for row in files.collect()}

    def _numbered_files(self, counts: dict[str, int], ends: dict[str, int]) -> tuple[dict[str, int], dict[str, int]]:
        """Rename the files such that each bucket's go on from its end, in the order of their periods."""
        ends, renamed = dict(ends), {}
        for path in sorted(counts, key=lambda p: [re.sub(r"^at\d+-", "", part) for part in p.split("/")]):
            folder, name = path.rsplit("/", 1)
            bucket = folder.rsplit("/", 1)[1].removeprefix("bucket=") if self.spec.super_table else "0"
            start = ends.get(bucket, 0)
            new = f"at{start:018d}-" + re.sub(r"^at\d+-", "", name)
            if new != name:
                fs.rename(self.spark, path, new)
            renamed[f"{folder}/{new}"] = counts[path]
            ends[bucket] = start + counts[path]
        return renamed, ends

    def _write(self, rows: DataFrame, target: str, writers: int | None = None) -> None:
        layout = self.spec.layout
        folders = [*([BATCH] if BATCH in rows.columns else []), *layout]
        if layout:
            # The hint lets the runtime split a large period and bucket over several tasks and
            # put small ones together; the sort gives each file narrow key ranges.
            rows = rows.withColumns(layout)
            hinted = [writers, *folders] if writers else folders
            if self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
                rows = rows.hint("rebalance", *hinted)
            else:
                salt = F.pmod(F.xxhash64(self.spec.time), F.lit(SALTS))
                rows = rows.repartition(*hinted, salt)
            order = self.spec.key if self.spec.super_table else [self.spec.time]
            rows = rows.sortWithinPartitions(*folders, *order)
        elif writers:
            rows = rows.hint("rebalance", writers)
        writer = rows.write.mode("overwrite").options(
            maxRecordsPerFile=MAX_ROWS_PER_FILE, partitionOverwriteMode="static", **self.spec.file_options
        )
        (writer.partitionBy(*folders) if folders else writer).parquet(target)

    # -- what there is -------------------------------------------------------------------

    def committed(self, batch: str) -> bool:
        return batch in self.committed_batches()

    def folded(self, batch: str) -> bool:
        """Whether a compaction has taken the batch into the base."""
        return batch in self._folded()

    def batches(self) -> list[str]:
        """Ids of the batches in the log that the base does not hold."""
        folded = self._folded()
        return sorted(b for b in self._state()[1]["live"] if b not in folded)

    def committed_batches(self) -> set[str]:
        """Ids of all batches that count, in the log or in the base."""
        return {*self._state()[1]["live"], *self._folded()}

    def last_commit(self) -> int:
        """The number of the last write, 0 before the first."""
        return self._last_commit()

    def _generations(self) -> list[tuple[int, dict]]:
        found = fs.glob(self.spark, f"{self.path}/base/gen=*/_folded.json")
        numbered = []
        for path in found:
            if path not in self._described:  # such a file never changes
                self._described[path] = fs.read_json(self.spark, path)
            numbered.append((int(path.split("/")[-2].removeprefix("gen=")), self._described[path]))
        return sorted(numbered, key=lambda pair: pair[0])

    def _folded(self) -> set[str]:
        return {batch for _, made in self._generations() for batch in made["batches"]}

    def _by_period(self, batches: dict[str, dict]) -> dict[str, list[str]]:
        """The batches that have rows of a period, by period; one period without a layout."""
        periods: dict[str, list[str]] = {}
        for batch, described in batches.items():
            for period in described["periods"]:
                periods.setdefault(period, []).append(batch)
        return periods

    def _periods_of(self, batches: Sequence[str]) -> list[str]:
        live = self._state()[1]["live"]
        return sorted(self._by_period({b: live[b] for b in batches}))

    # -- read ----------------------------------------------------------------------------

    @property
    def _stored_schema(self) -> T.StructType:
        layout = [T.StructField("period", T.DateType()), T.StructField("bucket", T.IntegerType())]
        layout = [f for f in layout if f.name in self.spec.layout]
        return T.StructType([*self.spec.schema.fields, T.StructField(COMMIT, T.LongType()), *layout])

    def _files(self, root: str, folders: Sequence[str]) -> DataFrame | None:
        if not folders:
            return None
        paths = [f"{self.path}/{root}/{folder}" for folder in folders]
        reader = self.spark.read.schema(self._stored_schema).option("basePath", f"{self.path}/{root}")
        return reader.parquet(*paths).select(*self._stored_schema.names)

    def _base_folders(self, generations: Sequence[tuple[int, dict]]) -> dict[str, str]:
        """The base as folders: for every period the newest generation that holds it."""
        folders: dict[str, str] = {}
        for number, made in generations:
            if made["periods"] is None:
                folders = {"": f"gen={number}"}
            else:
                folders.update({p: f"gen={number}/period={p}" for p in made["periods"]})
        return folders

    def read(
        self,
        start: datetime | None = None,
        end: datetime | None = None,
        tables: Sequence[str] | None = None,
        tags: Sequence[str] | None = None,
    ) -> DataFrame:
        """The table's rows, one per key, as of now.

        ``start`` (inclusive), ``end`` (exclusive) and ``tables`` restrict the key; the derived
        conditions on ``period`` and ``bucket`` leave out whole folders. Predicates ``tags`` on fixed tags
        leave out buckets without a sub-table that matches any; rows of the others are not tested. Conditions on other columns
        belong on the result: they must not see rows that a later one has replaced.
        """
        base, log, periods = self._current()
        buckets = self._buckets_of_tags(base, log, tags) if tags is not None else None
        whole = [f for period, f in base.items() if period not in periods]
        rewritten = [f for period, f in base.items() if period in periods]
        single = {
            p
            for p, among in periods.items()
            # without a key no row replaces another
            if not self.spec.key or (len(among) == 1 and log[among[0]]["distinct"] and p not in base)
        }
        alone = self._log_folders(log, single)
        mixed = self._log_folders(log, periods.keys() - single)
        collapsed = _union(self._files("base", rewritten), self._files("log", mixed))
        collapsed = self._collapsed(self._restricted(collapsed, start, end, tables, buckets))
        rows = _union(self._files("base", whole), self._files("log", alone))
        rows = _union(self._restricted(rows, start, end, tables, buckets), collapsed)
        if rows is None:
            rows = self.spark.createDataFrame([], self._stored_schema)
        return rows.select(*self.spec.schema.names)

    def _current(self) -> tuple[dict[str, str], dict[str, dict], dict[str, list[str]]]:
        """Base folders by period, log batches not yet folded, and those by the periods they touch."""
        _, state = self._state()  # before the base, so that what is folded meanwhile is not missed
        generations = self._generations()
        folded = {batch for _, made in generations for batch in made["batches"]}
        fresh = {b: described for b, described in state["live"].items() if b not in folded}
        return self._base_folders(generations), fresh, self._by_period(fresh)

    def _batch_folder(self, batch: str, described: dict) -> str:
        return f"{self._commit_folder(described['commit'])}/{BATCH}={batch}"

    def _log_folders(self, log: dict[str, dict], wanted) -> list[str]:
        """The folders of the wanted periods: one for a batch that has no others."""
        folders = []
        for batch, described in log.items():
            folder, touched = self._batch_folder(batch, described), described["periods"]
            chosen = [p for p in touched if p in wanted]
            if len(chosen) < len(touched):
                folders += [f"{folder}/period={p}" for p in chosen]
            elif chosen:
                folders.append(folder)
        return folders

    def _sub_tables(self, base: dict[str, str], log: dict[str, dict]) -> DataFrame | None:
        """The sub-tables listed beside the commits and generations that are in use."""
        commits = {self._commit_folder(described["commit"]) for described in log.values()}
        folders = [f"{self.path}/log/{c}" for c in sorted(commits)]
        folders += sorted({f"{self.path}/base/{folder.split('/')[0]}" for folder in base.values()})
        if not self._has_tag_index or not folders:
            return None
        kinds = {f.name: f for f in self.spec.schema.fields}
        schema = T.StructType([kinds[TBNAME], T.StructField("bucket", T.IntegerType()), *[kinds[t] for t in self.spec.tags]])
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{SUB_TABLES}" for folder in folders])

    def _buckets_of_tags(self, base: dict[str, str], log: dict[str, dict], tags: Sequence[str]) -> list[int] | None:
        """The buckets that hold a sub-table which matches any predicate; None if the listed tags can't tell."""
        listed = self._sub_tables(base, log)
        if listed is None:
            return None
        try:
            matching = listed.where(" OR ".join(f"({tag})" for tag in tags) if tags else "false")
        except AnalysisException:  # a predicate on other columns than tags
            return None
        return [row["bucket"] for row in matching.select("bucket").distinct().collect()]  # as many as there are buckets

    def _restricted(self, rows: DataFrame | None, start, end, tables, buckets=None) -> DataFrame | None:
        if rows is None:
            return None
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        moment = F.col(self.spec.time)
        if start is not None:
            rows = rows.where(moment >= _instant(start))
            if self.spec.layout:
                rows = rows.where(F.col("period") >= period_of(_instant(start), self.spec.period))
        if end is not None:
            rows = rows.where(moment < _instant(end))
            if self.spec.layout:
                rows = rows.where(F.col("period") <= period_of(_instant(end), self.spec.period))
        if tables is not None:
            names = list(dict.fromkeys(tables))
            if "bucket" in self.spec.layout:
                rows = rows.where(F.col("bucket").isin(self._buckets_of(names)))
            rows = read_tables(rows, names)
        return rows

    def _buckets_of(self, names: Sequence[str]) -> list[int]:
        """The buckets of a list of sub-tables, worked out in one expression over the list."""
        listed = self.spark.createDataFrame([(list(names),)], f"`{TBNAME}` array<string>")
        buckets = F.array_distinct(F.transform(TBNAME, lambda n: bucket_of(n, self.spec.buckets)))
        return sorted(listed.select(buckets).first()[0])

    def _collapsed(self, rows: DataFrame | None) -> DataFrame | None:
        if rows is None or not self.spec.key:
            return rows
        # Period and bucket are functions of the key: as part of it they change nothing, and
        # conditions on them still reach the scan. Fixed tags are functions of it by promise.
        key = [*self.spec.key, *self.spec.layout, *(self.spec.tags if self.spec.fixed_tags else [])]
        if self.spec.distinct_order:
            return collapse_rows(rows.drop(COMMIT), key, self.spec.order_by, True).withColumn(
                COMMIT, F.lit(None).cast("long")
            ).select(*rows.columns)
        return collapse_rows(rows, key, [*self.spec.order_by, COMMIT])

    def tags(self) -> DataFrame:
        """One row per sub-table: its name and its tags, as of its latest row.

        Fixed tags of a table with buckets are listed at each write and read from there. Else they come from
        the rows; copies do no harm then, so nothing is collapsed: tasks send one row per sub-table.
        """
        base, log, _ = self._current()
        listed = self._sub_tables(base, log)
        if listed is not None:
            return listed.groupBy(TBNAME).agg(*[F.max(F.col(f"`{t}`")).alias(t) for t in self.spec.tags])
        folders = [self._batch_folder(b, described) for b, described in log.items()]
        rows = _union(self._files("base", list(base.values())), self._files("log", folders))
        if rows is None:
            rows = self.spark.createDataFrame([], self._stored_schema)
        latest = F.max(F.struct(self.spec.time, *self.spec.order_by, COMMIT, *self.spec.tags)).alias("_latest")
        return rows.groupBy(TBNAME).agg(latest).select(TBNAME, *[f"_latest.{t}" for t in self.spec.tags])

    # -- maintenance ---------------------------------------------------------------------

    def compact(self) -> None:
        """Fold the log into the base. Only periods with rows in the log are written anew."""
        base, fresh, touched = self._current()
        if not fresh:
            return
        periods = sorted(touched) if self.spec.layout else None
        replaced = self._files("base", [f for period, f in base.items() if period in touched])
        log = self._files("log", [self._batch_folder(b, described) for b, described in fresh.items()])
        rows = self._collapsed(_union(replaced, log)).select(*self.spec.schema.names)
        number = self._generations()[-1][0] + 1 if self._generations() else 0
        while not fs.claim(self.spark, f"{self.path}/claims/{number}"):  # another compaction has it
            number += 1
        target = f"{self.path}/base/gen={number}"
        self._write(rows, target)
        self._list_sub_tables(target)
        fs.write_json(self.spark, f"{target}/_folded.json", {"batches": sorted(fresh), "periods": periods})

    def vacuum(self) -> None:
        """Delete batches that the base holds or that later ones replace, and what newer generations
        replace of the base. Streams must have read the batches, and no query may still be running on
        any of it."""
        number, state = self._state()
        folded = self._folded()
        kept = {self._batch_folder(b, of) for b, of in state["live"].items() if b not in folded}
        for path in fs.glob(self.spark, f"{self.path}/log/{COMMIT}=*/{BATCH}=*"):
            commit, batch = path.split("/")[-2:]
            if f"{commit}/{batch}" not in kept and int(commit.removeprefix(f"{COMMIT}=")) <= number:
                fs.delete(self.spark, path)
        generations = self._generations()
        used = set(self._base_folders(generations).values())
        for number, made in generations:
            for period in made["periods"] or [None]:
                folder = f"gen={number}" if period is None else f"gen={number}/period={period}"
                if folder not in used:
                    pattern = f"{self.path}/base/{folder}" + ("/part-*" if period is None else "")
                    for path in fs.glob(self.spark, pattern):
                        fs.delete(self.spark, path)


def _union(left: DataFrame | None, right: DataFrame | None) -> DataFrame | None:
    return left.union(right) if left is not None and right is not None else left or right


def _instant(moment: datetime) -> Column:
    """A literal instant; a date and time without a zone is in UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    micros = (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))
