import pytest
from pyspark.sql import functions as F, types as T

from tidewell import fs, open_sink, open_table, tables
from tidewell.operators import pack_rows
from tidewell.streaming import run_into_table, stream_into_table

from . import meters


@pytest.fixture
def source(lake, spark):
    table = lake.create_table("power", meters.spec(order_by=("phase",)))
    table.append(meters.frame(spark, copies=True), batch="history")
    return table


@pytest.fixture
def target(lake):
    return lake.create_table("power_sink", meters.spec("sink_meters", order_by=("phase",)))


@pytest.fixture
def topic(lake, source):
    return lake.create_topic("topic_meters", source, meters.NAMES)


def test_earliest_reads_the_history(topic, target):
    group = topic.group("g")
    run_into_table(topic.read(group, "earliest"), target, group.checkpoint)
    assert target.read().count() == 18
    assert meters.total(target.read()) == 1221 * 3


def test_latest_reads_what_comes_later_and_goes_on_from_there(topic, source, target, spark):
    group = topic.group("g")
    run_into_table(topic.read(group, "latest"), target, group.checkpoint)
    assert target.read().count() == 0
    tomorrow = meters.frame(spark).withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    source.append(tomorrow.where("groupid = 1"), batch="later")
    # a later start goes on from the first one, whatever the option says
    run_into_table(topic.read(group, "earliest"), target, group.checkpoint)
    assert meters.total(target.read()) == 606 * 3
    source.append(tomorrow.where("groupid = 2"), batch="later-still")
    run_into_table(topic.read(group, "latest"), target, group.checkpoint)
    assert meters.total(target.read()) == 1221 * 3


def test_a_stream_started_again_with_nothing_new_writes_nothing(topic, target):
    group = topic.group("g")
    for _ in range(2):
        run_into_table(topic.read(group, "earliest"), target, group.checkpoint)
    assert len(target.batches()) == 1


def test_a_crash_after_the_write_is_replayed_once(topic, source, target, spark):
    for i in range(3):
        rows = meters.frame(spark).withColumn("ts", F.col("ts") + F.expr(f"interval {i + 1} days"))
        source.append(rows, batch=f"day-{i}")
    group = topic.group("g")

    def crash(number):
        if number == 2:
            raise RuntimeError("injected")

    with pytest.raises(Exception, match="injected"):
        run_into_table(
            topic.read(group, "earliest", files_per_batch=1), target, group.checkpoint, after_write=crash
        )
    run_into_table(topic.read(group, "earliest", files_per_batch=1), target, group.checkpoint)
    assert sorted(target.read().collect()) == sorted(source.read().collect())
    assert len(target.batches()) == 4


def test_two_streams_do_not_replace_each_other(topic, target, lake, spark):
    other = lake.create_table("power", meters.spec("others", order_by=("phase",)))
    rows = meters.frame(spark)
    other.append(rows.withColumn("tbname", F.concat(F.lit("x"), "tbname")))
    second = lake.create_topic("topic_others", other)
    for one in (topic, second):
        run_into_table(one.read(one.group("g"), "earliest"), target, one.group("g").checkpoint)
    assert target.read().count() == 36


def test_a_topic_is_a_stored_select(lake, source, spark):
    topic = lake.create_topic("hot", source, ["ts", "voltage * 2 as doubled", "tbname"], "`current` > 90")
    stream = lake.topic("hot").read(topic.group("g"), "earliest")
    assert stream.isStreaming and stream.columns == ["ts", "doubled", "tbname"]
    query = stream.writeStream.format("memory").queryName("hot_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("hot_rows").agg(F.sum("doubled")).first()[0] == 203 * 3 * 2


def test_positions_of_a_topic(lake, spark, tmp_path):
    """Positions count the rows of a vgroup from 0 without gaps, write after write, also of a write again."""
    source = lake.create_table("power", meters.spec(order_by=("phase",), buckets=3, numbered=True))
    topic = lake.create_topic("numbered", source, meters.NAMES)
    group = topic.group("g")
    written = []
    for number, (rows, batch) in enumerate(((meters.frame(spark, copies=True), "a"), (meters.frame(spark), "b"), (meters.frame(spark), "b"))):
        rows = rows.withColumn("ts", F.col("ts") + F.expr(f"interval {number} hours"))
        source.append(rows, batch=batch)
        written.append({r["tbname"]: r["count"] for r in rows.groupBy("tbname").count().collect()})
        stream = topic.read(group, "earliest", with_positions=True)
        assert stream.columns == [*meters.NAMES, "vgroup", "position"]
        out = stream.writeStream.format("parquet").option("checkpointLocation", group.checkpoint)
        out.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        read = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
        assert len(read) == sum(sum(w.values()) for w in written)
        vgroups = {}
        for r in read:
            vgroups.setdefault(r["vgroup"], []).append(r)
        for among in vgroups.values():
            among.sort(key=lambda r: r["position"])
            assert [r["position"] for r in among] == list(range(len(among)))
            names = {r["tbname"] for r in among}
            starts = [sum(w[n] for w in written[:k] for n in names) for k in range(len(written))]
            last = among[starts[-1] :]  # what was written last, in the order of its time
            for name in names:
                times = [r["ts"] for r in last if r["tbname"] == name]
                assert times == sorted(times) and len(times) == written[-1][name]
        assert len({(r["tbname"], r["vgroup"]) for r in read}) == 2
    with pytest.raises(ValueError, match="not numbered"):
        plain = lake.create_table("power", meters.spec("plain"))
        lake.create_topic("plain", plain).read(group, "earliest", with_positions=True)
    source.compact()
    assert source.read().count() == 18 + 12


def test_a_group_starts_after_one_number(topic, source, spark):
    one = meters.frame(spark).limit(1)
    for i in range(5):
        source.append(one, batch=f"b{i}")
    group = topic.group("late")
    topic.read(group, "latest")
    assert fs.read_json(spark, group.start_file) == {"reset": "latest", "after": 6}
    source.append(one, batch="b0")  # written again: the topic sees it, as what comes later
    query = topic.read(group, "latest").writeStream.format("memory").queryName("late_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("late_rows").count() == 1


def test_rejects_of_a_stream(topic, target, spark, tmp_path):
    group = topic.group("g")
    voltage = F.when(F.col("tbname") == "d1002", F.lit("high")).otherwise(F.col("voltage").cast("string"))
    rows = topic.read(group, "earliest").withColumn("voltage", voltage)
    run_into_table(rows, target, group.checkpoint, rejects=f"file://{tmp_path}/rejects")
    assert meters.total(target.read()) == 606 * 3
    rejects = target.read_rejects(f"file://{tmp_path}/rejects", rows.schema).collect()
    assert len(rejects) == 12 and {(r["voltage"], *r["rejected"]) for r in rejects} == {("high", "voltage")}


def test_elements_that_are_batches(topic, target):
    group = topic.group("g")
    packed = pack_rows(topic.read(group, "earliest"), 5)
    run_into_table(packed, target, group.checkpoint, packed="rows")
    assert meters.total(target.read()) == 1221 * 3


def test_a_polling_stream(topic, source, target, spark):
    group = topic.group("g")
    query = stream_into_table(topic.read(group, "earliest"), target, group.checkpoint, poll_ms=200)
    try:
        query.processAllAvailable()
        assert meters.total(target.read()) == 1221 * 3
        source.append(meters.frame(spark).withColumn("ts", F.col("ts") + F.expr("interval 1 day")))
        query.processAllAvailable()
        assert meters.total(target.read()) == 1221 * 6
    finally:
        query.stop()


def test_only_appended_rows_are_taken(topic, target, spark):
    stream = topic.read(topic.group("g"), "earliest")
    with pytest.raises(ValueError, match="output mode 'update'"):
        stream_into_table(stream, target, topic.group("g").checkpoint, output_mode="update")
    with pytest.raises(ValueError, match="not a stream"):
        stream_into_table(meters.frame(spark), target, topic.group("g").checkpoint)


def test_wrong_starts(topic, lake):
    with pytest.raises(ValueError, match="'middle'"):
        topic.read(topic.group("g"), "middle")
    with pytest.raises(ValueError, match="no topic"):
        lake.topic("nothing")


def test_a_stream_table_by_options(lake, topic, target, spark):
    options = {
        "td.jdbc.mode": "cdc",
        "bootstrap.servers": lake.root,
        "topic": "topic_meters",
        "group.id": "group_20",
        "auto.offset.reset": "earliest",
        "enable.auto.commit": "false",
    }
    stream = open_table(spark, options, meters.spec().schema, view="stream_meters")
    hot = spark.sql("SELECT * FROM stream_meters WHERE `current` > 40")
    assert stream.isStreaming
    sink = open_sink(
        spark,
        {"td.jdbc.url": lake.root, "sink.db.name": "power_sink", "sink.supertable.name": "sink_meters"},
        meters.NAMES,
    )
    sink.insert_stream(hot, options).awaitTermination()
    assert meters.total(sink.store.read()) == 1221 * 3


def stream_options(lake, **more):
    return {
        "td.jdbc.mode": "cdc", "url": lake.root, "topic": "topic_meters", "group.id": "g",
        "auto.offset.reset": "earliest", **more,
    }


def sink_options(lake, **more):
    return {"td.jdbc.url": lake.root, "sink.db.name": "power_sink", "sink.supertable.name": "sink_meters", **more}


def test_a_batched_stream_table_into_a_batched_sink(lake, topic, target, spark):
    options = stream_options(lake, **{"td.batch.mode": "true", "batch.size": "5"})
    stream = open_table(spark, options)
    assert stream.columns == ["rows"]
    sink = open_sink(spark, sink_options(lake, **{"td.batch.mode": "true"}), meters.NAMES)
    sink.insert_stream(stream, options).awaitTermination()
    assert meters.total(target.read()) == 1221 * 3


def test_user_records_through_a_stream(lake, topic, target, spark):
    options = stream_options(lake)
    record = "device string, place string, grp int, at timestamp, volts int, amps float, angle float"
    names = ["tbname", "location", "groupid", "ts", "voltage", "current", "phase"]
    pairs = dict(zip(names, T.StructType.fromDDL(record).names))
    stream = open_table(
        spark, options, T.StructType.fromDDL(record), convert=lambda batch: batch.rename(columns=pairs)
    )
    back = {v: k for k, v in pairs.items()}
    sink = open_sink(spark, sink_options(lake), names, convert=lambda batch: batch.rename(columns=back))
    sink.insert_stream(stream, options).awaitTermination()
    assert sorted(target.read().collect()) == sorted(
        lake.table("power", "meters").read().collect()
    )


def test_the_poll_interval_of_the_source_paces_the_stream(lake, topic, target, spark):
    options = stream_options(lake, **{"poll.interval_ms": "100"})
    sink = open_sink(spark, sink_options(lake))
    query = sink.insert_stream(open_table(spark, options), options, until_stopped=True)
    try:
        query.processAllAvailable()
        assert query.isActive
        assert meters.total(target.read()) == 1221 * 3
    finally:
        query.stop()


def test_a_stream_into_a_database_sends_each_micro_batch(lake, topic, spark, monkeypatch):
    sent = []
    monkeypatch.setattr(tables, "write_jdbc", lambda rows, *settings: sent.append((rows.count(), *settings)))
    options = stream_options(lake)
    target = {
        "td.jdbc.url": "jdbc:some://host:6041/power", "sink.db.name": "power", "sink.supertable.name": "m",
        "sink.batch.size": "20", "sink.parallelism": "3",
    }
    open_sink(spark, target).insert_stream(open_table(spark, options), options).awaitTermination()
    assert [(n, table, rows, writers) for n, _, table, rows, writers, _ in sent] == [
        (meters.frame(spark, copies=True).count(), "power.m", 20, 3)
    ]


def test_the_parallelism_of_a_sink_holds_for_streams(lake, topic, target, spark, monkeypatch):
    asked = []
    append = type(target).append
    monkeypatch.setattr(
        type(target), "append", lambda self, rows, **named: (asked.append(named["writers"]), append(self, rows, **named))
    )
    options = stream_options(lake)
    sink = open_sink(spark, sink_options(lake, **{"sink.parallelism": "2"}))
    sink.insert_stream(open_table(spark, options), options).awaitTermination()
    assert asked == [2]
    assert meters.total(target.read()) == 1221 * 3


def test_a_write_that_breaks_off_is_seen_by_no_stream(topic, source, target, spark):
    rows = meters.frame(spark).withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    broken = rows.withColumn(
        "voltage", F.when(F.col("groupid") == 1, F.raise_error(F.lit("injected")).cast("int")).otherwise(F.col("voltage"))
    )
    with pytest.raises(Exception, match="injected"):
        source.append(broken, batch="broken")
    group = topic.group("g")
    run_into_table(topic.read(group, "earliest"), target, group.checkpoint)
    assert sorted(target.read().collect()) == sorted(source.read().collect())
    assert source.batches() == ["history"]
