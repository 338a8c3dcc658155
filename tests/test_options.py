import pytest

from tidewell import TableOptions, open_sink, open_table

SOURCE = {"td.jdbc.mode": "source", "td.jdbc.url": "file:/lake/power", "scan.query": "select 1"}
CDC = {"td.jdbc.mode": "cdc", "topic": "t", "group.id": "g"}
SINK = {"td.jdbc.url": "file:/lake", "sink.db.name": "power", "sink.table.name": "t"}


def without(options, name):
    return {k: v for k, v in options.items() if k != name}


def test_defaults():
    opts = TableOptions({})
    assert opts.get("auto.offset.reset") == "latest"
    assert opts.number("poll.interval_ms") == 500
    assert opts.number("sink.batch.size") == 500
    assert opts.number("batch.size") == 2000
    assert opts.get("charset") == "UTF-8"
    assert opts.flag("td.batch.mode") is False
    assert opts.number("sink.parallelism") is None


def test_complete_options_pass():
    TableOptions(SOURCE).check_read()
    TableOptions(CDC).check_read()
    TableOptions(SINK).check_sink()


@pytest.mark.parametrize("name", ["td.jdbc.url", "scan.query"])
def test_source_needs(name):
    with pytest.raises(ValueError, match=name):
        TableOptions(without(SOURCE, name)).check_read()


@pytest.mark.parametrize("name", ["topic", "group.id"])
def test_stream_needs(name):
    with pytest.raises(ValueError, match=name):
        TableOptions(without(CDC, name)).check_read()


def test_stream_needs_an_address():
    with pytest.raises(ValueError, match="url or bootstrap.servers"):
        TableOptions({**CDC, "bootstrap.servers": ""}).check_read()
    TableOptions({**CDC, "bootstrap.servers": "", "url": "file:/lake"}).check_read()


@pytest.mark.parametrize("name", ["td.jdbc.url", "sink.db.name", "sink.table.name"])
def test_sink_needs(name):
    with pytest.raises(ValueError, match=name):
        TableOptions(without(SINK, name)).check_sink()


def test_the_super_table_wins():
    assert TableOptions({**SINK, "sink.supertable.name": "s"}).sink_table == "s"


@pytest.mark.parametrize("mode", [None, "", "sink", "other"])
def test_other_modes_do_not_read(spark, mode):
    options = without(SOURCE, "td.jdbc.mode") if mode is None else {**SOURCE, "td.jdbc.mode": mode}
    with pytest.raises(ValueError, match="td.jdbc.mode"):
        open_table(spark, options)


@pytest.mark.parametrize(
    "wrong",
    [
        {**CDC, "auto.offset.reset": "middle"},
        {**CDC, "poll.interval_ms": "soon"},
        {**CDC, "poll.interval_ms": "-1"},
        {**SOURCE, "td.batch.mode": "true", "batch.size": "0"},
    ],
)
def test_wrong_values(wrong):
    with pytest.raises(ValueError):
        TableOptions(wrong).check_read()


def test_wrong_sink_values(spark):
    with pytest.raises(ValueError, match="sink.parallelism"):
        open_sink(spark, {**SINK, "sink.parallelism": "0"})
    with pytest.raises(ValueError, match="whole number"):
        open_sink(spark, {**SINK, "sink.batch.size": "many"})


def test_unknown_options_are_an_error():
    with pytest.raises(ValueError, match="unknown table options: scan.qurey"):
        TableOptions({"scan.qurey": "select 1"})


def test_connection_options_are_passed_on_as_given():
    given = {**SOURCE, "user": "u", "timezone": "UTC-8", "enableAutoReconnect": "true"}
    assert TableOptions(given).connection == {"user": "u", "timezone": "UTC-8", "enableAutoReconnect": "true"}
