"""The SQL that yields the rows of each registered query, for DuckDB on the same files."""

from __future__ import annotations

# The meters as SQL, and the same with one row per (tbname, ts).
_M = """
M AS (
  SELECT event_id, ts, value AS current,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS voltage,
         CAST(event_id % 100 AS DOUBLE) / 100 AS phase,
         concat('loc_', CAST(user_id % 10 AS VARCHAR)) AS location,
         CAST(user_id % 10 AS INTEGER) AS groupid,
         concat('d', CAST(user_id AS VARCHAR)) AS tbname,
         event_type
  FROM events
),
K AS (
  SELECT * FROM M QUALIFY row_number() OVER (PARTITION BY tbname, ts ORDER BY event_id DESC) = 1
)
"""
_METERS = "event_id, ts, current, voltage, phase, location, groupid, tbname"
_TAGGED = "ts, current, voltage, phase, location, groupid, tbname"


def _m(body: str) -> str:
    return f"WITH {_M} {body}"


_STORED = _m(f"SELECT {_METERS} FROM K")
_RAW = _m(f"SELECT {_METERS} FROM M")
_ALL_TAGGED = _m(f"SELECT {_TAGGED} FROM M")


def _slices(index: str) -> str:
    return _m(
        f"""
        SELECT CAST({index} AS BIGINT) AS slice, COUNT(*) AS row_count, CAST(SUM(voltage) AS BIGINT) AS sum_voltage
        FROM M WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29 05:00:00' GROUP BY 1
        """
    )


_COERCED = """
, C AS (SELECT event_id, voltage * 3 AS reading, voltage % 7 = 0 AS bad_code, voltage FROM M)
"""

_HOURLY = _m(
    """
    SELECT tbname, date_trunc('hour', ts) AS hour, MAX(event_id) AS event_id,
           arg_max(voltage, event_id) AS voltage
    FROM M GROUP BY 1, 2
    """
)

ORACLES: dict[str, str] = {
    "supertable_scan": _ALL_TAGGED,
    "scan_sql": _ALL_TAGGED,
    "scan_structured": _m("SELECT ts, current, tbname FROM M WHERE voltage > 50"),
    "filter_rows": _m(f"SELECT {_TAGGED} FROM M WHERE current > 90"),
    "sum_global": _m("SELECT CAST(SUM(voltage) AS BIGINT) AS sum_voltage, COUNT(*) AS row_count FROM M"),
    "sum_by_table": _m(
        "SELECT tbname, CAST(SUM(voltage) AS BIGINT) AS sum_voltage, COUNT(*) AS row_count FROM M GROUP BY tbname"
    ),
    "dec_sum": _m(
        "SELECT tbname, CAST(SUM(CAST(current AS DECIMAL(18,2))) AS DOUBLE) AS sum_current FROM M GROUP BY tbname"
    ),
    "order_limit": _m("SELECT event_id, ts, current, tbname FROM M ORDER BY ts DESC, event_id LIMIT 100"),
    "time_slices": _slices("(epoch_us(ts) - 1704067200000000) // 21600000000"),
    "time_slice_single": _slices("0"),
    "time_slices_sum": _m(
        """
        , W AS (SELECT unnest(range(0, 88)) AS slice)
        SELECT slice, CAST(SUM(voltage) AS BIGINT) AS sum_voltage, COUNT(event_id) AS row_count
        FROM W LEFT JOIN M ON slice = (epoch_us(ts) - 1703980800000000) // 28800000000
          AND ts >= TIMESTAMP '2023-12-31' AND ts < TIMESTAMP '2024-01-29 05:00:00' AND voltage > 50
        GROUP BY slice
        """
    ),
    "time_slices_ordered": _m(
        """
        SELECT event_id, voltage, (epoch_us(ts) - 1704844800000000) // 259200000000 AS slice FROM M
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
        """
    ),
    "per_table_limit_own_time": _m(
        """
        SELECT tbname, ts AS at FROM M WHERE tbname IN ('d1', 'd2', 'd3', 'd5', 'd8', 'd13')
        QUALIFY row_number() OVER (PARTITION BY tbname ORDER BY ts) <= 4
        """
    ),
    "open_table_slices": _m(
        """
        SELECT event_id, voltage, groupid FROM K WHERE groupid < 6
        UNION ALL SELECT event_id, voltage, groupid FROM K WHERE groupid > 3 AND groupid < 8
        """
    ),
    "ddl_insert_select": _m(f"SELECT {_METERS}, CASE WHEN current > 40 THEN 'warm' ELSE 'cold' END AS part FROM K"),
    "sink_normal_range": """
        SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-06-15'
    """,
    "sink_parallelism": _STORED,
    "stream_decode": _m(
        "SELECT ts, CAST(event_id AS VARCHAR) AS event_id, CAST(voltage AS SMALLINT) AS voltage,"
        " concat(location, ' é日') AS place, tbname FROM M"
    ),
    "tag_slices": _m(
        """
        SELECT CAST(0 AS INTEGER) AS tag_slice, event_id, groupid FROM M WHERE groupid < 6
        UNION ALL
        SELECT CAST(1 AS INTEGER), event_id, groupid FROM M WHERE groupid > 3 AND groupid < 8
        """
    ),
    "table_slices": _m(
        f"""
        SELECT {_METERS} FROM M JOIN (
          SELECT DISTINCT tbname AS listed FROM M WHERE event_type = 'purchase'
          UNION ALL
          SELECT DISTINCT tbname FROM M WHERE event_type = 'error'
        ) ON tbname = listed
        """
    ),
    "per_table_topn": _m(
        f"SELECT {_METERS} FROM M QUALIFY row_number() OVER (PARTITION BY tbname ORDER BY ts, event_id) <= 5"
    ),
    "per_table_latest": _m(
        """
        SELECT event_id, tbname, row_number() OVER (PARTITION BY tbname ORDER BY ts DESC, event_id DESC) AS position
        FROM M QUALIFY position <= 40
        """
    ),
    "bounds_zone": _m("SELECT event_id, ts - INTERVAL 8 HOUR AS utc_ts FROM M"),
    "row_batches": _m(
        """
        SELECT tbname, CAST((rn - 1) // 20 AS BIGINT) AS batch, COUNT(*) AS row_count,
               MIN(event_id) AS first_id, MAX(event_id) AS last_id
        FROM (SELECT *, row_number() OVER (PARTITION BY tbname ORDER BY ts, event_id) AS rn FROM M)
        GROUP BY 1, 2
        """
    ),
    "unpack_batches": _RAW,
    "ts_millis": _m(
        "SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('millisecond', ts) AS ts_ms FROM M"
    ),
    "types_decode": _m(
        """
        SELECT event_id, CAST(current AS FLOAT) AS current, CAST(voltage AS SMALLINT) AS voltage,
               CAST(groupid AS TINYINT) AS groupid, voltage % 2 = 1 AS odd, CAST(event_id AS INTEGER) AS id_text
        FROM M
        """
    ),
    "utf8_roundtrip": _m("SELECT event_id, location, hex(encode(location)) AS location_hex FROM M"),
    "record_by_name": _m("SELECT event_id, current, voltage, phase, location, groupid, tbname FROM M"),
    "record_custom": _m(
        "SELECT event_id, concat(tbname, '@', location) AS label, CAST(voltage * 2 AS INTEGER) AS voltage FROM M"
    ),
    "map_rows": _m("SELECT event_id, concat(tbname, '|', location, '|', CAST(voltage AS VARCHAR)) AS line FROM M"),
    "json_ingest": _m(
        """
        SELECT event_id, ts, CAST(voltage + 300 AS INTEGER) AS voltage,
               concat('location_', CAST(voltage AS VARCHAR)) AS location, voltage AS groupid,
               concat('d0', CAST(voltage AS VARCHAR)) AS tbname
        FROM M
        """
    ),
    "collapse_key": _HOURLY,
    "collapse_row": _m(
        f"""
        SELECT {_METERS}, date_trunc('hour', ts) AS hour FROM M
        QUALIFY row_number() OVER (
          PARTITION BY tbname, date_trunc('hour', ts) ORDER BY voltage DESC, event_id DESC
        ) = 1
        """
    ),
    "sink_supertable": _STORED,
    "sink_tags": _m("SELECT DISTINCT tbname, location, groupid FROM M"),
    "sink_compacted": _m(
        f"""
        SELECT CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN event_id + 1000000000 ELSE event_id END AS event_id,
               {_TAGGED}
        FROM K
        """
    ),
    "table_read_pruned": _m(
        f"""
        SELECT {_METERS} FROM K
        WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00'
        """
    ),
    "lake_time_slices": _m(
        """
        SELECT CAST((epoch_us(ts) - 1704384000000000) // 86400000000 AS BIGINT) AS slice,
               COUNT(*) AS row_count, CAST(SUM(voltage) AS BIGINT) AS sum_voltage
        FROM K
        WHERE ts >= TIMESTAMP '2024-01-04 16:00:00' AND ts < TIMESTAMP '2024-01-20 04:30:00' GROUP BY 1
        """
    ),
    "lake_tag_slices": _m(
        """
        SELECT CAST(0 AS INTEGER) AS tag_slice, event_id, groupid, tbname FROM K WHERE tbname IN ('d3', 'd14', 'd15')
        UNION ALL
        SELECT CAST(1 AS INTEGER), event_id, groupid, tbname FROM K WHERE groupid = 4 AND tbname LIKE 'd1%'
        """
    ),
    "sink_normal": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "sink_bind": _RAW,
    "insert_select": _STORED,
    "values_insert": _m(
        f"""
        SELECT {_METERS} FROM K
        UNION ALL
        SELECT NULL, ts, current, voltage, phase, location, groupid, tbname FROM (VALUES
          (TIMESTAMP '2023-05-02 06:00:00', CAST(11.5 AS DOUBLE), 118, CAST(0.75 AS DOUBLE), 'loc_6', 6, 'd9006'),
          (TIMESTAMP '2023-05-02 06:20:00', CAST(12.25 AS DOUBLE), 121, CAST(0.5 AS DOUBLE), 'loc_6', 6, 'd9006'),
          (TIMESTAMP '2023-05-02 06:40:00', CAST(13.0 AS DOUBLE), 117, CAST(0.25 AS DOUBLE), 'loc_6', 6, 'd9006'),
          (TIMESTAMP '2023-05-03 21:15:30', CAST(7.75 AS DOUBLE), 233, CAST(1.5 AS DOUBLE), 'loc_8', 8, 'd9018')
        ) AS v(ts, current, voltage, phase, location, groupid, tbname)
        """
    ),
    "coerce_rows": _m(
        _COERCED
        + """
        SELECT event_id, CAST(reading AS TINYINT) AS reading, voltage AS code FROM C
        WHERE reading <= 127 AND NOT bad_code
        """
    ),
    "coerce_rejects": _m(
        _COERCED
        + """
        SELECT event_id, reading, CASE WHEN bad_code THEN 'n/a' ELSE CAST(voltage AS VARCHAR) END AS code,
               concat_ws(',', CASE WHEN reading > 127 THEN 'reading' END,
                              CASE WHEN bad_code THEN 'code' END) AS columns
        FROM C WHERE reading > 127 OR bad_code
        """
    ),
    "coerce_write": _m(
        _COERCED.replace("FROM M", "FROM K")
        + """
        SELECT event_id, reading, CASE WHEN bad_code THEN 'n/a' ELSE CAST(voltage AS VARCHAR) END AS code,
               concat_ws(',', CASE WHEN reading > 127 THEN 'reading' END, CASE WHEN bad_code THEN 'code' END) AS columns
        FROM C
        """
    ),
    "stream_rejects": _m(
        _COERCED.replace("FROM M", "FROM K")
        + """
        SELECT event_id, reading, CASE WHEN bad_code THEN 'n/a' ELSE CAST(voltage AS VARCHAR) END AS code,
               concat_ws(',', CASE WHEN reading > 127 THEN 'reading' END, CASE WHEN bad_code THEN 'code' END) AS columns
        FROM C
        """
    ),
    "types_roundtrip": _m(
        """
        , F AS (SELECT *, event_type <> 'error' AS filled FROM K)
        SELECT ts, tbname,
               CASE WHEN filled THEN voltage END AS int_col,
               CASE WHEN filled THEN event_id + 1000000000000 END AS long_col,
               CASE WHEN filled THEN current END AS double_col,
               CASE WHEN filled THEN voltage % 2 = 0 END AS bool_col,
               CASE WHEN filled THEN location END AS binary_col,
               CASE WHEN filled THEN concat('n_', location) END AS nchar_col,
               CASE WHEN filled THEN hex(encode(location)) END AS varbinary_col,
               CASE WHEN filled THEN lpad(printf('%X', event_id), 12, '0') END AS geometry_col,
               CASE WHEN filled THEN CAST(groupid AS TINYINT) END AS tinyint_col,
               CASE WHEN filled THEN CAST(voltage AS SMALLINT) END AS smallint_col
        FROM F
        """
    ),
    "insert_literals": _m(
        """
        SELECT event_id,
               concat('(', CAST(event_id AS VARCHAR), ',', CAST(epoch_us(ts) // 1000 AS VARCHAR), ',',
                      CAST(voltage AS VARCHAR), ',''', replace(concat(location, '''s'), '''', ''''''), ''',''',
                      tbname, ''')') AS tuple
        FROM M
        """
    ),
    "insert_statements": _m(
        """
        SELECT COUNT(*) AS tuples,
               CAST(SUM(length(concat('(', CAST(epoch_us(ts) // 1000 AS VARCHAR), ',', CAST(voltage AS VARCHAR),
                 ',''', location, ''',', CAST(groupid AS VARCHAR), ',''', tbname, ''')'))) AS BIGINT) AS tuple_chars,
               CAST(0 AS INTEGER) AS too_long, CAST(1 AS INTEGER) AS prefixed
        FROM M
        """
    ),
    "copy_resume": _m(
        f"SELECT {_METERS} FROM K WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-28 05:00:00'"
    ),
    "stream_scan": _RAW,
    "stream_batches": _STORED,
    "stream_to_supertable": _STORED,
    "stream_collapse": _HOURLY,
    "stream_from_position": _m(f"SELECT {_METERS} FROM K WHERE ts >= TIMESTAMP '2024-01-12'"),
    "stream_resume": _STORED,
    "vgroup_positions": _m(
        """
        , P AS (SELECT tbname, ts >= TIMESTAMP '2024-01-12' AS news FROM M)
        SELECT tbname, CAST(1 AS BIGINT) AS vgroups, COUNT(*) + COUNT(*) FILTER (news) AS row_count,
               2 * COUNT(*) FILTER (news) AS news, true AS dense
        FROM P GROUP BY tbname
        """
    ),
    "open_table": _m(f"SELECT {_TAGGED} FROM K WHERE current > 90"),
    "open_table_stream": _STORED,
}
