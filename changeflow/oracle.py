"""The expected rows of every query, as SQL computed from the supplied tables.

None of it passes through JSON decoding, streams or the latest-state operator:
it is derived from ``events`` directly, so it can judge them.
"""

from __future__ import annotations

LOG = """log AS (
  SELECT md5(CAST(e.event_id // 3 AS VARCHAR)) AS uuid,
         CASE WHEN (e.event_id // 3) % 2 = 0 THEN 'robot' ELSE 'teleop' END AS tbl,
         'RobotID_0' || CAST(e.user_id % 3 + 1 AS VARCHAR) AS robot_id,
         e.ts AS "timestamp",
         upper(e.event_type) AS event_id,
         CASE WHEN (e.event_id // 3) % 2 = 1
              THEN 'OPERATOR_' || CAST(e.user_id % 10 AS VARCHAR) END AS teleoperator_id,
         CASE WHEN e.event_id % 3 = 0 THEN 'INSERT'
              WHEN e.event_id % 3 = 2 AND (e.event_id // 3) % 5 = 0 THEN 'DELETE'
              ELSE 'UPDATE' END AS operation,
         e.event_id AS seq
  FROM events e)"""

TS = "strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f')"
_ROW = f"'uuid', uuid, 'robot_id', robot_id, 'timestamp', {TS}, 'event_id', event_id"
_TELEOP = f"{_ROW}, 'teleoperator_id', teleoperator_id"


def _json(head: str, wrap: bool) -> str:
    """JSON text of a change; teleop rows have one more field."""
    def one(fields: str) -> str:
        if wrap:
            return f"json_object({head}, 'data', json_object({fields}))"
        return f"json_object({head}{', ' if head else ''}{fields})"

    return (
        f"CAST(CASE WHEN tbl = 'teleop' THEN {one(_TELEOP)} ELSE {one(_ROW)} END AS VARCHAR)"
    )


FLAT = _json("'operation', operation, 'table', tbl", False)
NESTED = _json("'action', operation", True)
WRAPPED = _json("'table', tbl, 'action', operation", True)
BARE = _json("", False)
TOPIC = "CASE WHEN tbl = 'robot' THEN 'robot_events' ELSE 'teleop_events' END"

ROW = 'uuid, robot_id, "timestamp", event_id, teleoperator_id'
ROBOT_ROW = 'uuid, robot_id, "timestamp", event_id'
LIVE = f"""{LOG}, last AS (
  SELECT *, row_number() OVER (PARTITION BY tbl, uuid ORDER BY seq DESC) AS rn FROM log),
live AS (SELECT * FROM last WHERE rn = 1 AND operation <> 'DELETE')"""

TEXT = (
    "concat_ws('|', uuid, robot_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f'), event_id)"
)
TEXT5 = (
    "concat_ws('|', uuid, robot_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S.%f'), event_id, "
    "teleoperator_id)"
)
# Both tables in one layout: a robot row has a NULL, written as \\N.
TEXT_ALL = f"concat_ws('|', {TEXT}, COALESCE(teleoperator_id, '\\N'))"
ORDERS_TEXT = (
    "concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
    "CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS VARCHAR), "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), o_orderpriority)"
)
CUSTOMER_TEXT = (
    "concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), "
    "CAST(CAST(c_acctbal AS DECIMAL(38,6)) AS VARCHAR), c_mktsegment)"
)


def _number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _sum(text: str) -> str:
    return f"CAST(COALESCE(sum({_number(text)}), 0) AS VARCHAR)"


def _xor(text: str) -> str:
    return f"COALESCE(bit_xor({_number(text)}), 0)"


def _sample(text: str, key: str) -> str:
    return f"md5(string_agg({text}, '' ORDER BY {key}))"


N = "CAST(count(*) AS BIGINT)"


def _with_log(select: str) -> str:
    return f"WITH {LOG} {select}"


def _checksum(label: str, text: str, source: str) -> str:
    return (
        f"SELECT {label} AS tbl, {N} AS row_count, {_sum(text)} AS checksum_sum, "
        f"{_xor(text)} AS checksum_xor FROM {source}"
    )


def _side(name: str, text: str) -> str:
    """The check values of one live table."""
    where = f"FROM live WHERE tbl = '{name}'"
    pair = "{} || ':' || CAST({} AS VARCHAR)"
    return f"""
  SELECT '{name}' AS tbl, 'row_count' AS check_name, CAST(count(*) AS VARCHAR) AS v {where}
  UNION ALL SELECT '{name}', 'key_checksum', {pair.format(_sum('uuid'), _xor('uuid'))} {where}
  UNION ALL SELECT '{name}', 'row_checksum', {pair.format(_sum(text), _xor(text))} {where}
  UNION ALL SELECT '{name}', 'sample_checksum', {_sample('t', 'uuid, t')} FROM (
    SELECT uuid, {text} AS t {where} ORDER BY uuid, t LIMIT 100)"""


CHECKED = f"""WITH {LIVE}, checked AS ({_side('robot', TEXT)}
  UNION ALL {_side('teleop', TEXT5)})
SELECT tbl, check_name, v AS source_value, v AS target_value, 'PASS' AS verdict FROM checked"""

_DELTA = "{c} - lag({c}) OVER (PARTITION BY hostname ORDER BY \"timestamp\", seq)"
METRICS = """WITH m AS (
  SELECT ts AS "timestamp", 'host_' || CAST(user_id % 5 AS VARCHAR) AS hostname,
         value / 5 AS cpu_percent, value / 10 AS memory_percent,
         event_id * 512 AS disk_read_total, event_id * 256 AS disk_write_total,
         event_id AS seq FROM events)"""
HOST_METRICS = f"""{METRICS} SELECT "timestamp", hostname, cpu_percent, memory_percent,
  CAST(disk_read_total AS DOUBLE) AS disk_io_read,
  CAST(disk_write_total AS DOUBLE) AS disk_io_write, seq FROM m"""

_DAMAGED = f"""WITH {LOG}, encoded AS (SELECT *, {FLAT} AS value FROM log), damaged AS (
  SELECT seq, tbl, event_id AS kind,
    CASE event_id WHEN 'ERROR' THEN substr(value, 1, length(value) - 5)
      WHEN 'SIGNUP' THEN '[' || value || ']'
      WHEN 'VIEW' THEN replace(value, '"timestamp":"2024', '"timestamp":"noon')
      WHEN 'CLICK' THEN replace(value, '"uuid"', '"id"')
      ELSE value END AS raw,
    CASE event_id WHEN 'ERROR' THEN 'not_json_object' WHEN 'SIGNUP' THEN 'not_json_object'
      WHEN 'VIEW' THEN 'bad_timestamp' WHEN 'CLICK' THEN 'no_key' END AS error
  FROM encoded)"""

# Verdicts of four tables with one fault each; the checks are decided by how
# the fault was made.
_FAULTY = """(VALUES
  ('orders', 'row_count', 'PASS'), ('orders', 'key_checksum', 'PASS'),
  ('orders', 'row_checksum', 'PASS'),
  ('customer', 'row_count', 'PASS'), ('customer', 'key_checksum', 'PASS'),
  ('customer', 'row_checksum',
     CASE WHEN (SELECT count(*) FROM customer WHERE c_custkey = 0) > 0
          THEN 'FAIL' ELSE 'PASS' END),
  ('supplier', 'row_count', 'SKIPPED'), ('supplier', 'key_checksum', 'SKIPPED'),
  ('supplier', 'row_checksum', 'SKIPPED'),
  ('part', 'row_count', 'PASS'), ('part', 'key_checksum', 'ERROR'),
  ('part', 'row_checksum', 'ERROR')) v(tbl, check_name, verdict)"""

_PARTS = (
    'CAST(year("timestamp") AS INTEGER) AS "year", CAST(month("timestamp") AS INTEGER) AS "month", '
    'CAST(day("timestamp") AS INTEGER) AS "day"'
)


def _records(where: str = "TRUE") -> str:
    return _with_log(f"SELECT {TOPIC} AS topic, {FLAT} AS value, seq FROM log WHERE {where}")


def _violations(column: str, condition: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS col, CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) "
        f"AS violations FROM {source}"
    )


ORACLE: dict[str, str] = {
    "read_change_stream": _records("tbl = 'robot'"),
    "read_change_stream_options": _records("tbl = 'teleop'"),
    "read_change_stream_topics": _records(),
    "read_table": _with_log(f"SELECT operation, {ROW}, seq FROM log"),
    "read_source_table": (
        f"SELECT {N} AS row_count, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key "
        "FROM orders"
    ),
    "append_stream": _with_log(f"SELECT operation, {ROW}, seq FROM log WHERE tbl = 'robot'"),
    "append_stream_by_date": _with_log(
        f"SELECT {ROW}, {_PARTS}, seq FROM log WHERE tbl = 'teleop'"
    ),
    "append_batches": _with_log(
        f"SELECT operation, {ROBOT_ROW}, seq FROM log WHERE tbl = 'robot'"
    ),
    "split_batches": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "init_tables": _with_log(
        f"SELECT tbl, robot_id, {N} AS row_count FROM log GROUP BY tbl, robot_id"
    ),
    "publish_changes": _with_log(
        f"SELECT uuid AS record_key, {TOPIC} AS topic, {FLAT} AS value, seq FROM log"
    ),
    "decode_value": _records(),
    "parse_nested": _with_log(f"SELECT operation, {ROW}, seq FROM log"),
    "parse_wrapped": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "parse_bare": _with_log(f"SELECT 'INSERT' AS operation, {ROW}, seq FROM log"),
    "parse_flat": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "parse_metrics": HOST_METRICS,
    "parse_metrics_text": (
        "SELECT 'cpu ' || event_type AS cpu, props AS memory, CAST(user_id AS VARCHAR) AS disk_io, "
        'ts AS "timestamp", event_id AS seq FROM events'
    ),
    "parse_metrics_broker": """SELECT 'broker_' || CAST(user_id % 3 AS VARCHAR) AS broker_id,
  ts AS "timestamp", event_id % 400 / 4 AS cpu_percent, event_id % 200 / 2 AS memory_percent,
  event_id % 64 / 8 AS disk_read_mbps, event_id % 32 / 8 AS disk_write_mbps,
  CAST(CASE WHEN event_type <> 'error' THEN user_id END AS INTEGER) AS messages_in_per_sec,
  event_id * 1000 AS bytes_in_per_sec, event_id * 10 AS bytes_out_per_sec,
  event_id AS seq FROM events""",
    "flatten": _with_log("SELECT uuid, robot_id, event_id FROM log"),
    "filter_topic": _with_log(
        "SELECT operation, uuid, robot_id, seq FROM log WHERE tbl = 'robot'"
    ),
    "split_by_presence": _with_log("SELECT operation, tbl, uuid, teleoperator_id, seq FROM log"),
    "add_date_parts": _with_log(f"SELECT uuid, {_PARTS}, seq FROM log"),
    "keep_inserts": _with_log(
        f"SELECT operation, {ROW}, seq FROM log WHERE operation = 'INSERT'"
    ),
    "route_by_channel_or_table": """SELECT event_id AS seq,
  CASE WHEN event_type IN ('click', 'view')
         OR (event_type <> 'error' AND (event_id // 3) % 2 = 0) THEN 'robot_cdc'
       WHEN event_type = 'signup'
         OR (event_type <> 'error' AND (event_id // 3) % 2 = 1) THEN 'teleop_cdc' END AS topic
  FROM events""",
    "route_default_teleop": """SELECT event_id AS seq,
  CASE WHEN event_type = 'click' THEN 'robot_events' ELSE 'teleop_events' END AS topic
  FROM events""",
    "encode_nested": _with_log(f"SELECT {NESTED} AS value, seq FROM log"),
    "encode_wrapped": _with_log(f"SELECT {WRAPPED} AS value, seq FROM log"),
    "encode_flat": _with_log(f"SELECT {FLAT} AS value, seq FROM log"),
    "quarantine_malformed": f"{_DAMAGED} SELECT raw, error, seq FROM damaged WHERE error IS NOT NULL",
    "decode_report": (
        f"{_DAMAGED} SELECT COALESCE(error, 'ok') AS outcome, {N} AS records "
        "FROM damaged GROUP BY COALESCE(error, 'ok')"
    ),
    "quarantine_by_date": f"{_DAMAGED} SELECT COALESCE(error, tbl) AS outcome, seq FROM damaged",
    "quarantine_metrics": (
        "SELECT CASE WHEN event_id % 5 < 2 THEN 'not_json_object' ELSE 'landed' END AS outcome, "
        "event_id AS seq FROM events"
    ),
    "quarantine_shared": _with_log(
        "SELECT CASE WHEN event_id IN ('ERROR', 'SIGNUP') THEN 'not_json_object' "
        "WHEN event_id = 'VIEW' THEN 'no_data' ELSE tbl END AS outcome, seq FROM log"
    ),
    "unforwarded": _with_log(
        "SELECT * FROM (SELECT CASE WHEN event_id IN ('ERROR', 'SIGNUP') THEN 'not_json_object' "
        "WHEN operation <> 'INSERT' THEN NULL WHEN event_id = 'VIEW' THEN 'no_topic' "
        "WHEN event_id = 'CLICK' THEN 'bad_operation' ELSE 'forwarded' END AS outcome, seq "
        "FROM log) o WHERE outcome IS NOT NULL"
    ),
    "record_key": _with_log("SELECT uuid AS record_key, seq FROM log"),
    "unwrap_data": _with_log(
        "SELECT CASE WHEN tbl = 'robot' THEN 'robot_cdc' ELSE 'teleop_cdc' END AS topic, "
        f"{BARE} AS value, seq FROM log WHERE operation = 'INSERT'"
    ),
    "counter_delta": (
        f"{METRICS} SELECT hostname, {_DELTA.format(c='disk_read_total')} AS disk_read_total_delta, "
        f"{_DELTA.format(c='disk_write_total')} AS disk_write_total_delta, seq FROM m"
    ),
    "project_to_table": _with_log(
        f"SELECT {ROBOT_ROW}, 'robot_events' AS topic, seq FROM log WHERE tbl = 'robot'"
    ),
    "row_count": " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, {N} AS row_count FROM {t}"
        for t in ("events", "orders", "customer", "lineitem")
    ),
    "key_checksum": _with_log(_checksum("tbl", "uuid", "log GROUP BY tbl")),
    "table_checksum": _with_log(
        " UNION ALL ".join(
            [
                _checksum("'log'", TEXT, "log"),
                _checksum("'orders'", ORDERS_TEXT, "orders"),
                _checksum("'customer'", CUSTOMER_TEXT, "customer"),
            ]
        )
    ),
    "partial_checksum": _with_log(
        " UNION ALL ".join(
            [
                f"SELECT '{t}' AS tbl, {N} AS sampled_rows, {_sample('t', 'uuid, t')} AS "
                f"sample_checksum FROM (SELECT uuid, {TEXT} AS t FROM log WHERE tbl = '{t}' AND "
                "operation = 'INSERT' ORDER BY uuid, t LIMIT 100)"
                for t in ("robot", "teleop")
            ]
            + [
                f"SELECT 'orders' AS tbl, {N} AS sampled_rows, {_sample('t', 'o_orderkey, t')} AS "
                f"sample_checksum FROM (SELECT o_orderkey, {ORDERS_TEXT} AS t FROM orders "
                "ORDER BY o_orderkey, t LIMIT 100)"
            ]
        )
    ),
    "row_hash": _with_log(f"SELECT seq, md5({TEXT}) AS row_hash FROM log"),
    "topk_by_key": _with_log(
        f"SELECT {ROBOT_ROW} FROM log WHERE operation = 'INSERT' ORDER BY uuid LIMIT 100"
    ),
    "reconcile_counts": f"SELECT * FROM ({CHECKED}) c WHERE check_name = 'row_count'",
    "reconcile_checksums": f"SELECT * FROM ({CHECKED}) c WHERE check_name <> 'row_count'",
    "reconcile_verdicts": f"SELECT tbl, check_name, verdict FROM {_FAULTY}",
    "qa_verdict": (
        "SELECT bool_and(verdict IN ('PASS', 'SKIPPED')) AS passed, "
        + ", ".join(
            f"CAST(count(*) FILTER (WHERE verdict = '{v}') AS BIGINT) AS n_{v.lower()}"
            for v in ("PASS", "FAIL", "SKIPPED", "ERROR")
        )
        + f" FROM {_FAULTY}"
    ),
    "batch_row_count": _with_log(f"SELECT tbl, {N} AS row_count FROM log GROUP BY tbl"),
    "check_not_null": _with_log(
        " UNION ALL ".join(
            _violations(c, f'"{c}" IS NULL', "log")
            for c in ("uuid", "robot_id", "timestamp", "event_id", "teleoperator_id")
        )
    ),
    "check_unique_key": _with_log(
        f"SELECT uuid, {N} AS copies FROM log GROUP BY uuid HAVING count(*) > 1"
    ),
    "check_length": _with_log(
        " UNION ALL ".join(
            _violations(c, f"length({c}) > {n}", source)
            for c, n, source in (
                ("uuid", 36, "log"), ("robot_id", 50, "log"), ("event_id", 5, "log"),
                ("teleoperator_id", 50, "log"), ("text", 1000, "documents"),
                ("source", 50, "documents"), ("lang", 2, "documents"),
            )
        )
    ),
    "default_timestamp": _with_log(
        "SELECT seq, TRUE AS has_timestamp, "
        "CASE WHEN event_id <> 'ERROR' THEN \"timestamp\" END AS given FROM log"
    ),
    "trigger": _with_log(
        f"SELECT CAST(3 AS BIGINT) AS batches, {N} AS row_count FROM log WHERE tbl = 'robot'"
    ),
    "checkpoint": _with_log(
        "SELECT operation, uuid, robot_id, seq FROM log WHERE tbl = 'teleop'"
    ),
    "batch_id": _with_log(
        "SELECT CAST(CASE WHEN operation = 'INSERT' THEN 0 ELSE 1 END AS BIGINT) AS batch_id, "
        f"{N} AS row_count FROM log WHERE tbl = 'teleop' GROUP BY 1"
    ),
    "output_mode_append": _with_log(
        f"SELECT operation, {N} AS row_count FROM log WHERE tbl = 'robot' GROUP BY operation"
    ),
    "run_many": _with_log(
        f"SELECT tbl, robot_id, {N} AS row_count FROM log GROUP BY tbl, robot_id"
    ),
    "current_state": f"WITH {LIVE} SELECT operation, tbl, {ROW}, seq FROM live",
    "fold_changes": f"WITH {LIVE} SELECT operation, tbl, {ROW}, seq FROM live",
    "dedupe_replays": _records(),
    "dedupe_replays_stream": _records(),
    "replicate_events": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "replicate_metrics": HOST_METRICS,
    "run_qa": CHECKED,
    "replicated_matches_source": f"""WITH {LIVE}, checked AS (
  SELECT tbl, CAST(count(*) AS VARCHAR) AS n,
    {_sum(TEXT_ALL)} || ':' || CAST({_xor(TEXT_ALL)} AS VARCHAR) AS c FROM live GROUP BY tbl)
SELECT tbl, n AS source_row_count, n AS target_row_count, c AS source_row_checksum,
  c AS target_row_checksum, TRUE AS matches FROM checked""",
    "append_stream_all": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "append_stream_by_date_all": _with_log(f"SELECT tbl, {ROW}, {_PARTS}, seq FROM log"),
    "append_batches_all": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "table_checksum_all": _with_log(_checksum("tbl", TEXT_ALL, "log GROUP BY tbl")),
    "partial_checksum_all": _with_log(
        " UNION ALL ".join(
            f"SELECT '{t}' AS tbl, {N} AS sampled_rows, {_sample('t', 'uuid, t')} AS "
            f"sample_checksum FROM (SELECT uuid, {TEXT_ALL} AS t FROM log WHERE tbl = '{t}' AND "
            "operation = 'INSERT' ORDER BY uuid, t LIMIT 100)"
            for t in ("robot", "teleop")
        )
    ),
    "row_hash_all": _with_log(f"SELECT seq, md5({TEXT_ALL}) AS row_hash FROM log"),
    "topk_by_key_all": _with_log(
        f"SELECT {ROW} FROM log WHERE operation = 'INSERT' ORDER BY uuid LIMIT 100"
    ),
    "trigger_all": _with_log(
        f"SELECT tbl, CAST(3 AS BIGINT) AS batches, {N} AS row_count FROM log GROUP BY tbl"
    ),
    "checkpoint_all": _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log"),
    "batch_id_all": _with_log(
        "SELECT tbl, CAST(CASE WHEN operation = 'INSERT' THEN 0 ELSE 1 END AS BIGINT) AS batch_id, "
        f"{N} AS row_count FROM log GROUP BY 1, 2"
    ),
    "output_mode_append_all": _with_log(
        f"SELECT tbl, operation, {N} AS row_count FROM log GROUP BY tbl, operation"
    ),
}


# --- logs of whole batches, landed in three parts of the event ids --------------

ORACLE["batch_commit"] = _with_log(f"SELECT operation, tbl, {ROW}, seq FROM log")
ORACLE["compact_log"] = ORACLE["batch_commit"]
ORACLE["dedupe_overlaps"] = ORACLE["batch_commit"]
ORACLE["incremental_state"] = f"WITH {LIVE} SELECT tbl, {ROW}, seq FROM live"


def _live_before(bound: str) -> str:
    """The live rows after the changes before an event id."""
    return LIVE.replace("ORDER BY seq DESC) AS rn FROM log)", f"ORDER BY seq DESC) AS rn FROM log WHERE seq < {bound})")


def _part_end(i: int) -> str:
    return f"(SELECT min(event_id) + (max(event_id) - min(event_id) + 1) * {i} // 3 FROM events)"


ORACLE["reconcile_at_position"] = " UNION ALL ".join(
    f"""SELECT {i} AS position, tbl, check_name, source_value, verdict FROM (
    {CHECKED.replace(LIVE, _live_before(_part_end(i)))}) c"""
    for i in (1, 2)
)

# The first sign of a key decides the fault: 0 taken out of the source, 1 another
# event id there, 2 a copy of the row there under the key spelled backwards.
ORACLE["differing_rows"] = f"""WITH {LIVE} SELECT * FROM (
  SELECT tbl, CASE WHEN left(uuid, 1) = '2' THEN reverse(uuid) ELSE uuid END AS uuid,
    CASE left(uuid, 1) WHEN '0' THEN 'extra' WHEN '1' THEN 'changed' WHEN '2' THEN 'missing' END AS difference
  FROM live) d WHERE difference IS NOT NULL"""

ORACLE["counter_delta_stream"] = ORACLE["counter_delta"]


def _counted(rule: str, column: str, where: str, table: str) -> str:
    return (
        f"SELECT '{table}' AS tbl, '{rule}' AS rule, '{column}' AS col, {N} AS violations "
        f"FROM faulty WHERE tbl = '{table}' AND {where}"
    )


# A second insert follows a live row: the change before it is its entity's first.
ORACLE["incremental_checks"] = f"""WITH {LOG}, faulty AS (SELECT tbl, uuid, seq, event_id, "timestamp",
    teleoperator_id, CASE WHEN event_id <> 'ERROR' THEN robot_id END AS robot_id,
    seq % 3 = 1 AND (seq // 3) % 7 = 0 AND lag(seq) OVER (PARTITION BY uuid ORDER BY seq) IS NOT NULL AS again FROM log)
""" + " UNION ALL ".join(
    [
        _counted("not_null", c, f'"{c}" IS NULL', t)
        for t, more in (("robot", ()), ("teleop", ("teleoperator_id",)))
        for c in ("uuid", "robot_id", "timestamp", "event_id", *more)
    ]
    + [
        _counted(rule, c, where, t)
        for t in ("robot", "teleop")
        for rule, c, where in (
            ("length", "event_id", "length(event_id) > 5"), ("length", "uuid", "length(uuid) > 36"), ("unique", "uuid", "again"),
        )
    ]
)

# --- all tables of a log in one scan ----------------------------------------------

_CHANGE_TEXT = f"concat_ws('|', operation, {TEXT_ALL}, CAST(seq AS VARCHAR))"
_FIRST = f"""WITH {LOG}, texts AS (SELECT *, {_CHANGE_TEXT} AS t FROM log),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY uuid, t) AS rn FROM texts)"""
ORACLE["checksum_by_table"] = _with_log(_checksum("tbl", _CHANGE_TEXT, "log GROUP BY tbl"))
ORACLE["topk_by_table"] = f"{_FIRST} SELECT tbl, operation, {ROW}, seq FROM ranked WHERE rn <= 100"
ORACLE["partial_checksum_by_table"] = (
    f"{_FIRST} SELECT tbl, {N} AS sampled_rows, {_sample('t', 'uuid, t')} AS sample_checksum "
    "FROM ranked WHERE rn <= 100 GROUP BY tbl"
)

# --- fields that a schema does not take --------------------------------------------

ORACLE["field_report"] = f"""SELECT * FROM (
  SELECT 'cpu_percent' AS field, 'not_cast' AS problem, {N} AS records FROM events WHERE event_id % 4 = 0
  UNION ALL SELECT 'severity', 'unknown', {N} FROM events WHERE event_type = 'error') r WHERE records > 0"""
ORACLE["unmatched_fields"] = _with_log(
    "SELECT seq, CASE WHEN teleoperator_id IS NOT NULL THEN 'teleoperator_id' END AS field, "
    "teleoperator_id AS text FROM log"
)
