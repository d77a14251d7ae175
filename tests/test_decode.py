"""Decoding, with the inputs that must not break it."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions import json_fields
from changeflow.operators import decode, encode, routing
from changeflow.schemas import BARE, ENVELOPES, FLAT, NESTED, WRAPPED, ROBOT, table_schema
from tests.conftest import rows


def records(spark, *values):
    numbered = list(enumerate(values))
    df = spark.createDataFrame(numbered, "offset long, value string")
    return df.withColumn("value", F.col("value").cast("binary"))


def outcome(spark, envelope, *values):
    decoded = decode.decode_changes(records(spark, *values), envelope)
    found = {r.offset: r for r in decoded.collect()}
    return [found[i] for i in range(len(values))]


GOOD = '{"operation":"INSERT","table":"robot","uuid":"u","robot_id":"r","timestamp":"2024-01-02T03:04:05.123456","event_id":"e"}'


def test_malformed_text_is_quarantined_with_its_text(spark):
    bad = ["{oops", "", '[{"uuid":"a"}]', "null", '"text"', "7", GOOD[:-9]]
    decoded = decode.decode_changes(records(spark, *bad, GOOD), FLAT)
    found = decode.quarantine_malformed(decoded)
    assert [r.raw for r in found.orderBy("offset").collect()] == bad
    assert {r.error for r in found.collect()} == {decode.NOT_AN_OBJECT}
    assert decode.accepted(decoded).count() == 1


def test_null_value_is_dropped_and_counted(spark):
    decoded = decode.decode_changes(records(spark, None, GOOD, "{"), FLAT)
    assert decode.accepted(decoded).count() == 1
    assert decode.quarantine_malformed(decoded).count() == 1
    assert rows(decode.decode_report(decoded)) == [
        ("not_json_object", 1), ("null_value", 1), ("ok", 1),
    ]


def test_bad_timestamp_is_quarantined_when_strict(spark):
    text = GOOD.replace("2024-01-02T03", "nope")
    assert outcome(spark, FLAT, text)[0].error == "bad_timestamp"
    loose = decode.decode_changes(records(spark, text), FLAT, strict=False).first()
    assert loose.error is None and loose.timestamp is None and loose.uuid == "u"


def test_key_case_is_folded(spark):
    upper = '{"UUID":"u","Robot_ID":"r","Timestamp":"2024-01-02 03:04:05","Event_ID":"e","Teleoperator_ID":"t"}'
    row = outcome(spark, BARE, upper)[0]
    assert (row.uuid, row.robot_id, row.event_id, row.teleoperator_id) == ("u", "r", "e", "t")
    assert row.error is None and row.operation == "INSERT"
    nested = '{"Action":"INSERT","DATA":' + upper + "}"
    row = outcome(spark, NESTED, nested)[0]
    assert (row.operation, row.uuid, row.has_data) == ("INSERT", "u", True)
    escaped = '{"\\u0055UID":"u"}'
    assert outcome(spark, BARE, escaped)[0].uuid == "u"


def test_last_of_two_keys_wins(spark):
    values = ['{"uuid":"a","UUID":"b"}', '{"UUID":"b","uuid":"a"}', '{"uuid":"a","uuid":"b"}']
    assert [r.uuid for r in outcome(spark, BARE, *values)] == ["b", "a", "b"]


def test_unknown_keys_are_ignored_and_a_missing_key_is_an_error(spark):
    extra = GOOD[:-1] + ',"more":{"x":[1,2]}}'
    assert outcome(spark, FLAT, extra)[0].error is None
    for envelope in (BARE, FLAT):
        found = outcome(spark, envelope, "{}", '{"robot_id":"r"}', '{"uuid":null}')
        assert [r.error for r in found] == [decode.NO_KEY] * 3


@pytest.mark.parametrize("envelope", [NESTED, WRAPPED])
def test_data_of_an_envelope(spark, envelope):
    values = [
        '{"action":"INSERT","data":"str"}',
        '{"action":"INSERT","data":5}',
        '{"action":"INSERT","data":[{"uuid":"u"}]}',
        '{"action":"INSERT","data":null}',
        '{"action":"INSERT","data":{}}',
        '{"action":"INSERT"}',
        '{"action":"INSERT","data":{"x":1}}',
        '{"action":"INSERT","data":{"uuid":"u"}}',
        '{"action":"UPDATE","data":{"uuid":"u"}}',
    ]
    found = outcome(spark, envelope, *values)
    assert [r.error for r in found] == [decode.DATA_NOT_AN_OBJECT] * 3 + [None] * 3 + [
        decode.NO_KEY, None, None,
    ]
    decoded = decode.decode_changes(records(spark, *values), envelope)
    kept = routing.keep_inserts(decode.accepted(decoded))
    assert rows(kept, "operation", "uuid", "offset") == [("INSERT", "u", 7)]


def test_offsets_in_text(spark):
    text = GOOD.replace("05.123456", "05.123456+02:00")
    wall = outcome(spark, FLAT, text)[0].timestamp
    assert wall == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    bare = '{"uuid":"u","timestamp":"2024-01-02T03:04:05.123456+02:00"}'
    instant = decode.decode_changes(records(spark, bare), BARE)
    assert instant.select(F.unix_micros("timestamp")).first()[0] == int(
        dt.datetime(2024, 1, 2, 1, 4, 5, 123456, dt.timezone.utc).timestamp() * 1_000_000
    )


NASTY = [
    "plain", "", " ", "a|b", 'quote " inside', "back\\slash", "tab\tnew\nline", "ünïcödé", "机器人",
    "😀", "{}", '{"uuid":"x"}', "null", "A:B", '":"', "K", "\u0000x", "RobotID_01",
]


@pytest.mark.parametrize("envelope", ENVELOPES)
def test_round_trip(spark, envelope):
    """Encode, decode: the same rows, microseconds and odd texts included."""
    rng = random.Random(7)
    data = [
        (
            f"id{i}", rng.choice(NASTY), dt.datetime(1995 + i % 60, 1 + i % 12, 1 + i % 28, i % 24,
                                                   i % 60, i % 60, rng.randrange(10**6)),
            rng.choice(NASTY + [None]), rng.choice(NASTY + [None, None]),
            rng.choice(["INSERT", "UPDATE", "DELETE"]), rng.choice(["robot", "teleop"]), i,
        )
        for i in range(400)
    ]
    schema = T.StructType(
        table_schema("teleop").fields
        + [T.StructField("operation", T.StringType()), T.StructField("table", T.StringType()),
           T.StructField("offset", T.LongType())]
    )
    log = spark.createDataFrame(data, schema)
    names = table_schema(ROBOT).fieldNames()
    encoded = encode.encode_changes(log, envelope, names, ["teleoperator_id"])
    decoded = decode.decode_changes(encoded.select("value", "offset"), envelope, zoned=False)
    shown = [*names, "teleoperator_id", "offset"]
    assert rows(decode.accepted(decoded), *shown) == rows(log, *shown)
    if envelope == FLAT:
        assert rows(decoded, "operation", "table", "offset") == rows(log, "operation", "table", "offset")


def test_both_routes_agree(spark, monkeypatch):
    """The exact parse settles a record only if folding case gives the same."""
    rng = random.Random(11)
    keys = ["uuid", "UUID", "Uuid", "robot_id", "ROBOT_ID", "timestamp", "event_id", "x", "data"]
    values = ["a", "B", 1, 2.5, None, True, {"y": "Z"}, [1, "q"], "2024-01-01", "\\", '"', "é"]
    texts = []
    for _ in range(600):
        pairs = [(rng.choice(keys), rng.choice(values)) for _ in range(rng.randrange(6))]
        text = "{" + ", ".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in pairs) + "}"
        texts.append(text if rng.random() < 0.9 else text[: rng.randrange(len(text))])
    for envelope in (BARE, FLAT):
        fast = rows(decode.decode_changes(records(spark, *texts), envelope))
        with monkeypatch.context() as patch:
            patch.setattr(json_fields, "has_plain_keys", lambda text: "false")
            slow = rows(decode.decode_changes(records(spark, *texts), envelope))
        assert fast == slow


def test_metrics_keep_the_sample_when_a_field_does_not_cast(spark):
    text = '{"broker_id":"b","timestamp":"2024-01-01T00:00:00","messages_in_per_sec":1.5,"bytes_in_per_sec":7}'
    parsed = decode.parse_metrics(records(spark, text, "{oops"), "broker")
    good = decode.accepted(parsed).collect()
    assert len(good) == 1
    assert (good[0].messages_in_per_sec, good[0].bytes_in_per_sec) == (None, 7)
    assert decode.quarantine_malformed(parsed).count() == 1


def test_delete_carries_the_old_image(spark):
    image = "struct<uuid:string,robot_id:string>"
    df = spark.createDataFrame(
        [("DELETE", "robot", ("old", "r"), None), ("UPDATE", "robot", ("old", "r"), ("new", None))],
        f"operation string, table string, old {image}, new {image}",
    )
    values = [r.value for r in encode.encode_changes(df, FLAT, ["uuid", "robot_id"]).collect()]
    assert values == [
        '{"operation":"DELETE","table":"robot","uuid":"old","robot_id":"r"}',
        '{"operation":"UPDATE","table":"robot","uuid":"new","robot_id":null}',
    ]


def test_unwrap_forwards_the_row_untouched(spark):
    text = '{"table" : "robot", "action" : "INSERT", "data" : {"UUID":"u","extra":[1,{"a":null}]}}'
    opened = decode.open_wrapper(records(spark, text, '{"action":"INSERT","data":"x"}', "{"))
    assert [r.error for r in opened.orderBy("offset").collect()] == [
        None, decode.DATA_NOT_AN_OBJECT, decode.NOT_AN_OBJECT,
    ]
    good = decode.unwrap_data(opened.where("error IS NULL")).first()
    assert json.loads(good.value) == {"UUID": "u", "extra": [1, {"a": None}]}


def test_the_record_is_parsed_once(spark, plan_of):
    """A filter on the outcome must not repeat the parse below it."""
    for envelope, parses in ((FLAT, 2), (BARE, 2), (NESTED, 4), (WRAPPED, 4)):
        decoded = decode.accepted(decode.decode_changes(records(spark, GOOD), envelope))
        plan = plan_of(decoded.where("operation = 'INSERT'"))
        assert plan.count("from_json(") <= parses
        assert "Exchange" not in plan
