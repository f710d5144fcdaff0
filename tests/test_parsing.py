import json

import pytest
from pyspark.sql import functions as F

from fixtures import line
from ledgerloom.functions.times import iso_instant, micros_of
from ledgerloom.operators.parsing import copy_event_time, dead_letters, parse_transactions, valid_rows
from ledgerloom.sources.writers import json_rows

MALFORMED = [
    "not json",
    "",
    "   ",
    "5",
    "[1,2]",
    '["transaction_id","user_id","amount","timestamp"]',
    '{"a":1',
    "{'transaction_id':'t','user_id':'u','amount':1,'timestamp':'2026-01-01T00:00:00','merchant_category':'g','location':'B'}",
    line() + " tail",
    line() + line(),
    line() + "," + line(),
]


def parse(spark, lines, **options):
    return parse_transactions(spark.createDataFrame([(x,) for x in lines], "value string"), **options)


def test_malformed_lines_keep_their_raw_text(spark):
    dead = dead_letters(parse(spark, MALFORMED)).collect()
    assert sorted(r.value for r in dead) == sorted(MALFORMED)
    assert {r.reason for r in dead} == {"not a JSON object"}


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"transaction_id":"t","user_id":"u","timestamp":"2026-01-01T00:00:00"}', "missing required key"),
        ('{"transaction_id":"t","user_id":"u","amount":1,"timestamp":"2026-01-01T00:00:00","location":"B"}', "missing feature key"),
        (line(amount="null"), "amount is not a number"),
        (line(amount='"12.5"'), "amount is not a number"),
        (line(amount="NaN"), "not a JSON object"),
        (line(ts="yesterday"), "timestamp is not ISO-8601"),
        (line(ts="2026-02-30T00:00:00"), "timestamp is not ISO-8601"),
    ],
)
def test_unusable_objects_are_dead_letters(spark, text, reason):
    row = dead_letters(parse(spark, [text])).first()
    assert row.value == text
    if reason != "not a JSON object":
        assert row.reason == reason


def test_missing_required_key_can_be_dropped(spark):
    missing = '{"transaction_id":"t","user_id":"u","timestamp":"2026-01-01T00:00:00"}'
    parsed = parse(spark, [missing, "not json", line()], on_missing="drop")
    counts = {r.parse_status: r["count"] for r in parsed.groupBy("parse_status").count().collect()}
    assert counts == {"dropped": 1, "dead_letter": 1, "valid": 1}
    assert [r.value for r in dead_letters(parsed).collect()] == ["not json"]
    with pytest.raises(ValueError):
        parse(spark, [line()], on_missing="ignore")


def test_null_value_of_a_required_key_is_present(spark):
    text = line().replace('"user_id":"u"', '"user_id":null')
    assert valid_rows(parse(spark, [text])).first().user_id is None


def passed_on(spark, text, **added):
    rows = valid_rows(parse(spark, [text])).select("members", *[F.lit(v).alias(k) for k, v in added.items()])
    return json_rows(rows).first().value


def test_members_survive_with_their_types_and_order(spark):
    text = line()[:-1] + ',"note":{"x":[1,"2"]},"code":"5","n":5}'
    out = json.loads(passed_on(spark, text, flag=True))
    assert out == {**json.loads(text), "flag": True}
    assert list(out) == [*json.loads(text), "flag"]


@pytest.mark.parametrize("value", ["1", '"yes"', "null", "true", '{"a":[]}'])
def test_a_mistyped_field_keeps_its_value(spark, value):
    text = line()[:-1] + f',"is_fraud":{value}}}'
    assert json.loads(passed_on(spark, text)) == json.loads(text)
    assert valid_rows(parse(spark, [text])).first().is_fraud is (True if value == "true" else None)


def test_absent_fields_stay_absent(spark):
    assert "is_fraud" not in json.loads(passed_on(spark, line()))


def test_the_last_of_repeated_keys_counts(spark):
    text = line(amount='7,"note":1,"amount":8')[:-1] + ',"note":"b"}'
    assert passed_on(spark, text).count('"note"') == 1
    assert json.loads(passed_on(spark, text)) == json.loads(text)
    assert valid_rows(parse(spark, [text])).first().amount == 8.0


def test_what_json_does_not_have(spark):
    assert json.loads(passed_on(spark, line()[:-1] + ',"note":NaN}'))["note"] == "NaN"
    nested = line()[:-1] + ',"note":{"a":1,"a":2}}'
    assert dead_letters(parse(spark, [nested])).first().value == nested


def test_a_column_wins_over_a_member_of_its_name(spark):
    out = passed_on(spark, line()[:-1] + ',"flag":"theirs"}', flag="ours")
    assert out.count('"flag"') == 1 and json.loads(out)["flag"] == "ours"


@pytest.mark.parametrize(
    "text, micros",
    [
        ("2026-02-28T03:16:53.770902", 1772248613770902),
        ("2026-02-28 03:16:53", 1772248613000000),
        ("2026-02-28T03:16", 1772248560000000),
        ("2026-02-28", 1772236800000000),
        ("2026-02-28T03:16:53Z", 1772248613000000),
        ("2026-02-28T03:16:53+01:00", 1772245013000000),
        ("2026-02-28T03:16:53.5-02:30", 1772257613500000),
        ("2026-02-28T03:16Z", 1772248560000000),
        ("2026-02-28T03:16+01:00", 1772244960000000),
        ("2026", None),
        ("2026-2-8", None),
        ("28.02.2026", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_instants(spark, text, micros):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.unix_micros(iso_instant(F.col("t")))).first()[0] == micros


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_event_time_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2026-03-08T02:30:00.25",)], "t string")
        df = df.select(iso_instant(F.col("t")).alias("z"), F.col("t").cast("timestamp_ntz").alias("n"))
        assert tuple(df.select(micros_of(df, "z"), micros_of(df, "n")).first()) == (1772937000250000,) * 2
        with pytest.raises(TypeError):
            micros_of(df.select(F.lit("x").alias("s")), "s")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_event_time_copy(spark):
    rows = copy_event_time(valid_rows(parse(spark, [line()])).select("timestamp"))
    assert rows.first().event_time == "2026-01-01T00:00:00"


def test_each_line_is_parsed_once(spark):
    plan = dead_letters(parse(spark, [line()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
