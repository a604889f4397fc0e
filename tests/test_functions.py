"""Column functions on the edge inputs the source semantics define."""

import pytest
from pyspark.sql import functions as F

from commitlake.functions import (
    commit_type, days_between, greatest_strict, json_value, parse_rfc3339, pct, pr_number, rate, safe_bool,
    safe_int,
)
from commitlake.sources.envelope import parse_payload


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("payload,expected", [
    ('{"a":{"x":1}}', None),
    ('{"a":[1]}', None),
    ('{"a":"[Fix] x"}', "[Fix] x"),
    ('{"a":"{not json"}', "{not json"),
    ('{"a":12}', "12"),
    ('{"a":true}', "true"),
    ('{"a":null}', None),
    ('{"b":1}', None),
    ('{"a":1.0}', "1.0"),
    ('{"a":-3}', "-3"),
    ('{"a":1,"a":2}', "2"),
    ('{"a":"[x] y","b":1,"b":2}', "[x] y"),
    ('{"a":[1],"b":1,"b":2}', None),
    ('{"a":[]}', None),
    ('{"a":{}}', None),
    ('{"a":"[1, 2]"}', "[1, 2]"),
    ('{"a":"{\\"x\\":1}"}', '{"x":1}'),
    ('{"a":""}', ""),
    ('{"a":', None),
])
def test_strict_scalar(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "data string")
    got = parse_payload(df, [("a", "a", "s")], keep=[]).first()["a"]
    assert got == expected
    assert df.select(json_value("data", "$.a").alias("a")).first()["a"] == expected


def test_loose_scalar_returns_container_text(spark):
    df = spark.createDataFrame([('{"a":{"x":1}}',)], "data string")
    assert parse_payload(df, [("a", "a", "s")], keep=[], strict=False).first()["a"] == '{"x":1}'


@pytest.mark.parametrize("text,expected", [("12", 12), ("1.5", None), ("99999999999999999999", None),
                                           ("abc", None), (None, None), ("-3", -3)])
def test_safe_int(spark, text, expected):
    assert one(spark, safe_int, text) == expected


@pytest.mark.parametrize("text,expected", [("TRUE", True), ("false", False), ("1", None), ("yes", None),
                                           ("t", None), (None, None)])
def test_safe_bool(spark, text, expected):
    assert one(spark, safe_bool, text) == expected


@pytest.mark.parametrize("text,ok", [
    ("2024-01-02T03:04:05Z", True), ("2024-01-02T03:04:05+05:30", True), ("2024-01-02T03:04:05.1-08:00", True),
    ("2024-01-02T03:04:05.123456789Z", True), ("2024-01-02", False), ("2024-01-02T03:04:05", False),
    ("2024-01-02T03:04:05+0530", False), ("2024-01-02T03:04:60Z", False), ("garbage", False),
])
def test_parse_rfc3339(spark, text, ok):
    got = spark.createDataFrame([(text,)], "v string").select(
        F.date_format(parse_rfc3339(F.col("v")), "yyyy-MM-dd HH:mm:ss").alias("r")).first()["r"]
    assert (got is not None) == ok
    if text == "2024-01-02T03:04:05+05:30":
        assert got == "2024-01-01 21:34:05"


@pytest.mark.parametrize("msg,expected", [
    ("feat: add", "other"), ("feat(api): x", "feature"), ("feat!: x", "other"), ("FEAT(x)", "feature"),
    ("fix:é", "other"), ("build:jar", "build"), ("style:fmt", "style"), (None, "other"), ("feat:add", "feature"),
    ("perf(io): fast", "performance"), ("ci(gh): run", "ci"), ("[build] jar", "other"), ("feat(", "other"),
    ("docs:readme", "docs"), ("refactor(db): x", "refactor"), ("test:unit", "test"), ("chore(deps): x", "chore"),
    ("fixup: x", "other"), ("feat:_x", "feature"),
])
def test_commit_type(spark, msg, expected):
    assert one(spark, commit_type, msg) == expected


@pytest.mark.parametrize("msg,expected", [("no ref", None), ("see #12abc #5", 12), ("#99999999999999999999", None),
                                          (None, None), ("(#7)", 7)])
def test_pr_number(spark, msg, expected):
    assert one(spark, pr_number, msg) == expected


def test_days_between_truncates_toward_zero(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' a, TIMESTAMP'2024-01-02 23:59:59' b")
    r = df.select(days_between(F.col("a"), F.col("b")).alias("f"), days_between(F.col("b"), F.col("a")).alias("r"))
    assert tuple(r.first()) == (1, -1)


def test_rates_round_half_up_and_null_safe(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (1, 8)], "n long, d long")
    got = [tuple(r) for r in df.select(pct(F.col("n"), F.col("d")), rate(F.col("n"), F.col("d"))).collect()]
    assert got == [(33.33, 0.33), (None, None), (12.5, 0.13)]


def test_greatest_strict_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "x long")
    assert [r[0] for r in df.select(greatest_strict(F.col("x"), 1)).collect()] == [None, 1, 5]


@pytest.mark.parametrize("payload,kind,expected", [('{"a":{"x":1}}', "i", None), ('{"a":[true]}', "b", None),
                                                   ('{"a":"7"}', "i", 7), ('{"a":["2024-01-02T03:04:05Z"]}', "t", None)])
def test_typed_leaves_reject_containers(spark, payload, kind, expected):
    df = spark.createDataFrame([(payload,)], "data string")
    assert parse_payload(df, [("a", "a", kind)], keep=[]).first()["a"] == expected


@pytest.mark.parametrize("message,strict,lenient", [
    ("feat: add", "other", "feature"), ("feat:add", "feature", "feature"), ("fix(api)!: y", "fix", "fix"),
    ("feat!: x", "other", "feature"), ("docs(a b): z", "docs", "docs"), ("build (x)", "other", "other"),
    ("feature: x", "other", "other"), ("Perf: up", "other", "performance"), (None, "other", "other"),
])
def test_lenient_classifier(spark, message, strict, lenient):
    assert one(spark, commit_type, message) == strict
    assert one(spark, lambda m: commit_type(m, lenient=True), message) == lenient


@pytest.mark.parametrize("payload", ['{"a":1.0}', '{"a":1.5}', '{"a":7}', '{"a":"7"}', '{"a":1,"a":2}', '{"a":1e2}'])
def test_safe_int_is_the_same_on_both_routes(spark, payload):
    df = spark.createDataFrame([(payload,)], "data string")
    assert parse_payload(df, [("a", "a", "i")], keep=[]).first()["a"] == df.select(
        safe_int(json_value("data", "$.a")).alias("a")).first()["a"]


def test_container_check_needs_both_brackets_and_a_message_without_a_reference_no_cast(spark):
    from commitlake.functions import json_value
    from commitlake.functions.text import pr_number
    df = spark.createDataFrame([('{"a": "[build] jar"}',), ('{"a": "[x]"}',), ('{"a": ["x"]}',), ('{"a": {"b": 1}}',),
                                ('{"a": "{b}"}',), ('{"a": "fix (#12)"}',), ('{"a": "#99999999999999999999"}',)], "j string")
    got = df.select(json_value("j", "$.a").alias("v"), pr_number(json_value("j", "$.a")).alias("n")).collect()
    assert [r.v for r in got] == ["[build] jar", "[x]", None, None, "{b}", "fix (#12)", "#99999999999999999999"]
    assert [r.n for r in got] == [None, None, None, None, None, 12, None]
    plan = df.select(json_value("j", "$.a"), pr_number(F.col("j")))._jdf.queryExecution().analyzed().toString()
    assert "EndsWith" in plan and "nullif(regexp_extract" in plan
