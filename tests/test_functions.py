"""Text, JSON and time rules against hand-read expectations."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from sluice.functions import jsonvalue as J
from sluice.functions import text as X
from sluice.functions import timetext as T


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_text_rules_match_python(spark):
    values = ["  a\t b \n", "o'neil abc1def", " x　", "ÉCOLE été", "", "a\x1cb"]
    assert column(spark, values, X.strip) == [v.strip() for v in values]
    assert column(spark, values, X.collapse_spaces) == [" ".join(v.split()) for v in values]
    assert column(spark, values, X.title) == [v.title() for v in values]


def test_float_text_matches_python(spark):
    values = [0.0, -0.0, 1.0, -2.5, 0.1, 1e-4, 9.5e-5, 1.5e-7, 12345678.5, 1e15, 1e16, 1.5e20, 123456789012.25,
              float("inf"), float("-inf"), float("nan"), 300.0, 1e-3, 1e7]
    assert column(spark, values, X.float_text, "double") == [str(v) for v in values]


def test_json_quote_matches_python(spark):
    values = ["plain", 'q"\\', "é", "😀x", "\n\t\r\b\f\x01\x7f", "a/b"]
    assert column(spark, values, X.json_quote) == [json.dumps(v) for v in values]


def test_only_one_whole_json_value_is_accepted(spark):
    values = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}],[1', "", "nope", "12", "null"]
    got = column(spark, values, lambda c: J.whole(J.parse_wrapped(c)))
    assert got == [True, True, False, False, False, False, False, False, True, True]


def test_base64_needs_complete_padding(spark):
    values = ["YWJj", "YW Jj", "YQ==", "YQ=", "YWJ", "notjson", "/w==", "é", "YQ==zz"]
    assert column(spark, values, J.base64_text) == ["abc", "abc", "a", None, None, None, None, None, "a"]


def micros(*args):
    at = datetime.datetime(*args, tzinfo=datetime.timezone.utc)
    return (at - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)) // datetime.timedelta(microseconds=1)


TIMES = [
    ("2024-01-05T10:11:12Z", micros(2024, 1, 5, 10, 11, 12)),
    ("2024-01-05 10:11:12", micros(2024, 1, 5, 10, 11, 12)),
    ("2024-01-05x10:11", micros(2024, 1, 5, 10, 11)),
    ("2024-01-05T10", micros(2024, 1, 5, 10)),
    ("2024-01-05T10:11:12.123", micros(2024, 1, 5, 10, 11, 12, 123000)),
    ("2024-01-05T10:11:12.123456+05:30", micros(2024, 1, 5, 4, 41, 12, 123456)),
    ("2024-01-05T10:11:12-23:30", micros(2024, 1, 6, 9, 41, 12)),
    ("2024-01-05T10:11:12.12", None),
    ("2024-01-05", micros(2024, 1, 5)),
    ("2024/1/5", micros(2024, 1, 5)),
    ("2024/01/05 3:4:5", micros(2024, 1, 5, 3, 4, 5)),
    ("2024-02-30", None),
    ("2024-01-05T24:00:00Z", None),
    ("12:00", None),
    ("2026", micros(1970, 1, 1, 0, 33, 46)),
    ("20260223", micros(1970, 8, 23, 11, 50, 23)),
    ("1704067200", micros(2024, 1, 1)),
    ("1704067200000", micros(2024, 1, 1)),
    ("1704067200123456", micros(2024, 1, 1, 0, 0, 0, 123456)),
    (" 1.5 ", 1_500_000),
    ("-1", -1_000_000),
    ("1_000", 1_000_000_000),
    ("1e20", None),
    ("nan", None),
    ("", None),
    ("   ", None),
    ("yesterday", None),
]


def test_event_time_grammar(spark):
    got = column(spark, [t for t, _ in TIMES], lambda c: F.unix_micros(T.parse_event_time(c, F.lit("string"))))
    assert dict(zip([t for t, _ in TIMES], got)) == dict(TIMES)


@pytest.mark.parametrize("kind,expected", [("integer", micros(2024, 1, 1)), ("boolean", None), ("object", None), ("null", None)])
def test_event_time_of_other_kinds(spark, kind, expected):
    got = column(spark, ["1704067200000"], lambda c: F.unix_micros(T.parse_event_time(c, F.lit(kind))))
    assert got == [expected]


def test_string_kinds(spark):
    cases = {
        "2024-01-05T10:11:12Z": "timestamp", "2024-01-05T10:11:12+05:30": "timestamp", "2024-01-05T10:11": "datetime",
        "2024-01-05": "date", "2024-02-30": "string", "10:11": "time", "12": "time", "42": "string", "10:11+02:00": "time",
        "2024-01-05 10:11:12": "string", "": "string", "Tea": "string", "1704067200": "string", " 2024-01-05 ": "date",
    }
    assert column(spark, list(cases), T.string_kind) == list(cases.values())


def test_canonical_temporal_texts(spark):
    assert column(spark, ["10", "10:11", "10:11:12.5", "10:11:12.500", "10:11:12.000", "25:00", "10:11Z"], T.iso_time) == [
        "10:00:00", "10:11:00", None, "10:11:12.500000", "10:11:12", None, None]
    assert column(spark, ["2024-01-05", "2024-01-05T10:11Z", "2024-01-05 10:11:12-00:00", "2024-02-30T10"], T.iso_datetime) == [
        "2024-01-05T00:00:00", "2024-01-05T10:11:00+00:00", "2024-01-05T10:11:12+00:00", None]


def test_texts_that_cannot_be_json_are_not_parsed(spark):
    """The look at the first characters refuses nothing that the parser reads."""
    texts = [
        '{"a": 1}', ' \t\r\n[1]', '"x"', "-1.5e3", "0", "true", "false", "null", " null ", "not-json", "nul", "oops{", "eyJhIjoxfQ==", "",
        " ", "NaN", "Infinity", "+1", ".5", "]", "],[", "\u00a01", "\ufeff1", "/* */1", "'x'", "truex", "1 2", "1]", None,
    ]
    whole = lambda v: F.when(J.whole(F.col(v)), F.to_json(J.first_value(F.col(v))))
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    d = d.withColumns({"now": J.parse_wrapped(F.col("t")), "all": F.try_parse_json(F.concat(F.lit("["), "t", F.lit(',"\\u0001end"]')))})
    rows = d.select("t", whole("now").alias("now"), whole("all").alias("all"), F.col("now").isNull().alias("skipped")).collect()
    assert [r for r in rows if r["now"] != r["all"]] == []
    assert {r.t for r in rows if r["all"] is not None} == {*texts[:9]}
    assert all(r.skipped for r in rows if r.t in ("not-json", "oops{", "eyJhIjoxfQ=="))
