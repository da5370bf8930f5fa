import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from partnerlens.functions import columns as X


def test_safe_cast_blank_and_junk(spark):
    df = spark.createDataFrame([("",), (" ",), ("abc",), ("12",), (None,)], "s string")
    out = df.select(X.safe_cast("s", "int").alias("i"), X.safe_cast("s", "numeric").alias("n")).collect()
    assert [r.i for r in out] == [None, None, None, 12, None]
    assert out[3].n == Decimal("12.00")


def test_safe_cast_bool_and_ts(spark):
    df = spark.createDataFrame([("true",), ("false",), ("",), ("2001-02-03T04:05:06Z",)], "s string")
    out = df.select(X.safe_cast("s", "bool").alias("b"), X.safe_cast("s", "timestamp").alias("t")).collect()
    assert [r.b for r in out[:3]] == [True, False, None]
    assert out[3].t == dt.datetime(2001, 2, 3, 4, 5, 6)


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 2)], "n int, d int")
    assert [r.q for r in df.select(X.safe_divide(F.col("n"), F.col("d")).alias("q")).collect()] == [None, None, 1.5]


def test_seconds_between_keeps_fraction(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, 0, 0, 1, 500000), dt.datetime(2001, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(X.seconds_between(F.col("a"), F.col("b")).alias("s")).first().s == 1.5


def test_regex_group_email_domain(spark):
    df = spark.createDataFrame([("A@B.com",), ("noat",), ("a@b@c.org",), (None,)], "e string")
    assert [r.d for r in df.select(X.email_domain(F.col("e")).alias("d")).collect()] == ["b.com", None, "c.org", None]


def test_json_value(spark):
    df = spark.createDataFrame([('{"a":" x ","n":null,"o":{"k":1}}',), ("not json",)], "j string")
    out = df.select(X.json_value(F.col("j"), "a").alias("a"), X.json_value(F.col("j"), "n").alias("n"),
                    X.json_value(F.col("j"), "missing").alias("m")).collect()
    assert out[0].a == " x " and out[0].n is None and out[0].m is None
    assert out[1].a is None


def test_parse_loose_timestamp(spark):
    df = spark.createDataFrame([("1000",), ("1970-01-01T00:00:02Z",), ("junk",), ("",)], "s string")
    out = [r.t for r in df.select(X.parse_loose_timestamp(F.col("s")).alias("t")).collect()]
    assert out == [dt.datetime(1970, 1, 1, 0, 0, 1), dt.datetime(1970, 1, 1, 0, 0, 2), None, None]


def test_days_between_nonneg(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 3), dt.datetime(2001, 1, 1)), (dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 3)),
                                (None, dt.datetime(2001, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    out = [r.d for r in df.select(X.days_between_nonneg(F.col("a"), F.col("b")).alias("d")).collect()]
    assert out == [2.0, None, None]
