from __future__ import annotations

from datetime import date

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tristrata import functions as fx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_golden_keys(spark):
    text = lambda v: F.lit(v).cast("string")
    assert one(spark, fx.sk(text("42"))) == 4744849287861989057
    assert one(spark, fx.sk(F.lit(42))) == 4744849287861989057
    assert one(spark, fx.sk(text(None))) == 42
    assert one(spark, fx.sk(text(None), null_key=False)) is None
    assert one(spark, fx.sk(text(""))) == 7444071767201028348


def reference_key(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return min(h if h < 2**63 else 2**64 - h, 2**63 - 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=40), st.none() | st.text(max_size=40)), min_size=20, max_size=60))
def test_composite_keys_are_the_hash_of_their_text(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", fx.sk_concat("a", "b").alias("k"), fx.nk_concat("a", "b").alias("n"))
    for r in got.collect():
        assert r.n == f"{r.a}|{r.b or ''}"
        assert r.k == reference_key(r.n)


def test_version_key_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    # the second time does not exist as wall clock of New York, the third repeats there
    times = {
        1704088800000000: "2024-01-01 06:00:00",
        1710037800500000: "2024-03-10 02:30:00.5",
        1730613600000000: "2024-11-03 06:00:00",
        -1: "1969-12-31 23:59:59.999999",
    }
    try:
        for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for micros, text in times.items():
                start = F.timestamp_micros(F.lit(micros))
                assert one(spark, fx.sk_version(F.lit(7), start)) == reference_key(f"7|{text}")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("5.4 mmol/L", 5.4),
        ("<0.5", 0.5),
        ("3.5-5.0 g/dL", None),
        ("1,200", 1200.0),
        ("Negative", None),
        ("1.5e3", 1.53),
        ("cells 10^3/uL 5", 1035.0),
        ("-", None),
        ("", None),
        (None, None),
    ],
)
def test_extract_number(spark, ansi, text, number):
    assert one(spark, fx.extract_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("09:30", "10:15", 45),
        ("09:30", None, None),
        ("09:30", "10:00:00", None),
        ("9:30", "10:00", None),
        ("23:30", "00:30", -1380),
        ("24:00", "10:00", None),
        ("10:60", "10:00", None),
        (" 09:30", "10:00", None),
        ("09:30\n", "10:00", None),
        ("ab:cd", "10:00", None),
    ],
)
def test_duration(spark, ansi, start, end, minutes):
    text = lambda v: F.lit(v).cast("string")
    day = F.lit(date(2024, 1, 5))
    assert one(spark, fx.duration_minutes(day, text(start), text(end))) == minutes


def test_duration_equals_timestamp_difference(spark):
    rows = [(f"{h:02d}:{m:02d}", f"{(h * 7) % 24:02d}:{(m * 11) % 60:02d}") for h in range(24) for m in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("d", F.lit(date(2024, 1, 5)))
    at = lambda c: F.unix_timestamp(
        F.try_to_timestamp(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" "), F.col(c)), F.lit("yyyy-MM-dd HH:mm"))
    )
    parsed = ((at("b") - at("a")) / 60).cast("int")
    assert df.where(~fx.duration_minutes("d", "a", "b").eqNullSafe(parsed)).count() == 0


def test_no_duration_without_a_day(spark):
    assert one(spark, fx.duration_minutes(F.lit(None).cast("date"), F.lit("09:00"), F.lit("10:00"))) is None


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-05 10:11:12", date(2024, 1, 5)),
        ("2024-1-5", date(2024, 1, 5)),
        ("2024-02-30", None),
        ("05/01/2024", None),
        ("", None),
    ],
)
def test_try_date(spark, ansi, text, day):
    assert one(spark, fx.try_date(F.lit(text))) == day


@pytest.mark.parametrize(
    ("value", "number"),
    [("5.0", 5), (" 7 ", 7), ("abc", None), (1e12, None), ("", None), (5.7, 5), ("-3.9", -3),
     ("5d", None), ("1e3", 1000), ("NaN", None), ("\t8\n", 8), ("3000000000", None), ("+4.", 4)],
)
def test_safe_int(spark, ansi, value, number):
    assert one(spark, fx.safe_int(F.lit(value))) == number


@pytest.mark.parametrize("text", ["1.5", " 2 ", "-.5", "1e-3", "x", "", "1.2.3", "Infinity", "5d", "--1", "1e", "0x1p3"])
def test_safe_float_equals_try_cast(spark, text):
    assert one(spark, fx.safe_cast(F.lit(text), "double")) == one(spark, F.lit(text).try_cast("double"))


def test_bad_numbers_raise_nothing_inside(spark):
    bad = spark.range(300_000).select(F.concat(F.lit("n/a "), F.col("id").cast("string")).alias("x"))
    assert bad.where(fx.safe_int("x").isNotNull() | fx.safe_cast("x", "float").isNotNull()).count() == 0


def test_normalize_keeps_tabs(spark):
    assert one(spark, fx.normalize(F.lit("  A\t "))) == "a\t"
