from decimal import ROUND_HALF_UP, Decimal

import pytest
from fixtures import at, values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmere.functions import days, labels, repair
from eventmere.functions.exact import percent_2dp, ratio_2dp


def half_up(s, n):
    exact = (Decimal(s) * 10**10 / Decimal(n)) if n else None
    if exact is None:
        return None
    cents, rest = divmod(abs(s) * 100, n)
    cents += 1 if 2 * rest >= n else 0
    return float(Decimal(cents if s >= 0 else -cents) / 100)


def test_every_half_is_rounded_away_from_zero(spark):
    rows = spark.range(600, 6000).select(ratio_2dp(F.col("id"), F.lit(200)).alias("r"), "id").collect()
    expected = {s: float((Decimal(s) / 200).quantize(Decimal("0.01"), ROUND_HALF_UP)) for s in range(600, 6000)}
    assert {r.id: r.r for r in rows} == expected


def test_no_double_rounding(spark):
    row = spark.range(1).select(ratio_2dp(F.lit(16496), F.lit(100000)).alias("r")).first()
    assert row.r == 0.16


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(0, 10**12)), min_size=1, max_size=50))
def test_ratio_matches_whole_number_arithmetic(spark, pairs):
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(pairs)], "i int, s long, n long")
    got = {r.i: r.r for r in df.select("i", ratio_2dp(F.col("s"), F.col("n")).alias("r")).collect()}
    assert got == {i: half_up(s, n) for i, (s, n) in enumerate(pairs)}


def test_huge_products_fit(spark):
    s, n = F.lit("300000000000000000000000").cast("decimal(38,0)"), F.lit("90000000000000000000000").cast("decimal(38,0)")
    assert spark.range(1).select(ratio_2dp(s, n).alias("r")).first().r == 3.33


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(percent_2dp(F.lit(3), F.lit(0)).alias("r")).first().r is None


@pytest.mark.parametrize(
    ("text", "number"),
    [("3", 3), ("3.0", 3), (" 4 ", 4), ("3.9", 3), ("1e3", 1000), ("n/a", None), ("", None), (None, None),
     ("3d", None), ("NaN", None), ("Infinity", None), ("9007199254740993", 9007199254740993)],
)
def test_lenient_long(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(repair.lenient_long(F.col("t")).alias("v")).first().v == number


def test_lenient_double_keeps_fractions(spark):
    df = spark.createDataFrame([("7.5",), ("x",), ("-.5",)], "t string")
    assert [r.v for r in df.select(repair.lenient_double(F.col("t")).alias("v")).collect()] == [7.5, None, -0.5]


def test_lenient_time_applies_offsets(spark):
    df = spark.createDataFrame([("2026-07-01 10:00:00.5+02:00",), ("2026-07-01 08:00:00.5",), ("bad",)], "t string")
    got = [r.v for r in df.select(F.unix_micros(repair.lenient_time(F.col("t"))).alias("v")).collect()]
    assert got[0] == got[1] == int(at("2026-07-01 08:00:00.5").timestamp() * 10**6)
    assert got[2] is None


def test_day_ranges():
    assert days.parse_range(None, None) is None
    first, last = days.parse_range("2024-02-28", "2024-03-01")
    assert days.day_list(first, last) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(ValueError):
        days.parse_range("2024-02-28", None)
    with pytest.raises(ValueError):
        days.parse_range(None, "2024-02-28")
    with pytest.raises(ValueError):
        days.parse_range("2024-03-02", "2024-03-01")


def test_stable_ids_tell_shifted_values_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), ("ab", "c")], "x string, y string")
    ids = [r.i for r in df.select(labels.stable_uuid(F.col("x"), F.col("y")).alias("i")).collect()]
    assert ids[0] == ids[3] and len(set(ids)) == 3 and all(len(i) == 36 for i in ids)


def test_labels(spark):
    df = spark.createDataFrame([(at("2024-01-31 12:05:59"), "Video_START", 7)], "t timestamp, k string, n int")
    row = values(
        df.select(
            labels.order_label(F.col("t"), F.lit(123456)),
            labels.minute_stamp(F.col("t")),
            labels.day_text(F.col("t")),
            labels.kind_of(F.col("k")),
            labels.kind_of(F.lit(None).cast("string")),
            labels.creator_label(F.col("n")),
        )
    )[0]
    assert row == ("ORD-20240131-123456", "20240131_1205", "2024-01-31", "video_start", "none", "Creator 7")
