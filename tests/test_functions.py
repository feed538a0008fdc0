from datetime import date, datetime

from pyspark.sql import functions as F

from tallyloom import functions as f
from tallyloom.fixed_values import CHEAPEST_PRIORITY, Bands, Rules
from tallyloom.functions.rules import argmax_label, decide, tier


def one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def test_casts_round_and_fail_to_null(spark):
    got = one(spark, "a string, b string, c string", ("12.5", "n/a", "1234567890.12"),
              f.safe_int("a"), f.safe_int("b"), f.safe_decimal("c", 10, 2))
    assert list(got) == [13, None, None]


def test_division_guards(spark):
    got = one(spark, "a int, z int, n int", (7, 0, None), f.safe_divide("a", "z"), f.safe_divide("a", "n"), f.cents_to_dollars("a"))
    assert list(got) == [None, None, 0.07]


def test_exact_ratio_rounds_ties_half_up(spark):
    got = one(spark, "a string, q int", ("3.49", 2), f.exact_ratio(F.col("a").cast("decimal(10,2)"), "q"))
    assert str(got[0]) == "1.75"


def test_dates(spark):
    a, b = date(2022, 1, 31), date(2022, 2, 1)
    got = one(spark, "a date, b date", (a, b), f.month_diff("a", "b"), f.day_of_week0(F.lit(date(2022, 1, 2))), f.year_month("a"))
    assert list(got) == [1, 0, "2022-01"]
    got = one(spark, "a timestamp, b timestamp", (datetime(2022, 1, 1, 0, 59), datetime(2022, 1, 1, 1, 1)), f.hours_between("a", "b"))
    assert got[0] == 1
    texts = one(spark, "a string, b string, c string", ("01-16-95", "01-16-1995", "03-02-22"), *[f.parse_month_first(c) for c in "abc"])
    assert list(texts) == [date(1995, 1, 16), None, date(2022, 3, 2)]


def test_business_days_match_counting(spark):
    start, end = date(2022, 1, 1), date(2022, 3, 9)
    days = [date.fromordinal(n) for n in range(start.toordinal(), end.toordinal())]
    got = one(spark, "a date, b date", (start, end), f.business_days("a", "b"), f.business_days("b", "a"), f.business_days("a", "a"))
    want = sum(d.weekday() < 5 for d in days)
    assert list(got) == [want, -want, 0]


def test_keys_and_hash(spark):
    import hashlib

    got = one(spark, "a string, b string", ("x", None), f.surrogate_key("a", "b"), f.row_hash("a", "b"))
    assert got[0] == hashlib.md5(b"x-_dbt_utils_surrogate_key_null_").hexdigest()
    assert got[1] == hashlib.md5(b"x").hexdigest()


def test_rules_first_match_and_null(spark):
    bands = Bands(">=", ((10, "big"), (5, "mid")), "small")
    df = spark.createDataFrame([(10,), (5,), (4,), (None,)], "x int")
    assert [r[0] for r in df.select(tier("x", bands)).collect()] == ["big", "mid", "small", "small"]
    assert [r[0] for r in df.select(decide(Rules((("five", "x = 5"),), None))).collect()] == [None, "five", None, None]
    tie = spark.createDataFrame([(3, 3, 1)], "a int, b int, c int")
    assert tie.select(argmax_label((("c", "C"), ("b", "B"), ("a", "A")))).first()[0] == "B"
    assert CHEAPEST_PRIORITY[0] == "ajio"


def test_clamp(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (500.0,)], "x double")
    assert [r[0] for r in df.select(f.clamp(F.col("x"))).collect()] == [0.0, 50.0, 100.0]
