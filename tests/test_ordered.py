"""Ordered operators against plain windows, with one hot group, NULL keys and many ranges and blocks."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tallyloom.operators import ordered

from .conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, ties in the ordering value, NULL keys and values."""
    rng = random.Random(3)
    data = []
    for i in range(400):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        data.append((key, rng.randrange(30), i, None if i % 50 == 0 else rng.randrange(12)))
    return spark.createDataFrame(data, "k string, o int, id int, v int").repartition(5)


@pytest.fixture(params=[20, 500_000])
def part_rows(request, monkeypatch):
    """Many small parts, and none."""
    monkeypatch.setattr(ordered, "PART_ROWS", request.param)
    return request.param


def order():
    return [F.col("o").asc(), F.col("id").asc()]


def by():
    return ordered.by("o", "id")


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sums_and_row_numbers(skewed, keys, part_rows):
    upto = Window.partitionBy(*keys).orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumns({"s": F.sum("v").over(upto), "c": F.count("*").over(upto), "low": F.min("o").over(Window.partitionBy(*keys)), "all": F.sum("v").over(Window.partitionBy(*keys))})
    got = ordered.running_sums(skewed, keys, by(), {"s": F.col("v"), "c": F.lit(1)}, lowest={"low": "o"}, totals={"all": "s"})
    assert rows(got, "id", "s", "c", "low", "all") == rows(plain, "id", "s", "c", "low", "all")
    assert rows(ordered.row_numbers(skewed, keys, by(), "n"), "id", "n") == rows(plain, "id", "c")


def test_counts_of_subgroups_share_the_layout(skewed, part_rows):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k", "v").orderBy(*order())))
    got = ordered.running_sums(skewed, ["k"], by(), {"c": F.lit(1)}, counts={"n": ["v"]})
    assert rows(got, "id", "n") == rows(plain, "id", "n")


def test_double_sums_are_refused(skewed):
    with pytest.raises(TypeError):
        ordered.running_sums(skewed, ["k"], by(), {"s": F.col("v").cast("double")})


@pytest.mark.parametrize("reach", [6, 40])
def test_frames_reach_over_parts(skewed, reach, part_rows):
    def exprs(w):
        return {"lag": F.lag("v", reach).over(w), "sum": F.sum("v").over(w.rowsBetween(-reach, 0))}

    plain = skewed.withColumns(exprs(Window.partitionBy("k").orderBy(*order())))
    plain = plain.withColumn("n", F.row_number().over(Window.partitionBy("k", "v").orderBy(*order())))
    got = ordered.with_frames(skewed, ["k"], by(), exprs, reach=reach, counts={"n": ["v"]})
    assert set(got.columns) == set(plain.columns)
    assert rows(got, "id", "lag", "sum", "n") == rows(plain, "id", "lag", "sum", "n")


@pytest.mark.parametrize("n", [7, 399])
def test_ntile(skewed, n, part_rows):
    down = [F.col("v").desc_nulls_last(), F.col("o").desc_nulls_first(), F.col("id").desc()]
    plain = skewed.withColumns({"t": F.ntile(n).over(Window.orderBy(*order())), "u": F.ntile(n).over(Window.orderBy(*down))})
    turned = [ordered.By("v", True), ordered.By("o", True, True), ordered.By("id", True)]
    got = ordered.ntile_scores(skewed, n, {"t": by(), "u": turned})
    assert rows(got, "id", "t", "u") == rows(plain, "id", "t", "u")
    assert ordered.ntile_scores(skewed.limit(0), 5, {"t": by()}).count() == 0


def test_code_follows_the_ordering(spark):
    """The code never falls along the ordering, for every kind of column, direction and place of NULLs."""
    import datetime as dt

    rng = random.Random(6)
    texts = ["", "a", "ab", "abc", "abcde", "abcdf", "z", "é", "ÿ", "\u4e2d", "~", "Z", None]
    data = [(rng.choice([None, dt.date(1960 + i, 1, 1 + i % 3)]) if i % 4 else dt.date(2000, 1, 1), rng.choice(texts),
             rng.choice([None, float("nan"), -1.5, 0.0, 7e20, float("inf"), -float("inf")]), i) for i in range(60)]
    df = spark.createDataFrame(data, "d date, s string, x double, i int").withColumn("ts", F.timestamp_seconds(F.col("i") * 1000 - 20000))
    for columns in (["d", "s", "i"], ["s", "i"], ["x", "i"], ["ts"], ["d", "x", "i"]):
        for down in (False, True):
            for first in (False, True):
                o = ordered.by(*columns, descending=down, nulls_first=first)
                codes = [r.c for r in df.withColumn("c", ordered._code(df, o)).orderBy(*[b.sort() for b in o]).collect()]
                assert codes == sorted(codes), (columns, down, first)


def test_one_exchange_serves_sums_counts_and_minima(skewed, spark, part_rows):
    got = ordered.running_sums(
        skewed, ["k"], by(), {"s": F.col("v")}, lowest={"low": "o"}, totals={"all": "s"}, counts={"n": ["v"]})
    plan = got._jdf.queryExecution().executedPlan().toString()
    # sums per part of large groups are a small second branch
    assert "Exchange hashpartitioning" in plan and "rangepartitioning" not in plan
    if part_rows == 500_000:
        assert plan.count("Exchange hashpartitioning") == 1


def test_value_ranks(skewed, part_rows):
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    plain = skewed.withColumns({"r": F.rank().over(w), "d": F.dense_rank().over(w), "p": F.percent_rank().over(w)})
    got = ordered.value_ranks(skewed, ["k"], "v", True, "r", "d", "p")
    assert rows(got, "id", "r", "d", F.round("p", 9)) == rows(plain, "id", "r", "d", F.round("p", 9))


def test_numbers_and_frames_of_subgroups_share_an_exchange(skewed, part_rows):
    def exprs(w):
        return {"lag": F.lag("v", 1).over(w), "sum": F.sum("v").over(w.rowsBetween(-6, 0))}

    plain = skewed.withColumns(exprs(Window.partitionBy("k", "v").orderBy(*order())))
    plain = plain.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order())))
    got = ordered.numbered_frames(skewed, ["k"], ["v"], by(), exprs, 6, "n")
    assert set(got.columns) == set(plain.columns)
    assert rows(got, "id", "lag", "sum", "n") == rows(plain, "id", "lag", "sum", "n")
    if part_rows == 500_000:
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("down", [False, True])
def test_row_ranks(skewed, keys, down, part_rows):
    w = Window.partitionBy(*keys).orderBy(F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_last())
    plain = skewed.withColumn("r", F.rank().over(w))
    assert rows(ordered.row_ranks(skewed, keys, "v", "r", down), "id", "r") == rows(plain, "id", "r")


def test_parts_are_assigned_in_generated_code(skewed, monkeypatch):
    """No lambda runs over the cut points of a row."""
    monkeypatch.setattr(ordered, "PART_ROWS", 20)
    laid, cut = ordered._parted(skewed, ["k"], by())
    assert cut and "lambda" not in laid._jdf.queryExecution().executedPlan().toString()


def test_percentiles_and_mode(skewed, spark):
    import numpy as np

    data = [(r.k, r.v) for r in skewed.collect() if r.v is not None]
    got = {r.k: (r.a, r.b) for r in ordered.exact_percentiles(skewed, ["k"], "v", {"a": 0.3, "b": 1.0}).collect()}
    for k in {k for k, _ in data}:
        vals = [v for kk, v in data if kk == k]
        assert got[k] == pytest.approx((np.percentile(vals, 30), max(vals)))
    df = spark.createDataFrame([("x", 2), ("x", 1), ("x", None), ("y", None)], "k string, v int")
    assert rows(ordered.most_frequent(df, ["k"], "v", "m"), "k", "m") == [("x", 1)]
