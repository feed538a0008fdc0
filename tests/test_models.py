"""Models: draws follow row keys, not the layout of the table."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.ml import models

from .conftest import rows


@pytest.mark.parametrize("n", [300, 60_000])
def test_isolation_forest_ignores_partitioning(spark, n):
    rng = random.Random(4)
    data = [(f"k{i}", float(rng.gauss(100, 10) if i % 50 else 900 + i % 7), rng.randrange(1, 9), rng.randrange(60, 100)) for i in range(n)]
    df = spark.createDataFrame(data, "order_item_key string, order_amount double, quantity int, order_performance_score int")
    few, many = (
        models.isolation_forest(df.repartition(parts), trees=20, sample=64).select("order_item_key", "anomaly_score", "is_anomaly")
        for parts in (2, 7)
    )
    assert few.exceptAll(many).isEmpty() and few.count() == n
    assert 0 < few.filter("is_anomaly").count() <= 0.1 * n + 1


def test_train_split_is_by_key(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    share = df.filter(models.train_split(df, "k")).count() / 5000
    assert 0.78 < share < 0.82
    assert rows(df.filter(models.train_split(df, "k")), "k") == rows(df.repartition(5).filter(models.train_split(df, "k")), "k")


def test_forest_ignores_partitioning(spark):
    """Steps and a slope in more values than bins, with noise."""
    rng = random.Random(9)
    data = []
    for i in range(3000):
        q, p, m = rng.randrange(1, 51), rng.choice((60, 70, 80)), rng.choice((10.5, 20.25, 30.0, None))
        data.append((f"k{i}", 10.0 * q + (40 if p > 60 else 0) + (m or 0) + rng.gauss(0, 20), q, p, m))
    df = spark.createDataFrame(data, "order_item_key string, order_amount double, quantity int, order_performance_score int, seasonal_avg_order_value double")
    few, many = (models.revenue_forest(df.repartition(parts), trees=20).collect() for parts in (2, 7))
    for a, b in zip(few, many):
        assert a.feature == b.feature and tuple(a)[1:] == pytest.approx(tuple(b)[1:], rel=1e-6)
    assert sum(r.importance for r in few) == pytest.approx(1) and few[0].importance == max(r.importance for r in few)
    assert few[0].train_rows + few[0].test_rows == df.dropna().count() and few[0].r2 > 0.6


def test_regression_tree_grows_to_the_cells():
    """One tree that may try every feature predicts each cell's own mean."""
    bins = np.array([(a, b) for a in range(5) for b in range(3)])
    mean = np.random.default_rng(1).normal(size=len(bins))
    predicted, gains = models._regression_tree(bins, np.full(len(bins), 2.0), 2 * mean, bins, np.random.default_rng(2), 30, 2)
    assert predicted == pytest.approx(mean) and (gains > 0).all()


@pytest.mark.parametrize("sample", [2, 40, 300])
def test_leaf_masks_end_in_the_leaf_that_the_walk_reaches(sample):
    """Also rows that lie on a cut, and trees of more leaves than one word of bits."""
    rng = np.random.default_rng(sample)
    x = np.column_stack([rng.normal(size=sample).round(2), rng.integers(0, 9, sample), rng.integers(0, 2, sample)]).astype(float)
    trees = [[np.array(c) for c in zip(*models._grow(x, np.random.default_rng(i), 12))] for i in range(3)]
    places = [np.unique(np.concatenate([t[2][t[1] == f] for t in trees])) for f in range(3)]
    tried = np.concatenate([x, x + 0.3, [[1e9] * 3, [-1e9] * 3], np.column_stack([np.resize(p if len(p) else [0.0], 50) for p in places])])
    cells = [np.searchsorted(p, tried[:, f]) for f, p in enumerate(places)]
    for _, feature, cut, left, right, path in trees:
        walked = []
        for row in tried:
            at = 0
            while feature[at] >= 0:
                at = left[at] if row[feature[at]] <= cut[at] else right[at]
            walked.append(path[at])
        assert models._path_lengths(cells, *models._leaf_masks(feature, cut, left, right, path, places)).tolist() == walked
