"""Published tables and the incremental summary built on them."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import Params
from tallyloom.plans import finance
from tallyloom.sources import versions

from .conftest import rows

LOAD = ("id long, part string, v long, at int", ["id"], "part", "at")


def load(spark, path, data, shape=lambda df: df):
    df = shape(spark.createDataFrame(data, LOAD[0]))
    versions.upsert_published(spark, path, df, LOAD[1], LOAD[2], LOAD[3])


def test_upserts_replace_by_key_and_keep_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not versions.is_published(spark, path)
    load(spark, path, [(1, "2001-01", 1, 1), (2, "2001-02", 2, 1), (2, "2001-02", 3, 2)])
    load(spark, path, [(2, "2001-02", 9, 3), (3, "2001-02", 4, 1), (4, "a b=c", 5, 1)])
    want = [(1, "2001-01", 1), (2, "2001-02", 9), (3, "2001-02", 4), (4, "a b=c", 5)]
    assert rows(versions.read_published(spark, path), "id", "part", "v") == want
    load(spark, path, [(2, "2001-02", 9, 3), (3, "2001-02", 4, 1), (4, "a b=c", 5, 1)])
    assert rows(versions.read_published(spark, path), "id", "part", "v") == want
    one = versions.read_published(spark, path).filter("part = '2001-01'")
    assert len(one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]) > 5
    assert versions.remove_unread(spark, path, keep=1) == 1
    assert rows(versions.read_published(spark, path), "id", "part", "v") == want
    with pytest.raises(ValueError):
        load(spark, path, [(1, "2001-01", 1, 1)], lambda df: df.withColumn("v", F.lit("x")))


@pytest.mark.parametrize("broken", ["write", "manifest"])
def test_a_load_that_fails_halfway_leaves_the_old_version_whole(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "t")
    load(spark, path, [(i, f"p{i % 5}", i, 1) for i in range(50)])
    before = rows(versions.read_published(spark, path), "id", "part", "v")
    new = [(i, f"p{i % 5}", -i, 2) for i in range(100)]
    with pytest.raises(Exception):
        if broken == "write":
            # the staged rows are whole; writing the merged ones fails in one task after others have written theirs
            merge = versions.merge_rows

            def failing(old, fresh, key):
                bad = F.when(F.col("id") == 73, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
                return merge(old, fresh, key).withColumn("v", bad.cast("long"))

            monkeypatch.setattr(versions, "merge_rows", failing)
        else:
            monkeypatch.setattr(versions, "_publish", lambda *a: 1 / 0)
        load(spark, path, new)
    monkeypatch.undo()
    assert rows(versions.read_published(spark, path), "id", "part", "v") == before
    load(spark, path, new)
    assert rows(versions.read_published(spark, path), "id", "v") == sorted(((i, -i) for i in range(100)), key=repr)
    assert versions.remove_unread(spark, path) >= (1 if broken == "manifest" else 0)


def test_a_number_that_is_taken_refuses_the_load(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [(1, "a", 1, 1)])
    with pytest.raises(RuntimeError):
        versions._publish(spark, path, 1, {"part=a": "other"})
    assert rows(versions.read_published(spark, path), "id") == [(1,)]


def lines(spark, days):
    rng = random.Random(4)
    data = []
    for d in days:
        for group in (("amazon", "Kurta", "b2b"), ("amazon", None, "b2c"), ("international", "Set", "b2c")):
            if rng.random() < 0.9:
                data += [(*group, d, f"s{k}", rng.randrange(99), rng.randrange(1, 4), float(rng.randrange(100, 900))) for k in range(2)]
    df = spark.createDataFrame(
        data, "partner_channel string, product_category string, customer_segment string, order_date date, product_sku string,"
              " order_id long, quantity int, revenue_per_unit double")
    return df.withColumn("revenue", (F.col("revenue_per_unit") * F.col("quantity")).cast("decimal(18,2)"))


def test_refresh_equals_a_full_rebuild_and_reads_only_reached_months(spark, tmp_path, monkeypatch):
    p = Params(as_of=date(2004, 1, 1))
    monkeypatch.setattr(finance, "REACH", 40)
    whole = lines(spark, [date(2000, 1, 1) + timedelta(days=i) for i in range(700)])
    changed = [date(2000, 9, 10), date(2000, 9, 12)]
    path = str(tmp_path / "summary")
    first = whole.filter(~F.col("order_date").isin(changed) | (F.col("product_sku") == "s0") & (F.col("order_date") == changed[1]))
    finance.save_financial_summary(spark, finance.financial_summary(finance.financial_performance(first), p), path)
    months = finance.refresh_financial_summary(spark, path, whole, changed, p)
    # 40 rows on both sides of the changed days, in whole months, out of 23 months
    assert {"2000-08", "2000-09", "2000-10"} <= set(months) <= {f"2000-{m:02d}" for m in range(7, 12)}
    want = finance.financial_summary(finance.financial_performance(whole), p)
    got = versions.read_published(spark, path)
    columns = [c for c in want.columns if not c.startswith("summary_")]
    assert rows(got, *columns) == rows(want, *columns)
