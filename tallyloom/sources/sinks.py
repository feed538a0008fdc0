"""Writers: full refresh, view, append, keyed upsert, failing rows, report files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def check_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Fail on any schema change (names or types) against the target table."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in target}
    if have != want:
        changed = sorted(k for k in have.keys() | want.keys() if have.get(k) != want.get(k))
        raise ValueError(f"schema change in {changed}")
    return df.select(*[f.name for f in target])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_failures(checks: dict[str, DataFrame], folder: str) -> None:
    """Store the failing rows of each named check."""
    for name, rows in checks.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")


def merge_rows(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key is not replaced, plus all of ``new``."""
    cond = reduce(lambda a, b: a & b, (old[k].eqNullSafe(new[k]) for k in key))
    return old.join(new, cond, "left_anti").unionByName(new)


def last_versions(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the largest ``order``."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.max(F.struct(F.col(order).alias("o"), row.alias("r"))).alias("v")).select("v.r.*")


def upsert_partitions(
    spark: SparkSession, path: str, new: DataFrame, key: Sequence[str], partition: str, order: str,
) -> None:
    """Keyed upsert into a Parquet table partitioned by ``partition`` (which ``key`` determines).

    Of several rows of one key in ``new`` the one with the largest ``order`` wins (NULL is the smallest; of
    equals the row that sorts last).  Only the partitions that occur in ``new`` are read and
    replaced, so the cost follows the size of the change, not of the table.  Running it twice changes
    nothing.  ``new`` is staged first: it is used twice and must not depend on the files being
    replaced.  The final overwrite replaces folders one after another: if it fails halfway, run the same
    load again; readers that need all or nothing read a copy.
    """
    from .staging import stage, unstage

    new = stage(last_versions(new, key, order), "upsert")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    merged = new
    if fs.exists(hadoop):
        # the partition column is text in the path; its type is taken from the new rows
        check_schema(spark.read.parquet(path).drop(partition), new.drop(partition).schema)
        old = spark.read.schema(new.schema).parquet(path)
        touched = new.select(partition).distinct()
        # pruned at run time to the partitions present in `touched`
        merged = stage(merge_rows(old.join(touched, partition, "left_semi"), new, key), "upsert")
    # rebalancing gathers small partitions into one file and spreads a large one over several tasks
    (
        merged.hint("rebalance", partition)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )
    unstage(new)
    if merged is not new:
        unstage(merged)
