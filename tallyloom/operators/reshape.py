"""Dynamic pivot, duplicate keys, row change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import row_hash
from ..sources.staging import spread


def pivot_table(
    df: DataFrame, group: Sequence[str], column: str, value: str, agg: str = "sum", values: Sequence | None = None,
) -> DataFrame:
    """One column per value of ``column`` (lower case, blanks and dashes to ``_``).

    Spark finds the values itself; give ``values`` to save that pass.  Cells without rows
    count as 0, as do the rows of other values for every aggregate.
    """
    known = values
    if known is None:
        # the values become columns, so they are few; Spark's own pivot bound applies
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        rows = df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{column} has more than {limit} values; raise spark.sql.pivotMaxValues or pass values")
        known = [r[0] for r in rows]
    fn = getattr(F, agg)
    cells = [
        fn(F.when(F.col(column) == F.lit(v), F.col(value)).otherwise(F.lit(0))).alias(
            str(v).replace(" ", "_").replace("-", "_").lower()
        )
        for v in known
    ]
    return df.groupBy(*group).agg(*cells)


def duplicate_keys(df: DataFrame, key: str, attributes: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys that occur with more than one combination of attributes; many known ``rows`` are dealt to more tasks.

    Rows are dealt by all columns, so a key with many rows is no single task's.
    """
    combos = spread(df.filter(F.col(key).isNotNull()), [key, *attributes], rows).groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("rows"))
    return combos.groupBy(key).agg(F.count(F.lit(1)).alias("combinations")).filter("combinations > 1")


def row_hash_changes(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between two versions, by row hash.

    Only key and hash of each side are shuffled.
    """
    a = old.select(*key, row_hash(*columns).alias("old_hash"))
    b = new.select(*key, row_hash(*columns).alias("new_hash"))
    kind = (
        F.when(F.col("old_hash").isNull(), "added")
        .when(F.col("new_hash").isNull(), "removed")
        .when(F.col("old_hash") != F.col("new_hash"), "changed")
    )
    return a.join(b, list(key), "full").withColumn("change_type", kind).filter("change_type is not null")
