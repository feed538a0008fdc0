"""Published tables: readers see one whole version or the one before, never parts of both.

A load writes the partitions that it replaces into a folder of its own.  A manifest (a small Parquet table) names
for every partition the version that holds it; it is written aside and renamed into place last, so the rename publishes the
load.  A load that fails before it leaves files that no manifest names.  Loads are numbered: of two
at the same time one finds its number taken and is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sinks import check_schema, last_versions, merge_rows
from .staging import stage, unstage

_MANIFEST = "part string, version string"


def _folder(spark: SparkSession, path: str):
    """File system and path object of a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, f"{path}/manifest") if n.isdigit()]


def _parts(spark: SparkSession, path: str, manifest: str) -> dict[str, str]:
    """Partition folder to version; one entry per partition of the table."""
    return {r.part: r.version for r in spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/{manifest}").collect()}


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_manifests(spark, path))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version; filters on the partition column keep the scan to those partitions."""
    parts = _parts(spark, path, _manifests(spark, path)[-1])
    folders = [f"{path}/data/version={version}/{part}" for part, version in sorted(parts.items())]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("version")


def _publish(spark: SparkSession, path: str, number: int, parts: dict[str, str]) -> None:
    aside = f"{path}/manifest/_{uuid.uuid4().hex}"
    spark.createDataFrame(sorted(parts.items()), _MANIFEST).coalesce(1).write.parquet(aside)
    fs, source = _folder(spark, aside)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/{number:012d}")
    # renaming onto an existing folder would move the manifest into it
    if fs.exists(target) or not fs.rename(source, target):
        raise RuntimeError(f"load {number} of {path} was published by another writer: run this load again")


def upsert_published(
    spark: SparkSession, path: str, new: DataFrame, key: Sequence[str], partition: str, order: str,
) -> None:
    """Keyed upsert into a published table partitioned by the text column ``partition`` (which ``key`` determines).

    Of several rows of a key in ``new`` that with the largest ``order`` wins.  Only partitions that occur in ``new`` are
    read and written again.  Running it twice changes nothing.
    """
    new = stage(last_versions(new, key, order), "upsert")
    done = _manifests(spark, path)
    number = int(done[-1]) + 1 if done else 1
    parts, merged = {}, new
    if done:
        parts = _parts(spark, path, done[-1])
        old = read_published(spark, path).withColumn(partition, F.col(partition).cast("string"))
        check_schema(old.drop(partition), new.drop(partition).schema)
        touched = [r[0] for r in new.select(partition).distinct().collect()]
        merged = merge_rows(old.filter(F.col(partition).isin(touched)).select(*new.columns), new, key)
    version = f"{number}-{uuid.uuid4().hex}"
    folder = f"{path}/data/version={version}"
    # rebalancing gathers small partitions into one file and spreads a large one over several tasks
    merged.hint("rebalance", partition).write.partitionBy(partition).parquet(folder)
    parts |= {name: version for name in _names(spark, folder) if "=" in name}
    _publish(spark, path, number, parts)
    unstage(new)


def remove_unread(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete version folders that none of the last ``keep`` manifests names, and older manifests; returns the folders deleted."""
    done = _manifests(spark, path)
    named = {v for m in done[-keep:] for v in _parts(spark, path, m).values()}
    stale = [n for n in _names(spark, f"{path}/data") if n.startswith("version=") and n.split("=", 1)[1] not in named]
    for gone in [f"{path}/manifest/{m}" for m in done[:-keep]] + [f"{path}/data/{n}" for n in stale]:
        fs, place = _folder(spark, gone)
        fs.delete(place, True)
    return len(stale)
