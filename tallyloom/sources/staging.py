"""Intermediate tables on the cluster's shared folder.

Cutting lineage by writing a table survives the loss of executors, keeps the data
columnar (later reads prune columns and push filters), and never holds it on the driver.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: rows that a task of a large exchange should hold, about
TASK_ROWS = 250_000
_SETTING = "spark.checkpoint.dir"
#: settings of the jobs that write a staged table: their shuffle files go when the job ends, and whole-stage code gives way
#: where a method would be longer (in bytes) than HotSpot compiles, which would leave it interpreted row by row
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the session.

    A local master without the setting gets one beside its warehouse tables; on a cluster
    the setting is required.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    spark.conf.set(_SETTING, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _writing(spark: SparkSession):
    """Settings of the jobs inside, whose result is a table."""
    before = {name: spark.conf.get(name, None) for name in _WRITING}
    for name, value in _WRITING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and read it back from there."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with _writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_each(frames: Iterable[DataFrame], label: str) -> DataFrame:
    """Write frames of the same columns one after the other into one table, so that the shuffle files of one are gone before the next."""
    path = first = None
    for df in frames:
        spark = df.sparkSession
        path, first = path or new_path(spark, label), first or df.dtypes
        if df.dtypes != first:
            raise TypeError(f"columns differ: {set(df.dtypes) ^ set(first)}")
        with _writing(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_slices(df: DataFrame, most: int) -> list[DataFrame]:
    """A staged table in ``most`` frames or fewer, each of whole files."""
    spark = df.sparkSession
    jvm = spark._jvm
    files = sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in df.inputFiles())
    n = min(most, len(files))
    return [spark.read.schema(df.schema).parquet(*files[i * len(files) // n:(i + 1) * len(files) // n]) for i in range(n)]


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    top = shared_dir(spark).split(":", 1)[-1]
    for name in paths:
        if top.lstrip("/") in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later job reads; ``df`` is what ``stage`` returned."""
    _delete(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def unstage_files(df: DataFrame) -> None:
    """Delete the files of one of a table's ``file_slices``."""
    _delete(df.sparkSession, df.inputFiles())


def spread(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """Hash partitions by the keys in tasks of about TASK_ROWS of the ``rows`` that meet there.

    A join or aggregation by these keys takes the partitions over.  Where the session's number of shuffle partitions already gives
    tasks as small, or the rows are not known, the frame stays as it is.
    """
    parts = math.ceil((rows or 0) / TASK_ROWS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
