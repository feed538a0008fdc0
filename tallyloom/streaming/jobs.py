"""Continuous versions of the monitor: hourly activity, quality counters, summary upsert.

Each job runs with ``trigger(availableNow=True)`` by default (process what is there, then
stop); pass another trigger for a continuous run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import safe_divide
from ..plans.finance import save_financial_summary
from ..quality.profile import quality_rates
from ..sources.sinks import upsert_partitions

NOW = {"availableNow": True}


def read_events(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """File stream; timestamps without zone become instants, which watermarks need."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    raw = stream.parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_counts(events: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Events, orders, users' conversion rate per hour."""
    hourly = events.withWatermark("ts", lateness).groupBy(F.window("ts", "1 hour")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("orders"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("order_value"),
    )
    return hourly.select(
        F.col("window.start").alias("hour"), "events", "orders", "order_value",
        safe_divide("orders", "events").alias("conversion_rate"),
    )


def orders_per_hour(events: DataFrame, table: str, checkpoint: str, trigger: dict = NOW) -> StreamingQuery:
    """Keep a table of hourly counts current.

    Update mode hands over every hour that changed, including the newest ones that a
    watermark would still hold back; each batch replaces those hours by key, so a replayed
    batch changes nothing.
    """
    def save(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("day", F.to_date("hour").cast("string"))
        upsert_partitions(batch.sparkSession, table, rows, ["hour"], "day", "events")

    return (
        hourly_counts(events).writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def stream_quality(
    events: DataFrame, table: str, checkpoint: str, key: str, required: Sequence[str], numeric: Sequence[str], dates: Sequence[str],
    trigger: dict = NOW,
) -> list[StreamingQuery]:
    """Quality counters over a whole stream: counts that add up per micro-batch, and keys that were not seen before.

    The state store holds every key once (spread by key over the shuffle partitions; set
    ``spark.sql.streaming.stateStore.providerClass`` to RocksDB where keys outgrow executor memory), so a key that returns in a
    later batch is a duplicate.  Both jobs write one small row per batch into a folder of that batch: a replayed
    batch overwrites its own row.  ``stream_quality_totals`` adds the rows up.
    """
    def counters(batch: DataFrame, batch_id: int) -> None:
        aggs = [F.count(F.lit(1)).alias("total_rows")]
        aggs += [F.count_if(F.col(c).isNull()).alias(f"null_count_{c}") for c in required]
        for c in numeric:
            number = F.col(c).try_cast("double")
            aggs += [
                F.count_if(F.col(c).try_cast("decimal(18,3)").isNull() & F.col(c).isNotNull()).alias(f"invalid_numeric_{c}"),
                F.count(number).alias(f"n_{c}"), F.avg(number).alias(f"mean_{c}"), (F.var_pop(number) * F.count(number)).alias(f"spread_{c}"),
                F.min(number).alias(f"min_{c}"), F.max(number).alias(f"max_{c}"),
            ]
        aggs += [F.count_if(F.col(c).try_cast("date").isNull() & F.col(c).isNotNull()).alias(f"invalid_date_{c}") for c in dates]
        aggs += [F.max(c).alias("max_date") for c in dates[:1]]
        batch.agg(*aggs).write.mode("overwrite").parquet(f"{table}/rows/batch={batch_id}")

    def first_seen(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count(key).alias("n")).write.mode("overwrite").parquet(f"{table}/keys/batch={batch_id}")

    started = []
    for name, rows, save in (("rows", events, counters), ("keys", events.select(key).dropDuplicates([key]), first_seen)):
        job = rows.writeStream.foreachBatch(save).option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger)
        started.append(job.start())
    return started


def stream_quality_totals(
    spark: SparkSession, table: str, name: str, now: datetime, key: str, required: Sequence[str], numeric: Sequence[str], dates: Sequence[str],
) -> DataFrame:
    """The row that ``quality_check`` gives for all rows streamed so far."""
    rows, keys = (spark.read.parquet(f"{table}/{part}") for part in ("rows", "keys"))
    aggs = [F.sum("total_rows").alias("total_rows"), *[F.sum(f"null_count_{c}").alias(f"null_count_{c}") for c in required]]
    for c in numeric:
        n, weighed = F.sum(f"n_{c}"), F.sum(F.col(f"mean_{c}") * F.col(f"n_{c}"))
        mean = F.try_divide(weighed, n)
        spread = F.sum(f"spread_{c}") + F.sum(F.col(f"mean_{c}") * F.col(f"mean_{c}") * F.col(f"n_{c}")) - mean * weighed
        aggs += [
            F.sum(f"invalid_numeric_{c}").alias(f"invalid_numeric_{c}"), mean.alias(f"avg_{c}"),
            F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.nullif(n - 1, F.lit(0)))).alias(f"stddev_{c}"),
            F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}"),
        ]
    aggs += [F.sum(f"invalid_date_{c}").alias(f"invalid_date_{c}") for c in dates]
    aggs += [F.max("max_date").alias("max_date") for _ in dates[:1]]
    # two one-row results meet in one aggregation
    seen = keys.select(F.col("n").alias(f"unique_{key}"))
    both = rows.unionByName(seen, allowMissingColumns=True)
    return quality_rates(both.agg(*aggs, F.sum(f"unique_{key}").alias(f"unique_{key}")), name, now, key, required, dates)


def stream_summary_upsert(summary_rows: DataFrame, table: str, checkpoint: str, trigger: dict = NOW) -> StreamingQuery:
    """Upsert arriving summary rows into the financial summary table by key."""
    def save(batch: DataFrame, _: int) -> None:
        save_financial_summary(batch.sparkSession, batch, table)

    return (
        summary_rows.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


__all__ = [
    "hourly_counts", "orders_per_hour", "read_events", "stream_quality", "stream_quality_totals", "stream_summary_upsert",
]
