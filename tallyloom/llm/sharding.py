"""Sharding by jump consistent hashing (DataFrame functions only).

Law ``key``: a row's shard depends on its id and the number of shards alone.  The hash
walks a pseudo-random sequence of ever larger shard numbers; the last one below the shard
count is the shard.  One more shard therefore moves rows only into itself, and there is
no ring table.

Nulls and edge cases: a NULL id hashes as id 0 and sorts first; a NULL text has no bytes
(size 1, checksum 0); repeated rows get the same shard and a slot each; an empty table gives
an empty result.  Only the id and the text are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_name, stage, text_of

# fixed value of the published hash: the multiplier of its generator
MULTIPLIER = 2862933555777941757
_HI, _LO, _MASK = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF, 0xFFFFFFFF


def jump_shards(key: str, counts: list[int]) -> Column:
    """Shard of the long column ``key`` for each of ``counts`` shards: an array of int in that order.

    One walk serves all counts.  The generator's 64-bit state is kept as two 32-bit halves,
    multiplied in 16-bit limbs, so that no product overflows a long.
    """
    if not counts or min(counts) < 1:
        raise ValueError("shard counts must be positive")
    upper = f"(shiftright(s.lo, 16) * {_LO}L)"
    mid = f"((s.lo & 65535L) * {_LO}L + ({upper} & 65535L) * 65536L + 1L)"
    high = (
        f"((shiftright({mid}, 32) + shiftright({upper}, 16) + ((s.lo * {_HI}L) & {_MASK}L)"
        f" + (s.hi & 65535L) * {_LO}L + ((shiftright(s.hi, 16) * {_LO}L) & 65535L) * 65536L) & {_MASK}L)"
    )
    # the upper 31 bits of the new state set the length of the next jump
    jump = f"cast(floor((s.j + 1) * (2147483648D / (shiftright({high}, 1) + 1))) as bigint)"
    last = ", ".join(f"if(t.j < {n}, t.j, s.b[{i}])" for i, n in enumerate(counts))
    moved = f"transform(array(named_struct('hi', {high}, 'lo', {mid} & {_MASK}L, 'j', {jump})), t -> named_struct('hi', t.hi, 'lo', t.lo, 'j', t.j, 'b', array({last})))[0]"
    start = (
        f"named_struct('hi', shiftrightunsigned({key}, 32), 'lo', {key} & {_MASK}L, 'j', 0L,"
        f" 'b', array({', '.join(['0L'] * len(counts))}))"
    )
    top = max(counts)
    walk = f"aggregate(sequence(1, {top}), {start}, (s, i) -> if(s.j >= {top}, s, {moved}))"
    return F.expr(f"transform({walk}.b, x -> cast(x as int))")


def number_within(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Gapless numbers from 0 within each group, by ``order``, without one task per group.

    Rows are range-partitioned by (group, order) into a staged layout; each part counts its
    rows per group, and a running sum over those few counts gives the part's first number.
    Expects narrow rows.
    """
    part = "_part"
    laid = df.repartitionByRange(group, *order).withColumn(part, F.spark_partition_id())
    laid = stage(laid, "number")
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = (
        laid.groupBy(group, part).agg(F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy(group, part).orderBy(*order)
    return (
        laid.withColumn("_at", F.row_number().over(inside) - 1).join(first, [group, part])
        .withColumn(out, F.col("_first") + F.col("_at")).drop(part, "_at", "_first")
    )


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with shard, slot within the shard, and the shard if one more were added.

    Returns id, size (bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.
    Slots follow (id, checksum, size), so they are fixed but for equal rows.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias(id_col), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_key"),
    )
    rows = rows.withColumn("_s", jump_shards("_key", [shards, shards + 1])).select(
        id_col, "size", "text_crc32", F.lit("key").alias("law"), F.col("_s")[0].alias("shard"),
        F.col("_s")[1].alias("grown_shard"),
    )
    numbered = number_within(rows, "shard", [id_col, "text_crc32", "size"], "slot")
    return numbered.select(
        id_col, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard",
    )


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id") -> DataFrame:
    """The documents with a ``shard`` column (replacing one of that name)."""
    key = free_name(docs, "_key")
    keyed = docs.drop("shard").withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(0)))
    return keyed.withColumn("shard", jump_shards(f"`{key}`", [shards])[0]).drop(key)
