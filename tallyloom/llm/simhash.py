"""SimHash near-duplicates by vantage-point trees.

Each text gets a 64-bit fingerprint of its word shingles; fingerprints that differ in at most
``radius`` bits link, and groups are the connected components.  Equal fingerprints are one
point.  A vantage-point tree, balanced on a bounded sample, partitions the points into shards by
Hamming distance.  At each node a point inside the ball whose distance lies within ``radius`` of
its border also goes to the outer shard: by the triangle inequality any linked pair across the
border has such an inner point, so each linked pair meets in some shard, where pairs are exact.
The sample (``SAMPLE`` points) only balances the shards; it never decides what is compared.

Edge cases: no words (NULL or empty text) gives fingerprint zero, linked like any other; fewer words
than a shingle give one shingle of all words; repeated rows share a point; a group whose ids are
all NULL has a NULL component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import LOWER_ASCII, byte_texts, slices, stage, text_of, unstage

SAMPLE = 16384
SHARD_POINTS = 3000
MOST_LEVELS = 17
SEED = 42


def simhash(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of one text: bit b is set if more than half of the shingle hashes have it."""
    words = text.translate(LOWER_ASCII).split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], np.uint64
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, longs: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, fp) for every row, fp the fingerprint as a signed long, and the columns ``longs`` of that type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = np.array([simhash(t, shingle) for t in byte_texts(b, "text")], np.uint64).view(np.int64)
            kept = [b.column(c) for c in longs]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found), *kept], ["doc_id", "fp", *longs])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *longs)
    return texts.mapInArrow(run, ", ".join(["doc_id long", "fp long", *[f"{c} long" for c in longs]]))


class VantageTree:
    """Binary tree over fingerprints in heap order: a vantage point and a ball radius per node."""

    def __init__(self, sample: np.ndarray, levels: int, radius: int):
        rng = np.random.default_rng(SEED)
        inner = 2**levels - 1
        self.levels, self.radius = levels, radius
        self.points = rng.integers(0, 2**64, max(inner, 1), dtype=np.uint64)
        self.balls = np.full(max(inner, 1), 31, np.int64)
        members = {0: sample}
        for node in range(inner):
            own = members.pop(node, np.empty(0, np.uint64))
            if len(own) >= 16:
                # of a few points, the one that spreads the others most
                tried = rng.choice(own, 8)
                far = np.bitwise_count(own[None, :] ^ tried[:, None]).astype(np.int64)
                best = int(far.std(axis=1).argmax())
                self.points[node], self.balls[node] = tried[best], int(np.median(far[best]))
            d = np.bitwise_count(own ^ self.points[node])
            members[2 * node + 1], members[2 * node + 2] = own[d <= self.balls[node]], own[d > self.balls[node]]

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the point and its shard, once for each shard that it belongs to."""
        at, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        for _ in range(self.levels):
            d = np.bitwise_count(fps[at] ^ self.points[node]).astype(np.int64)
            ball = self.balls[node]
            inside = d <= ball
            border = inside & (d > ball - self.radius)
            at = np.concatenate((at, at[border]))
            node = np.concatenate((2 * node + np.where(inside, 1, 2), 2 * node[border] + 2))
        return at, node


def local_roots(n: int, a: np.ndarray, b: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """Smallest member index of the component of each of n items linked by pairs (a, b)."""
    label = np.arange(n) if roots is None else roots
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        if not len(a) or (before == label).all():
            break
    return label


def shard_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All links among the points of one shard, as (point, smallest point of its local component)."""
    names = np.unique(fps)
    n = len(names)
    # order by distance to one more vantage point: linked points are at most radius apart in it
    d = np.bitwise_count(names ^ names[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    p, d = names[order], d[order]
    label = np.arange(n)
    for lo in range(0, n, 256):
        hi = min(lo + 256, n)
        end = int(np.searchsorted(d, d[hi - 1] + radius, side="right"))
        a, b = np.nonzero(np.bitwise_count(p[lo:hi, None] ^ p[None, lo:end]) <= radius)
        up = b > a
        label = local_roots(n, a[up] + lo, b[up] + lo, label)
    # components are labelled by order; name them by their smallest member
    smallest = np.full(n, np.iinfo(p.dtype).max, p.dtype)
    np.minimum.at(smallest, label, p)
    root = smallest[label]
    linked = root != p
    return p[linked], root[linked]


def _levels(n: int) -> int:
    """Levels of a tree whose shards hold about SHARD_POINTS of n points."""
    return min(MOST_LEVELS, math.ceil(math.log(n / SHARD_POINTS) / math.log(1 / 0.6))) if n > SHARD_POINTS else 0


def _dealt(routed: DataFrame, shard: list[str], point: str) -> DataFrame:
    """Rows with pairs of blocks (i, j) of their shard.

    A shard of more points than planned is compared in pairs of blocks: any two of its points still meet.
    """
    sizes = routed.groupBy(*shard).agg(F.ceil(F.count("*") / (4 * SHARD_POINTS)).cast("int").alias("blocks"))
    return (
        routed.join(sizes, shard)
        .withColumn("own", F.pmod(F.xxhash64(point), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("own", "other", "blocks")
    )


def near_links(points: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct points (fp) to links (a, b), a > b in unsigned order, that span every linked group."""
    levels = _levels(points.count())
    drawn = points.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect() if levels else []
    tree = VantageTree(np.array([r.fp for r in drawn], np.int64).view(np.uint64), levels, radius)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, node = tree.route(fps)
            yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), pa.array(fps[at].view(np.int64))], ["shard", "fp"])

    routed = stage(points.select("fp").mapInArrow(send, "shard int, fp long"), "vantage")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(pdf["fp"].to_numpy().view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    found = stage(_dealt(routed, ["shard"], "fp").groupBy("shard", "i", "j").applyInPandas(links, "a long, b long").distinct(), "links")
    unstage(routed)
    return found


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root) for each linked node, root the smallest node.

    Alternates two star steps until nothing changes: each node's larger neighbours move to its
    smallest neighbour, then its smaller ones do.  Each round is a staged table.
    """
    now = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        own = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(own, "a").select(F.col("b").alias("x"), "a", "m")
        small = small.select(F.col("x").alias("a"), F.col("m").alias("b")).unionByName(own.select("a", F.col("m").alias("b")))
        nxt = stage(small.filter("a <> b").distinct(), "stars")
        unstage(now)
        now = nxt
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest doc_id of the group)."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    points = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    links = near_links(points, radius)
    roots = components(links)
    unstage(links)
    placed = points.join(roots, points.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    heads = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(heads, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    found = simhash_components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with one row left of each near-duplicate group: that of the smallest id (NULL last, ties by the text's hash)."""
    keys = [F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("k"), F.xxhash64(text_of(text_col)).alias("th")]
    prints = fingerprints(docs.select(*keys, text_of(text_col).alias("text")), "k", "text", shingle, ["th"])
    points = stage(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").alias("k"), "th")).alias("head")), "points")
    links = near_links(points, radius)
    roots = components(links)
    unstage(links)
    placed = points.join(roots, points.fp == roots.node, "left").select("head", F.coalesce("root", "fp").alias("root"))
    heads = stage(placed.groupBy("root").agg(F.min("head").alias("head")).select("head.k", "head.th"), "heads")
    unstage(points)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(*keys, whole.alias("doc")).join(heads, ["k", "th"], "left_semi").dropDuplicates(["k", "th"]).select("doc.*")
