"""Exact top-k search by pivot-table elimination.

Scores are integer inner products.  The distances of a vector to the origin and to a table of pivots fix its place in the span
of the pivots and its distance from that span; the two together bound the distance of two vectors from below (more
closely than the largest single difference of pivot distances, which eliminates nothing among vectors of many independent
components), and so their score from above.  Within a block of candidates a query evaluates them in the order of that
bound and stops when the bound falls under its k-th best score.  The table of places is computed once and staged with the
vectors.  Candidates and queries are packed into blocks by a row key, every query block meets every candidate block once, and
the best k of each meeting are merged by rank.

Edge cases: a vector that is NULL or holds a NULL, NaN or infinite component, or has another length than most do,
takes no part; NULL ids take no part; with fewer than k candidates all are returned; ties go to the smaller id; equal rows
(one id and vector) count once; different vectors of one id are rows of their own, each a candidate of all others, and each a
query with ranks of its own; an empty table gives an empty result.  Only id and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

PIVOTS = 56
SAMPLE = 2048
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 256
FIRST, _STEP = 128, 256


def grid(embedding: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component as long; NULL for a vector that takes no part."""
    x = f"transform({embedding}, x -> cast(x as double))"
    good = f"{embedding} is not null and size({embedding}) > 0 and forall({embedding}, x -> x is not null and not isnan(x) and abs(cast(x as double)) < double('infinity'))"
    return F.expr(f"if({good}, transform({x}, x -> cast(floor({scale} * x) as bigint)), null)")


def choose_pivots(sample: np.ndarray) -> np.ndarray:
    """Independent pivots from a bounded sample: each the vector farthest from the span of those before."""
    rest, picked = sample.copy(), []
    least = 1e-6 * (sample**2).sum(axis=1).max(initial=0)
    while len(picked) < min(PIVOTS, *sample.shape):
        far = (rest**2).sum(axis=1)
        best = int(np.argmax(far))
        if far[best] <= least:
            break
        picked.append(best)
        unit = rest[best] / np.sqrt(far[best])
        rest -= np.outer(rest @ unit, unit)
    return sample[picked]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances to the origin and to each pivot: whole numbers for whole vectors."""
    squares = (x**2).sum(axis=1)
    to_pivots = squares[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.column_stack((squares, to_pivots))


def place(far: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in the span of the pivots that the distances fix, and the distance from that span."""
    squares = far[:, :1]
    products = (squares + (pivots**2).sum(axis=1)[None, :] - far[:, 1:]) / 2
    if not len(pivots):
        return np.zeros((len(far), 0)), np.sqrt(squares[:, 0])
    triangle = np.linalg.qr(pivots.T, mode="r")
    at = np.linalg.solve(triangle.T, products.T).T
    return at, np.sqrt(np.maximum(squares[:, 0] - (at**2).sum(axis=1), 0))


class Block(NamedTuple):
    """Vectors with their row keys, ids and places: coordinates in the span of the pivots and, last, the distance from it."""

    keys: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    places: np.ndarray


def places(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.column_stack(place(pivot_distances(x, pivots), pivots))


def scores_with(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as long; sums of doubles only where they stay whole (``exact``)."""
    return (x @ q if exact else x.astype(np.int64) @ q.astype(np.int64)).astype(np.int64)


def best_of(ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    top = np.lexsort((ids[rows], -scores))[:k]
    return rows[top], scores[top]


def search_block(asking: Block, offered: Block, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the rows of its best k candidates in the block, and their scores."""
    ids, x = offered.ids, offered.x.astype(np.float64)
    q_squares, x_squares = ((b.places**2).sum(axis=1) for b in (asking, offered))
    # doubles hold every partial sum of a product of vectors whose lengths multiply to less than 2^52
    exact = math.sqrt(q_squares.max(initial=0) * x_squares.max(initial=0)) < 2**52
    if not exact:
        x = offered.x
    # |q - x|^2 is at least the squared distance in the span plus (q_off - x_off)^2, so <q, x> is at most this;
    # the last terms are more than rounding can take away
    bounds = asking.places @ offered.places.T + 0.5 + 1e-9 * (q_squares[:, None] + x_squares[None, :])
    found = []
    for i in range(len(asking.ids)):
        bound, q = bounds[i], asking.x[i]
        bound[offered.keys == asking.keys[i]] = -np.inf  # no row is its own candidate
        first = np.argpartition(-bound, FIRST)[:FIRST] if len(bound) > FIRST else np.arange(len(bound))
        first = first[bound[first] > -np.inf]
        best, scores = best_of(ids, first, scores_with(q, x[first], exact), k)
        bound[first] = -np.inf
        rest = np.nonzero(bound >= (scores[-1] if len(best) == k else -1e300))[0]
        order = rest[np.argsort(-bound[rest], kind="stable")]
        for at in range(0, len(order), _STEP):
            if len(best) == k and bound[order[at]] < scores[-1]:
                break
            rows = order[at : at + _STEP]
            best, scores = best_of(
                ids, np.concatenate((best, rows)), np.concatenate((scores, scores_with(q, x[rows], exact))), k)
        found.append((i, best, scores))
    return found


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each query row."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), grid(vector_col).alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    given = given.filter("x is not null and vec_id is not null")
    given = given.groupBy("vec_id", "x").agg(F.max("asks").alias("asks"))
    # the key is fixed by writing it
    given = stage(given.withColumn("row", F.monotonically_increasing_id()), "grid")
    widths = given.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    width = widths.width if widths else 1
    given = given.filter(F.size("x") == width)
    n = widths.n if widths else 0
    drawn = given.orderBy(F.xxhash64("vec_id"), "vec_id", "x").select("x").limit(SAMPLE).collect()
    pivots = choose_pivots(np.array([r.x for r in drawn], np.float64)) if drawn else np.zeros((0, width))
    q_blocks, x_blocks = (max(1, math.ceil(n / size)) for size in (QUERY_BLOCK * 20, CANDIDATE_BLOCK))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            at = places(x.astype(np.float64), pivots)
            at = pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), at.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, at], [*b.schema.names, "at"])

    table = stage(given.select("row", "vec_id", "asks", "x").mapInArrow(
        placed, "row long, vec_id long, asks boolean, x array<long>, at array<double>"), "pivot_table")

    def packed(rows: DataFrame, blocks: int, block: str) -> DataFrame:
        number = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(block)
        return rows.select(number, "row", "vec_id", "x", "at").groupBy(block).agg(
            F.collect_list(F.struct("row", "vec_id", "x", "at")).alias(f"{block}_rows"))

    asking = packed(table.filter("asks"), q_blocks, "q")
    offered = packed(table, x_blocks, "c")
    # each block of the query set goes to each block of rows, by an equal block number
    met = asking.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(x_blocks - 1)))).join(offered, "c").select("q_rows", "c_rows")

    def unpack(rows: pa.Array) -> Block:
        flat = rows.flatten()
        keys, ids = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id"))
        x, at = (flat.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) for c in ("x", "at"))
        return Block(keys, ids, x, at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                q, c = (unpack(b.column(name).slice(i, 1)) for name in ("q_rows", "c_rows"))
                found = search_block(q, c, k)
                lens = [len(rows) for _, rows, _ in found]
                rows = np.concatenate([r for _, r, _ in found])
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(np.repeat(q.ids, lens)), "row": pa.array(np.repeat(q.keys, lens)),
                    "vec_id": pa.array(c.ids[rows]), "score": pa.array(np.concatenate([s for _, _, s in found]))})

    near = met.mapInArrow(run, "query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: the same rows by comparing all
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT a.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, b.vec_id AS vec_id,
       CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
WINDOW w AS (PARTITION BY a.vec_id ORDER BY list_inner_product(a.x, b.x) DESC, b.vec_id)
QUALIFY row_number() OVER w <= 20
"""
