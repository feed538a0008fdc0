"""Ranked lexical search: short posting lists summed term by term, long lists skipped document by document.

Queries are handled in blocks of bounded size against all documents.  One pass over the texts writes, for each document, its
length and the block's terms that it holds; document frequencies and collection statistics come from that table.  The
second pass reads it in blocks of documents, as posting lists.  For each query the short lists (rare terms) are
added up term at a time into accumulators.  Those then act as one list, bounded by the largest accumulator, beside the long lists,
bounded by their largest impact.  Documents are visited in strides: lists are ordered by bound, and those
that together cannot reach the query's current k-th score (the threshold) propose no documents; a proposed document is looked up
in the other lists from the largest bound down and left as soon as the bounds still open cannot lift it to the
threshold.  Bounds only skip documents that cannot enter the result; ties with the threshold are always evaluated.

Scores are 64-bit integers.  A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); its impact in a document of n terms
is weight * ((10^9 tf) div (1000 tf + 20 m)), m = 50 + (50 n N) div L, with N documents that hold terms and L terms in all.

Edge cases: NULL and empty texts hold no term and count nowhere; every row is a document of its own, also among rows
of one id; rows of one item id form one item with the terms of all its texts; NULL ids sort first; equal scores go by id; items without
terms, or whose terms no document holds, return nothing; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.operators import ordered

from .common import byte_texts, id_back, id_key, slices, stage, text_of, unstage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: terms of the items that one pass handles (an item alone may have more)
BLOCK_TERMS = 200_000
#: documents per block of posting lists, and per stride of the visit
BLOCK_DOCS, STRIDE = 8192, 2048
#: lists up to this share of a block's documents are summed term at a time
SHORT_SHARE = 1 / 16
#: parts of an item's candidates when the best of all tasks are merged
MERGED = 16

_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, q, term): distinct terms of every item, items in blocks of about BLOCK_TERMS terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [sorted(set(terms_of(t))) for t in byte_texts(b, "text")]
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([b.column("q").take(row), pa.array([t for x in found for t in x], pa.binary())], ["q", "term"])

    texts = items.select(id_key(id_col).alias("q"), text_of(text_col).alias("text"))
    pairs = stage(texts.mapInArrow(run, "q long, term binary").distinct(), "item_terms")
    sizes = pairs.groupBy("q").agg(F.count("*").alias("n"))
    placed = ordered.running_sums(sizes, [], ordered.by("q"), {"upto": F.col("n")})
    placed = placed.select("q", F.expr(f"upto div {BLOCK_TERMS}").alias("block"))
    return stage(pairs.join(placed, "q"), "item_blocks")


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(k, n, terms, tfs): of each document with terms its length and the vocabulary's terms that it holds, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, terms, tfs = [], [], []
            for text in byte_texts(b, "text"):
                words = terms_of(text)
                times = Counter(words)
                held = sorted((vocabulary[w], times[w]) for w in times.keys() & vocabulary.keys())
                n.append(len(words))
                terms.append([t for t, _ in held])
                tfs.append([x for _, x in held])
            out = pa.RecordBatch.from_arrays(
                [b.column("k"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["k", "n", "terms", "tfs"])
            yield out.filter(pa.array([x > 0 for x in n], pa.bool_()))

    return docs.mapInArrow(run, "k long, n long, terms array<int>, tfs array<int>")


def _frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """Number of documents that hold each term; tasks send one count per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(terms, np.int64)
        for b in batches:
            seen += np.bincount(b.column(0).flatten().to_numpy(), minlength=terms)
        some = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], ["term", "df"])

    rows = index.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(terms, np.int64)
    for r in rows:
        df[r.term] = r.df
    return df


class Best:
    """The k best (score, id) of one query, higher scores first, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def threshold(self) -> int:
        """Lower scores cannot enter; scores of 0 never do."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
            best = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[best], ids[best]


class Postings:
    """Posting lists of a block of documents: for each term the places of its documents, ascending, and their impacts."""

    def __init__(self, ids: np.ndarray, places: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.argsort(terms, kind="stable")
        self.ids, self.places, self.impacts = ids, places[order], impacts[order]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=n_terms))))
        self.tops = np.zeros(n_terms, np.int64)
        np.maximum.at(self.tops, terms, impacts)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ends[term], self.ends[term + 1]
        return self.places[lo:hi], self.impacts[lo:hi]

    def search(self, query: np.ndarray, best: Best) -> None:
        """Bring the block's documents into the query's best."""
        n = len(self.ids)
        sizes = self.ends[query + 1] - self.ends[query]
        short = query[(sizes > 0) & (sizes <= n * SHORT_SHARE)]
        rest = query[sizes > n * SHORT_SHARE]
        rest = rest[np.argsort(self.tops[rest], kind="stable")]
        bounds = self.tops[rest]
        if bounds.sum() + self.tops[short].sum() < best.threshold:
            return
        # term at a time: the short lists become one list of accumulators
        sums = np.zeros(n, np.int64)
        for term in short:
            at, impact = self.of(term)
            sums[at] += impact
        # the accumulators take their place among the long lists by their bound
        top = int(sums.max()) if n else 0
        where = int(np.searchsorted(bounds, top))
        lists = [self.of(t) for t in rest]
        lists.insert(where, None)
        bounds = np.insert(bounds, where, top)
        upto = np.cumsum(bounds)
        for lo in range(0, n, STRIDE):
            hi = min(lo + STRIDE, n)
            # lists below ``first`` cannot reach the threshold together, so they propose nothing
            first = int(np.searchsorted(upto, best.threshold))
            if first == len(lists):
                return
            score = np.zeros(hi - lo, np.int64)
            held = np.zeros(hi - lo, bool)
            for one in lists[first:]:
                if one is None:
                    score += sums[lo:hi]
                    held |= sums[lo:hi] > 0
                else:
                    a, z = np.searchsorted(one[0], (lo, hi))
                    score[one[0][a:z] - lo] += one[1][a:z]
                    held[one[0][a:z] - lo] = True
            at = np.nonzero(held)[0]
            score = score[at]
            for i in range(first - 1, -1, -1):
                open_ = score + upto[i] >= best.threshold
                at, score = at[open_], score[open_]
                if not len(at):
                    break
                if lists[i] is None:
                    score = score + sums[lo + at]
                else:
                    places, impact = lists[i]
                    found = np.minimum(np.searchsorted(places, lo + at), len(places) - 1)
                    score = score + np.where(places[found] == lo + at, impact[found], 0)
            enter = score >= best.threshold
            best.add(score[enter], self.ids[lo + at[enter]])


def _searched(index: DataFrame, queries: dict[int, np.ndarray], weights: np.ndarray, n: int, length: int, k: int) -> DataFrame:
    """(q, k, score): of each task the k best documents of every query."""

    names = np.array(list(queries), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for b in slices(batches, BLOCK_DOCS):
            tfs, terms = (b.column(c).flatten().to_numpy().astype(np.int64) for c in ("tfs", "terms"))
            # in Python's integers, because 50 n N may pass 64 bits
            m = np.array([50 + (50 * x * n) // length for x in b.column("n").to_pylist()], np.int64)
            places = np.repeat(np.arange(b.num_rows), np.diff(b.column("terms").offsets.to_numpy()))
            impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[places]))
            block = Postings(b.column("k").to_numpy(), places, terms, impacts, len(weights))
            for query, found in zip(queries.values(), best):
                block.search(query, found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, [len(x.ids) for x in best])),
             pa.array(np.concatenate([x.ids for x in best])), pa.array(np.concatenate([x.scores for x in best]))],
            ["q", "k", "score"])

    return index.mapInArrow(run, "q long, k long, score long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best per query of all tasks, with their rank: first within parts of each query, then among those."""
    found = found.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(MERGED)))
    order = [F.desc("score"), F.asc("k")]
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order))).filter(F.col("rank") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its k documents of the highest scores above 0."""
    spark = docs.sparkSession
    texts = docs.select(id_key(id_col).alias("k"), text_of(text_col).alias("text"))
    wanted = _item_terms(items, item_col, item_text)
    results = []
    for block in [r.block for r in wanted.select("block").distinct().orderBy("block").collect()]:
        own: dict[int, list[bytes]] = {}
        for r in wanted.filter(F.col("block") == block).collect():
            own.setdefault(r.q, []).append(bytes(r.term))
        vocabulary = {t: i for i, t in enumerate(sorted({t for terms in own.values() for t in terms}))}
        queries = {q: np.array(sorted(vocabulary[t] for t in terms), np.int64) for q, terms in own.items()}
        index = stage(_index(texts, vocabulary), "index")
        n, length = index.agg(F.count("*"), F.sum("n")).first()
        if n:
            df = _frequencies(index, len(vocabulary))
            weights = np.array([weight(n, int(x)) for x in df], np.int64)
            found = _searched(index, queries, weights, n, length, k)
            results.append(stage(_merged(found, k).select("q", "rank", "k", "score"), "ranked"))
        unstage(index)
    unstage(wanted)
    empty = spark.createDataFrame([], "q long, rank int, k long, score long")
    return reduce(DataFrame.unionByName, results, empty).select(
        id_back("q").alias(item_col), F.col("rank").cast("int").alias("rank"), id_back("k").alias(id_col), "score")


#: the same rows from the whole table of terms
RANKED_SQL = r"""
WITH t AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
sizes AS (SELECT row, sum(tf) AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n) AS len FROM sizes),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, docs),
s AS (
  SELECT item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len)))) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (row), total
  GROUP BY item_id, row, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
WHERE rank <= 50
"""
