"""Substring dedup by difference-cover anchors.

A window is ``window`` consecutive words of one document; every word is removed that lies in a window
whose words also start earlier (in a document with a smaller id, or further up in the same one).
Windows are judged on the input.

Anchors are shorter runs of words, hashed only at positions that modulo ``PERIOD`` lie in the
difference cover ``COVER``: for any two positions some common shift below the period brings both into the cover,
so two equal windows share an anchor at the same place in both.  Anchors that occur
once are dropped; around the others the match is extended to all windows that hold them, and equal windows
are found by 128-bit hashes.  Copies of a whole text are settled by the text's hash beforehand: all
windows of a later copy start earlier.

Edge cases: a NULL or empty text has no words; documents shorter than a window are kept; a NULL id sorts first;
rows of one id are not earlier than each other, and identical rows get the same result; an empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import byte_texts, id_back, id_key, sized_slices, slices, stage, text_of, unstage

# every difference modulo 13 is a difference of two of these
PERIOD, COVER = 13, (0, 1, 3, 9)
_COVERED = np.isin(np.arange(PERIOD), COVER)
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 2**63, (2, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# bases are 3 modulo 8, so that their powers have the longest period there is modulo 2**64
_BASES = [int(x) * 8 + 3 for x in _RNG.integers(2**40, 2**60, 3)]
_CACHED_WORDS = 500_000
#: hashes are grouped slice by slice, so that the shuffles of one slice are gone before the next
SLICES = 3


class WordHashes(dict):
    """64-bit hash of each word; forgets all words when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << max(12, (n - 1).bit_length())
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, x, np.uint64))))
                for x in (self.base % 2**64, pow(self.base, -1, 2**64)))
        return self.up[:n], self.down[:n]


_POWERS = [Powers(base) for base in _BASES]


def run_hashes(h: np.ndarray, starts: np.ndarray, length: int, which: int) -> np.ndarray:
    """Hash of the ``length`` words from each start: a polynomial in the mixed word hashes, by prefix sums, then mixed."""
    up, down = _POWERS[which].of(len(h))
    g = h * _FACTORS[0, which]
    g ^= g >> np.uint64(32)
    g *= up
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(g, out=sums[1:])
    out = (sums[starts + length] - sums[starts]) * down[starts]
    out ^= out >> np.uint64(32)
    out *= _FACTORS[1, which]
    return out ^ (out >> np.uint64(29))


class Words:
    """Word hashes of several texts in a row; ``row`` and ``at`` place each word in its text, ``left`` counts words to its end."""

    def __init__(self, texts: list[bytes], hashes: WordHashes):
        split = [t.split() for t in texts]
        lens = np.fromiter(map(len, split), np.int64, len(split))
        self.h = hashes.of([w for words in split for w in words])
        self.first = np.cumsum(lens) - lens
        self.row = np.repeat(np.arange(len(split)), lens)
        self.at = np.arange(len(self.h)) - self.first[self.row]
        self.left = lens[self.row] - self.at

    def anchors(self, window: int, length: int) -> np.ndarray:
        """Places of the anchors of all texts of at least a window."""
        long_enough = (self.left >= length) & (self.at + self.left >= window)
        return np.nonzero(long_enough & _COVERED[self.at % PERIOD])[0]


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """(fp, k, th, at): anchors of each document, each kind once or twice per document."""
    length = window - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in sized_slices(batches, "text"):
            words = Words(byte_texts(b, "text"), hashes)
            places = words.anchors(window, length)
            fp, row = run_hashes(words.h, places, length, 0), words.row[places]
            order = np.argsort(fp, kind="stable")  # equal anchors stay in order of texts and places
            fp, row, places = fp[order], row[order], places[order]
            same = np.zeros(len(fp), bool)
            same[1:] = (fp[1:] == fp[:-1]) & (row[1:] == row[:-1])
            # a kind that repeats inside the document counts as repeated by itself: it goes out twice
            keep = ~same
            keep[1:] |= same[1:] & ~same[:-1]
            at, row = words.at[places[keep]].astype(np.int32), pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[keep].view(np.int64)), b.column("k").take(row), b.column("th").take(row), pa.array(at)], ["fp", "k", "th", "at"])

    return texts.mapInArrow(run, "fp long, k long, th long, at int")


def candidate_places(words: Words, kinds: np.ndarray, window: int) -> np.ndarray:
    """Places of the windows that hold an anchor of one of the repeated ``kinds`` (a place of each).

    A kind is repeated in all texts or in none, so the texts need not be held apart.
    """
    length = window - PERIOD + 1
    places = words.anchors(window, length)
    hit = places[np.isin(run_hashes(words.h, places, length, 0), run_hashes(words.h, kinds, length, 0))]
    n = len(words.h) + 1
    step = np.bincount(hit - np.minimum(words.at[hit], window - length), minlength=n) - np.bincount(hit + 1, minlength=n)
    return np.nonzero((np.cumsum(step)[:-1] > 0) & (words.left >= window))[0]


def repeats(row: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """True for windows equal to an earlier one of the same text."""
    order = np.argsort(one, kind="stable")
    tied = one[order[1:]] == one[order[:-1]]
    if (two[order[1:]] != two[order[:-1]])[tied].any():
        order = np.lexsort((two, one))
        tied = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
    later = np.zeros(len(one), bool)
    later[order[1:]] = tied & (row[order[1:]] == row[order[:-1]])  # rows ascend within a tie
    return later


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """(w1, w2, k, th, at, again) of candidate windows, from texts with ``ats``, starts of repeated anchors.

    again marks a window that starts earlier in its own document; each other kind comes once per document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in sized_slices(batches, "text"):
            words = Words(byte_texts(b, "text"), hashes)
            ats = b.column("ats")
            kinds = ats.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            kinds += np.repeat(words.first, pa.compute.list_value_length(ats).to_numpy(zero_copy_only=False))
            places = candidate_places(words, kinds, window)
            one, two = (run_hashes(words.h, places, window, i) for i in (1, 2))
            again = repeats(words.row[places], one, two)
            row = pa.array(words.row[places])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), b.column("k").take(row), b.column("th").take(row),
                 pa.array(words.at[places].astype(np.int32)), pa.array(again)],
                ["w1", "w2", "k", "th", "at", "again"])

    return texts.mapInArrow(run, "w1 long, w2 long, k long, th long, at int, again boolean")


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """(k, th, copy, starts): documents with something to remove.

    copy marks a later copy of a whole text; otherwise ``starts`` are the starts of repeated windows.
    """
    whole = docs.groupBy("th", "th2").agg(F.min("k").alias("first"), F.max("k").alias("last")).filter("first < last")
    copies = docs.select("k", "th", "th2").join(whole, ["th", "th2"]).filter("k > first")
    copies = stage(copies.select("k", "th").distinct(), "copies")
    anchors = stage(_anchors(docs.select("k", "th", "text"), window), "anchors")
    hits = []
    for i in range(SLICES):
        own = anchors.filter(F.pmod("fp", F.lit(SLICES)) == i)
        repeated = own.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
        # rows of one id and text share their places, so the lists stay as long as the text
        found = own.join(repeated, "fp", "left_semi").groupBy("k", "th").agg(F.collect_set("at").alias("ats"))
        hits.append(stage(found, "hits"))
    unstage(anchors)
    whole_hits = reduce(DataFrame.unionByName, hits).groupBy("k", "th").agg(F.flatten(F.collect_list("ats")).alias("ats"))
    texts = docs.select("k", "th", "text").join(whole_hits.join(copies, ["k", "th"], "left_anti"), ["k", "th"])
    windows = stage(_windows(texts, window), "windows")
    for h in hits:
        unstage(h)
    late = [windows.filter("again").groupBy("k", "th").agg(F.collect_set("at").alias("starts"))]
    for i in range(SLICES):
        own = windows.filter(~F.col("again") & (F.pmod("w1", F.lit(SLICES)) == i)).select("w1", "w2", "k", "th", "at")
        first = own.groupBy("w1", "w2").agg(F.min("k").alias("first"), F.max("k").alias("last")).filter("first < last")
        found = own.join(first.drop("last"), ["w1", "w2"]).filter("k > first")
        late.append(stage(found.groupBy("k", "th").agg(F.collect_set("at").alias("starts")), "late"))
    starts = reduce(DataFrame.unionByName, late).groupBy("k", "th").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    nothing = F.lit(None).cast("array<int>")
    found = starts.select("k", "th", F.lit(False).alias("copy"), "starts").unionByName(
        copies.select("k", "th", F.lit(True).alias("copy"), nothing.alias("starts")))
    found = stage(found, "spans")
    for part in late[1:]:
        unstage(part)
    unstage(windows)
    return found


def kept_words(words: list[bytes], copy: bool, starts: list[int] | None, window: int) -> list[bytes]:
    if copy:
        return words if len(words) < window else []
    if not starts:
        return words
    step = np.zeros(len(words) + 1, np.int32)
    at = np.array(starts, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    gone = np.cumsum(step[:-1]) > 0
    return [w for w, x in zip(words, gone.tolist()) if not x]


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (words left, joined by a space) and its SHA-256, a row per document."""
    if window < PERIOD + 1:
        raise ValueError(f"a window has at least {PERIOD + 1} words")
    text = text_of(text_col)
    keyed = docs.select(
        id_key(id_col).alias("k"), F.xxhash64(text).alias("th"), F.xxhash64(F.lit("again"), text).alias("th2"), text.alias("text"))
    spans = repeated_spans(keyed, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, removed, kept, sha = [], [], [], []
            for text, copy, starts in zip(byte_texts(b, "text"), b.column("copy").to_pylist(), b.column("starts").to_pylist()):
                words = text.split()
                left = kept_words(words, bool(copy), starts, window)
                joined = b" ".join(left)
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(joined.decode())
                sha.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(sha, pa.string())],
                ["k", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    both = keyed.select("k", "th", "text").join(spans, ["k", "th"], "left")
    out = both.mapInArrow(run, "k long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    return out.select(id_back("k").alias("doc_id"), "n_words", "n_removed", "kept_text", "kept_sha256")


def substring_digest(docs: DataFrame, window: int = 20) -> DataFrame:
    return dedup_substrings(docs, window).drop("kept_text")
