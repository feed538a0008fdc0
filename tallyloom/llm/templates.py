"""Benchmark decontamination by template canonicalisation.

Texts become sequences of lower-case words in which numbers, names (capitalised inside a sentence) and units
(after a number) are typed placeholders.  Windows of ``WINDOW`` template words are hashed and joined with
those of the benchmark.  Matching windows of a document and an item are lined up by their distance.  Along one line
each value of the item, by type, stands for the value that most of its places have in the document (over half; units
count in singular).  Windows whose values are the item's always count, others only if no slot contradicts that.  A document is contaminated by an item if consistent windows cover at least ``COVERED`` of the item's.
Equal questions, and questions with other numbers, names or units, are both caught.

Windows with fewer than ``LEAST_LITERALS`` words that are no placeholders say little as templates.  Every window, these
included, is also hashed as lower-case words with their values and matches exactly, so that copies are found in any case,
although names are told by their capitals.  An item shorter than a window is one window of its own length, down to
a single word.  An item whose other windows alone are covered by half is found too.

Edge cases: NULL and empty texts have no windows; repeated rows are judged together (a row of the result per
id, text and item); NULL ids are kept; an empty table or benchmark gives an empty result.  Only the id and text of both
tables are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_back, id_key, sized_slices, slices, stage, str_texts, text_of
from .substrings import WordHashes, run_hashes

WINDOW = 8
LEAST_LITERALS = 4
COVERED = 0.5
#: bits of the table that keeps other windows from being shuffled; 2 MB, whatever the size of the benchmark
SIEVE = 1 << 24
_SHIFT = 24
#: words of a pair that decides whether a text is worth templating are at most this far apart
FARTHEST = 3
_MIX = np.random.default_rng(2).integers(0, 2**63, FARTHEST + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: words that name a unit when they follow a number
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "gram", "grams", "ton", "tons", "pound",
    "pounds", "ml", "l", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days",
    "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "degrees", "mph",
)
_NUMBER = r"\d+(?:[.,]\d+)*"
_NUMBERS = re.compile(_NUMBER)
_WORDY = re.compile(rf"{_NUMBER}|[^\W\d_]+")
_NUM, _NAME, _UNIT = "\x01", "\x02", "\x03"
_PLAIN_OR_SLOT = re.compile(r"[^\W\d_]+|[\x01\x02]")
# a word of one capital and small letters, after a word and a space or a comma and a space
_NAMES = re.compile(r"(?<=[\w,] )[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][a-zß-öø-ÿα-ωа-я]+(?![^\W\d_])")
_UNIT_SET = frozenset(UNITS)
_UNIT_HASHES = WordHashes().of(list(UNITS))
_SINGULAR = {u: u[:-1] for u in UNITS if u[:-1] in UNITS and len(u) > 2} | {"feet": "foot", "inches": "inch", "degrees": "degree"}


def _clean(text: str) -> str:
    """Without the placeholders' own signs and the one letter that small letters make two of."""
    return text.replace(_NUM, " ").replace(_NAME, " ").replace("\u0130", "I")


def template(text: str) -> tuple[list[str], list[str]]:
    """Template words and, beside each, the value it stands for ('' for a plain word)."""
    text = _clean(text)
    words, values = [], []
    names = {m.start() for m in _NAMES.finditer(text)}
    for m in _WORDY.finditer(text):
        raw = m.group()
        if raw[0].isdigit():
            words.append(_NUM)
            values.append(raw)
        elif m.start() in names:
            words.append(_NAME)
            values.append(raw.lower())
        elif words and words[-1] == _NUM and raw.lower() in _UNIT_SET:
            words.append(_UNIT)
            values.append(raw.lower())
        else:
            words.append(raw.lower())
            values.append("")
    return words, values


def template_words(text: str) -> list[str]:
    """The template words alone, by substitutions over the whole text."""
    text = _NAMES.sub(_NAME, _clean(text))
    words = _PLAIN_OR_SLOT.findall(_NUMBERS.sub(_NUM, text).lower())
    if _NUM in words:
        words = [_UNIT if w in _UNIT_SET and before == _NUM else w for before, w in zip([""] + words, words)]
    return words


def plain_words(text: str) -> list[str]:
    """The words of ``template_words`` with values in place of slots."""
    return [w.lower() for w in _WORDY.findall(_clean(text))]


def _pair_hashes(h: np.ndarray, starts: np.ndarray, apart: int) -> np.ndarray:
    """Hash of the words ``apart`` words from each other, from each start."""
    out = h[starts] * _MIX[0] + h[starts + apart] * _MIX[apart]
    return out ^ (out >> np.uint64(31))


def raw_hashes(h: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return run_hashes(h, starts, size, 1) + np.uint64(size)


def template_hashes(words: list[str], hashes: WordHashes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``size`` template words with enough plain words, and their hashes."""
    if len(words) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = hashes.of(words)
    so_far = np.concatenate(([0], np.cumsum(~np.isin(h, hashes.of([_NUM, _NAME, _UNIT])))))
    starts = np.nonzero(so_far[size:] - so_far[:-size] >= min(LEAST_LITERALS, size))[0]
    return starts, run_hashes(h, starts, size, 0) + np.uint64(size)


def _item_windows(items: DataFrame) -> DataFrame:
    """(fp, k, th, at, slots, kinds, telling) of the windows of items: each as raw words, and as a template (telling) if it has plain words enough.

    kinds are type and place in the item of each slot.  Rows without ``at`` hold hashes of pairs of plain words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in slices(batches, 64):
            out: list[list] = [[] for _ in range(6)]
            for row, text in enumerate(str_texts(b, "text")):
                words, values, raw = template_words(text), template(text)[1], hashes.of(plain_words(text))
                size = min(len(words), WINDOW)
                if not size:
                    continue
                everywhere = np.arange(len(words) - size + 1)
                told, prints = template_hashes(words, hashes, size)
                for starts, fps, telling in ((told, prints, True), (everywhere, raw_hashes(raw, everywhere, size), False)):
                    out[0] += fps.view(np.int64).tolist()
                    out[1] += [row] * len(starts)
                    out[2] += starts.tolist()
                    out[3] += [[v for v in values[s : s + size] if v] for s in starts.tolist()]
                    out[4] += [[f"{words[i]}{i}" for i, v in enumerate(values[s : s + size], s) if v] for s in starts.tolist()]
                    out[5] += [telling] * len(starts)
                plain = np.array([not v for v in values])
                for apart in range(1, FARTHEST + 1):
                    both = np.nonzero(plain[:-apart] & plain[apart:])[0]
                    pairs = _pair_hashes(raw, both, apart).view(np.int64).tolist()
                    for column, value in zip(out, (pairs, *([x] * len(pairs) for x in (row, None, None, None, None)))):
                        column += value
            row = pa.array(out[1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), b.column("k").take(row), b.column("th").take(row), pa.array(out[2], pa.int32()),
                 *(pa.array(x, pa.list_(pa.string())) for x in out[3:5]), pa.array(out[5], pa.bool_())],
                ["fp", "k", "th", "at", "slots", "kinds", "telling"])

    return items.mapInArrow(run, "fp long, k long, th long, at int, slots array<string>, kinds array<string>, telling boolean")


def _sieve(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes ``fp``, two each, in a table of ``SIEVE`` bits: that is all the driver gets, for any number of hashes."""
    bit = F.explode(F.array(*(F.pmod(F.shiftrightunsigned("fp", n), F.lit(SIEVE)) + 1 for n in (0, _SHIFT))))
    parts = hashes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    packed = np.zeros(SIEVE // 8, np.uint8)
    for r in parts:
        piece = np.frombuffer(bytes(r.bits), np.uint8)
        packed[(r.part - 1) * len(piece) : r.part * len(piece)] = piece
    return packed


class Sieve:
    def __init__(self, packed: np.ndarray):
        self.bits = np.unpackbits(packed, bitorder="little").view(bool)

    def passes(self, fp: np.ndarray) -> np.ndarray:
        last = np.uint64(SIEVE - 1)
        found = self.bits[(fp & last).view(np.int64)]
        found[found] = self.bits[((fp[found] >> np.uint64(_SHIFT)) & last).view(np.int64)]
        return found


def worth_templating(h: np.ndarray, small: np.ndarray, left: np.ndarray, row: np.ndarray, lengths: list[int], sieve: Sieve) -> np.ndarray:
    """Rows that may hold a template window of the benchmark, from words (hashes) and which of them are in small letters.

    Of four plain words in eight, two pairs of neighbours are at most three words apart (two gaps of four would not fit), and a pair in a
    matching window is a pair of the benchmark's.  Two small words side by side, no units, are no slots: they are such a pair, too.
    Windows under four words have no slots and are found as raw words.
    """
    pairs, misses = (np.zeros(len(h) + WINDOW, np.int64) for _ in range(2))
    sure = small & ~np.isin(h, _UNIT_HASHES)
    for apart in range(1, FARTHEST + 1):
        starts = np.nonzero(left > apart)[0]
        known = sieve.passes(_pair_hashes(h, starts, apart))
        pairs[starts] += known
        if apart == 1:
            misses[starts] = ~known & sure[starts] & sure[starts + 1]
    pairs, misses = (np.concatenate(([0], np.cumsum(x))) for x in (pairs, misses))
    n, good = len(h), np.zeros(len(h), bool)
    near = pairs[WINDOW - 1 :][:n] - pairs[:n] >= 2
    for size in lengths:
        if size >= LEAST_LITERALS:
            good |= near & (left >= size) & (misses[size - 1 :][:n] == misses[:n])
    return np.unique(row[good])


def _windows(texts: DataFrame, lengths: list[int], packed: np.ndarray) -> DataFrame:
    """(fp, k, th, at, slots, telling) of the windows of documents that the sieve lets pass, as raw words and as templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sieve = WordHashes(), Sieve(packed)
        for b in sized_slices(batches, "text"):
            texts = str_texts(b, "text")
            found = [_WORDY.findall(_clean(t)) for t in texts]
            lens = np.fromiter(map(len, found), np.int64, len(found))
            words = list(chain.from_iterable(found))
            small = np.fromiter(map(str.islower, words), bool, len(words))
            row = np.repeat(np.arange(len(found)), lens)
            first = np.cumsum(lens) - lens
            # hashing each word is quicker here than finding it among many remembered ones
            h = np.fromiter(map(xxhash.xxh64_intdigest, map(str.lower, words)), np.uint64, len(words))
            del found, words
            at = np.arange(len(h)) - first[row]
            left = lens[row] - at
            fps, rows, ats, slots, telling = [], [], [], [], []
            for size in lengths:
                starts = np.nonzero(left >= size)[0]
                fp = raw_hashes(h, starts, size)
                good = sieve.passes(fp)
                fps.append(fp[good])
                rows.append(row[starts[good]])
                ats.append(at[starts[good]])
                slots += [None] * len(ats[-1])
                telling += [False] * len(ats[-1])
            for i in worth_templating(h, small, left, row, lengths, sieve).tolist():
                words, values = template_words(texts[i]), None
                for size in lengths:
                    starts, fp = template_hashes(words, hashes, size)
                    good = sieve.passes(fp)
                    if not good.any():
                        continue
                    starts = starts[good]
                    values = template(texts[i])[1] if values is None else values
                    fps.append(fp[good])
                    rows.append(np.full(len(starts), i))
                    ats.append(starts)
                    slots += [[v for v in values[s : s + size] if v] for s in starts.tolist()]
                    telling += [True] * len(starts)
            at_row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(fps).view(np.int64)), b.column("k").take(at_row), b.column("th").take(at_row),
                 pa.array(np.concatenate(ats).astype(np.int32)), pa.array(slots, pa.list_(pa.string())), pa.array(telling, pa.bool_())],
                ["fp", "k", "th", "at", "slots", "telling"])

    return texts.mapInArrow(run, "fp long, k long, th long, at int, slots array<string>, telling boolean")


def consistent(windows: list[dict]) -> list[dict]:
    """Those windows of one line (kinds, item_slots, slots) that are verbatim or agree with most places of their values."""
    places: dict[tuple, dict] = {}

    def swaps(w: dict) -> Iterator[tuple]:
        for kind, old, new in zip(w["kinds"], w["item_slots"], w["slots"]):
            if kind[0] == _UNIT:
                old, new = _SINGULAR.get(old, old), _SINGULAR.get(new, new)
            yield kind, (kind[0], old), new

    for w in windows:
        for kind, old, new in swaps(w):
            places.setdefault(old, {})[kind] = new
    stands = {}
    for old, found in places.items():
        new, times = Counter(found.values()).most_common(1)[0]
        stands[old] = new if 2 * times > len(found) else None
    return [w for w in windows if w["slots"] == w["item_slots"] or all(stands[old] == new for _, old, new in swaps(w))]


def _judged(lines: DataFrame) -> DataFrame:
    """(k, th, item_id, item_th, ats, told, changed) of the consistent windows of each line, told those of templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            good = [consistent(w) for w in b.column("wins").to_pylist()]
            made = [pa.array([[w["item_at"] for w in x] for x in good], pa.list_(pa.int32())),
                    pa.array([[w["item_at"] for w in x if w["telling"]] for x in good], pa.list_(pa.int32())),
                    pa.array([any(w["slots"] != w["item_slots"] for w in x) for x in good], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), *made], [*keys, "ats", "told", "changed"])

    keys = ["k", "th", "item_id", "item_th"]
    return lines.select(*keys, "wins").mapInArrow(run, "k long, th long, item_id long, item_th long, ats array<int>, told array<int>, changed boolean")


def _lengths(items: DataFrame) -> list[int]:
    """Template lengths under a window among the items (at most WINDOW - 1 numbers), and the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([min(len(template(t)[0]), WINDOW) for t in str_texts(b, "text")], pa.int32())], ["n"])

    found = {r.n for r in items.select("text").mapInArrow(run, "n int").distinct().collect()}
    return sorted(n for n in found if n)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(k, th, item_id, windows, item_windows, changed): contaminated documents and the items found in them.

    ``changed`` tells that some slot has another value than in the item.  k and th key the document (``row_keys``).
    """
    bench = items.select(id_key(item_col).alias("k"), F.xxhash64("text").alias("th"), text_of("text").alias("text"))
    bench = bench.dropDuplicates(["k", "th"])
    asked = docs.select(*row_keys(id_col, text_col), text_of(text_col).alias("text"))
    made = stage(_item_windows(bench), "bench")
    own = made.filter("at is not null").select(
        "fp", F.col("k").alias("item_id"), F.col("th").alias("item_th"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "kinds", "telling",
    )
    totals = own.groupBy("item_id", "item_th").agg(F.count_if(~F.col("telling")).alias("item_windows"), F.count_if("telling").alias("item_told"))
    lengths = _lengths(bench)
    if not lengths:
        asked = asked.limit(0)
    seen = _windows(asked, lengths or [WINDOW], _sieve(made.select("fp")))
    pairs = seen.join(own, ["fp", "telling"]).withColumn("slots", F.when(F.col("telling"), F.col("slots")).otherwise(F.col("item_slots")))
    # item and document slots of a window have the same types, as their templates are equal
    line = pairs.withColumn("line", F.col("at") - F.col("item_at")).groupBy("k", "th", "item_id", "item_th", "line").agg(
        F.collect_set(F.struct("item_at", "kinds", "telling", "item_slots", "slots")).alias("wins"))
    found = _judged(line).groupBy("k", "th", "item_id", "item_th").agg(
        *(F.size(F.array_distinct(F.flatten(F.collect_list(c)))).alias(n) for c, n in (("ats", "windows"), ("told", "told"))),
        F.max("changed").alias("changed"))
    half = (F.col("windows") >= COVERED * F.col("item_windows")) | (F.col("item_told") > 0) & (F.col("told") >= COVERED * F.col("item_told"))
    found = found.join(totals, ["item_id", "item_th"]).filter(half)
    return found.select("k", "th", id_back("item_id").alias("item_id"), "windows", "item_windows", "changed")


def row_keys(id_col: str = "doc_id", text_col: str = "text") -> list:
    return [id_key(id_col).alias("k"), F.xxhash64(text_of(text_col)).alias("th")]


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, windows, item_windows, changed for every contaminated document and item."""
    found = leaks(docs, items)
    return found.select(id_back("k").alias("doc_id"), "item_id", "windows", "item_windows", "changed")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found."""
    bad = stage(leaks(docs, items).select("k", "th").distinct(), "leaks")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    clean = docs.select(*row_keys(), whole.alias("doc")).join(bad, ["k", "th"], "left_anti")
    return clean.select("doc.*")
