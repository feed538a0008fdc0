"""Shared pieces: word splitting, row keys, sizes, and Arrow batches of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.sources.staging import stage, unstage  # noqa: F401  (re-exported)

# a word is a run of characters other than ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
NULL_ID = -(2**63)  # stands for a missing id where ids are joined, and sorts before all others

_UPPER = bytes(range(65, 91))
LOWER_ASCII = bytes.maketrans(_UPPER, _UPPER.lower())
LETTERS_OR_MARKS = re.compile(r"\w+|[^\w\s]+")


def id_key(c: str | Column) -> Column:
    """Integer id with NULL as the smallest value."""
    return F.coalesce(F.col(c).cast("long") if isinstance(c, str) else c.cast("long"), F.lit(NULL_ID))


def id_back(c: str) -> Column:
    return F.when(F.col(c) != NULL_ID, F.col(c))


def text_of(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def n_words(c: str) -> Column:
    return F.regexp_count(text_of(c), F.lit(WORD)).cast("long")


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes, NULL as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def str_texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a task builds from them stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def sized_slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of text; a longer text comes alone or last."""
    for b in batches:
        until = pc.cumulative_sum(pc.fill_null(pc.cast(pc.binary_length(b.column(column)), pa.int64()), 0)).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            past = int(until[at - 1]) if at else 0
            end = max(at + 1, min(int(until.searchsorted(past + size)) + 1, b.num_rows))
            yield b.slice(at, end - at)
            at = end


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
