"""Turn rule tables into ``Column`` expressions (all stay in generated JVM code)."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, functions as F

from ..fixed_values import Bands, Rules

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def _chain(branches, other) -> Column:
    """``CASE WHEN`` over (condition, value) pairs; ``other`` None means NULL."""
    branches = list(branches)
    chain = reduce(lambda c, b: c.when(b[0], F.lit(b[1])), branches[1:], F.when(branches[0][0], F.lit(branches[0][1])))
    return chain if other is None else chain.otherwise(F.lit(other))


def tier(col: Column | str, bands: Bands) -> Column:
    """Label of the first band whose bound the number passes."""
    c = F.col(col) if isinstance(col, str) else col
    return _chain(((_OPS[bands.op](c, F.lit(bound)), label) for bound, label in bands.cuts), bands.other)


def decide(rules: Rules) -> Column:
    """Label of the first rule whose predicate is true for the row."""
    return _chain(((F.expr(pred), label) for label, pred in rules.rows), rules.other)


def map_values(col: Column | str, mapping: dict, other=None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return _chain(((c == F.lit(k), v) for k, v in mapping.items()), other)


def set_map(col: Column, members: dict, other=None) -> Column:
    """Label of the first list that contains the value."""
    return _chain(((col.isin(*values), label) for label, values in members.items()), other)


def pattern_map(col: Column, patterns: dict, other=None) -> Column:
    return _chain(((col.like(p), label) for label, p in patterns.items()), other)


def suffix_map(col: Column, suffixes: dict, other=None) -> Column:
    return _chain(((col.endswith(s), label) for label, s in suffixes.items()), other)


def argmax_label(pairs, other=None) -> Column:
    """Label of the largest of several columns; the earlier pair wins a tie."""
    best = F.greatest(*[F.col(name) for name, _ in pairs])
    return _chain(((F.col(name) == best, label) for name, label in pairs), other)
