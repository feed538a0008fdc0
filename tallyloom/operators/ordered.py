"""Ordered operators that stay parallel inside one group.

A plain window evaluates each group in one task, which fails when a group (or the whole table) grows with the
data.  Here every row gets a part number beside its group, and one hash exchange by (group, part) serves all windows of a
call.  Groups are found to be large by a mergeable frequent-items sketch over the group keys, and their cut points come from a mergeable
quantile sketch of the ordering; other groups are one part.  Both sketches only balance: a part
is a range of the ordering whatever its size, so results never depend on them.  What precedes a part comes
from one small row per (group, part) of the large groups (at most ``MOST_PARTS``, so it is broadcast).

The input is read twice or three times, so callers pass staged or cheap frames, narrow ones where rows are wide, and join wide rows back by
a row key (``with_row_key``).  ``order`` must be a total order within a group.  Sums are exact: DOUBLE and FLOAT measures are
refused, because they would add in another order in another layout.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..sources.staging import file_slices, stage, stage_each, unstage, unstage_files

#: rows of a group from which it is cut, parts of all large groups together, parts of one group
PART_ROWS, MOST_PARTS, GROUP_PARTS = 500_000, 100_000, 1024
#: groups that the frequent-items sketch follows and returns, and the size of a quantile sketch
TRACKED, LARGEST, SKETCH_K = 65_536, 10_000, 4096
ROW_KEY = "__row"
_FAR = 1e300


@dataclass(frozen=True)
class By:
    """One column of an ordering."""

    column: str
    descending: bool = False
    nulls_first: bool = False

    def sort(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def reversed(self) -> By:
        return replace(self, descending=not self.descending, nulls_first=not self.nulls_first)

    def follows(self, value) -> Column:
        """Whether a row's column comes strictly after a known value."""
        c = F.col(self.column)
        if value is None:
            return c.isNotNull() if self.nulls_first else F.lit(False)
        return F.coalesce(c < F.lit(value) if self.descending else c > F.lit(value), F.lit(not self.nulls_first))


def by(*columns: str, descending: bool = False, nulls_first: bool = False) -> list[By]:
    return [By(c, descending, nulls_first) for c in columns]


def _sorts(order: Sequence[By]) -> list[Column]:
    return [o.sort() for o in order]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; the right copies of the keys are dropped."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys))
    return left.join(right, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_row_key(df: DataFrame, label: str, below_zero: bool = False) -> DataFrame:
    """The frame, staged with a unique row number, so that narrow results can be joined back; two frames have no number in common if one is
    numbered below zero."""
    number = F.monotonically_increasing_id()
    return stage(df.withColumn(ROW_KEY, -1 - number if below_zero else number), label)


def join_by_row_key(
    tables: Sequence[tuple[DataFrame, Sequence[DataFrame]]], label: str, finish: Callable[[DataFrame], DataFrame], slices: int,
) -> DataFrame:
    """Wide rows of staged tables (``with_row_key``), each table with staged narrow results that have one row for each, as ``finish`` leaves them.

    The wide rows meet the results in slices of whole files, so the shuffle of a slice, and then its files, are gone before the next; the inputs
    are gone at the end.  The results are read once a slice, of which each keeps its range of keys.
    """

    def joined():
        for base, results in tables:
            for wide in file_slices(base, slices):
                ends = wide.agg(F.min(ROW_KEY).alias("low"), F.max(ROW_KEY).alias("high")).first()
                own = [r.filter(F.col(ROW_KEY).between(F.lit(ends.low), F.lit(ends.high))) for r in results]
                df = finish(wide.join(reduce(lambda a, b: a.join(b, ROW_KEY), own), ROW_KEY))
                columns[:] = columns or df.columns
                yield df.select(*columns)
                unstage_files(wide)

    columns: list[str] = []
    found = stage_each(joined(), label)
    # a result may serve several tables
    for df in {id(df): df for base, results in tables for df in (base, *results)}.values():
        unstage(df)
    return found


def _group(keys: Sequence[str]) -> Column:
    """The grouping columns as one value; unlike a list of keys it joins NULLs without a rewrite."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def _text_share(c: Column) -> Column:
    """Place of a text among all texts, from 0 up to 1, by its first four bytes."""
    return F.conv(F.rpad(F.substring(F.hex(F.substring(c, 1, 4)), 1, 8), 8, "0"), 16, 10).cast("double") / 2**32


def _code(df: DataFrame, order: Sequence[By]) -> Column:
    """A DOUBLE that never falls along the ordering: its first column, and the second text within a date."""
    kinds = dict(df.dtypes)
    first = order[0]
    c, kind = F.col(first.column), kinds[first.column]
    if kind == "date":
        code = F.unix_date(c).cast("double")
    elif kind.startswith("timestamp"):
        code = F.unix_micros(c.cast("timestamp")).cast("double")
    elif kind == "string":
        code = _text_share(c)
    else:
        x = c.cast("double")
        code = F.when(F.isnan(x), F.lit(_FAR / 10)).when(x.isNotNull(), F.greatest(F.least(x, F.lit(_FAR / 100)), F.lit(-_FAR / 100)))
    code = -code if first.descending else code
    if kind == "date" and len(order) > 1 and kinds[order[1].column] == "string":
        share = _text_share(F.col(order[1].column))
        share = 1 - 2.0**-32 - share if order[1].descending else share
        code = code + F.coalesce(share, F.lit(0.0 if order[1].nulls_first else 1 - 2.0**-33))
    return F.coalesce(code, F.lit(-_FAR if first.nulls_first else _FAR))


def _large_groups(df: DataFrame, keys: Sequence[str], at_most: int | None, part_rows: int) -> tuple[list[int], int]:
    """Hashes of the groups that are cut, and the rows of a part; a table known to fit into a part is not looked at."""
    if at_most is not None and at_most <= part_rows:
        return [], part_rows
    if keys:
        found = df.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {LARGEST}, {TRACKED})").alias("top")).first()
    else:
        found = df.agg(F.count("*").alias("n")).first()
    rows = max(part_rows, found.n // MOST_PARTS)
    if found.n <= rows:
        return [], rows
    return ([t["item"] for t in found.top if t["count"] > rows] if keys else [0]), rows


def large_groups(df: DataFrame, keys: Sequence[str], at_most: int | None, part_rows: int) -> list[int]:
    """``xxhash64`` of the keys of groups of more than ``part_rows`` rows; the frame, if larger, is read once."""
    return _large_groups(df, keys, at_most, part_rows)[0]


def _cuts(df: DataFrame, large: list[int], rows: int) -> list[tuple[int, list[float]]]:
    """Distinct cut points of the large groups, ascending; df has the group's hash and the code."""
    shares = [i / GROUP_PARTS for i in range(1, GROUP_PARTS)]
    found = df.filter(F.col("__h").isin(large)).groupBy("__h").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double("__code", F.lit(SKETCH_K)).alias("s"))
    points = F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(x) for x in shares]))
    found = found.select("__h", "n", points.alias("q")).withColumn("parts", F.least(F.lit(GROUP_PARTS), F.ceil(F.col("n") / rows)).cast("int"))
    found = found.filter("parts > 1").selectExpr(
        "__h", f"array_distinct(transform(sequence(1, parts - 1), i -> q[int(i * {GROUP_PARTS}L div parts) - 1])) AS cuts")
    return [(r["__h"], list(r.cuts)) for r in found.collect()]


def _parted(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], at_most: int | None = None, part_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """Rows with ``__k`` and ``__part``, and whether any group has several parts."""
    large, rows = _large_groups(df, keys, at_most, part_rows or PART_ROWS)
    laid = df.withColumn("__k", _group(keys))
    if not large:
        return laid.withColumn("__part", F.lit(0)), False
    marked = laid.withColumn("__h", F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")).withColumn("__code", _code(df, order))
    found = _cuts(marked, large, rows)
    cuts = df.sparkSession.createDataFrame(found, "__h bigint, __cuts array<double>")
    marked = marked.join(F.broadcast(cuts), "__h", "left").withColumn("__part", F.when(F.col("__cuts").isNotNull(), F.lit(0)))
    # halving steps to the number of cuts at or below the row's code, as many as the longest list needs; a column each, so that all are
    # generated code and none is evaluated twice
    for i in reversed(range(max((len(c) for _, c in found), default=0).bit_length())):
        at, step = F.col("__part"), 2**i
        marked = marked.withColumn("__part", F.when(F.get("__cuts", at + (step - 1)) <= F.col("__code"), at + step).otherwise(at))
    return marked.drop("__h", "__code", "__cuts"), True


def _check_exact(df: DataFrame, sums: dict[str, Column]) -> None:
    inexact = [n for n, t in df.select(*[c.alias(n) for n, c in sums.items()]).dtypes if t in ("double", "float")]
    if inexact:
        raise TypeError(f"cast to a decimal before a running sum: {inexact}")


def _part_sums(laid: DataFrame, sums: dict[str, Column], lowest: dict[str, str]) -> DataFrame:
    """(__k, __part) of the large groups with what precedes the part and what the whole group has."""
    large = laid.filter("__part is not null")
    per_part = large.groupBy("__k", "__part").agg(
        *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()], *[F.min(c).alias(f"__m_{n}") for n, c in lowest.items()])
    whole = Window.partitionBy("__k")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "__k", "__part", *[F.sum(f"__s_{n}").over(before).alias(f"__before_{n}") for n in sums],
        *[F.sum(f"__s_{n}").over(whole).alias(f"__all_{n}") for n in sums], *[F.min(f"__m_{n}").over(whole).alias(f"__min_{n}") for n in lowest])


def _with_counts(laid: DataFrame, cut: bool, order: Sequence[By], counts: dict[str, Sequence[str]]) -> DataFrame:
    """Running counts within subgroups (further key columns); rows marked ``__copy`` do not count."""
    own = F.lit(1).cast("bigint") if "__copy" not in laid.columns else F.when(~F.col("__copy"), F.lit(1).cast("bigint"))
    for out, more in counts.items():
        laid = laid.withColumn("__sub", F.struct(*more))
        inside = Window.partitionBy("__k", "__part", "__sub").orderBy(*_sorts(order)).rowsBetween(Window.unboundedPreceding, 0)
        found = laid.withColumn(out, F.sum(own).over(inside))
        if cut:
            sizes = laid.filter("__part is not null").groupBy("__k", "__part", "__sub").agg(F.sum(own).alias("__n"))
            earlier = Window.partitionBy("__k", "__sub").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
            first = sizes.select("__k", "__part", "__sub", F.sum("__n").over(earlier).alias("__first"))
            found = found.join(first, ["__k", "__part", "__sub"], "left").withColumn(out, F.col(out) + F.coalesce("__first", F.lit(0))).drop("__first")
        laid = found.drop("__sub")
    return laid


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], sums: dict[str, Column],
    lowest: dict[str, str] | None = None, counts: dict[str, Sequence[str]] | None = None,
    totals: dict[str, str] | None = None, at_most: int | None = None, part_rows: int | None = None,
) -> DataFrame:
    """Inclusive running sums per group (``ROWS UNBOUNDED PRECEDING``), and group minima of ``lowest`` columns.

    ``totals`` names whole sums of the group, by the running sum that they end in; ``counts`` running counts
    within subgroups (further key columns).  All share one exchange.  ``at_most`` is a known bound of the rows, if any;
    ``part_rows`` replaces PART_ROWS.
    """
    _check_exact(df, sums)
    lowest, totals = lowest or {}, totals or {}
    laid, cut = _parted(df, keys, order, at_most, part_rows)
    part = Window.partitionBy("__k", "__part")
    upto = part.orderBy(*_sorts(order)).rowsBetween(Window.unboundedPreceding, 0)
    found = laid.withColumns({f"__local_{n}": F.sum(c).over(upto) for n, c in sums.items()})
    whole = {f"__w_{out}": F.sum(sums[n]).over(part) for out, n in totals.items()} | {f"__w_{n}": F.min(c).over(part) for n, c in lowest.items()}
    found = found.withColumns(whole) if whole else found
    local = {n: F.col(f"__local_{n}") for n in sums}
    if cut:
        found = found.join(F.broadcast(_part_sums(laid, sums, lowest)), ["__k", "__part"], "left")
        # NULL until the first known value of the group, as in a plain running sum
        local = {n: F.coalesce(c + F.col(f"__before_{n}"), c, f"__before_{n}") for n, c in local.items()}
    found = _with_counts(found, cut, order, counts or {})
    outs = dict(local)
    outs |= {out: F.when(F.col("__part").isNotNull(), F.col(f"__all_{n}")).otherwise(F.col(f"__w_{out}")) if cut else F.col(f"__w_{out}") for out, n in totals.items()}
    outs |= {n: F.when(F.col("__part").isNotNull(), F.col(f"__min_{n}")).otherwise(F.col(f"__w_{n}")) if cut else F.col(f"__w_{n}") for n in lowest}
    kept = [c for c in df.columns if c not in outs] + list(counts or {})
    return found.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for n, c in outs.items()])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[By], out: str, at_most: int | None = None) -> DataFrame:
    """1-based position of each row within its group."""
    return running_sums(df, keys, order, {out: F.lit(1).cast("bigint")}, at_most=at_most)


def _with_copies(laid: DataFrame, order: Sequence[By], reach: int) -> DataFrame:
    """Parts of large groups with copies (``__copy``) of the ``reach`` rows before them.

    Only the last rows of each part are sent on; short parts are skipped over by the rows that precede each part.
    """
    large = laid.filter("__part is not null")
    sizes = _part_sums(laid, {"n": F.lit(1).cast("bigint")}, {}).withColumn("before", F.coalesce("__before_n", F.lit(0)))
    ahead = Window.partitionBy("__k").orderBy("__part")
    following = F.collect_list(F.struct("__part", "before")).over(ahead.rowsBetween(1, reach))
    places = sizes.select("__k", "__part", following.alias("__next"), F.lead("before").over(ahead).alias("__upto"))
    ends = Window.partitionBy("__k", "__part").orderBy(*_sorts([o.reversed() for o in order]))
    tails = large.withColumn("__end", F.row_number().over(ends)).filter(F.col("__end") <= reach)
    tails = tails.join(F.broadcast(places), ["__k", "__part"]).filter("__upto is not null")
    reached = F.expr(f"filter(__next, x -> x.before - __upto + __end <= {reach})")
    copies = tails.withColumn("__to", F.explode(reached)).withColumn("__part", F.col("__to.__part")).drop("__to", "__next", "__upto", "__end")
    return laid.withColumn("__copy", F.lit(False)).unionByName(copies.withColumn("__copy", F.lit(True)))


def with_frames(
    df: DataFrame, keys: Sequence[str], order: Sequence[By],
    exprs: Callable[[WindowSpec], dict[str, Column]], reach: int, counts: dict[str, Sequence[str]] | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Window expressions that look back at most ``reach`` rows (lags, rolling frames), and subgroup counts beside them.

    Parts of large groups also get copies of the ``reach`` rows before them, so every frame is complete inside its part.
    """
    laid, cut = _parted(df, keys, order, at_most)
    if cut:
        laid = _with_copies(laid, order, reach)
    found = laid.withColumns(exprs(Window.partitionBy("__k", "__part").orderBy(*_sorts(order))))
    found = _with_counts(found, cut, order, counts or {})
    return (found.filter("not __copy") if cut else found).drop("__k", "__part", "__copy")


def numbered_frames(
    df: DataFrame, keys: Sequence[str], inside: Sequence[str], order: Sequence[By],
    exprs: Callable[[WindowSpec], dict[str, Column]], reach: int, out: str, at_most: int | None = None,
) -> DataFrame:
    """Position of each row within its group (``out``) and, beside it, ``with_frames`` within its subgroup (further key columns).

    Where no group is large, one exchange by the group serves both.
    """
    laid, cut = _parted(df, keys, order, at_most)
    if cut:
        framed = stage(with_frames(df, [*keys, *inside], order, exprs, reach, at_most=at_most), "frames")
        return row_numbers(framed, keys, order, out, at_most)
    group, sub = Window.partitionBy("__k", "__part"), Window.partitionBy("__k", "__part", *inside)
    found = laid.withColumn(out, F.row_number().over(group.orderBy(*_sorts(order))).cast("bigint"))
    return found.withColumns(exprs(sub.orderBy(*_sorts(order)))).drop("__k", "__part")


def _tile_starts(df: DataFrame, total: int, n: int, order: Sequence[By]) -> list[tuple]:
    """The ordering's values of the first row of each tile but the first."""
    q, r = divmod(total, n)
    places = [p for p in (b * q + min(b, r) + 1 for b in range(1, n)) if p <= total]
    if not places:
        return []
    value, ties = order[0].column, order[1:]
    wanted = F.array(*[F.lit(p).cast("bigint") for p in places])
    hist = stage(df.groupBy(value).agg(F.count(F.lit(1)).alias("__n")), "counts")
    hist = running_sums(hist, [], [order[0]], {"__upto": F.col("__n")})
    inside = F.filter(wanted, lambda p: (p > F.col("__upto") - F.col("__n")) & (p <= F.col("__upto")))
    held = hist.withColumn("__at", F.transform(inside, lambda p: p - (F.col("__upto") - F.col("__n")))).filter(F.size("__at") > 0)
    held = held.select(value, "__at").collect()
    if not ties:
        return [(r[value],) for r in held for _ in r["__at"]]
    same = df.filter(reduce(lambda a, b: a | b, (F.col(value).eqNullSafe(F.lit(r[value])) for r in held)))
    same = row_numbers(same.select(value, *[o.column for o in ties]), [value], ties, "__pos")
    first = reduce(lambda a, b: a | b, (F.col(value).eqNullSafe(F.lit(r[value])) & F.col("__pos").isin(list(r["__at"])) for r in held))
    return [tuple(r) for r in same.filter(first).select(value, *[o.column for o in ties]).collect()]


def _tile(order: Sequence[By], starts: list[tuple]) -> Column:
    """Number of tiles that start at or before the row, plus one for the first."""

    def reached(start: tuple) -> Column:
        at = F.lit(True)
        for o, value in reversed(list(zip(order, start))):
            at = o.follows(value) | (F.col(o.column).eqNullSafe(F.lit(value)) & at)
        return at.cast("bigint")

    return reduce(lambda a, b: a + b, (reached(s) for s in starts), F.lit(1).cast("bigint"))


def ntile_scores(df: DataFrame, n: int, orders: dict[str, Sequence[By]]) -> DataFrame:
    """Several ``NTILE(n)`` columns over the whole table.

    A tile is known by the first row of each tile: n - 1 places, found by counts of the leading value and, inside the few values in
    which a tile starts, by the rest of the ordering.  Rows are compared with those places and never moved.  A table that
    fits into one part is numbered there.
    """
    wide = stage(df, "scored")
    total = wide.count()
    if total <= PART_ROWS:
        return wide.withColumns({out: F.ntile(n).over(Window.orderBy(*_sorts(order))).cast("bigint") for out, order in orders.items()})
    return wide.withColumns({out: _tile(order, _tile_starts(wide, total, n, order)) for out, order in orders.items()})


def value_ranks(
    df: DataFrame, keys: Sequence[str], value: str, descending: bool = False,
    rank: str | None = None, dense: str | None = None, percent: str | None = None, source: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """RANK / DENSE_RANK / PERCENT_RANK of a value within its group.

    Ranks depend on the value alone, so the distinct values are ranked, counted with map-side combining, and the
    result is joined back.  ``source`` may name a cheaper frame with the same rows to count on, ``at_most`` a bound of its rows.
    """
    source = df if source is None else source
    hist = source.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    if at_most is None or at_most > PART_ROWS:
        hist = stage(hist, "counts")
    hist = running_sums(
        hist, keys, by(value, descending=descending), {"__upto": F.col("__n"), "__dense": F.lit(1).cast("bigint")},
        totals={"__total": "__upto"}, at_most=at_most)
    hist = hist.withColumn("__rank", F.col("__upto") - F.col("__n") + 1)
    outs: dict[str, Column] = {}
    if rank:
        outs[rank] = F.col("__rank")
    if dense:
        outs[dense] = F.col("__dense")
    if percent:
        share = F.try_divide((F.col("__rank") - 1).cast("double"), (F.col("__total") - 1).cast("double"))
        outs[percent] = F.coalesce(share, F.lit(0.0))
    ranks = hist.select(*keys, value, *[c.alias(n) for n, c in outs.items()])
    return null_safe_join(df, ranks, [*keys, value])


def row_ranks(
    df: DataFrame, keys: Sequence[str], value: str, out: str, descending: bool = False, at_most: int | None = None,
) -> DataFrame:
    """RANK of a value within its group, for values that seldom repeat: the rows themselves are ranked, in one exchange.

    Equal values have one code and so lie in one part, which makes a rank the rank within the part after the rows of earlier parts.
    """
    order = by(value, descending=descending)
    laid, cut = _parted(df, keys, order, at_most)
    found = laid.withColumn(out, F.rank().over(Window.partitionBy("__k", "__part").orderBy(*_sorts(order))).cast("bigint"))
    if cut:
        before = _part_sums(laid, {"n": F.lit(1).cast("bigint")}, {}).select("__k", "__part", "__before_n")
        found = found.join(F.broadcast(before), ["__k", "__part"], "left")
        found = found.withColumn(out, F.col(out) + F.coalesce("__before_n", F.lit(0).cast("bigint"))).drop("__before_n")
    return found.drop("__k", "__part")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles per group, one row per group.

    Works on value counts and running totals instead of gathering a group's values in one
    aggregation buffer, so that a hot group stays spread out.
    """
    values = df.filter(F.col(value).isNotNull())
    hist = stage(values.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "counts")
    hist = running_sums(hist, keys, by(value), {"__upto": F.col("__n")}, totals={"__total": "__upto"})
    x = F.col(value).cast("double")
    aggs, outs = [], {}
    for name, p in wanted.items():
        at = (F.col("__total") - 1) * F.lit(float(p))
        low = F.floor(at)
        high = F.least(low + 1, F.col("__total") - 1)
        aggs += [
            F.min(F.when(F.col("__upto") > low, x)).alias(f"__lo_{name}"),
            F.min(F.when(F.col("__upto") > high, x)).alias(f"__hi_{name}"),
            F.max(at - low).alias(f"__f_{name}"),
        ]
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        outs[name] = lo + (hi - lo) * F.col(f"__f_{name}")
    return hist.groupBy(*keys).agg(*aggs).select(*keys, *[c.alias(n) for n, c in outs.items()])


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """MODE per group (NULLs ignored, ties to the smallest value) from value counts."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.groupBy(*keys).agg(F.max("__n").alias("__top"))
    best = null_safe_join(counts, top, keys).filter("__n = __top")
    return best.groupBy(*keys).agg(F.min(value).alias(out))
