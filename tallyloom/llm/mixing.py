"""Mixing sources to target weights by hierarchical budgeting.

A token budget is shared over a tree domain > language > source.  At each node the children share
the node's budget by their weights; a child whose subtree cannot use its share (tokens times the
most epochs) keeps what it can use, and the rest goes to its siblings, again by weight.  A
node's capacity is its subtree's, so a shortage leaves a family only when all siblings are full.
Each leaf then takes whole epochs of its documents and a prefix of one more: documents in the order
of a seeded hash of (seed, epoch, document) as long as their tokens fit.  Shares are whole
tokens, rounded down.

The prefix of a leaf is one cut-off hash, found over hash ranges, so no task sorts a whole leaf
and texts are never shuffled.

Edge cases: NULL domain, language or source is the value ''; a NULL or empty text has no tokens and is
taken while its turn comes within the prefix; identical rows are taken together; a weight not listed is
the default, weights are positive integers; an empty table gives an empty result.  Other columns are
kept and never read; those named as an added column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_name, n_words, stage, text_of

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class MixPlan:
    """Weights per level, budget as a share of all tokens (percent), epochs and seed."""

    domain: Mapping[str, int] = field(default_factory=dict)
    lang: Mapping[str, int] = field(default_factory=dict)
    source: Mapping[str, int] = field(default_factory=dict)
    budget_percent: int = 80
    max_epochs: int = 2
    seed: str = "mix-1"
    default_weight: int = 1


def weight_of(level: str, weights: Mapping[str, int], default: int) -> Column:
    c = F.lit(None).cast("long")
    for name, w in weights.items():
        c = F.when(F.col(level) == name, F.lit(w).cast("long")).otherwise(c)
    return F.coalesce(c, F.lit(default).cast("long"))


def share(children: DataFrame, parents: list[str], budget: str, out: str) -> DataFrame:
    """Fill children (columns cap, w) of each parent from its budget; siblings take over shortages."""
    family = Window.partitionBy(*parents)
    line = family.orderBy(F.col("cap") / F.col("w"), *[c for c in LEVELS if c in children.columns])
    before, after = (Window.unboundedPreceding, -1), (Window.currentRow, Window.unboundedFollowing)
    rest = F.col(budget) - F.coalesce(F.sum("cap").over(line.rowsBetween(*before)), F.lit(0))
    full = F.col("cap") * F.sum("w").over(line.rowsBetween(*after)) <= rest * F.col("w")
    marked = children.withColumn("_full", full)
    left = F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(family), F.lit(0))
    open_w = F.sum(F.when(~F.col("_full"), F.col("w"))).over(family)
    marked = marked.withColumn("_left", left).withColumn("_open", open_w)
    return marked.withColumn(out, F.expr(f"if(_full, cap, (_left * w) div _open)")).drop("_full", "_left", "_open", "w", "cap")


def leaf_budgets(leaves: DataFrame, plan: MixPlan) -> DataFrame:
    """Leaves (domain, lang, source, supply) with ``quota``, the tokens that each may give."""
    at = leaves.withColumn("cap", F.col("supply") * plan.max_epochs)
    families = [at.groupBy(*LEVELS[: i + 1]).agg(F.sum("cap").alias("cap")) for i in range(3)]
    # the few nodes of the first level are one family
    everything = Window.partitionBy("_one")
    top = families[0].withColumn("_one", F.lit(1)).withColumn("_all", F.sum("cap").over(everything))
    top = top.withColumn("_budget", F.expr(f"((_all div {plan.max_epochs}L) * {plan.budget_percent}L) div 100"))
    top = top.withColumn("w", weight_of("domain", plan.domain, plan.default_weight))
    got = share(top, ["_one"], "_budget", "_quota").select("domain", F.col("_quota").alias("_budget"))
    for i in (1, 2):
        level = LEVELS[i]
        below = families[i].join(got, list(LEVELS[:i]))
        below = below.withColumn("w", weight_of(level, getattr(plan, level), plan.default_weight))
        got = share(below, list(LEVELS[:i]), "_budget", "_quota").select(*LEVELS[: i + 1], F.col("_quota").alias("_budget"))
    return leaves.join(got, list(LEVELS)).withColumnRenamed("_budget", "quota")


ADDED = ("domain", "tokens", "epoch")


def _turn(plan: MixPlan) -> Column:
    """Place of a document in the leaf's next epoch."""
    return F.md5(F.concat_ws("|", F.lit(plan.seed), F.col("_full").cast("string"), F.col("_unit")))


def mix(
    docs: DataFrame, plan: MixPlan, domain: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source", added: tuple[str, str, str] = ADDED,
) -> DataFrame:
    """Columns of docs plus domain, tokens, epoch: one row per document and epoch in which it is taken.

    ``added`` names the three new columns; a column of docs of such a name (in any case) is replaced.
    """
    leaf = {"domain": domain, "lang": F.col(lang_col), "source": F.col(source_col)}
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), n_words(text_col).alias("_tokens"),
        F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text_of(text_col)))).alias("_unit"),
        *[F.coalesce(v.cast("string"), F.lit("")).alias(f"_{c}") for c, v in leaf.items()],
    )
    narrow = rows.select(*[F.col(f"_{c}").alias(c) for c in LEVELS], "_unit", "_tokens")
    units = stage(narrow.groupBy(*LEVELS, "_unit").agg(F.sum("_tokens").alias("_tokens"), F.count("*").alias("_n")), "units")
    leaves = units.groupBy(*LEVELS).agg(F.sum("_tokens").alias("supply"), F.sum("_n").alias("_rows"))
    quotas = leaf_budgets(leaves, plan).select(
        *LEVELS, F.expr("if(supply = 0, 0L, quota div supply)").alias("_full"),
        F.expr("if(supply = 0, 0L, quota % supply)").alias("_rest"),
    )
    quotas = stage(quotas, "quotas")
    # hash ranges of about 20,000 documents: the prefix is found range by range
    digits = max(2, math.ceil(math.log(max(units.count(), 1) / 20_000 + 1, 16)))
    turns = units.join(quotas, list(LEVELS)).withColumn("_turn", _turn(plan)).withColumn("_range", F.substring("_turn", 1, digits))
    ranges = turns.groupBy(*LEVELS, "_range").agg(F.sum("_tokens").alias("_sum"), F.min("_rest").alias("_rest"))
    along = Window.partitionBy(*LEVELS).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
    ranges = ranges.filter("_before <= _rest").drop("_rest", "_sum")
    inside = Window.partitionBy(*LEVELS, "_range").orderBy("_turn").rowsBetween(Window.unboundedPreceding, 0)
    taken = (
        turns.join(ranges, [*LEVELS, "_range"])
        .withColumn("_so_far", F.col("_before") + F.sum("_tokens").over(inside)).filter("_so_far <= _rest")
    )
    cuts = taken.groupBy(*LEVELS).agg(F.max("_turn").alias("_cut"))
    cuts = quotas.join(cuts, list(LEVELS), "left").select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "_full", "_cut")
    cuts = stage(cuts, "cuts")
    copies = F.col("_full") + F.coalesce((_turn(plan) <= F.col("_cut")).cast("long"), F.lit(0))
    chosen = rows.join(cuts, [f"_{c}" for c in LEVELS]).withColumn("_copies", copies).filter("_copies > 0")
    chosen = chosen.withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    taken = {c.lower() for c in added}
    keep = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c.lower() not in taken]
    return chosen.select(*keep, *[F.col(f"_{c}").alias(name) for c, name in zip(ADDED, added)])


#: the query's plan: four domains by source number, English half of each
QUERY_PLAN = MixPlan(domain={"d0": 4, "d1": 3, "d2": 2, "d3": 1}, lang={"en": 5, "de": 2, "fr": 2, "es": 1})


def source_domain(source_col: str = "source") -> Column:
    """Domain of a source name by its trailing number modulo four; ``other`` without one."""
    number = F.regexp_extract(F.coalesce(F.col(source_col), F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", "other").otherwise(F.concat(F.lit("d"), (F.try_to_number(number, F.lit("999999999")).cast("long") % 4).cast("string")))


def mix_documents(docs: DataFrame, plan: MixPlan = QUERY_PLAN) -> DataFrame:
    return mix(docs, plan, source_domain())


def drawn_documents(docs: DataFrame, plan: MixPlan = QUERY_PLAN) -> DataFrame:
    """The documents that the plan draws, once per epoch, with their own columns only."""
    mixed = mix(docs, plan, source_domain(), added=tuple(free_name(docs, c) for c in ADDED))
    return mixed.select(*[f"`{c}`" for c in docs.columns])


def mix_sql(table: str = "documents", plan: MixPlan = QUERY_PLAN) -> str:
    """The same rows in DuckDB SQL: doc_id, domain, lang, source, tokens, epoch."""

    def case(level: str) -> str:
        listed = " ".join(f"WHEN '{k}' THEN {v}" for k, v in getattr(plan, level).items())
        return f"CASE {level} {listed} ELSE {plan.default_weight} END" if listed else str(plan.default_weight)

    def fill(name: str, parents: str, level: str, source: str) -> str:
        over = f"PARTITION BY {parents} ORDER BY cap / w, {', '.join(LEVELS[: LEVELS.index(level) + 1])}"
        names = ", ".join(LEVELS[: LEVELS.index(level) + 1])
        return f"""
{name}_m AS (
  SELECT *, cap * sum(w) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (budget - coalesce(sum(cap) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS is_full
  FROM ({source})),
{name} AS (
  SELECT {names}, CAST(CASE WHEN is_full THEN cap ELSE
         ((budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {parents}), 0)) * w)
         // sum(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {parents}) END AS BIGINT) AS budget
  FROM {name}_m)"""

    def cap(columns: str) -> str:
        return f"SELECT {columns}, CAST(sum(supply) * {plan.max_epochs} AS BIGINT) AS cap FROM leaves GROUP BY {columns}"

    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
              ELSE 'd' || (CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4) END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS unit
  FROM {table}),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply FROM rows_ GROUP BY ALL),
total AS (SELECT CAST(sum(supply) * {plan.budget_percent} // 100 AS BIGINT) AS budget FROM leaves),
{fill("dom", "one", "domain", f"SELECT *, 1 AS one, {case('domain')} AS w FROM ({cap('domain')}), total")},
{fill("lan", "domain", "lang", f"SELECT *, {case('lang')} AS w FROM ({cap('domain, lang')}) JOIN dom USING (domain)")},
{fill("src", "domain, lang", "source", f"SELECT *, {case('source')} AS w FROM ({cap('domain, lang, source')}) JOIN lan USING (domain, lang)")},
quota AS (
  SELECT domain, lang, source, CASE WHEN supply = 0 THEN 0 ELSE budget // supply END AS whole,
         CASE WHEN supply = 0 THEN 0 ELSE budget % supply END AS rest
  FROM leaves JOIN src USING (domain, lang, source)),
turns AS (
  SELECT r.*, whole, rest, md5('{plan.seed}|' || whole || '|' || unit) AS turn
  FROM rows_ r JOIN quota USING (domain, lang, source)),
picked AS (
  SELECT *, whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY turn
                                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest
                         THEN 1 ELSE 0 END AS copies
  FROM turns)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS BIGINT) AS epoch
FROM (SELECT *, unnest(range(0, copies)) AS epoch FROM picked)
"""
