"""URL filter: listed rules first, then association rules mined by FP-growth (DataFrame functions and MLlib).

Listed rules (host, path, verdict) fit a host and its subdomains when the path starts with the rule's;
the longest wins.  The urls that a listed rule decides are the labels: FP-growth mines combinations
of their tokens (scheme, host labels, path segments, query keys, fragment) that imply a verdict, pruned by
support, by confidence, and by dropping a rule that a shorter one with the same verdict covers at
no less confidence.  Other urls are looked up in an inverted index that holds each rule under its rarest
token; of the rules whose tokens the url holds, the most confident wins, then the best supported, then the
one with more tokens, then block.  Without any, the verdict is allow.

Edge cases: a NULL url, or one without ``://``, has an empty host and path, no tokens and no
rule; equal urls are judged once; NULL ids and repeated rows are kept; without labels nothing is mined;
an empty table gives an empty result.  Only the id and the url are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from .common import stage

#: (host, path prefix, verdict)
QUERY_RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(urls: DataFrame) -> DataFrame:
    """Adds host, path and tail (what follows the path) to column url."""
    after = F.expr("if(instr(url, '://') > 0, substring(url, instr(url, '://') + 3), '')")
    cut = urls.withColumn("_after", F.coalesce(after, F.lit(""))).withColumn("_host", F.regexp_extract("_after", r"^[^/?#]*", 0))
    rest = F.expr("substring(_after, length(_host) + 1)")
    return (
        cut.withColumn("_rest", rest).withColumn("path", F.regexp_extract("_rest", r"^[^?#]*", 0))
        .withColumn("tail", F.expr("substring(_rest, length(path) + 1)"))
        .withColumn("host", F.translate("_host", _UPPER, _LOWER)).drop("_after", "_host", "_rest")
    )


def listed_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest listed rule that fits host and path; NULL if none."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0], r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def url_tokens() -> Column:
    """Distinct tokens of a split url; runs of digits in path segments count as one token."""
    scheme = "array(concat('scheme=', lower(substring_index(url, '://', 1))))"
    host = "transform(filter(split(host, '[.]'), x -> x <> ''), x -> concat('host=', x))"
    path = "transform(filter(split(lower(path), '/'), x -> x <> ''), x -> concat('path=', regexp_replace(x, '[0-9]+', '0')))"
    query = "transform(filter(split(substring_index(substring(tail, 2), '#', 1), '&'), x -> x <> ''), x -> concat('query=', lower(substring_index(x, '=', 1))))"
    fragment = "if(instr(tail, '#') > 0, array(concat('part=', lower(substring_index(tail, '#', -1)))), cast(array() as array<string>))"
    asked = f"if(startswith(tail, '?'), {query}, cast(array() as array<string>))"
    return F.expr(f"if(host = '', cast(array() as array<string>), array_sort(array_distinct(concat({scheme}, {host}, {path}, {asked}, {fragment}))))")


def _index(rules: DataFrame) -> DataFrame:
    """Rules with ``token``, the one of their tokens that the fewest rules hold."""
    use = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    spread = rules.select("rule_id", F.explode("tokens").alias("token")).join(use, "token")
    rarest = spread.groupBy("rule_id").agg(F.min_by("token", F.struct("uses", "token")).alias("token"))
    return rules.join(rarest, "rule_id")


def matches(sets: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """(key, rule columns) for each rule whose tokens all lie in the row's ``held`` array."""
    spread = sets.select(key, "held", F.explode("held").alias("token"))
    found = spread.join(_index(rules), "token").filter(F.size(F.array_except("tokens", "held")) == 0)
    return found.drop("token", "held")


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(tokens, label) rows to rules (rule_id, tokens, verdict, confidence, support), pruned.

    Few partitions suffice: FP-growth deals conditional transactions by item, and only items above
    ``min_support`` are dealt.
    """
    items = labelled.select(F.array_union("tokens", F.array(F.concat(F.lit("label="), "label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence, numPartitions=8).fit(items)
    mined = model.associationRules.filter(F.col("consequent")[0].startswith("label=")).select(
        F.array_sort("antecedent").alias("tokens"), F.expr("substring(consequent[0], 7)").alias("verdict"), "confidence", "support",
    )
    mined = stage(mined.withColumn("rule_id", F.concat_ws(" ", F.col("verdict"), F.array_join("tokens", " "))), "mined")
    longer = mined.select(F.col("rule_id").alias("long_id"), F.col("tokens").alias("held"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    covered = matches(longer.select(F.struct("long_id", "v", "c").alias("long"), "held"), "long", mined)
    covered = covered.filter("long.long_id <> rule_id and long.v = verdict and confidence >= long.c")
    return mined.join(covered.select(F.col("long.long_id").alias("rule_id")).distinct(), "rule_id", "left_anti")


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = QUERY_RULES, min_support: float = 0.01,
    min_confidence: float = 0.8, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, mined_rule (tokens of the rule that decided, if mined)."""
    urls = pages.select(F.coalesce(F.col(url_col), F.lit("")).alias("url")).distinct()
    rule, says = listed_rule(rules)
    split = split_url(urls).withColumns({"rule": rule, "listed": says, "tokens": url_tokens()})
    split = stage(split.select("url", "host", "path", "rule", "listed", "tokens"), "urls")
    labelled = split.filter("listed is not null").select("tokens", F.col("listed").alias("label"))
    open_ = split.filter("listed is null").select("url", F.col("tokens").alias("held"))
    if labelled.isEmpty():
        best = open_.select("url", F.lit(None).cast("string").alias("mined"), F.lit(None).cast("string").alias("mined_rule")).limit(0)
    else:
        fits = matches(open_, "url", mine_rules(labelled, min_support, min_confidence))
        rank = F.struct("confidence", "support", F.size("tokens"), "verdict", "rule_id")
        best = fits.groupBy("url").agg(F.max(rank).alias("best")).select(
            "url", F.col("best.verdict").alias("mined"), F.col("best.rule_id").alias("mined_rule"))
    judged = split.join(best, "url", "left").select(
        F.col("url").alias("_url"), "host", "path", "rule",
        F.coalesce("listed", "mined", F.lit("allow")).alias("verdict"), "mined_rule",
    )
    asked = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
    return asked.join(judged, "_url").select("page_id", "host", "path", "rule", "verdict", "mined_rule")
