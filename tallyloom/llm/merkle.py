"""Merkle manifest of a table by nested-struct rollup.

Every row is a leaf, the SHA-256 of its columns.  Within a group leaves ascend by id; every ``fan`` consecutive nodes become
the hash of their concatenated hex digests, level by level, until one node (the subroot) remains.  Subroots,
ordered by group, are folded in the same way into the root.

A leaf's rank gives its block of ``fan ** levels`` leaves and one digit per level below.  One exchange by (group, block) serves
all levels: the lowest digit is grouped away, its nodes nested as structs in their parent, then the next digit, so a block
ends as one bounded row.  Block roots are the leaves of the next tier.  On the way back a tier's blocks meet the path of
their root in one grouping by (group, block), and transform and explode take the nested structs apart into one
proof per leaf; no table is joined.

Edge cases: a NULL column enters as ``-``, an empty text as ``0:``, texts enter whole; NULL ids and the NULL group come first; rows of
one id ascend by their leaf hash, and repeated rows are leaves of their own with equal hashes; an empty table gives
an empty result; other columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.operators import ordered

from .common import stage, unstage

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: rows of a group that one task ranks
PART_ROWS = 16_384
_PATH = "array<struct<left: string, right: string>>"


def leaf_hash(values: Sequence[str | Column]) -> Column:
    """Hash of values, each ``-`` if NULL, else its UTF-8 byte count, a colon and itself."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """Root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda x, p: F.sha2(F.concat(p["left"], x, p["right"]), 256))


def siblings(proof: Column) -> Column:
    """The proof's digests from the lowest level to the highest, left to right, as one text."""
    return F.array_join(F.flatten(F.transform(proof, lambda p: F.array(p["left"], p["right"]))), "")


def _blocks(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """(g, n, block, h, kids) of nodes (g, n, pos, h, item): n nodes in the group, kids nested ``levels`` deep.

    A level is real while the group has more than one node in it; above that nodes pass through.
    """
    digits = [F.expr(f"int(pos div {fan ** k} % {fan})").alias(f"d{k}") for k in range(levels)]
    rows = nodes.select("g", "n", F.expr(f"pos div {fan ** levels}").alias("block"), *digits, "h", "item").repartition("g", "block")
    for k in range(levels):
        child = F.struct(F.col(f"d{k}").alias("d"), "h", "item" if k == 0 else "kids")
        keys = ["g", "n", "block", *[f"d{j}" for j in range(levels - 1, k, -1)]]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(child)).alias("kids"))
        digests = F.transform("kids", lambda x: x["h"])
        rows = rows.withColumn("h", F.when(F.col("n") > fan**k, F.sha2(F.array_join(digests, ""), 256)).otherwise(digests[0]))
    return rows


def _leaves(blocks: DataFrame, fan: int, levels: int, carried: Sequence[str]) -> DataFrame:
    """(g, pos, h, item, path) of blocks (g, n, block, kids, path), path being the block's own way up."""
    rows = blocks.withColumn("pos", F.col("block"))
    for k in range(levels - 1, -1, -1):
        digests = F.transform("kids", lambda x: x["h"])
        marked = F.transform("kids", lambda x, i: F.struct(
            x.alias("kid"), F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(digests, i + 2, F.lit(fan)), "").alias("right")))
        rows = rows.select("g", "n", "pos", "path", *carried, F.explode(marked).alias("x"))
        longer = F.concat(F.array(F.struct("x.left", "x.right")), "path")
        rows = rows.select(
            "g", "n", (F.col("pos") * fan + F.col("x.kid.d")).alias("pos"), *carried,
            F.when(F.col("n") > fan**k, longer).otherwise(F.col("path")).alias("path"),
            *(["x.kid.kids"] if k else ["x.kid.h", "x.kid.item"]))
    return rows.drop("n")


def _joined_up(blocks: DataFrame, above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Blocks with the path of their root and the columns ``carried``: both are grouped by (g, block)."""
    both = blocks.select("g", "block", "n", "kids").unionByName(above, allowMissingColumns=True)
    kept = [F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", *carried)]
    return both.groupBy("g", "block").agg(*kept)


def _rolled(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """Staged blocks of every tier, the last with one block per group."""
    tiers = [stage(_blocks(nodes, fan, levels), "merkle")]
    while not tiers[-1].filter("block > 0").isEmpty():
        fewer = F.ceil(F.col("n") / fan**levels).alias("n")
        nodes = tiers[-1].select("g", fewer, F.col("block").alias("pos"), "h", F.lit(None).cast("int").alias("item"))
        tiers.append(stage(_blocks(nodes, fan, levels), "merkle"))
    return tiers


def _proved(tiers: list[DataFrame], above: DataFrame, fan: int, levels: int, carried: Sequence[str]) -> DataFrame:
    """Leaves of the lowest tier with their whole paths, from ``above`` (g, block, path, carried) of the top tier's blocks."""
    for tier in tiers[:0:-1]:
        found = _leaves(_joined_up(tier, above, carried), fan, levels, carried)
        above = found.select("g", F.col("pos").alias("block"), "path", *carried)
    return _leaves(_joined_up(tiers[0], above, carried), fan, levels, carried)


def _ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[ordered.By]) -> DataFrame:
    """Rows with their rank from 0 (pos) and the number of rows (n) in their group."""
    found = ordered.running_sums(rows, keys, order, {"pos": F.lit(1).cast("bigint")}, totals={"n": "pos"}, part_rows=PART_ROWS)
    return found.withColumn("pos", F.col("pos") - 1)


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: Sequence[str] = LEAF_COLUMNS,
    extras: dict[str, Column] | None = None, fan: int = 8, levels: int = 3,
) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof, and ``extras`` (expressions over the document).

    proof holds, from the leaf upwards, the digests on the left and on the right of the node in its run, concatenated.
    """
    item = F.struct(F.col(id_col).alias("id"), *[c.alias(name) for name, c in (extras or {}).items()])
    rows = docs.select(F.col(group_col).alias("g"), F.col(id_col).alias("id"), leaf_hash(columns).alias("h"), item.alias("item"))
    rows = stage(rows, "leaves")
    nodes = _ranked(rows, ["g"], ordered.by("id", "h", nulls_first=True)).select("g", "n", "pos", "h", "item")
    tiers = _rolled(nodes, fan, levels)

    tops = tiers[-1].select(F.col("g").alias("item"), "h")
    heads = _ranked(tops, [], ordered.by("item", nulls_first=True)).withColumn("g", F.lit(0))
    head_tiers = _rolled(heads.select("g", "n", "pos", "h", "item"), fan, levels)
    root = head_tiers[-1].select("g", "block", F.lit(None).cast(_PATH).alias("path"), F.col("h").alias("root"))
    root = root.withColumn("path", F.array().cast(_PATH))
    groups = stage(_proved(head_tiers, root, fan, levels, ["root"]), "groups")
    above = groups.select(F.col("item").alias("g"), F.lit(0).cast("long").alias("block"), "path", F.col("h").alias("subroot"), "root")
    for done in (rows, *head_tiers):
        unstage(done)
    found = _proved(tiers, above, fan, levels, ["subroot", "root"])
    kept = [F.col(f"item.`{name}`").alias(name) for name in (extras or {})]
    return found.select(F.col("item.id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), *kept)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tamper_report(docs: DataFrame) -> DataFrame:
    """Manifest digest of every document, and whether its proof still holds after tampering with a third of the texts."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = [F.translate("text", _UPPER, _LOWER) if c == "text" else c for c in LEAF_COLUMNS]
    found = manifest(docs, extras={"tampered": F.when(hit, leaf_hash(lowered))})
    now = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    found = found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), now.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels_sql(first: str, keys: str, name: str, levels: int) -> str:
    """Nodes of every level of a table (keys, i, h); a group's single node stays as it is."""
    steps = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS c FROM {first})"]
    for k in range(levels):
        steps.append(
            f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS c FROM (SELECT {keys}, i // 8 AS i,"
            f" CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h"
            f" FROM {name}{k} GROUP BY {keys}, i // 8))")
    return ",\n".join(steps)


def _sides_sql(name: str, keys: str, level: int) -> str:
    """Digests on both sides of each node in its run at a level."""
    run = f"PARTITION BY {keys}, i // 8 ORDER BY i ROWS BETWEEN"
    return (
        f"SELECT {keys}, i, c, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
        f" coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{level}")


def merkle_sql(levels: int = 7) -> str:
    """The same rows by plain SQL, for up to 8 ** levels rows per language and 64 languages."""
    part = {c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in LEAF_COLUMNS}
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    leaf = f"sha256({' || '.join(part.values())})"
    tampered = f"sha256({' || '.join([*list(part.values())[:-1], part['text'].replace('|| text', '|| ' + lower)])})"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda b: ord(b)::BIGINT)),"
        " lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT for z in range(8)]),"
        " lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"
    )
    steps = [("n", "lang", k, f"i // {8 ** k}") for k in range(levels)] + [("g", "one", k, f"g // {8 ** k}") for k in range(2)]
    walk, at = [], "w0"
    for step, (name, keys, k, pos) in enumerate(steps):
        side = f"s{step}"
        match = f"{side}.i = {at}.{pos}" + (f" AND {side}.lang IS NOT DISTINCT FROM {at}.lang" if name == "n" else "")
        walk.append(
            f"w{step + 1} AS (SELECT {at}.* REPLACE (CASE WHEN c > 1 THEN proof || l || r ELSE proof END AS proof,"
            f" CASE WHEN c > 1 THEN sha256(l || x || r) ELSE x END AS x) FROM {at} JOIN ({_sides_sql(name, keys, k)}) AS {side} ON {match})")
        at = f"w{step + 1}"
    walk_sql = ",\n".join(walk)
    return f"""
WITH d AS (
  SELECT doc_id, lang, {leaf} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {tampered} END AS tampered FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
leaves AS (SELECT lang, i, leaf AS h FROM o),
{_levels_sql("leaves", "lang", "n", levels)},
tops AS (SELECT 1 AS one, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, h FROM n{levels}),
heads AS (SELECT one, i, h FROM tops),
{_levels_sql("heads", "one", "g", 2)},
w0 AS (
  SELECT o.doc_id, o.lang, o.leaf, o.i, t.i AS g, t.h AS subroot, r.h AS root, '' AS proof, coalesce(o.tampered, o.leaf) AS x
  FROM o JOIN tops AS t ON t.lang IS NOT DISTINCT FROM o.lang CROSS JOIN g2 AS r),
{walk_sql}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified FROM {at}
"""
