"""Merkle manifest and ranked search against plain Python, with nulls, ties, repeats, long texts and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import merkle, ranking

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, G string, Item string, path string, k long, score string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(part, (r.doc_id, r.source, r.lang, r.n_chars, text)))


def level(nodes):
    return [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]


def climb(nodes, at):
    """(root, runs) of the node at a place: each run as (left, right)."""
    steps = []
    while len(nodes) > 1:
        lo = at // 8 * 8
        steps.append((nodes[lo:at], nodes[at + 1 : lo + 8]))
        nodes, at = level(nodes), at // 8
    return nodes[0], steps


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    tops = {}
    for g in langs:
        nodes = [leaf(r, r.text) for r in groups[g]]
        while len(nodes) > 1:
            nodes = level(nodes)
        tops[g] = nodes[0]
    out = []
    for i, g in enumerate(langs):
        root, upper = climb([tops[x] for x in langs], i)
        nodes = [leaf(r, r.text) for r in groups[g]]
        for at, r in enumerate(groups[g]):
            _, steps = climb(nodes, at)
            steps = steps + upper
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            x = leaf(r, text)
            for left, right in steps:
                x = h(*left, x, *right)
            proof = h(*[d for left, right in steps for d in left + right])
            out.append((r.doc_id, leaf(r, r.text), tops[g], root, proof, x, x == root))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "g", "i", "p", 5, "s") for r in rows], SCHEMA)


def documents(n):
    rng = random.Random(n)
    rows = [(i, f"Text {i} Ä\x00 é", rng.choice(["en", "en", "en", "de", None, "ß"]), rng.choice(["web", None]), i) for i in range(n)]
    return rows + [(n, None, "solo", None, None), (n + 1, "", "en", "web", 0), (n + 1, "", "en", "web", 0), (None, "A" * 5000, "en", "x", 5)]


@pytest.mark.parametrize("n,langs", [(0, 0), (9, 0), (700, 0), (90, 75)])
def test_manifest_matches_plain_hashing(spark, n, langs):
    rows = documents(n) + [(1000 + i, "T", f"l{i}", "s", 1) for i in range(langs)]
    df = table(spark, rows)
    got = [tuple(r) for r in merkle.tamper_report(df).collect()]
    assert sorted(got, key=repr) == sorted(brute_manifest(df.collect()), key=repr)
    assert n < 100 or {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_tiers_of_any_height_give_the_same_manifest(spark, levels):
    df = table(spark, documents(200))
    one, other = (merkle.manifest(df, levels=k).select("doc_id", "leaf", "root", "proof").collect() for k in (3, levels))
    assert sorted(map(repr, one)) == sorted(map(repr, other))
    held = merkle.manifest(df, levels=levels).filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root"))
    assert held.count() == 0


def test_manifest_of_an_empty_table(spark):
    assert merkle.tamper_report(table(spark, [])).count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranked(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = defaultdict(set)
    for q, t in items:
        queries[q] |= set(terms(t))
    out = []
    for q, wanted in queries.items():
        found = []
        for i, c in held:
            m = 50 + (50 * sum(c.values()) * n) // length
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted if t in c)
            if s > 0:
                found.append((-s, i is not None, i or 0, i))
        out += [(q, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    chances = [1 / (i + 1) for i in range(400)]
    text = lambda n: " ".join(rng.choices(words, chances, k=n))
    docs = [(i, text(rng.randrange(1, 120))) for i in range(600)]
    docs += [(600 + i, docs[5][1]) for i in range(120)]
    docs += [(800, None), (801, ""), (802, " ,;- \n"), (803, text(20000)), (5, docs[9][1]), (5, docs[9][1]), (None, docs[9][1])]
    docs += [(804, "ÄRGER, W1! x_y w2-w3"), (805, "ärger")]
    items = [(i, text(rng.randrange(1, 40))) for i in range(30)]
    items += [(30, docs[5][1]), (31, None), (32, ""), (33, "nowhere"), (34, "w0"), (34, "w300"), (None, "w7 W7 w8"), (35, "Ärger x y")]
    return docs, items


@pytest.mark.parametrize("k", [1, 7, 50])
def test_ranking_matches_brute_force(spark, searched, k, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 100)
    docs, items = searched
    df = spark.createDataFrame([(i, t, 1, "b", "c") for i, t in docs], "doc_id long, text string, Rank int, term string, Q string").repartition(5)
    asked = spark.createDataFrame([(i, t, 2, "x") for i, t in items], "item_id long, text string, block int, doc_id string")
    got = ranking.ranked(df, asked, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_ranked(docs, items, k)


def test_ranking_of_empty_tables(spark, searched):
    docs = spark.createDataFrame(searched[0][:20], "doc_id long, text string")
    items = spark.createDataFrame(searched[1][:5], "item_id long, text string")
    assert ranking.ranked(docs.limit(0), items).count() == 0
    assert ranking.ranked(docs, items.limit(0)).count() == 0
    assert ranking.ranked(docs.filter("false").unionByName(docs.selectExpr("doc_id", "'' text")), items).count() == 0


def test_short_and_long_lists_and_skipping(searched):
    """One block against the plain sums, with lists on both sides of the limit and a threshold already set."""
    import numpy as np

    rng = np.random.default_rng(1)
    n, n_terms = 5000, 40
    shares = np.concatenate((np.full(20, 0.002), np.full(20, 0.4)))
    hit = rng.random((n, n_terms)) < shares
    places, held = np.nonzero(hit)
    impacts = rng.integers(1, 1000, len(places))
    ids = rng.permutation(n).astype(np.int64)
    block = ranking.Postings(ids, places, held, impacts, n_terms)
    full = np.zeros((n, n_terms), np.int64)
    full[places, held] = impacts
    for size in (1, 5, 30):
        query = np.sort(rng.choice(n_terms, size, replace=False))
        scores = full[:, query].sum(axis=1)
        order = np.lexsort((ids, -scores))
        want = [(int(scores[i]), int(ids[i])) for i in order[:10] if scores[i] > 0]
        for start in (0, len(want) - 1):
            best = ranking.Best(10)
            if start:
                best.add(np.array([s for s, _ in want[:start]]), np.array([i + n for _, i in want[:start]]))
            block.search(query, best)
            together = want + [(s, i + n) for s, i in want[:start]]
            assert list(zip(best.scores.tolist(), best.ids.tolist())) == sorted(together, key=lambda x: (-x[0], x[1]))[:10]
