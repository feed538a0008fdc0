"""Line, substring and near-duplicate operators against brute force, with nulls, ties and clashing names."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import lines, simhash, substrings
from tallyloom.llm.common import sized_slices

SCHEMA = "doc_id long, text string, lang string, n_lines long, domain string, k string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(spark, data):
    return spark.createDataFrame([(i, t, None, 7, "x", "y") for i, t in data], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    """Passages that repeat within and across texts, copies, near copies, short, empty and NULL texts, a long one."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    passages = [" ".join(rng.choices(words, k=k)) for k in (20, 21, 35, 19, 60)]
    found = []
    for i in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(4)]
        parts += rng.sample(passages, 2)
        rng.shuffle(parts)
        found.append(rng.choice(["\n", " ", " \t"]).join(parts))
    found += [found[3], found[3], found[4] + " extra", "", None, "one", "a b", "same " * 100, " \n "]
    found += ["\n".join(found[7].split()[:30] * 60), found[9].replace(" ", "  ")]
    return list(enumerate(found))


def test_substrings_match_brute_force(spark, texts):
    got = {r.doc_id: r for r in substrings.substring_digest(corpus(spark, texts)).collect()}
    seen, removed = set(), 0
    for i, text in texts:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        removed += sum(gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert removed > 1000 and len(got) == len(texts)


@pytest.mark.parametrize("window", [14, 33])
def test_difference_cover_aligns_any_two_positions(window):
    length = window - substrings.PERIOD + 1
    for a in range(13):
        for b in range(13):
            assert any((a + s) % 13 in substrings.COVER and (b + s) % 13 in substrings.COVER for s in range(13))
    assert length + substrings.PERIOD - 1 == window


def test_substrings_with_repeated_and_null_ids(spark):
    text = " ".join(f"v{i}" for i in range(25))
    df = corpus(spark, [(1, text), (1, text), (None, text), (2, text), (3, None)])
    got = sorted(((r.doc_id is not None, r.doc_id, r.n_words, r.n_removed) for r in substrings.substring_digest(df).collect()), key=repr)
    # the NULL id comes first and keeps the passage
    assert got == [(False, None, 25, 0), (True, 1, 25, 25), (True, 1, 25, 25), (True, 2, 25, 25), (True, 3, 0, 0)]
    assert substrings.substring_digest(df.limit(0)).count() == 0


def test_substrings_of_many_identical_rows(spark):
    """Rows of one id and text share their anchors and windows instead of multiplying them."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(90)}" for _ in range(400))
    df = corpus(spark, [(None, text)] * 600 + [(7, "x " + text)])
    got = substrings.substring_digest(df).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r["count"]) for r in got) == [(0, 400, 0, 600), (7, 401, 400, 1)]


def test_run_hashes_tell_runs_apart_anywhere():
    """Equal runs hash alike at any place, others differ, single words and permutations included."""
    words = substrings.WordHashes()
    h = words.of(b"a b c d a b c d b a c d c c a b".split())
    for which in range(3):
        one = substrings.run_hashes(h, np.arange(13), 4, which)
        assert one[0] == one[4] and len(set(one.tolist())) == 12
        assert len(set(substrings.run_hashes(h, np.arange(16), 1, which).tolist())) == 4
    assert len(substrings.run_hashes(h[:0], np.arange(0), 4, 0)) == 0


def test_sized_slices_keep_all_rows():
    texts = ["x" * n for n in (5, 0, 300, 1, 1, 1, 90)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = [p.column("text").to_pylist() for p in sized_slices(iter([batch]), "text", 100)]
    assert sum(parts, []) == texts and parts[0] == texts[:3] and max(map(len, parts)) < 6


def brute_lines(data, run):
    seen, out = set(), {}
    for i, text in data:
        rows = [] if text is None else text.split("\n")
        gone = [False] * len(rows)
        for a in range(len(rows) - run + 1):
            w = tuple(rows[a : a + run])
            if w in seen:
                gone[a : a + run] = [True] * run
            seen.add(w)
        out[i] = (len(rows), sum(gone), None if text is None else "\n".join(r for r, g in zip(rows, gone) if not g))
    return out


@pytest.mark.parametrize("run,gram", [(3, 2), (1, 1), (4, 1), (5, 5)])
def test_lines_match_brute_force(spark, run, gram):
    rng = random.Random(run)
    data = [(i, "\n".join(rng.choice("abcd") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 30)))) for i in range(50)]
    data += [(50, None), (51, ""), (52, "\n\n\n\n"), (53, data[4][1]), (54, "a\nb\n"), (55, "x\n" * 3000)]
    want = brute_lines(data, run)
    out = lines.dedup_lines(corpus(spark, data), run, gram)
    assert set(out.columns) == {"doc_id", "text", "lang", "n_lines", "domain", "k", "n_removed"}
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in out.collect()}
    assert got == want
    assert lines.line_digest(corpus(spark, data).limit(0)).count() == 0
    other = lines.dedup_lines(corpus(spark, data).drop("n_lines").withColumn("N_Lines", F.lit("own")), run, gram)
    assert sorted(c for c in other.columns if c.lower() == "n_lines") == ["n_lines"] and other.count() == len(data)


def test_lines_with_repeated_and_null_ids(spark):
    df = corpus(spark, [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc")])
    assert sorted((r.n_lines, r.n_removed) for r in lines.line_digest(df).collect()) == [(3, 0), (3, 3), (3, 3)]


def brute_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("points", [3000, 8])
def test_simhash_matches_brute_force(spark, texts, points, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", points)
    rng = random.Random(2)
    data = list(texts)
    for i, t in texts[:40]:  # near copies: one word of many changes
        words = (t * 3).split()
        data.append((1000 + i, " ".join(words)))
        words[rng.randrange(len(words))] = "changed"
        data.append((2000 + i, " ".join(words).upper()))
    prints = {i: brute_print(t) for i, t in data}
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(corpus(spark, data)).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_vantage_tree_brings_every_close_pair_together():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**64, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (300, 2), dtype=np.uint64)
    fps = np.unique(np.concatenate((centres, centres ^ flips[:, 0], centres ^ flips[:, 0] ^ flips[:, 1])))
    tree = simhash.VantageTree(fps[:200], 6, 2)
    at, shard = tree.route(fps)
    homes = {}
    for i, s in zip(at.tolist(), shard.tolist()):
        homes.setdefault(i, set()).add(s)
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(fps ^ fps[i]) <= 2)[0]:
            assert homes[i] & homes[int(j)]


def test_simhash_edges(spark):
    df = corpus(spark, [(5, "a b c"), (5, "a b c"), (None, None), (7, ""), (None, "zz yy xx ww")])
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (None, 7), (7, 7), (None, None)], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    names = list(range(-40, 40))
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(30)] + [(names[40], names[i]) for i in range(41, 60)] + [(names[70], names[71])]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for part in (names[:31], names[40:60], names[70:72]):
        assert {got.get(x, x) for x in part} == {min(part)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_row_of_a_repeated_line_is_found(spark):
    """A single passage in every document: one anchor kind holds a large share of all rows."""
    passage = " ".join(f"p{i}" for i in range(22))
    df = corpus(spark, [(i, f"start{i} {passage} end{i}") for i in range(200)])
    got = substrings.substring_digest(df).agg(F.sum("n_removed")).first()[0]
    assert got == 199 * 22


@pytest.mark.parametrize("points", [3000, 8])
def test_keep_one_matches_all_pairs_of_fingerprints(spark, points, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", points)
    rng = random.Random(8)
    data = []
    for i in range(30):
        words = [f"u{rng.randrange(4000)}" for _ in range(400)]
        data.append((i, " ".join(words)))
        for c in (1, 2, 3):
            near = list(words)
            near[20 * c] = "new"
            data.append((100 * c + i, " ".join(near)))
    data += [(500, None), (501, ""), (502, data[0][1]), (502, data[0][1]), (None, data[4][1]), (None, "alone"), (503, "x y")]
    order = sorted(data, key=lambda d: (d[0] is None, d[0] or 0))
    prints = [brute_print(t) for _, t in order]
    root = list(range(len(order)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(order)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = [order[i][0] for i in range(len(order)) if find(i) == i]
    kept = simhash.keep_one(corpus(spark, data))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr) == sorted(want, key=repr)
    assert 32 < len(want) < len(data) - 10
    assert simhash.keep_one(corpus(spark, data).limit(0)).count() == 0
