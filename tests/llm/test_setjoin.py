"""The chosen-path set join against all pairs, also with large nodes of copies and of half-equal texts."""

import random
import re

import numpy as np
import pytest

from tallyloom.llm import setjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def token_set(text, shingle):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < shingle:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1))


def brute(data, shingle, percent):
    sets = [token_set(t, shingle) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    groups = {}
    for i, (doc, _) in enumerate(data):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(data):
        ids = [d for d in groups[find(i)] if d is not None]
        head = min(ids) if ids else None
        out.append((doc, len(sets[i]), head, doc == head))
    return sorted(out, key=repr)


def joined(spark, data, shingle, percent=80):
    df = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in data], "doc_id long, text string, K int, sketch string, node string, N int")
    return sorted((tuple(r) for r in setjoin.similar_groups(df, shingle, percent).collect()), key=repr)


def changed(rng, words, times, kinds=5000):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.randrange(kinds)}"
    return words


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    found = [" ".join(rng.choices(words, k=rng.randrange(1, 150))) for _ in range(120)]
    for base in found[:40]:
        found += [" ".join(changed(rng, base.split(), t)) for t in (1, 3, 6, 9)]
        found.append(" ".join(base.split()[: max(1, int(len(base.split()) * 0.82))]))
    found += [found[3], found[3].upper(), found[3].replace(" ", "\t\n"), None, "", " \n", "one", "ONE", "one two", "two one", "a a a a", "a a"]
    found += ["long " + " ".join(rng.choices(words, k=30000))]
    found += [found[-1] + " tail"]
    data = list(enumerate(found))
    return data + [(3, found[3]), (None, found[5]), (None, "nobody else"), (7, "other text of a repeated id")]


@pytest.mark.parametrize("shingle,percent", [(2, 80), (5, 80), (2, 50)])
def test_groups_match_all_pairs(spark, texts, shingle, percent):
    # NULL ids: kept is compared as the operator defines it, true only for a group without any id
    want = [(d, n, c, True if c is None else k if d is not None else False) for d, n, c, k in brute(texts, shingle, percent)]
    assert joined(spark, texts, shingle, percent) == sorted(want, key=repr)


def test_large_nodes_are_whole(spark, monkeypatch):
    """Many near copies, a chain of drifting texts and texts that share half: nodes stay large at the last level."""
    monkeypatch.setattr(setjoin, "SMALL", 6)
    monkeypatch.setattr(setjoin, "RUN", 16)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base, half = rng.choices(words, k=150), rng.choices(words, k=100)
    found = [" ".join(changed(rng, base, rng.randrange(0, 9))) for _ in range(150)]
    found += [" ".join(half + rng.choices(words, k=rng.randrange(15, 60))) for _ in range(100)]
    drift = rng.choices(words, k=150)
    for _ in range(60):
        drift = changed(rng, drift, 4)
        found.append(" ".join(drift))
    found += [found[0]] * 50
    rng.shuffle(found)
    data = list(enumerate(found))
    want = brute(data, 2, 80)
    assert joined(spark, data, 2) == want
    assert 30 < sum(k for *_, k in want) < 200


def test_near_misses_of_a_large_group_are_few_pairs(spark, monkeypatch):
    """Texts just below the similarity to a group of near copies meet it in many large nodes, but their pairs are not passed on."""
    monkeypatch.setattr(setjoin, "SMALL", 6)
    monkeypatch.setattr(setjoin, "BLOCK", 16, raising=False)
    rng = random.Random(10)
    base = rng.choices([f"w{i}" for i in range(9000)], k=420)
    found = [" ".join(changed(rng, base, 2)) for _ in range(60)] + [" ".join(changed(rng, base, 26)) for _ in range(40)]
    data = list(enumerate(found))
    passed, crowd_pairs = [], setjoin._crowd_pairs

    def seen(*args):
        pairs = crowd_pairs(*args)
        passed.append([tuple(r) for r in pairs.collect()])
        return pairs

    monkeypatch.setattr(setjoin, "_crowd_pairs", seen)
    want = brute(data, 2, 80)
    assert joined(spark, data, 2) == want and sum(k for *_, k in want) > 30
    assert len(passed) == 1 and len(passed[0]) == len(set(passed[0])) < 300


def test_pairs_of_large_nodes_are_all_pairs_that_link(spark, monkeypatch):
    """Points that nothing has linked before, in nodes of several blocks: each link is found, once, whatever the main groups."""
    monkeypatch.setattr(setjoin, "BLOCK", 8)
    monkeypatch.setattr(setjoin, "SIDE", 3)
    rng = random.Random(11)
    base = rng.choices([f"w{i}" for i in range(900)], k=80)
    words = setjoin.WordHashes()
    sets = [setjoin.token_set(words, " ".join(changed(rng, base, rng.randrange(0, 10))).encode(), 2) for _ in range(60)]
    sketch = [np.concatenate([setjoin.sketch_of(s), setjoin.parities_of(s)]).view(np.int64).tolist() for s in sets]
    crowd = [(v, p, len(sets[p]), *sketch[p], p if p % 3 else 0) for v in (5, 6, 7) for p in range(60) if v < 7 or p < 4]
    crowd = spark.createDataFrame(crowd, f"{setjoin._ROW}, root long")
    tokens = spark.createDataFrame([(p, bytearray(s.tobytes())) for p, s in enumerate(sets)], "p long, tokens binary")
    found = [tuple(r) for r in setjoin._crowd_pairs(crowd, tokens, 80, setjoin.least_agreement(80)).collect()]

    def alike(x, y):
        both = len(np.intersect1d(x, y))
        return 100 * both >= 80 * (len(x) + len(y) - both)

    want = {(a, b) for b in range(60) for a in range(b) if (a % 3 or b % 3) and alike(sets[a], sets[b])}
    assert len(found) == len(set(found)) and want <= set(found) and len(want) > 100


def test_empty_table(spark):
    assert joined(spark, [], 2) == [] and joined(spark, [(1, None), (2, "")], 2) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_trees_and_sketches_hold_the_promised_recall():
    """Pairs exactly at the similarity: tokens of a tree meet at every level, and sketches reach the least agreement."""
    rng = np.random.default_rng(2)
    trees, least = setjoin.trees_for(80), setjoin.least_agreement(80)
    orders = np.random.default_rng(12).integers(0, 2**63, trees * setjoin.DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    met, agree = 0, []
    for _ in range(400):
        both = rng.integers(0, 2**64, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate((both, rng.integers(0, 2**64, 10, dtype=np.uint64)))) for _ in range(2))
        one, two = (setjoin.chosen_tokens(x, orders).reshape(trees, setjoin.DEPTH, -1) for x in (a, b))
        shared = (one[..., :, None] == two[..., None, :]).any(axis=(2, 3))
        met += shared.all(axis=1).any()
        same = 128 - np.bitwise_count(setjoin.sketch_of(a) ^ setjoin.sketch_of(b)).sum()
        agree.append(int(same))
        assert np.bitwise_count(setjoin.parities_of(a) ^ setjoin.parities_of(b)).sum() <= 20
    assert met == 400 and min(agree) >= least
    assert abs(np.mean(agree) - 0.9 * 128) < 2


def test_bitmap_places(spark):
    values = [0, 1, 32767, 32768, 32769, 2**23 - 1, -5, 2**40 + 7]
    seen = setjoin.bitmap(spark.createDataFrame([(v,) for v in values], "v long"), "v", 2**23)
    assert setjoin._in_bitmap(seen, np.array(values, np.int64), 2**23).all()
    assert not setjoin._in_bitmap(seen, np.array([2, 3, 32766, 32770, -6], np.int64), 2**23).any()
