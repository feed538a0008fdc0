"""Sharding, mixing, url rules, top-k and decontamination against brute force, with nulls and ties."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, sharding, templates, topk, urls

SCHEMA = "doc_id long, text string, lang string, source string, shard string, slot int, epoch string"


def docs(spark, data):
    return spark.createDataFrame([(i, t, lang, source, "s", 1, "e") for i, t, lang, source in data], SCHEMA)


# ---- sharding -----------------------------------------------------------------------
def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(spark):
    ids = [*range(300), -5, 2**62 + 11, -(2**63), None, 7, 7]
    data = [(i, None if n % 11 == 0 else "é" * (n % 5), None, None) for n, i in enumerate(ids)]
    got = sharding.assign_shards(docs(spark, data), 16).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r.shard, r.grown_shard, r.law) == (jump(r.doc_id or 0, 16), jump(r.doc_id or 0, 17), "key")
        assert r.grown_shard in (r.shard, 16)
    for s in range(16):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [(-(2**64) if r.doc_id is None else r.doc_id, r.text_crc32, r.size) for r in own]
        assert keys == sorted(keys)
    sizes = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _, _ in data)
    assert sorted((r["size"], r.text_crc32) for r in got) == sizes
    own = sharding.shard_documents(docs(spark, data).withColumn("_key", F.lit("own")), 5)
    assert {r._key for r in own.collect()} == {"own"}
    placed = sharding.shard_documents(docs(spark, data), 5)
    assert all(r.shard == jump(r.doc_id or 0, 5) for r in placed.collect()) and placed.columns.count("shard") == 1
    assert sharding.assign_shards(docs(spark, data).limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.jump_shards("x", [0])


# ---- mixing -------------------------------------------------------------------------
def fill(budget, children):
    """Integer water filling: children {name: (capacity, weight)}."""
    order, open_, rest = sorted(children, key=lambda c: (children[c][0] / children[c][1], c)), dict(children), budget
    given = {}
    for c in order:
        cap, w = children[c]
        if cap * sum(x for _, x in open_.values()) > rest * w:
            break
        given[c], rest = cap, rest - cap
        del open_[c]
    total = sum(w for _, w in open_.values())
    return given | {c: rest * w // total for c, (_, w) in open_.items()}


@pytest.mark.parametrize("percent,epochs", [(50, 1), (80, 2), (300, 3), (0, 2)])
def test_mix_matches_brute_force(spark, percent, epochs):
    rng = random.Random(percent)
    data = [(i, " ".join("w" * rng.randrange(0, 30)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c1", None])) for i in range(200)]
    data += [(200 + i, " ".join("hot" * 9), "en", "a") for i in range(150)] + [(500, None, "en", "a"), (3, data[3][1], data[3][2], data[3][3])]
    plan = mixing.MixPlan(domain={"x": 3}, lang={"en": 4}, source={"b": 2}, budget_percent=percent, max_epochs=epochs)
    domain = F.when(F.col("source") == "a", "x").otherwise(F.lit("y"))
    got = mixing.mix(docs(spark, data), plan, domain).collect()
    leaves = {}
    for i, t, lang, source in data:
        leaf = ("x" if source == "a" else "y", lang or "", source or "")
        leaves[leaf] = leaves.get(leaf, 0) + len((t or "").split())
    weight = [lambda n: {"x": 3}.get(n, 1), lambda n: {"en": 4}.get(n, 1), lambda n: {"b": 2}.get(n, 1)]

    def share(path, budget):
        if len(path) == 3:
            return {path: budget}
        below = {}
        for leaf, supply in leaves.items():
            if leaf[: len(path)] == path:
                below[leaf[len(path)]] = below.get(leaf[len(path)], 0) + supply * epochs
        out = {}
        for c, b in fill(budget, {c: (cap, weight[len(path)](c)) for c, cap in below.items()}).items():
            out |= share((*path, c), b)
        return out

    quotas = share((), min(sum(leaves.values()) * percent // 100, sum(leaves.values()) * epochs))
    used = {}
    for r in got:
        leaf = (r.domain, r.lang or "", r.source or "")
        used[leaf] = used.get(leaf, 0) + r.tokens
    longest = max(len((t or "").split()) for _, t, _, _ in data)
    for leaf, quota in quotas.items():
        assert quota - longest * 2 < used.get(leaf, 0) <= quota
    copies = {}
    for r in got:
        copies.setdefault((r.doc_id, r.text), []).append(r.epoch)
    for leaf in leaves:
        counts = [len(copies.get((i, t), [])) / (2 if i == 3 else 1) for i, t, lang, source in data
                  if ("x" if source == "a" else "y", lang or "", source or "") == leaf]
        assert max(counts) - min(counts) <= 1 and max(counts) <= epochs
    assert {c for c in mixing.mix(docs(spark, data), plan, domain).columns} == {*[c.split()[0] for c in SCHEMA.split(", ")], "domain", "tokens"}
    clash = docs(spark, data).withColumn("Tokens", F.lit("own")).withColumn("domain", F.lit("mine"))
    assert "Tokens" not in mixing.mix(clash, plan, domain).columns
    drawn = mixing.drawn_documents(clash, plan)
    assert drawn.columns == clash.columns and all((r.Tokens, r["domain"], r.epoch) == ("own", "mine", "e") for r in drawn.collect())
    # the same plan draws the same rows, whatever the layout
    again = mixing.mix(docs(spark, data).repartition(7), plan, domain).collect()
    assert sorted((r.doc_id, r.epoch) for r in got) == sorted((r.doc_id, r.epoch) for r in again)
    assert mixing.mix(docs(spark, data).limit(0), plan, domain).count() == 0


# ---- urls ---------------------------------------------------------------------------
def test_urls(spark):
    listed = [
        ("HTTP://A.Example.NET/en/1?x=1", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/en", "example.net", "/en", "net/", "block"),
        ("https://notexample.net/en/2", "notexample.net", "/en/2", "net/", "block"),
        ("http://b.example.com/de/3#t", "b.example.com", "/de/3", "example.com/de/", "block"),
        ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        ("ftp://net", "net", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://H?q=/en/", "h", "", None, "allow"),
        ("x://É.org/fr/é?", "É.org", "/fr/é", "org/fr/", "allow"),
    ]
    df = spark.createDataFrame([(i, u, "h") for i, (u, *_) in enumerate(listed)] + [(0, listed[0][0], "h"), (None, None, "h")], "page_id long, url string, host string")
    got = {r.page_id: tuple(r)[1:5] for r in urls.judge_urls(df).collect()}
    assert urls.judge_urls(df).count() == len(listed) + 2
    assert got == {**{i: tuple(w[1:]) for i, w in enumerate(listed)}, None: ("", "", None, "allow")}
    assert urls.judge_urls(df.limit(0)).count() == 0
    assert urls.judge_urls(df.filter("page_id in (5, 6)")).count() == 2  # nothing to learn from


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        tokens = sorted(rng.sample("abcdef", rng.randrange(1, 5)))
        bad = "a" in tokens and "b" in tokens or rng.random() < 0.05
        rows.append((tokens, "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, label string")
    got = {(r.verdict, tuple(r.tokens)): (r.confidence, r.support) for r in urls.mine_rules(labelled, 0.02, 0.8).collect()}
    from itertools import combinations

    every = {}
    for k in range(1, 5):
        for held in combinations("abcdef", k):
            n = [lab for t, lab in rows if set(held) <= set(t)]
            for verdict in ("block", "allow"):
                hits = n.count(verdict)
                if hits >= 0.02 * len(rows) and hits >= 0.8 * len(n):
                    every[verdict, held] = hits / len(n)
    want = {
        (v, t): c for (v, t), c in every.items()
        if not any(v == w and set(u) < set(t) and d >= c for (w, u), d in every.items())
    }
    assert got.keys() == want.keys() and got[("block", ("a", "b"))][0] == 1.0
    sets = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "id int, held array<string>")
    hits = {(r.id, r.rule_id) for r in urls.matches(sets, "id", urls.mine_rules(labelled, 0.02, 0.8)).collect()}
    assert hits == {(i, " ".join((v, *t))) for i, (held, _) in enumerate(rows) for v, t in want if set(t) <= set(held)}


# ---- top k --------------------------------------------------------------------------
@pytest.mark.parametrize("block", [4096, 16])
def test_top_k_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 1)
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.3, (150, 8)).astype(np.float32)
    vectors[50:90] = vectors[3]  # many equal vectors
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    data += [(200, None), (201, [1.0, None] + [0.0] * 6), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (204, []), (205, [1.0] * 7), (None, data[0][1]), (20, data[20][1])]
    df = spark.createDataFrame([(i, v, 1.5) for i, v in data], "vec_id long, embedding array<float>, score double")
    got = {}
    for r in topk.exact_top_k(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.floor(64 * vectors.astype(np.float64)).astype(int)
    assert sorted(got) == list(range(0, 150, 20))
    for q, found in got.items():
        best = sorted((-int(x[q] @ x[i]), i) for i in range(150) if i != q)[:20]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    twice = spark.createDataFrame([(20, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [1.0, 9.0]), (2, [2.0**23, 1.0])], df.select("vec_id", "embedding").schema)
    near = topk.exact_top_k(twice, F.lit(True), 20).filter("query_id = 20").select("rank", "vec_id", "score").collect()
    assert sorted(map(tuple, near)) == [(1, 2, 2**35), (2, 1, 20480), (3, 1, 4096)]
    big = [(i, [float(2**23 * (i + 1)), float(2**22 + i), 1.0]) for i in range(12)]  # scores beyond 2^53
    near = topk.exact_top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5).collect()
    whole = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(big[0][1], v)), i) for i, v in big[1:])[:5]
    assert sorted((r["rank"], r.vec_id, r.score) for r in near) == [(n + 1, i, -s) for n, (s, i) in enumerate(whole)]
    few = topk.exact_top_k(df.filter("vec_id < 5"), F.col("vec_id") == 0, 20).collect()
    assert len(few) == 4 and topk.exact_top_k(df.limit(0), F.lit(True)).count() == 0


def test_bound_order_stops_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 60, (8, 16))
    x = np.floor(centres[rng.integers(0, 8, 3000)] + rng.normal(0, 2, (3000, 16)))
    pivots = topk.choose_pivots(x[:500])
    at, off = topk.place(topk.pivot_distances(x, pivots), pivots)
    exact = x[:50] @ x.T
    assert (at[:50] @ at.T + np.outer(off[:50], off) + 0.5 >= exact).all()
    table = topk.places(x, pivots)
    own = np.arange(3000)
    for i, rows, scores in topk.search_block(topk.Block(own[:5], own[:5], x[:5], table[:5]), topk.Block(own, own, x, table), 10):
        best = sorted((-int(x[i] @ x[j]), j) for j in range(3000) if j != i)[:10]
        assert [(-s, r) for r, s in zip(rows.tolist(), scores.tolist())] == best


# ---- decontamination ----------------------------------------------------------------
ITEM = "A farmer named Alma sells 12 kg of ripe apples at the market. How many coins does Alma get when each kg costs 3 coins?"


def test_reparameterised_questions_are_found(spark):
    same = ITEM.replace("Alma", "Boris").replace("12", "45").replace("kg", "pounds").replace(" 3 ", " 7,5 ")
    mixed = ITEM.replace("named Alma", "named Boris").replace("does Alma", "does Carla")
    data = [
        (1, f"Some words before it here. {ITEM} And after", None, None), (2, f"Read this: {same}", None, None), (3, mixed, None, None),
        (4, "A farmer sells apples at the market and nothing else happens there today", None, None), (5, None, None, None), (6, "", None, None),
        (7, ITEM.lower(), None, None), (10, ITEM.upper(), None, None), (None, ITEM, None, None), (1, f"Some words before it here. {ITEM} And after", None, None),
        (8, "short item with five words", None, None), (9, " 12 45 " * 50, None, None),
    ]
    items = spark.createDataFrame([(70, ITEM, 0), (71, None, 0), (72, "", 0), (73, "Short item, with five words.", 0), (74, "1 2 3 4 5 6 7 8 9 10", 0), (70, ITEM, 0)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r.changed for r in templates.contaminated(docs(spark, data), items).collect()}
    assert got == {(1, 70): False, (2, 70): True, (7, 70): False, (10, 70): False, (None, 70): False, (8, 73): False}
    clean = templates.drop_contaminated(docs(spark, data), items)
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == [3, 4, 5, 6, 9]
    assert clean.columns == docs(spark, data).columns
    assert templates.contaminated(docs(spark, data), items.limit(0)).count() == 0
    assert templates.contaminated(docs(spark, data).limit(0), items).count() == 0


def test_template_types():
    words, values = templates.template("In town Anna ran 3.5 miles, then saw Bob. Then 7 dogs")
    assert words == ["in", "town", "\x02", "ran", "\x01", "\x03", "then", "saw", "\x02", "then", "\x01", "dogs"]
    assert [v for v in values if v] == ["anna", "3.5", "miles", "bob", "7"]


def test_both_ways_to_template_words_agree():
    rng = random.Random(6)
    pieces = ["Anna", "anna", "Élan", "élan", "McDonald", "12", "3.5", "1,000.", "kg", "KG", "5kg", "miles", "is", "IT", ",", ".", "\n", "_x", "\x01", "Bob's", "µm", "ßa", "٣", "word"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice([" ", " ", "", ", "]) for _ in range(rng.randrange(12)))
        assert templates.template_words(text) == templates.template(text)[0], text


def found_in(spark, texts, items):
    """(doc, item, changed) with places in the lists as ids."""
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = templates.contaminated(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]), benchmark).collect()
    return {(r.doc_id, r.item_id, r.changed) for r in found}


def brute_matches(text, item):
    """Whether the item is found in the text, by comparing every window of one with every window of the other."""
    signs = {"\x01", "\x02", "\x03"}
    (a, av), (b, bv) = templates.template(text), templates.template(item)
    raw_a, raw_b = templates.plain_words(text), templates.plain_words(item)
    size = min(8, len(b))
    lines = {}
    for i in range(len(b) - size + 1):
        for j in range(len(a) - size + 1):
            plain = sum(w not in signs for w in b[i : i + size])
            for told, equal in ((False, raw_a[j : j + size] == raw_b[i : i + size]),
                                (True, a[j : j + size] == b[i : i + size] and plain >= min(4, size))):
                if equal:
                    lines.setdefault(j - i, []).append((i, j, told))
    good, told_good = set(), set()
    one = lambda v: v[:-1] if v.endswith("s") and v[:-1] in templates.UNITS and len(v) > 2 else {"feet": "foot"}.get(v, v)
    for windows in lines.values():
        swaps = {}  # (type, item value) -> {place: value in the text}
        of = {}
        for i, j, told in windows:
            for x in range(size):
                if bv[i + x]:
                    new = av[j + x] if told else bv[i + x]
                    old = (b[i + x], one(bv[i + x]) if b[i + x] == "\x03" else bv[i + x])
                    new = one(new) if b[i + x] == "\x03" else new
                    swaps.setdefault(old, {})[i + x] = new
                    of.setdefault((i, told), []).append((old, new))
        for i, j, told in windows:
            same = not told or [v for v in av[j : j + size] if v] == [v for v in bv[i : i + size] if v]
            most = all(2 * list(swaps[old].values()).count(new) > len(swaps[old]) for old, new in of.get((i, told), []))
            if same or most:
                good.add(i)
                if told:
                    told_good.add(i)
    n = len(b) - size + 1
    n_told = sum(sum(w not in signs for w in b[i : i + size]) >= min(4, size) for i in range(n))
    return size > 0 and (2 * len(good) >= n or n_told > 0 and 2 * len(told_good) >= n_told)


def test_decontamination_matches_brute_force(spark):
    """Copies in other case, with other slots, cut, reordered, and mixed with text of the same words."""
    rng = random.Random(11)
    names, units = ["Alma", "Boris", "Carla", "Dmitri"], ["kg", "miles", "minutes", "foot"]
    common = "the a of trader river walked sold carried every market morning evening before after slowly twice".split()

    def sentence():
        words = [rng.choice(common) for _ in range(rng.randrange(4, 16))]
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(1, len(words)), rng.choice([rng.choice(names), f"{rng.randrange(30)} {rng.choice(units)}", str(rng.randrange(99))]))
        return " ".join(words).capitalize() if rng.random() < 0.2 else " ".join(words)

    items = [". ".join(sentence() for _ in range(rng.randrange(1, 5))) for _ in range(25)] + ["12 + 7 = ?", "Carla", "\u0130t is 3 km from here to the old river market"]

    def changed(text):
        way = rng.randrange(7)
        if way == 0:
            return text.lower()
        if way == 1:
            return text.upper()
        if way == 2:
            for old, new in zip(names, names[1:]):
                text = text.replace(old, new)
            return text
        if way == 3:
            return re.sub(r"\d+", lambda m: str(rng.choice([int(m.group()) + 1, 5])), text)
        if way == 4:
            return " ".join(text.split()[rng.randrange(6) :])
        if way == 5:
            return text.replace(rng.choice(common), "zebra")
        return text

    texts = [f"{sentence()}. {changed(rng.choice(items))}. {sentence()} {sentence()}" for _ in range(120)] + [sentence() for _ in range(40)]
    want = {(i, j) for i, t in enumerate(texts) for j, item in enumerate(items) if brute_matches(t, item)}
    assert len({i for i, _ in want}) > 60
    assert {(i, j) for i, j, _ in found_in(spark, texts, items)} == want


def test_one_contradicting_slot_spoils_only_its_windows(spark):
    timed = "Stir the thick soup for 2 minutes over a low flame and then let it rest in the covered pot for 3 minutes before you serve it warm"
    texts = [
        ITEM.replace("named Alma", "named Boris"), ITEM.replace("12 kg", "3 kg"), timed.replace("2 minutes", "1 minute"),
        ITEM.replace("named Alma", "named Boris").replace("does Alma", "does Carla"),  # no value in most places
    ]
    assert found_in(spark, texts, [ITEM, timed]) == {(0, 0, False), (1, 0, True), (2, 1, True)}


def test_items_of_few_plain_words_are_found_as_they_are(spark):
    items = ["What is 12 + 35 - 7 * 4?", "Who is Alan Turing?", "1 km 1000 m 2 km 2000 m 3 km 3000 m", "Then Alan, Bob", "7 * 8 = ?", None, ""]
    texts = [f"Here is some text before it. {t} And some more text after it" for t in items[:5]]
    texts += ["What is 12 + 35 - 7 * 5?", "Who is Ada Lovelace?", "1 km 1000 m 2 km 2000 m 4 km 4000 m 5 km", "Then Alan, Bert", "7 * 9 = ?", "", None]
    assert found_in(spark, texts, items) == {(i, i, False) for i in range(5)}


def test_windows_of_few_plain_words_spoil_no_other_match(spark):
    """An item mostly of numbers is still found with other numbers by its windows of prose."""
    table = "The clerk writes down all of these amounts in one long row for the king: "
    item, other = (table + " ".join(str(n) for n in range(a, a + 40)) for a in (100, 300))
    assert found_in(spark, [item, other], [item]) == {(0, 0, False), (1, 0, True)}


def test_items_without_an_id_are_found(spark):
    items = spark.createDataFrame([(None, ITEM), (3, "Short item, with five words.")], "item_id long, text string")
    texts = docs(spark, [(1, ITEM, None, None), (2, "short item with five words", None, None), (4, "nothing of that", None, None)])
    assert {(r.doc_id, r.item_id) for r in templates.contaminated(texts, items).collect()} == {(1, None), (2, 3)}
    assert [r.doc_id for r in templates.drop_contaminated(texts, items).collect()] == [4]
