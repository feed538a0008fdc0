"""Classifiers by held-out accuracy and by their edges; the pipeline against plainer versions of its stages."""

import os
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyloom.llm import quality, toxicity
from tallyloom.llm.labels import training_texts
from tallyloom.llm.mixing import mix_sql
from tallyloom.llm.simhash import simhash

from .test_selection import jump

SMALL = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
SCHEMA = "doc_id long, text string, score double, label int"


def held_out_accuracy(report, labels, target):
    found = report.join(labels, "doc_id").filter("held_out").select("predicted", target).collect()
    return sum(r[0] == r[1] for r in found) / len(found), len(found)


@given
def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    report = quality.quality_report(docs, labels)
    right, n = held_out_accuracy(report, labels, "quality")
    assert n > 50 and right >= 0.9
    for r in report.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


@given
def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    report = toxicity.toxicity_report(docs, labels)
    right, n = held_out_accuracy(report, labels, "toxic")
    assert n > 50 and right >= 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in report.collect())


def test_swaps_keep_neutral_mentions_low():
    """A term that stands in most toxic texts by chance must not carry the score."""
    rng = random.Random(1)
    made, rows, swaps, y = toxicity.Features(), [], [], []
    groups = (("women", "men"),)
    for i in range(400):
        words = {f"n{rng.randrange(60)}" for _ in range(20)}
        bad = i % 4 == 0
        if bad and rng.random() < 0.8:
            words.add(rng.choice(["slur", "insult"]))
        if rng.random() < (0.9 if bad else 0.05):
            words.add("women")
        other = toxicity.swapped(words, groups)
        rows.append(np.sort(made.of(words)))
        swaps.append(None if other is None else np.sort(made.of(other)))
        y.append(float(bad))
    always = made.of({"women", "men"})

    def gap(model):
        w = dict(zip(model.chosen.tolist(), model.weights.tolist()))
        return sum(w.get(f, 0) for f in made["women"]) - sum(w.get(f, 0) for f in made["men"])

    free = toxicity.SwapModel(rows, [None] * len(rows), np.array(y), always)
    tied = toxicity.SwapModel(rows, swaps, np.array(y), always)
    assert gap(free) > 1.5 and abs(gap(tied)) < 0.5 * gap(free)


def test_swapped_words():
    assert toxicity.swapped({"the", "men"}, (("women", "men"),)) == {"the", "women"}
    assert toxicity.swapped({"the"}, (("women", "men"),)) is None


def test_edges(spark):
    good, bad = "calm plain words in a line", "### $$$ *** !!! ### $$$"
    data = [(i, (good if i % 2 else bad) * (1 + i % 3), None, 0) for i in range(80)]
    data += [(None, good, None, 0), (200, None, None, 0), (201, "", None, 0), (202, "x " * 20000, None, 0), (5, data[5][1], None, 0)]
    docs = spark.createDataFrame(data, SCHEMA)
    labels = spark.createDataFrame(
        [(i, i % 2, 1 - i % 2) for i in range(80)] + [(None, 1, 1), (7, None, None), (3, 0, 1), (300, 1, 1)], "doc_id long, quality int, toxic int")
    for report in (quality.quality_report(docs, labels), toxicity.toxicity_report(docs, labels)):
        got = report.collect()
        assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in quality.quality_report(docs, labels).collect()}
    assert scores[41] > 0.5 > scores[40]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < len(data)
    nothing = labels.limit(0)
    assert {r.score for r in quality.quality_report(docs, nothing).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_report(docs, nothing).collect()} == {0.0}
    assert quality.quality_report(docs.limit(0), labels).count() == 0 and toxicity.toxicity_report(docs.limit(0), labels).count() == 0
    # learning sees no row of the left-out fold, and at most the stated number
    used = training_texts(docs, labels, "quality", 5, 0, 10).collect()
    assert 0 < len(used) <= 10


def test_context_table_counts_all_documents(spark):
    data = [(i, f"alpha beta gamma {i % 7}", None, 0) for i in range(90)]
    one = quality.context_table(spark.createDataFrame(data, SCHEMA).coalesce(1))
    many = quality.context_table(spark.createDataFrame(data, SCHEMA).repartition(9))
    assert np.array_equal(one, many) and one[:, -1].sum() == 90 * 4


# ---- pipeline -----------------------------------------------------------------------
@given
def test_pipeline_stages_against_plain_versions(spark):
    duckdb = pytest.importorskip("duckdb")
    from tallyloom.llm.common import stage

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), name)
        kept.append(docs.toPandas())
        assert docs.columns == columns or name == "sharding"
    good, distinct, clean, mixed, placed = kept

    rows = sorted(good.itertuples(), key=lambda r: r.doc_id)
    prints = [simhash(r.text.encode()) for r in rows]
    first = list(range(len(rows)))

    def find(x):
        while first[x] != x:
            x = first[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                first[y] = x
    left = set(distinct.doc_id)
    assert left == {rows[i].doc_id for i in range(len(rows)) if find(i) == i} and len(left) < len(rows)

    items = [r.text.lower().split() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = [" ".join(w) for w in items]
    leaky = {r.doc_id for r in distinct.itertuples() if any(x in " ".join(r.text.lower().split()) for x in leaks)}
    assert leaky and not leaky & set(clean.doc_id) and len(left - set(clean.doc_id)) <= len(leaky) + 3

    con = duckdb.connect()
    con.register("clean", clean)
    want = sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({mix_sql('clean')})").fetchall())
    assert sorted(mixed.doc_id) == want == sorted(placed.doc_id)
    assert all(jump(int(r.doc_id), 16) == r.shard for r in placed.itertuples())
    assert sorted(corpus_pipeline.run(spark, SMALL).toPandas().doc_id) == want


def test_pipeline_on_edge_rows(spark, tmp_path):
    rows = [(1, "plain words here", "en", "src1", 3), (1, "plain words here", "en", "src1", 3), (None, None, None, None, None), (2, "", None, "src", 0), (3, "long " * 30000, "de", "src0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "no such text in any document at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == [*docs.columns, "shard"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 1
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
