"""Classifiers: held-out accuracy on the given tables, and odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tristrata.llm import byte_cnn, fm_toxicity, langid, queries
from tristrata.llm.tables import bounded_sample

BIG = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, "123 ½ —"), (4, "word " * 60000), (4, "word " * 60000), (None, "x")]


def odd(spark):
    return spark.createDataFrame([(i, t, "en", 5) for i, t in ODD], "doc_id long, text string, lang string, score int")


def test_language(spark):
    rows = queries.op5_language_id(spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.99 and rows.score.between(0, 1).all()


def test_odd_languages(spark):
    got = langid.identify(odd(spark), langid.fit(odd(spark), F.lit(True))).collect()
    assert [(r.doc_id, r.lang_pred) for r in got if r.lang_pred == "und"] == [(1, "und"), (2, "und"), (3, "und")] and len(got) == len(ODD)
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    none = langid.identify(odd(spark), langid.fit(odd(spark), F.lit(False))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert langid.family_of("xx") != langid.family_of("yy")


@pytest.mark.parametrize("left_out", ["en", "de"])
def test_unlearned_language_goes(spark, left_out):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text", "lang")
    held = queries.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(F.col("lang") != left_out), ~held)
    rng = np.random.default_rng(0)
    letters = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), rng.integers(20, 400))) for _ in range(200)]
    rows = docs.where(held).union(spark.createDataFrame([(-i, t, "letters") for i, t in enumerate(letters)] + [(None, None, "none"), (None, "12 3", "none")], docs.schema))
    rows = rows.withColumn("kind", F.when(F.col("lang").isin(left_out, "letters", "none"), F.col("lang")).when(F.length("text") < 100, "short").otherwise("learned"))
    count = lambda df: {r.kind: r["count"] for r in df.groupBy("kind").count().collect()}
    every, kept = count(rows), count(langid.where_known(rows, model))
    print(left_out, {k: f"{kept.get(k, 0)} of {n} kept" for k, n in every.items()})
    assert "none" not in kept and kept.get("letters", 0) == 0 and kept.get(left_out, 0) < 0.02 * every[left_out]
    assert kept["learned"] > 0.99 * every["learned"] and kept["short"] > 0.95 * every["short"] > 0


def test_only_the_language_identified_counts(spark):
    """Both texts are familiar in ``xx`` alone; the second is identified as ``yy`` by its family."""
    xx, yy = "some plain words", "zzzz qqqq zzzz qqqq"
    vectors = np.stack([np.append(langid._features(np.frombuffer(t.encode(), np.uint8)), 1.0) for t in (xx, yy)]).astype(np.float32)
    familiar = np.zeros((1 << langid.RUN_BITS, 2), bool)
    familiar[:, 0] = True
    model = langid.LanguageModel([["xx"], ["yy"]], 9 * vectors.T, {}, familiar, 0.5)
    docs = spark.createDataFrame([(1, xx), (2, yy), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()} == {1: "xx", 2: "yy", 3: "und"}
    assert [r.doc_id for r in langid.where_known(docs, model).collect()] == [1]


def test_runs_do_not_depend_on_slices(monkeypatch):
    text = np.frombuffer("Some  words, été and 12 more.".encode() * 40, np.uint8)
    whole = langid._runs(text)
    monkeypatch.setattr(langid, "_PART", 7)
    assert (langid._runs(text) == whole).all() and langid._runs(text[:0]).shape == (2, 0)


@pytest.mark.parametrize(("query", "label", "least"), [(queries.op9_fm_toxicity, "toxic", 0.95), (queries.op10_byte_cnn, "quality", 0.96)])
def test_labels(spark, query, label, least):
    rows = query(spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows[label]).mean() > least and rows.score.between(0, 1).all()


def test_odd_scores(spark):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (4, 1, None), (77, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for fit, label in ((fm_toxicity.fit, "toxic"), (byte_cnn.fit, "quality")):
        for some in (labels, labels.limit(0)):
            got = fm_toxicity.score(odd(spark), fit(odd(spark), some, label), 0.5).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
            assert fm_toxicity.score(odd(spark).limit(0), fit(odd(spark), some, label), 0.5).count() == 0


def test_factors_learn_what_weights_can_not():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (1200, 2))
    y = (bits[:, 0] ^ bits[:, 1]).astype(int)
    rows = [np.sort(np.concatenate([np.flatnonzero(b) + 1, [100 + i]])) for i, b in enumerate(bits)]
    model = fm_toxicity.train(rows, y, epochs=150)
    z = np.zeros(4)
    for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        at = [i for i, s in enumerate(model.slots) if (s == 1 and a) or (s == 2 and b)]
        v = model.factors[at]
        z[k] = model.bias + model.weights[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
    assert len(model.slots) >= 1 and (len(model.slots) < 2 or (z[3] < z[1] + model.weights.max()))


def test_pair_decides_in_a_large_vocabulary():
    rng = np.random.default_rng(0)

    def rows(n):
        bits = rng.integers(0, 2, (n, 2))
        return [np.unique(np.concatenate([np.flatnonzero(b) + 1, rng.integers(100, 10100, 20)])) for b in bits], bits[:, 0] ^ bits[:, 1]

    model = fm_toxicity.train(*rows(3000))
    assert len(model.slots) > 9000 and {1, 2} <= set(model.slots.tolist())
    found, want = rows(500)
    z = []
    for r in found:
        at = np.flatnonzero(np.isin(model.slots, r))
        v = model.factors[at]
        z.append(model.bias + model.weights[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))
    assert ((np.array(z) > 0) == want).mean() > 0.95


def test_chunks_cover_every_byte():
    for n in (0, 1, 11, 511, 512, 513, 5000):
        seen = np.zeros(max(n, 1), bool)
        for s in byte_cnn.chunk_starts(n):
            seen[s : s + byte_cnn.CHUNK] = True
        assert seen.all()


def test_network_gradient():
    net = byte_cnn.ByteNetwork.start(1)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (5, 700, 1500)]
    y, share = np.array([1, 0, 1]), np.ones(3) / 3
    loss = lambda: -np.log(np.where(y == 1, p := net._score(texts), 1 - p)).mean()
    grads = net.gradients(texts, y, share)
    for part, grad in zip(net.parts(), grads):
        i = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        kept = part[i]
        part[i] = kept + 1e-3
        up = loss()
        part[i] = kept - 1e-3
        down = loss()
        part[i] = kept
        assert (up - down) / 2e-3 == pytest.approx(grad[i], rel=0.1, abs=1e-4)


def test_same_score_in_any_company():
    net = byte_cnn.ByteNetwork.start(1)
    texts = ["a", "long text " * 9000, "", "b " * 300]
    alone = [net.score(pa.array([t]))[0] for t in texts]
    assert net.score(pa.array(texts)) == pytest.approx(alone, abs=1e-5)


def test_bounded_sample(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 > 0, 1).alias("y"))
    got = bounded_sample(rows, "doc_id", "y", 300).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {None: 150, 1: 150}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids, before = {r.doc_id for r in out.select("doc_id").collect()}, {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) > 0.5 * len(before), name
        docs = out
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
