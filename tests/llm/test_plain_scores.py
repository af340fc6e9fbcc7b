"""Scores and the pipeline against plain versions, one step after another in Python."""

from __future__ import annotations

import math
import re
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tristrata.llm import byte_cnn, fm_toxicity, langid, queries
from tristrata.llm.tables import held_out, table
from tristrata.llm.word_bpe import WordBpe, tokenizer_path

TEXTS = ["", "a", "short one", "x" * 511, "Insult and group, insult!", "été à la mer " * 30, "wörter und Wörter " * 90, "line\nline\t" * 200, "日本 text"]


def plain_network(net, text):
    """Every window of every chunk by itself."""
    data = text.encode()
    length = len(data)
    starts = [0] if length <= byte_cnn.CHUNK else [*range(0, length - byte_cnn.CHUNK, byte_cnn.CHUNK - byte_cnn.OVERLAP), length - byte_cnn.CHUNK]
    responses = []
    for s in starts:
        chunk = data[s : s + byte_cnn.CHUNK].ljust(byte_cnn.CHUNK, b"\0")
        # A short text has windows up to the one that holds its last byte.
        windows = byte_cnn.PLACES if length >= byte_cnn.CHUNK else max(1, math.ceil((length - byte_cnn.WIDTH) / byte_cnn.STEP) + 1)
        best = np.full(byte_cnn.FILTERS, -np.inf)
        for w in range(min(windows, byte_cnn.PLACES)):
            seen = np.concatenate([net.embed[b] for b in chunk[w * byte_cnn.STEP : w * byte_cnn.STEP + byte_cnn.WIDTH]]).astype(float)
            best = np.maximum(best, seen @ net.filters)
        responses.append(np.maximum(best + net.bias, 0))
    r = np.array(responses)
    hidden = np.maximum(np.concatenate([r.mean(0), r.max(0), r.min(0)]) @ net.hidden + net.hidden_bias, 0)
    return 1 / (1 + math.exp(-(hidden @ net.out + net.out_bias[0])))


def test_network_scores():
    net = byte_cnn.ByteNetwork.start(4)
    assert net.score(pa.array(TEXTS)) == pytest.approx([plain_network(net, t) for t in TEXTS], abs=1e-5)


def test_pairwise_scores():
    """Bias, a weight for each term and a product of vectors for each pair of terms."""
    rng = np.random.default_rng(3)
    terms = sorted({w for t in TEXTS for w in re.findall(r"[^\W\d_]+", t.lower())})
    slot = {w: int(fm_toxicity.term_slots(pa.array([w]))[1][0]) for w in terms if len(fm_toxicity.term_slots(pa.array([w]))[1]) == 1}
    known = sorted(set(list(slot.values())[::2]))
    model = fm_toxicity.FactorizationMachine(np.array(known), -0.3, rng.normal(size=len(known)), rng.normal(size=(len(known), 5)))
    want = []
    for t in TEXTS:
        at = [known.index(s) for s in {slot[w] for w in re.findall(r"[^\W\d_]+", t.lower())} if s in known]
        z = model.bias + sum(model.weights[i] for i in at) + sum(float(model.factors[i] @ model.factors[j]) for i, j in combinations(at, 2))
        want.append(1 / (1 + math.exp(-z)))
    assert model.score(pa.array(TEXTS)) == pytest.approx(want, abs=1e-9)


def test_four_corners_of_a_pair():
    """Neither term tells anything alone; both or none mean one label, one of them the other."""
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (1500, 2))
    rows = [np.sort(np.concatenate([np.flatnonzero(b) + 1, [3]])) for b in bits]
    # Rows with the same terms count once, so each gets some of its own.
    rows = [np.append(r, rng.integers(100, 400, 6)) for r in rows]
    rows = [np.unique(r) for r in rows]
    model = fm_toxicity.train(rows, bits[:, 0] ^ bits[:, 1])
    z = {}
    for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
        at = [i for i, s in enumerate(model.slots) if s == 3 or s == 1 and a or s == 2 and b]
        z[a, b] = model.bias + model.weights[at].sum() + sum(float(model.factors[i] @ model.factors[j]) for i, j in combinations(at, 2))
    assert min(z[0, 1], z[1, 0]) > max(z[0, 0], z[1, 1])


def plain_features(text):
    data = [int(langid._FOLD[b]) for b in text.encode()]
    total = np.zeros(langid.DIMS)
    for k in (1, 2, 3):
        for i in range(len(data) - k + 1):
            number = int.from_bytes(bytes(data[i : i + k]), "big") + ((k - 1) << 24)
            total[(number * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
    logs = np.log1p(total)
    return np.append(logs / np.linalg.norm(logs), 1.0)


def test_language_scores(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    languages, scores = langid.predict(model, pa.array(TEXTS))
    for text, got, score in zip(TEXTS, languages, scores):
        if not any(c.isalpha() for c in text):
            assert (got, score) == ("und", 0)
            continue
        x = plain_features(text)
        z = np.exp(x @ model.family_weights - (x @ model.family_weights).max())
        family = int(z.argmax())
        members = model.families[family]
        duels = {m: [] for m in members}
        for a, b in combinations(members, 2):
            sure = 1 / (1 + math.exp(-4 * float(x @ model.pair_weights[a, b])))
            duels[a].append(sure)
            duels[b].append(1 - sure)
        won = {m: (sum(p >= 0.5 for p in d), sum(d)) for m, d in duels.items()}
        assert got == max(members, key=lambda m: won[m])
        assert score == pytest.approx(z[family] / z.sum() * (won[got][1] / len(duels[got]) if duels[got] else 1), abs=1e-4)


# --- the pipeline ------------------------------------------------------------------


def folder(spark, tmp_path, sf_dir, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, sf_dir, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def plain_sets(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    sets = [(i, plain_sets(t)) for i, t in rows]
    at = {}
    for k, (_, s) in enumerate(sets):
        for gram in s:
            at.setdefault(gram, []).append(k)
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    met = {(a, b) for found in at.values() for a, b in combinations(found, 2)}
    for a, b in met:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= 80 * len(x | y):
            root[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i for k, (i, _) in enumerate(sets) if least[find(k)] == i}


def test_pipeline_against_plain_stages(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labels = table(spark, sf_dir, "labels")
    net = byte_cnn.fit(docs, labels.where(~held_out(F.col("doc_id"))), "quality")
    score = dict(zip([i for i, _ in rows], net.score(pa.array([t for _, t in rows]))))
    some = [i for i, t in rows if len(t or "") < 900][:40]
    text = dict(rows)
    assert [score[i] for i in some] == pytest.approx([plain_network(net, text[i] or "") for i in some], abs=1e-4)
    good = stages["quality"](spark, docs, sf_dir).cache()
    assert {r.doc_id for r in good.collect()} == {i for i, s in score.items() if s >= queries.GOOD_FROM}

    known = stages["language"](spark, good, sf_dir).cache()
    model = langid.fit(good, ~held_out(F.col("doc_id")))
    held = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in known.collect()} == {i for i, t in held if any(c.isalpha() for c in t or "") and model.knows(np.frombuffer(t.encode(), np.uint8))}

    single = stages["near_copies"](spark, known, sf_dir).cache()
    assert {r.doc_id for r in single.collect()} == plain_kept([(r.doc_id, r.text) for r in known.collect()])

    mixed = stages["mixing"](spark, single, sf_dir).cache()
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in single.collect()]))
    want = con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op3_mix_sources']})").fetchall()
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for (i,) in want)

    bpe = WordBpe(tokenizer_path())
    tokens = {i: len(ids) + 1 for i, ids in zip(text, bpe.by_row(pa.array(list(text.values()))))}
    pieces = stages["packing"](spark, mixed, sf_dir).collect()
    served = {}
    for p in pieces:
        served[p.doc_id] = served.get(p.doc_id, 0) + p.length
        assert p.doc_tokens == tokens[p.doc_id]
    times = {i: sum(r.doc_id == i for r in mixed.collect()) for i in served}
    assert served == {i: tokens[i] * n for i, n in times.items()}


def test_pipeline_with_odd_rows(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    kind = docs.schema
    odd = [(None, "A good text without an id. " * 9, "en", "src0", 9), (None, None, None, None, None), (10**6, None, "en", "src0", 0), (10**6 + 1, "", "en", "src0", 0)]
    odd += [(10**6 + 2, "one text of the same id, and a good one it is " * 4, "en", None, 1), (10**6 + 2, "one text of the same id, and a good one it is " * 4, "en", None, 1)]
    odd += [(10**6 + 3, "word and more words " * 40_000, "en", "src0", 1)]
    more = docs.union(spark.createDataFrame(odd, kind))
    for name in ("score", "sig", "n", "rank", "epoch", "block", "tokens", "part", "gram"):  # names the stages use themselves
        more = more.withColumn(name, F.lit(1))
    sf = folder(spark, tmp_path, sf_dir, more)
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        docs = out.cache()
    assert docs.where("doc_id = 1000002").select("doc_id").distinct().count() <= 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0


def test_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    sf = folder(spark, tmp_path, sf_dir, table(spark, sf_dir, "documents").limit(0).repartition(1))
    docs = spark.createDataFrame([], table(spark, sf_dir, "documents").schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).count() == 0
    assert sf and corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0
