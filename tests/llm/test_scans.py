"""Notices, resampling and periodic runs against plain recomputation."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tristrata.llm import importance, license_scan, runs
from tristrata.llm.queries import QUERIES
from tristrata.llm.tables import table

SCHEMA = "doc_id long, text string, rank int, label string"
ODD = [None, "", " \n", "ONE", "é É ß 日本", "a\0b a\0b", "x" * 3000, "x" * 500 + " " + "y" * 70 + " k", "same " * 2500, "w " * 400_000]


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def odd_rows():
    rows = list(enumerate(ODD)) + [(3, "ONE"), (3, "other"), (None, "null id " * 30), (None, None)]
    return rows + [(i, "the same text again and again " * 5) for i in range(20, 30)]


# --- notices ------------------------------------------------------------------


def plain_labels(text):
    raw = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    words = re.findall(license_scan.WORD, raw)
    starts = [(i, n.label) for n in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(n.words)] == n.words]
    places = [i for i, _ in starts]
    return len(words), len(starts), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in starts}))


def test_notices_against_plain_search(spark):
    rng = random.Random(2)
    bits = ["CC", "by", "cc-by", "CC BY-NC 4", "all rights", "reserved", "General PUBLIC", "license", "Licensed under the Apache License, Version 2", "and", "é", "\n"]
    rows = odd_rows() + [(100 + i, " ".join(rng.choices(bits, k=rng.randint(1, 30)))) for i in range(300)]
    got = license_scan.license_labels(table_of(spark, rows)).collect()
    plain = [(i, *plain_labels(t)) for i, t in rows]
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted(plain, key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in got)


def test_notices_with_changed_words(spark):
    notice = license_scan.NOTICES[-1].words
    far = notice[:8] + ["x"] * 40 + notice[8:]
    rows = [
        (1, " ".join(notice)), (2, " ".join(["before", *notice[:7], "put", "in", *notice[7:]])), (3, " ".join(notice[:9] + notice[11:])),
        (4, " ".join(far)), (5, " ".join(notice[:5])), (6, " ".join(notice * 3)), (7, "licensed under the old apache license version 2"),
    ]
    got = {r.doc_id: r for r in license_scan.license_labels(table_of(spark, rows)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4, 5, 6)] == ["mpl-2", "mpl-2", "mpl-2", "", "", "mpl-2"]
    assert got[1].score == 1 and 0.6 <= got[2].score < 1 and got[4].score < 0.6
    spans = license_scan.scan(table_of(spark, rows)).where("counts AND label = 'mpl-2' AND doc_id = 6").collect()
    assert sorted((r.first_word, r.last_word) for r in spans) == [(k * len(notice), (k + 1) * len(notice) - 1) for k in range(3)]


def test_notices_plan_is_native_and_empty_tables(spark):
    df = table_of(spark, [])
    labels = license_scan.license_labels(df)
    assert labels.count() == 0
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD", "Cartesian", "NestedLoop")) or "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


# --- resampling -----------------------------------------------------------------


def plain_features(text):
    raw = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    words = re.findall(license_scan.WORD, raw)
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % importance.BUCKETS for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_resample(rows, target, percent=5, least=20):
    s, t = np.zeros(importance.BUCKETS, int), np.zeros(importance.BUCKETS, int)
    for _, text in rows:
        np.add.at(s, plain_features(text)[1], 1)
    for text in target:
        np.add.at(t, plain_features(text)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000.0) / ((a + 1) * (t.sum() + 10000.0)))) for a, b in zip(s, t)]
    out = []
    for i, text in rows:
        words, found = plain_features(text)
        weight = sum(gain[b] for b in found)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words), len(found), weight, score, None])
    can = sorted((r for r in out if r[1] >= least and r[0] is not None), key=lambda r: (-r[4], r[0], r[3], r[2], r[1]))
    for k, r in enumerate(can[: percent * sum(r[1] >= least for r in out) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_resampling_against_plain_sums(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "日本", "Mixed-Case"]
    rows = odd_rows() + [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(150, " ".join(vocabulary)), (151, "w1 " * 25)] * 3
    target = ["w1 w2 w3 w1", None, "", "w5 É w6 " * 50]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(table_of(spark, rows), goal, percent=20).collect()
    plain = plain_resample(rows, target, percent=20)
    assert sorted(map(tuple, got), key=str) == plain
    ranks = sorted(r.rank for r in got if r.rank)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_resampling_of_empty_tables(spark):
    docs, none = table_of(spark, [(1, "a b " * 20)]), spark.createDataFrame([], "text string")
    assert importance.resample(table_of(spark, []), docs).count() == 0
    assert [tuple(r) for r in importance.resample(docs, none).collect()] == plain_resample([(1, "a b " * 20)], [])


def test_weights_over_bit_planes():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 70, (30, importance.BUCKETS)) * (rng.random((30, importance.BUCKETS)) < 0.1)
    counts[3] = 0
    counts[4, 17] = 1 << 40
    gain = rng.integers(-9000, 9000, importance.BUCKETS)
    both = importance.planes(np.maximum(gain, 0)[None]), importance.planes(np.maximum(-gain, 0)[None])
    assert (importance.weights(counts, both) == counts @ gain).all()


# --- periodic runs ----------------------------------------------------------------


def plain_runs(words):
    out, n = {}, len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(6, 4 * p) and not any(s <= start and start + i - start + p <= s + size for s, size, q in out.values() if p % q == 0):
                out[start, p] = (start, i - start + p, p)
            i += 1
    return sorted(out.values(), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, tails=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if tails and doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, n, len(found), start, length, period, 1000 * length // period if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def repeating(rng, size):
    words = [f"w{rng.randrange(rng.choice([2, 4, 50]))}" for _ in range(rng.randint(0, size))]
    for _ in range(rng.randint(0, 3)):
        if words:
            a, p = rng.randrange(len(words)), rng.randint(1, 12)
            words = words[:a] + (words[a : a + p] * rng.randint(1, 7)) + words[a:]
    return words


def test_runs_of_the_automaton():
    rng = random.Random(5)
    for _ in range(400):
        words = repeating(rng, 60)
        ids = [zlib.crc32(w.encode()) for w in words]
        assert sorted(runs.stretch_runs(ids), key=lambda r: (r[0], r[2])) == plain_runs(words)


def test_runs_of_rows_against_plain_search(spark):
    rng = random.Random(6)
    rows = [r for r in odd_rows() if len(r[1] or "") < 20_000] + [(100 + i, rng.choice([" ", "\n", "  \t"]).join(repeating(rng, 90))) for i in range(400)]
    for tails in (True, False):
        got = runs.periodic_runs(table_of(spark, rows).repartition(3), tails=tails).collect()
        assert sorted(map(tuple, got), key=str) == sorted((plain_row(*r, tails=tails) for r in rows), key=str)
    assert runs.periodic_runs(table_of(spark, [])).count() == 0


def test_runs_of_long_texts(spark):
    words = [f"w{i}" for i in range(30_000)]
    text = " ".join(words + words[:999] * 5 + ["end"] * 7)
    (row,) = runs.periodic_runs(table_of(spark, [(1, text)])).collect()
    assert (row.n_runs, row.start, row.length, row.period) == (2, 30_000, 4995, 999)
    assert row.collapsed_sha256 == hashlib.sha256(" ".join(words + words[:999] + ["end"]).encode()).hexdigest()


def test_runs_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(runs, "word_slices", weak_slices(runs.word_slices))
    column, ids = pa.array(["a b c d e f g h a b c d", "x y " * 8]), pa.array([1, 2])
    assert runs._rows(list(runs._texts(ids, column, False))) == [plain_row(i, t, False) for i, t in zip((1, 2), column.to_pylist())]


def weak_slices(real):
    def slices(*args):
        for words in real(*args):
            words.hash = words.hash & np.uint64(1)
            yield words

    return slices


@pytest.mark.parametrize("tails", [True])
def test_runs_query(spark, sf_dir, tails):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    short = {i: t for i, t in docs if len(t or "") < 6000}
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert got.columns == names
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert set(rows) == {i for i, _ in docs}
    for i, t in short.items():
        plain = plain_row(i, t)
        assert rows[i] == plain[:1] + plain[2:]
