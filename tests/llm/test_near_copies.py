"""Near copies of vectors and documents, and search, against brute force."""

from __future__ import annotations

import pickle
import re
import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tristrata.llm import jaccard_join, pq_neardup, rp_forest
from tristrata.llm.components import components

VECTORS = "vec_id bigint, embedding array<double>, label int, component_id string"


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def vectors(n=260, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[60:140] = x[60] + rng.normal(size=(80, dims)) * 0.25  # a group whose members are not all similar
    x[140:160] = x[140]
    return x, rng.integers(0, 3, n)


def cosine(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return u @ u.T


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 3), (7, None), (8, 9), (20, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 8: 8, 9: 8} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_round_of_few_edges_takes_few_tasks(spark):
    """Many shuffle partitions that are not merged: nearly all tasks of a round are empty, and each leaves files."""
    few = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in few}
    context, group = spark.sparkContext, "few edges"
    for k, v in few.items():
        spark.conf.set(k, v)
    context.setJobGroup(group, group)
    try:
        got = {r.node: r.root for r in components(spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(13), 0)
    told = context.statusTracker()
    stages = {s for job in told.getJobIdsForGroup(group) for s in told.getJobInfo(job).stageIds}
    tasks = sum(info.numCompletedTasks for s in stages if (info := told.getStageInfo(s)))
    assert 0 < tasks < 1600


def test_counters_are_sent_compressed(spark, monkeypatch):
    """Driver and executors keep a broadcast on disk."""
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: (sent.append(len(pickle.dumps(value))), broadcast(self, value))[1])
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "some other words that stand alone here")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(docs).members.collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert sent and max(sent) < 1 << 20
    counts = np.zeros(jaccard_join.COUNTERS, np.uint16)
    step = jaccard_join.COUNTERS // jaccard_join.COUNTER_ROWS
    counts[[0, step, 2 * step - 1, jaccard_join.COUNTERS - 1]] = [1, 2, 65535, 4]
    parts = [(i, zlib.compress(counts[i * step : (i + 1) * step], 1)) for i in (0, 1, jaccard_join.COUNTER_ROWS - 1)]
    assert (jaccard_join.Counters(parts).table == counts).all()


def test_vectors_against_brute_force(spark):
    x, label = vectors()
    rows = [(i, x[i].tolist(), int(label[i]), "x") for i in range(len(x))]
    odd = [(900, None, 1, "x"), (901, [0.0] * 16, 1, "x"), (902, [float("nan")] * 16, 1, "x"), (903, [None] * 16, 1, "x"),
           (904, x[0].tolist(), None, "x"), (905, [], 1, "x"), (906, [1.0, 2.0], 1, "x"), (907, [2.0, 4.0], 1, "x")]
    got = {r.vec_id: r for r in pq_neardup.near_copies(spark.createDataFrame(rows + odd, VECTORS), 0.93, block=16).collect()}
    c = cosine(x)
    links = [(i, j) for i, j in combinations(range(len(x)), 2) if label[i] == label[j] and c[i, j] >= 0.93]
    assert len(links) > 300
    root = groups_of(range(len(x)), links)
    count = np.bincount(np.array(links).reshape(-1), minlength=len(x))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (count[i], root[i], root[i] == i) for i in range(len(x)))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (900, 901, 902, 903, 904, 905))
    assert (got[906].n_links, got[907].component_id) == (1, 906)


def test_no_vectors(spark):
    assert pq_neardup.near_copies(spark.createDataFrame([], VECTORS)).count() == 0
    assert rp_forest.nearest(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_adc_bound():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 20))
    book = pq_neardup.train(x, 6)
    residual = x - book.centres[0]
    code, error = book.encode(residual)
    exact = np.linalg.norm(residual[:, None] - residual[None], axis=2)
    assert (np.abs(book.distances(residual, code) - exact) <= error[None] + 1e-9).all()


def test_search(spark, monkeypatch):
    x, _ = vectors(700, 16, 4)
    rows = [(i, x[i].tolist(), 0, "x") for i in range(len(x))] + [(1000, None, 0, "x"), (1050, [0.0] * 16, 0, "x")]
    df = spark.createDataFrame(rows, VECTORS)
    c = cosine(x)
    np.fill_diagonal(c, -9)
    want = {i: np.lexsort((np.arange(len(x)), -np.round(c[i], 12)))[:5].tolist() for i in range(0, len(x), 50)}
    for share, least in ((1.0, 1.0), (rp_forest.SHARE, 0.9)):
        got = {}
        for r in rp_forest.nearest(df, F.col("vec_id") % 50 == 0, 5, share=share).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
            assert abs(r.score - c[r.query_id, r.vec_id]) < 1e-12
        assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
        found = sum(len(set(got[q]) & set(want[q])) for q in want) / (5 * len(want))
        assert found >= least
    monkeypatch.setattr(rp_forest, "QUERIES", 4)  # several blocks of queries
    again = rp_forest.nearest(df.unionByName(df), F.col("vec_id") % 50 == 0, 5, share=1.0).collect()
    assert {(r.query_id, r.rank): r.vec_id for r in again} == {(q, k + 1): v for q, found in want.items() for k, v in enumerate(found)}
    few = rp_forest.nearest(df.where("vec_id IN (150, 151, 152)"), F.col("vec_id") == 150, 5).collect()
    assert [(r.rank, r.vec_id) for r in sorted(few)] == [(1, 151), (2, 152)]


def test_search_among_copies(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 16))
    x[300:600] = x[300]  # a third of all rows
    x[700] = 3 * x[300]  # not equal, but as near
    df = spark.createDataFrame([(i, v.tolist(), 0, "x") for i, v in enumerate(x)], VECTORS)
    got = {}
    for r in rp_forest.nearest(df, F.col("vec_id").isin(300, 301, 599, 700, 5), 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[300] == [301, 302, 303, 304, 305] and got[301] == [300, 302, 303, 304, 305]
    assert got[599] == got[700] == [300, 301, 302, 303, 304] and len(got[5]) == 5


def word_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def documents():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    out = []
    for family in range(12):
        base = rng.choice(words, rng.integers(3, 120)).tolist()
        for copy in range(12):
            text = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 12)):
                text[rng.integers(len(text))] = str(rng.choice(words))
            out.append(" ".join(text) + (" the same closing line of many words" if copy % 3 == 0 else ""))
    return out + [out[0].upper(), out[0].replace(" ", "\n"), "", None, " \t", "one two", "one  TWO", "é É"]


def test_documents_against_brute_force(spark):
    texts = documents()
    rows = [(i + 10, t, "x") for i, t in enumerate(texts)] + [(10, texts[0], "x")]
    joined = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string, sig string"))
    got = {r.doc_id: r for r in joined.members.collect()}
    sets = {i + 10: word_set(t) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert 50 < len(links)
    root = groups_of(sets, links)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(s), root[i]) for i, s in sets.items()}
    kept = jaccard_join.kept_documents(spark.createDataFrame(rows, "doc_id long, text string, sig string"))
    assert kept.columns == ["doc_id", "text", "sig"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_every_link_against_brute_force(spark):
    alike = [" ".join(f"v{i}" for i in range(60)) + f" end{k}" for k in range(16)]
    texts = documents()[:60] + alike + ["", None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (1, texts[50]), (1, texts[3]), (2, alike[4]), (3, alike[5]), (3, alike[6]), (None, texts[2]), (None, texts[2])]
    docs = [(k if d is None else f"d{d}", word_set(t)) for k, (d, t) in enumerate(rows)]
    links, similar = {}, set()
    for (a, x), (b, y) in combinations(docs, 2):
        if x and 100 * len(x & y) >= 80 * len(x | y):
            similar |= {frozenset((x, y))} if x != y else set()
            if a != b:
                links.setdefault(a, set()).add(b)
                links.setdefault(b, set()).add(a)
    joined = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), block=4)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_links) for r in joined.members.collect())
    assert got == sorted((int(k[1:]) if isinstance(k, str) else -1, len(links.get(k, ()))) for k, _ in docs)
    pairs = joined.links.collect()
    assert len(pairs) == len({frozenset((r.a, r.b)) for r in pairs}) == len(similar) > 100
    few = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), groups_only=True)
    assert few.links.count() < len(pairs) and "n_links" not in few.members.columns
    assert {(r.doc_id, r.component_id) for r in few.members.collect()} == {(r.doc_id, r.component_id) for r in joined.members.collect()}


def test_no_documents(spark):
    assert jaccard_join.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).members.count() == 0


def test_suffix_filter_never_loses():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 200, 80).astype(np.uint64)) for _ in range(2))
        apart = len(np.setxor1d(x, y))
        assert not jaccard_join.suffix_apart(x, y, apart)
