"""Formatting, mixing, counting and packing: round trips and plain recomputation."""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tristrata.llm import chat, mixing, packing, separators, text, word_bpe
from tristrata.llm.text import word_slices
from tristrata.llm.word_bpe import WordBpe, tokenizer_path

ODD = ["", None, "  \n", "İstanbul ΑΣ ﬁ é", "a<|endoftext|> b", "x" * 300, "a\x1cb \x85 c", "I'LL naïve 12½ ×÷ ́a", "日本語 текст", "word " * 5000, "no gap" + "z" * 70000]


def plain_ids(text, special=True):
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = not special
    return t.encode(text or "", add_special_tokens=False).ids


def test_word_tokenizer_is_exact():
    for special in (True, False):
        got = list(WordBpe(tokenizer_path(), special).by_row(pa.array(ODD)))
        assert [g.tolist() for g in got] == [plain_ids(t, special) for t in ODD]


def odd_words():
    a, b = "a", "b"
    for _ in range(11):  # Thue-Morse words, which sums of powers modulo 2^64 don't tell apart
        a, b = a + b, b + a
    return ["cat\0", "dat", "cat", "\0cat", "\0", "\0\0", "a\0\0", "a\0", a[:1024], b[:1024], a, b]


def test_word_tokenizer_tells_odd_and_random_words_apart():
    rng = np.random.default_rng(3)
    letters = np.array(list("ab\0\x01d'1é%"))
    words = odd_words() + ["".join(letters[rng.integers(0, len(letters), n)]) for n in rng.integers(1, 12, 100_000)]
    texts = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
    t = Tokenizer.from_file(tokenizer_path())
    plain = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in WordBpe(tokenizer_path()).by_row(pa.array(texts))] == plain
    seen = {}
    for w in word_slices(pa.array(words)):
        for s, e, h, c in zip(w.start.tolist(), w.end.tolist(), w.hash.tolist(), w.check.tolist()):
            raw = bytes(w.data[s:e])
            assert seen.setdefault(h, raw) == raw and seen.setdefault((c,), raw) == raw


def test_word_tokenizer_forgets_words_that_came_once(monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHE_WORDS", 40)
    monkeypatch.setattr(word_bpe, "RECENT_WORDS", 10)
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghij"))
    texts = [" ".join(["the", "same", "words"] + ["".join(rng.choice(letters, 6)) for _ in range(15)]) for _ in range(60)]
    bpe = WordBpe(tokenizer_path())
    for k in range(0, 60, 2):  # a slice each
        assert [g.tolist() for g in bpe.by_row(pa.array(texts[k : k + 2]))] == [plain_ids(t) for t in texts[k : k + 2]]
        assert len(bpe.old.keys) < 100


def test_word_tokenizer_survives_equal_hashes(monkeypatch):
    real = text.word_hashes

    def weak(data, start, end):
        return (end - start).astype(np.uint64), real(data, start, end)[1]

    monkeypatch.setattr(text, "word_hashes", weak)
    texts = ["cat dog cat", "dog", "horse", "mouse cat", "", "horse\0"]
    assert [g.tolist() for g in WordBpe(tokenizer_path()).by_row(pa.array(texts))] == [plain_ids(t) for t in texts]


def test_word_tokenizer_refuses_other_files(tmp_path):
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        other = json.load(f)
    (tmp_path / "other.json").write_text(json.dumps(other))
    with pytest.raises(ValueError, match="not a word tokenizer"):
        WordBpe(str(tmp_path / "other.json"))


def test_chat_layouts(spark):
    trap = "\\### Assistant: </turn> ok \\n #"
    records = [
        {"turn": 0, "role": "a\nb#", "text": trap, "meta": {"x": 1}},
        {"prompt": "p", "response": "r", "system": "s"},
        {"instruction": "i", "input": "", "output": None},
        {"messages": [{"role": "human", "content": trap}, {"role": "gpt", "content": "fine"}]},
        {"conversations": [{"from": "prompter", "value": "q"}, {"from": "bot", "value": ""}]},
        {"unknown": 1}, {"messages": []}, [1],
    ]
    rows = [(i, json.dumps(r), "x") for i, r in enumerate(records)] + [(8, None, "x"), (9, "{", "x")]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string, layout string"))
    got = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got[0] == [("turn rows", "a\nb#", trap)]
    assert got[1] == [("prompt", "system", "s"), ("prompt", "user", "p"), ("prompt", "assistant", "r")]
    assert got[2] == [("instruction", "user", "i"), ("instruction", "assistant", "")]
    assert got[3] == [("messages", "user", trap), ("messages", "assistant", "fine")]
    assert got[4] == [("conversations", "user", "q"), ("conversations", "assistant", "")]
    assert all(got[i] == [(None, None, None)] for i in (5, 6, 7, 8, 9))
    formatted = chat.format_chat(turns)
    for r in formatted.where("formatted IS NOT NULL").collect():
        assert chat.read_turn(r.formatted) == (r.role, r.text)
        assert "</turn>" not in r.formatted[:-8] and "###" not in r.formatted[3:]
        assert chat.unescape(r.formatted[r.loss_start : r.loss_end]) == (r.text if r.role == "assistant" else "")
    digests = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert set(digests) == {0, 1, 2, 3, 4} and digests[3].loss_chars == 4 and digests[1].n_turns == 3


def test_chat_layouts_with_fields_of_others(spark):
    turns = [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]
    said = [{"from": "human", "value": "u"}, {"from": "gpt", "value": "a"}]
    records = [
        {"instruction": "u", "input": "more", "output": "a", "text": "### u more a"},
        {"messages": turns, "system": "s"},
        {"conversations": said, "system": "s"},
        {"prompt": "u", "response": "a", "input": "more"},
        {"prompt": "u", "completion": "a", "system": "s", "text": "x"},
        {"prompt": "u", "note": "of no layout"},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(6, "{"), (7, None)]
    chats = chat.format_chat(chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string")))
    got = {}
    for r in chats.orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.record == (rows[r.conv_id][1] if r.conv_id >= 5 else None)
    system, user, answer = ("system", "s"), ("user", "u"), ("assistant", "a")
    assert [got[i] for i in range(5)] == [[("user", "u\nmore"), answer], [system, user, answer], [system, user, answer], [("user", "u\nmore"), answer], [system, user, answer]]
    assert {r.conv_id: r.n_turns for r in chat.read_back(chats).collect()} == {0: 2, 1: 3, 2: 3, 3: 2, 4: 3}


def test_chat_records_that_no_layout_can_read(spark):
    good = {"messages": [{"role": "user", "content": "u"}]}
    odd = [
        json.dumps({"messages": [{"role": "user", "content": "u"}, "stray"]}), json.dumps({"messages": [{"role": "user", "content": "u"}, None]}),
        '{"prompt": "\\ud800", "response": "r"}', '{"turn": 99999999999999999999, "role": "user", "text": "t"}',
        '{"prompt": ' + "[" * 5000 + "]" * 5000 + ', "response": "r"}', '{"prompt": "p", "response": ' + '{"a": ' * 700 + "1" + "}" * 701, "[1]", "nul",
    ]
    rows = [(i, r) for i, r in enumerate(odd)] + [(100, json.dumps(good)), (101, '{"turn": true, "role": "user", "text": "t"}'), (None, None)]
    chats = chat.format_chat(chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, record string")))
    got = {r.conv_id: r for r in chats.collect()}
    assert all(got[i].formatted is None and got[i].record == r for i, r in enumerate(odd) if i != 5)
    assert (got[100].role, got[100].text, got[101].turn, got[101].text) == ("user", "u", None, "t")
    assert {r.conv_id for r in chat.read_back(chats).collect()} - {5} == {100, 101}
    empty = chat.canonical_turns(spark.createDataFrame([], "conv_id long, record string"))
    assert empty.count() == 0 and chat.read_back(chat.format_chat(empty)).count() == 0


def test_fingerprints_ignore_values_and_other_fields():
    layouts = chat.Layouts()
    a = layouts.of({"prompt": "x", "response": None, "score": 3})
    assert a == layouts.of({"response": "y", "prompt": ""}) and a[1].name == "prompt"
    assert layouts.of({"prompt": "x"})[1] is None


def mix_rows(hot=400, cold=40):
    rows = [(i, "hot", "w " * (1 + i % 7)) for i in range(hot)]
    rows += [(1000 * k + i, f"s{k}", "w " * 4) for k in range(1, 6) for i in range(cold)]
    return rows + [(9001, None, "a b"), (9002, "empty", None), (9003, "empty", "")]


def test_mixing(spark):
    df = spark.createDataFrame(mix_rows(), "doc_id long, source string, text string").withColumn("epoch", F.lit("x"))
    mix = mixing.mix_sources(df.drop("epoch"), entropy=0.99, repeats=3.0)
    assert 0 < mix.exponent < 1
    plan = {r.source: r for r in mix.sources.collect()}
    rows = mix.rows.collect()
    assert {r.doc_id for r in rows} == {r[0] for r in mix_rows()}
    assert math.isclose(sum(p.weight for p in plan.values()), 1)
    for source, p in plan.items():
        mine = [r for r in rows if r.source == source]
        largest = max([sum(r.tokens for r in mine if r.block == b and r.epoch == 0) for b in {r.block for r in mine}])
        used = sum(r.tokens for r in mine)
        assert p.budget <= used < p.budget + max(largest, 1) or p.tokens == 0
        assert used <= 3.0 * p.tokens + largest
        for epoch in {r.epoch for r in mine}:
            some = [(r.block, r.place) for r in mine if r.epoch == epoch]
            assert len({b for b, _ in some}) == len({x for _, x in some}) == len(set(some))
    assert [r.epoch for r in rows if r.doc_id == 9002] == [0]


def test_mixing_plan_is_native(spark):
    df = spark.createDataFrame(mix_rows(), "doc_id long, source string, text string")
    plan = mixing.mix_sources(df).rows._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_exponent_limits(spark):
    sizes = lambda *n: spark.createDataFrame([(str(i), x) for i, x in enumerate(n)], "source string, tokens long")
    assert mixing.find_exponent(sizes(), 0.9, 2) == 1 and mixing.find_exponent(sizes(5), 0.9, 2) == 1
    assert mixing.find_exponent(sizes(5, 5, 0), 1.0, 2) == 1
    assert abs(mixing.find_exponent(sizes(1000, 10), 1.0, 10) - 0.5) < 1e-9
    assert mix_entropy([1000, 10, 10], mixing.find_exponent(sizes(1000, 10, 10), 0.9, 1e9)) == pytest.approx(0.9 * math.log(3), abs=1e-6)
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, source string, text string")).rows.count() == 0


def mix_entropy(tokens, e):
    w = np.array(tokens, float) ** e
    w /= w.sum()
    return -(w * np.log(w)).sum()


def text_rows():
    return [(i, t, f"s{i % 3}" if i % 5 else None) for i, t in enumerate(ODD * 3)] + [(None, "no id", "s1"), (1, "twice", "s1"), (1, "twice", "s1")]


@pytest.mark.parametrize("targets", [None, {"s0": 1, "s1": 3}])
def test_packing(spark, targets):
    df = spark.createDataFrame(text_rows(), "doc_id long, text string, source string").withColumn("n", F.lit(1)).repartition(3)
    pieces = packing.pack(df, targets=targets).collect()
    want = {}
    for d, t, _ in text_rows():
        want.setdefault((d, len(plain_ids(t)) + 1), []).append(np.array(plain_ids(t) + [2], "<u4"))
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert len(p.ids) == 4 * p.length
        assert any(ids[p.start : p.start + p.length].tobytes() == bytes(p.ids) for ids in want[p.doc_id, p.doc_tokens])
    assert sum(p.length for p in pieces) == sum(len(ids) for found in want.values() for ids in found)
    lengths = []
    for k in range(len(by_sequence)):
        some = sorted(by_sequence[k], key=lambda p: p.offset)
        assert [p.offset for p in some] == [0, *np.cumsum([p.length for p in some])[:-1]]
        lengths.append(sum(p.length for p in some))
    assert all(n == 4096 or n & (n - 1) == 0 for n in lengths) and max(lengths) <= 4096


def test_rounds_keep_proportions_and_lose_nothing():
    for totals, weights in (([900_000, 70_001, 3], [900_000, 70_001, 3]), ([5000, 800_000, 40_000], [1, 1, 2])):
        rounds = packing.Rounds(totals, weights)
        n, last = 0, [0] * 3
        while last != totals:
            n += 1
            now = [rounds.served(q, n) for q in range(3)]
            assert all(a <= b <= t for a, b, t in zip(last, now, totals))
            for q in range(3):  # the deficit never exceeds a quantum
                credit = n * packing.WINDOW * weights[q] / sum(weights)
                assert now[q] == totals[q] or 0 <= credit - now[q] < packing.QUANTUM
            last = now
        assert packing.sequence_at(4096 + 5, 4096 + 6) == (2, 1, 2)


@pytest.mark.parametrize("targets", [None, {f"s{i}": 1.0 for i in range(0, 5000, 2)} | {"s1": 600.0}])
def test_packing_of_many_sources(spark, targets, monkeypatch):
    """Every source spreads over the whole stream at its share, however many there are."""
    monkeypatch.setattr(packing, "ROUNDS", 5)
    rows = [(i * 10 + k, "one two three four five six seven " * 4, f"s{i}") for i in range(5000) for k in range(2)]
    rows += [(10**6 + k, "word " * 400, "hot") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    window, quantum = 1 << 16, 8
    pieces = packing.pack(df, targets=targets, window=window, quantum=quantum).select("source", "length", "sequence_id", "offset", "doc_id", "start", "doc_tokens").collect()
    place = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        place.setdefault(p.sequence_id, []).append((p.offset, p.length, p.source))
    stream = [(n, source) for k in sorted(place) for _, n, source in place[k]]
    total = sum(n for n, _ in stream)
    assert total == sum(2 * 29 for _ in range(5000)) + 500 * 401
    assert all(offset == sum(n for _, n, _ in place[k][:j]) for k in list(place)[:20] for j, (offset, _, _) in enumerate(place[k]))
    totals = {}
    for n, source in stream:
        totals[source] = totals.get(source, 0) + n
    names = sorted(totals)
    weights = totals if targets is None else {s: max(1, round(targets.get(s, 0) * 1e6 / sum(targets.values()))) for s in names}
    rounds = packing.Rounds(totals, weights, window, quantum, sum(weights.values()))
    had, ends = dict.fromkeys(names, 0), {}
    for r in range(1, 5):
        ends[r] = sum(rounds.served(s, r) for s in names)
    seen, r = 0, 1
    for n, source in stream:
        had[source] += n
        seen += n
        if r in ends and seen == ends[r]:
            for s in names:  # at the end of a window no source is off by a quantum or more
                credit = r * window * weights[s] / rounds.weight
                assert had[s] == totals[s] or 0 <= credit - had[s] < quantum
            r += 1
    assert r >= 4


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


@pytest.mark.parametrize("block", [7, 1000, 1 << 16])
def test_counts(spark, block):
    df = spark.createDataFrame(text_rows(), "doc_id long, text string, file string").repartition(4)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in separators.document_counts(df, block=block).collect())
    assert got == sorted((d if d is not None else -1, len(plain_ids(t, special=False))) for d, t, _ in text_rows())


def test_scan_of_any_blocks(spark, monkeypatch):
    monkeypatch.setattr(separators, "RUN_BLOCKS", 3)
    rng = np.random.default_rng(0)
    ids = np.where(rng.random(2000) < 0.03, 9, 1).astype("<u2")
    cuts = [0, *sorted(rng.choice(2000, 40).tolist()), 2000]
    rows = [("f", i, ids[a:b].tobytes(), "x") for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))] + [("g", 0, None, "x"), ("h", 0, b"\x09\x00\x09\x00", "x"), (None, 0, b"\x01\x00", "x")]
    got = separators.scan(spark.createDataFrame(rows, "file string, block long, ids binary, n_tokens string"), 9).orderBy("file", "ordinal").collect()
    ends = np.flatnonzero(ids == 9)
    starts = np.append(0, ends + 1)
    want = [("f", i, s, e - s, True) for i, (s, e) in enumerate(zip(starts, ends))]
    if starts[-1] < 2000:
        want.append(("f", len(ends), starts[-1], 2000 - starts[-1], False))
    assert [tuple(r) for r in got if r.file == "f"] == want
    assert [tuple(r) for r in got if r.file != "f"] == [(None, 0, 0, 1, False), ("h", 0, 0, 0, True), ("h", 1, 1, 0, True)]
    assert zlib.crc32(b"") == 0
