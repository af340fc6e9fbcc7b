"""Mixture-controlled packing: deficit round-robin over source queues.

Tokens of a source form one queue. In every round each queue is credited its
target share of a window of tokens and serves whole quanta out of that credit;
what is left of the credit is the deficit it carries into the next round.
Because credit is exact arithmetic, the number of tokens that a queue has served
before round n is known without walking through the rounds before it, so every
task cuts its documents on its own and deficits hold across windows and
partitions alike. Where a queue's part of a round begins is a prefix sum over
(round, source) in Spark, so there may be any number of sources: no task knows
of others than those of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import frugal, ship, written
from .word_bpe import tokenizer_path, word_bpe

SEQUENCE = 4096
WINDOW = 8 * SEQUENCE
QUANTUM = 128
END_OF_DOCUMENT = 2
#: Rounds of one partition of the prefix sum.
ROUNDS = 4096
#: A source without a target has this share.
LEAST_SHARE = 1e-6


def id_rows(rows: list[np.ndarray], dtype: str) -> pa.Array:
    """One binary value for each array of ids."""
    ends = np.cumsum([0] + [len(r) for r in rows]) * np.dtype(dtype).itemsize
    data = np.concatenate(rows).astype(dtype) if rows else np.zeros(0, dtype)
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def token_store(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """The ids of every document, written once: (task, source, doc_id, before, n, ids).

    ``before`` counts the tokens of the same source that the same task wrote earlier.
    """

    ship(docs.sparkSession)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = word_bpe(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint16)
        passed: dict = {}
        for batch in batches:
            ids, before, at, size = [], [], 0, 0
            sources = batch.column("source").to_pylist()

            def out(upto: int) -> pa.RecordBatch:
                part = batch.slice(at, upto - at)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), task, np.int32)),
                        part.column("source"),
                        part.column("doc_id"),
                        pa.array(before, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        id_rows(ids, "<u2"),
                    ],
                    ["task", "source", "doc_id", "before", "n", "ids"],
                )

            for k, found in enumerate(bpe.by_row(batch.column("text"))):
                found = np.concatenate([found, end])
                ids.append(found)
                before.append(passed.get(sources[k], 0))
                passed[sources[k]] = before[-1] + len(found)
                size += len(found)
                if size > 1 << 20:
                    yield out(k + 1)
                    ids, before, at, size = [], [], k + 1, 0
            yield out(len(sources))

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    schema = f"task int, source string, doc_id {dict(rows.dtypes)['doc_id']}, before bigint, n bigint, ids binary"
    return written(rows.mapInArrow(frugal(tokenize), schema), "tokens")


@dataclass
class Rounds:
    """Where the n-th round of each queue lies; ``totals`` and ``weights`` by queue, ``weight`` that of all queues."""

    totals: list[int] | dict[str | None, int]
    weights: list[int] | dict[str | None, int]
    window: int = WINDOW
    quantum: int = QUANTUM
    weight: int = 0

    def __post_init__(self) -> None:
        self.weight = self.weight or sum(self.weights)

    def served(self, q, n: int) -> int:
        """Tokens of queue ``q`` served before round ``n``: its credit in whole quanta, or all once the credit covers it."""
        credit = n * self.window * self.weights[q]
        if credit >= self.totals[q] * self.weight:
            return self.totals[q]
        return credit // (self.weight * self.quantum) * self.quantum

    def round_of(self, q, place: int) -> int:
        n = place * self.weight // (self.window * self.weights[q])
        while self.served(q, n + 1) <= place:
            n += 1
        while self.served(q, n) > place:
            n -= 1
        return n

    def parts(self, q, place: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(round, tokens served before it, tokens served before the next one) of each round that serves some of these places."""
        while place < stop:
            n = self.round_of(q, place)
            upto = self.served(q, n + 1)
            yield n, self.served(q, n), upto
            place = upto


def sequence_at(place: int, total: int, length: int = SEQUENCE) -> tuple[int, int, int]:
    """(sequence, offset, its length) of a token: full sequences, and a last stretch cut into powers of two, none padded."""
    full = total // length
    if place < full * length:
        return place // length, place % length, length
    sequence, at, rest = full, place - full * length, total - full * length
    while True:
        size = 1 << (rest.bit_length() - 1)
        if at < size:
            return sequence, at, size
        sequence, at, rest = sequence + 1, at - size, rest - size


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = END_OF_DOCUMENT,
    targets: dict[str | None, float] | None = None,
    length: int = SEQUENCE,
    window: int = WINDOW,
    quantum: int = QUANTUM,
) -> DataFrame:
    """Pieces of documents in gapless sequences: (doc_id, source, start, length, doc_tokens, sequence_id, offset, ids).

    ``docs`` has doc_id, text and source; other columns are not read. Every row
    is packed whole, repeated rows each on their own; a null or empty text is
    its end id alone; null is a source like any other. ``targets`` are shares of
    tokens in each window; by default the shares of the input, so that all
    queues end together. A source without a target has a share of a millionth.
    When a queue runs out, the others go on in their proportions. ``ids`` are
    little-endian unsigned 32-bit numbers. An empty table gives no piece.
    """
    store = token_store(docs, tokenizer or tokenizer_path(), end_id)
    starts = _queue_starts(store, targets)
    total, weight = starts.agg(F.sum("n"), F.sum(F.when(F.col("first"), F.col("weight")))).first()
    begins = _begins(starts, window, quantum, weight or 1)

    def rounds_of(batch: pa.RecordBatch) -> Rounds:
        columns = (batch.column(c).to_pylist() for c in ("source", "total", "weight"))
        rows = list(zip(*columns))
        return Rounds({s: t for s, t, _ in rows}, {s: w for s, _, w in rows}, window, quantum, weight)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents into what each round serves of them."""
        names = ["doc_id", "source", "round", "inside", "start", "doc_tokens", "ids"]
        for batch in batches:
            rounds = rounds_of(batch)
            out: list[tuple] = []
            pieces: list[np.ndarray] = []
            size = 0

            def flush() -> pa.RecordBatch:
                row, n, inside, start, tokens = (pa.array(c, pa.int64()) for c in zip(*out))
                return pa.RecordBatch.from_arrays([batch.column("doc_id").take(row), batch.column("source").take(row), n, inside, start, tokens, id_rows(pieces, "<u2")], names)

            for k, (source, place, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "place", "ids")))):
                ids = np.frombuffer(raw, "<u2")
                for n, before, upto in rounds.parts(source, place, place + len(ids)):
                    at = max(before - place, 0)
                    pieces.append(ids[at : upto - place])
                    out.append((k, n, place + at - before, at, len(ids)))
                    size += len(pieces[-1])
                    if size > 1 << 20:
                        yield flush()
                        out, pieces, size = [], [], 0
            if out:
                yield flush()

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a round serves into sequences."""
        for batch in batches:
            out: list[tuple] = []
            pieces: list[np.ndarray] = []
            for k, (where, start, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("where", "start", "ids")))):
                ids, at = np.frombuffer(raw, "<u2"), 0
                while at < len(ids):
                    sequence, offset, long = sequence_at(where + at, total, length)
                    pieces.append(ids[at : at + long - offset])
                    out.append((k, start + at, len(pieces[-1]), sequence, offset))
                    at += len(pieces[-1])
            if out:
                row, start, n, sequence, offset = (pa.array(c, pa.int64()) for c in zip(*out))
                columns = [batch.column(c).take(row) for c in ("doc_id", "source", "doc_tokens")]
                yield pa.RecordBatch.from_arrays(
                    [columns[0], columns[1], start, n, columns[2], sequence, offset, id_rows(pieces, "<u4")],
                    ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    kind = dict(store.dtypes)["doc_id"]
    known = starts.select("base", "total", "weight", F.col("source").alias("of"), F.col("task").alias("by"))
    placed = store.join(known, (store["task"] == known["by"]) & store["source"].eqNullSafe(known["of"]))
    placed = placed.select("doc_id", "source", "total", "weight", (F.col("base") + F.col("before")).alias("place"), "ids")
    served = placed.mapInArrow(frugal(cut), f"doc_id {kind}, source string, round bigint, inside bigint, start bigint, doc_tokens bigint, ids binary")
    # Where rounds begin grows with the tokens: it is met by a shuffle at any size, never sent to all.
    begins = begins.hint("merge")
    met = served.join(begins, (served["round"] == begins["in_round"]) & served["source"].eqNullSafe(begins["of"]))
    return met.select("doc_id", "source", (F.col("begin") + F.col("inside")).alias("where"), "start", "doc_tokens", "ids").mapInArrow(
        frugal(lay),
        f"doc_id {kind}, source string, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary",
    )


def _queue_starts(store: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """(source, task, n, base, total, weight, first): where a task's tokens of a source begin in its queue. ``first`` holds once a source."""
    spark = store.sparkSession
    parts = store.groupBy("source", "task").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("source")
    before = of.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumns({"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": F.sum("n").over(of), "first": F.row_number().over(of.orderBy("task")) == 1})
    if targets is None:
        return written(starts.withColumn("weight", F.col("total")), "queue-starts")
    scale = 1 / LEAST_SHARE / max(sum(targets.values()), 1e-300)
    rows = [(s, max(1, round(t * scale))) for s, t in targets.items()]
    given = spark.createDataFrame(rows, "name string, given bigint")
    joined = starts.join(given, starts["source"].eqNullSafe(given["name"]), "left").drop("name")
    return written(joined.withColumn("weight", F.coalesce("given", F.lit(1).cast("bigint"))).drop("given"), "queue-starts")


def _begins(starts: DataFrame, window: int, quantum: int, weight: int) -> DataFrame:
    """(in_round, of, begin): where among all tokens the part of a source in a round begins.

    Rounds come one after another, and the sources of a round by name. The sum
    goes over blocks of rounds first, one number each, then inside each block.
    """

    def enumerate_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["of", "in_round", "part"]
        for batch in batches:
            rows = []
            for source, base, n, total, own in zip(*(batch.column(c).to_pylist() for c in ("source", "base", "n", "total", "weight"))):
                rounds = Rounds({source: total}, {source: own}, window, quantum, weight)
                for k, before, upto in rounds.parts(source, base, base + n):
                    rows.append((source, k, upto - before))
                    if len(rows) == 1 << 16:
                        yield _columns(rows, names)
                        rows = []
            yield _columns(rows, names)

    parts = starts.select("source", "base", "n", "total", "weight").mapInArrow(frugal(enumerate_), "of string, in_round bigint, part bigint")
    # Tasks that share a round of a source give the same number.
    parts = parts.groupBy("of", "in_round").agg(F.max("part").alias("part")).withColumn("block", F.floor(F.col("in_round") / ROUNDS))
    parts = written(parts, "round-parts")
    blocks = parts.groupBy("block").agg(F.sum("part").alias("size"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("in_round", "of").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("part").over(inside), F.lit(0)) + F.col("base")
    return written(parts.join(blocks, "block").select("in_round", "of", begin.alias("begin")), "round-begins")


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )
