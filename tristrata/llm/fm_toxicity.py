"""Toxicity by a factorization machine over hashed terms.

Besides a weight, each term has a short vector; the product of two vectors is
the weight of that pair of terms. So an insult next to the mention of a group
can count for more than both alone, which additive weights can't express. Every
term of the sample is learned, also one that tells nothing by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_sample, frugal, ship
from .text import NOT_LETTER, word_slices

#: Slots that terms are hashed to.
SLOT_BITS = 24
#: Labelled rows to learn from, at most; half of each label where there are enough.
SAMPLE_ROWS = 8000
FACTORS = 8
#: What the mean gradient of a weight must exceed to move it from zero, so that single documents set none.
LEAST_GRADIENT = 3e-4
#: Decay of vectors: pairs of terms that tell less than this together fade.
FADE = 0.02


def term_slots(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every distinct term of every row; terms are runs of letters, in lower case."""
    rows, slots = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for words in word_slices(pc.utf8_lower(column.cast(pa.large_string())), NOT_LETTER):
        pair = np.unique(words.row.astype(np.int64) << SLOT_BITS | (words.hash >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
        rows.append(pair >> SLOT_BITS)
        slots.append(pair & ((1 << SLOT_BITS) - 1))
    return np.concatenate(rows), np.concatenate(slots)


@dataclass
class FactorizationMachine:
    slots: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        row, slot = term_slots(column)
        at = np.minimum(np.searchsorted(self.slots, slot), max(len(self.slots) - 1, 0))
        known = self.slots[at] == slot if len(self.slots) else np.zeros(len(slot), bool)
        pair = np.unique(row[known] * max(len(self.slots), 1) + at[known])  # a long text comes in several slices
        row, at = pair // max(len(self.slots), 1), pair % max(len(self.slots), 1)
        z = self.bias + np.bincount(row, weights=self.weights[at], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            z += 0.5 * (np.bincount(row, weights=v, minlength=n) ** 2 - np.bincount(row, weights=v * v, minlength=n))
        return 1 / (1 + np.exp(np.clip(-z, -500, 500)))


def train(rows: list[np.ndarray], y: np.ndarray, factors: int = FACTORS, epochs: int = 40, seed: int = 5) -> FactorizationMachine:
    """Fit all slots of ``rows`` by logistic loss. Rows with the same terms and label count once, so that copies don't set weights.

    Rows are sparse. Weights follow Adam with a soft threshold; all vectors
    share one step size and fade, so only what many rows agree on makes them grow.
    """
    seen: dict[tuple[bytes, int], int] = {}
    for i, r in enumerate(rows):
        seen.setdefault((r.tobytes(), int(y[i])), i)
    keep = sorted(seen.values())
    rows, y = [rows[i] for i in keep], y[keep].astype(np.float64)
    slots, where = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_inverse=True)
    rate = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    bias = float(np.log(rate / (1 - rate)))
    if not len(slots) or y.min() == y.max():
        return FactorizationMachine(slots[:0], bias, np.zeros(0), np.zeros((0, factors)))
    lengths = np.array([len(r) for r in rows])
    ends = np.append(0, np.cumsum(lengths))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(slots)), rng.normal(0, 0.02, (len(slots), factors))
    share = np.where(y == 1, 0.5 / rate, 0.5 / (1 - rate))  # both labels weigh the same in sum
    bias, top, step = 0.0, 0.0, 0
    bias_moments, m, s = np.zeros(2), np.zeros(len(slots)), np.zeros(len(slots))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            b = order[at : at + 256]
            # The slots of these rows alone, and where each row has them.
            here, cell = np.unique(np.concatenate([where[ends[i] : ends[i + 1]] for i in b]), return_inverse=True)
            row = np.repeat(np.arange(len(b)), lengths[b])
            vc = v[here][cell]
            sums = np.stack([np.bincount(row, vc[:, f], len(b)) for f in range(factors)], axis=1)
            z = bias + np.bincount(row, w[here][cell], len(b)) + 0.5 * ((sums**2).sum(1) - np.bincount(row, (vc * vc).sum(1), len(b)))
            g = share[b] * (1 / (1 + np.exp(np.clip(-z, -50, 50))) - y[b]) / len(b)
            gw = np.bincount(cell, g[row], len(here))
            gs = g[:, None] * sums
            gv = np.stack([np.bincount(cell, gs[row, f], len(here)) for f in range(factors)], axis=1) - gw[:, None] * v[here]
            step += 1
            first, second = 1 - 0.9**step, 1 - 0.99**step
            bias_moments += (0.1, 0.01) * (np.array([g.sum(), g.sum() ** 2]) - bias_moments)
            bias -= 0.02 * (bias_moments[0] / first) / (np.sqrt(bias_moments[1] / second) + 1e-8)
            m *= 0.9
            s *= 0.99
            m[here] += 0.1 * gw
            s[here] += 0.01 * gw**2
            rates = 0.05 / (np.sqrt(s / second) + 1e-6)
            w -= rates * m / first
            w = np.sign(w) * np.maximum(np.abs(w) - rates * LEAST_GRADIENT, 0)
            top = max(0.999 * top, np.abs(gv).max(initial=0), 1e-12)
            v[here] -= 0.1 * gv / top
            v *= 1 - min(0.1 * FADE / top, 0.9)
    return FactorizationMachine(slots, float(bias), w, v)


def fit(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int = SAMPLE_ROWS) -> FactorizationMachine:
    """Learn from at most ``sample_rows`` labelled documents.

    ``labels`` has doc_id and the 0/1 column ``label``; null labels and labels
    without a document are left out, repeated ones count each.
    """
    ship(docs.sparkSession)
    chosen = bounded_sample(labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")), "doc_id", "y", sample_rows)
    # The number of chosen labels is bounded, whatever the table holds.
    few = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, slot = term_slots(batch.column("text"))
            pair = np.unique(row << SLOT_BITS | slot)
            row, slot = pair >> SLOT_BITS, pair & ((1 << SLOT_BITS) - 1)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            data = [slot[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("doc_id").cast(pa.string()), pa.array(data, pa.binary())], ["y", "doc_id", "slots"])

    table = few.mapInArrow(frugal(terms), "y int, doc_id string, slots binary").orderBy("doc_id", "y").toArrow()
    rows = [np.frombuffer(v.as_buffer(), "<i4").astype(np.int64) for v in table.column("slots")]
    return train(rows, np.array(table.column("y").to_pylist(), np.int64))


def score(docs: DataFrame, model, threshold: float) -> DataFrame:
    """(doc_id, score, predicted) for every row, from its whole text alone.

    ``model.score`` maps an Arrow column of texts to scores. A null text counts
    as empty; repeated rows are scored each.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(judge), f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")
