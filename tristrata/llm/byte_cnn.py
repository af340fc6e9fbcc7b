"""Quality by a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of it. Learned filters run
over the embedded bytes of each chunk and keep their largest response. The mean,
the largest and the smallest chunk response of each filter go through one hidden
layer into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_bytes, bounded_sample, frugal, learned, ship
from .text import buffers

CHUNK = 512
OVERLAP = 64
WIDTH = 12
STEP = 3
EMBED = 8
FILTERS = 32
HIDDEN = 16
PLACES = (CHUNK - WIDTH) // STEP + 1
#: Labelled rows to learn from, at most; half of each label where there are enough.
SAMPLE_ROWS = 3000
EPOCHS = 8
#: Bytes of their texts, at most; texts are taken whole, in order of doc_id.
SAMPLE_BYTES = 64 << 20
_BATCH = 64
_GROUP = 256


def chunk_starts(length: int) -> np.ndarray:
    """Where the chunks of a text start; the last ends with the text, so only short texts are padded."""
    if length <= CHUNK:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, length - CHUNK, CHUNK - OVERLAP), length - CHUNK)


def chunks(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes by chunk, windows that hold text, text of each chunk)."""
    out, places, owner = [], [], []
    for i, text in enumerate(texts):
        starts = chunk_starts(len(text))
        padded = text if len(text) >= CHUNK else np.concatenate([text, np.zeros(CHUNK - len(text), np.uint8)])
        out.append(padded[starts[:, None] + np.arange(CHUNK)])
        places.append(np.full(len(starts), PLACES if len(text) >= CHUNK else max(1, -(-(len(text) - WIDTH) // STEP) + 1)))
        owner.append(np.full(len(starts), i))
    return np.concatenate(out), np.minimum(np.concatenate(places), PLACES), np.concatenate(owner)


@dataclass
class ByteNetwork:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(seed: int) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return ByteNetwork(
            draw(256, EMBED, scale=0.5), draw(WIDTH * EMBED, FILTERS, scale=0.15), np.zeros(FILTERS, np.float32),
            draw(3 * FILTERS, HIDDEN, scale=0.1), np.zeros(HIDDEN, np.float32), draw(HIDDEN, scale=0.3), np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, where it is, and the windows it was taken from."""
        embedded = self.embed[data]
        a, b, c = embedded.strides
        windows = np.lib.stride_tricks.as_strided(embedded, (len(data), PLACES, WIDTH * EMBED), (a, STEP * b, c))
        z = windows.reshape(-1, WIDTH * EMBED) @ self.filters
        z = z.reshape(len(data), PLACES, FILTERS)
        for i in np.flatnonzero(places < PLACES):
            z[i, places[i] :] = -1e9
        where = z.argmax(1)
        return np.take_along_axis(z, where[:, None], 1)[:, 0] + self.bias, where, windows

    def combine(self, r: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean, largest and smallest response by text."""
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        count = np.diff(np.append(first, len(owner)))
        relu = np.maximum(r, 0)
        return np.hstack([np.add.reduceat(relu, first) / count[:, None], np.maximum.reduceat(relu, first), np.minimum.reduceat(relu, first)]), count

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability for each text, all its bytes read; long texts go through in groups of chunks."""
        offsets, data = buffers(column)
        out = np.zeros(len(offsets) - 1)
        wait, size, begin = [], 0, 0
        for i in range(len(out)):
            wait.append(data[offsets[i] : offsets[i + 1]])
            size += len(wait[-1])
            if size > _BATCH * CHUNK or i == len(out) - 1:
                out[begin : i + 1] = self._score(wait)
                wait, size, begin = [], 0, i + 1
        return out

    def _score(self, texts: list[np.ndarray]) -> np.ndarray:
        responses, owners = [], []
        group, size = [], 0

        def run() -> None:
            data, places, owner = (np.concatenate(p) for p in zip(*group))
            responses.append(self.responses(data, places)[0])
            owners.append(owner)
            group.clear()

        for i, text in enumerate(texts):
            starts = chunk_starts(len(text))
            for at in range(0, len(starts), _BATCH):
                s = starts[at : at + _BATCH]
                part, places, owner = chunks([text[s[0] : s[-1] + CHUNK]]) if len(starts) <= _BATCH else (text[s[:, None] + np.arange(CHUNK)], np.full(len(s), PLACES), np.zeros(len(s)))
                group.append((part, places, np.full(len(part), i)))
                size += len(part)
                if size >= _BATCH:
                    run()
                    size = 0
        if group:
            run()
        x, _ = self.combine(np.concatenate(responses), np.concatenate(owners))
        z = np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(np.clip(-z.astype(np.float64), -500, 500)))

    def gradients(self, texts: list[np.ndarray], y: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
        """Gradients of all parts; a group of chunks is unfolded at a time, so that long texts need no more memory."""
        data, places, owner = chunks(texts)
        groups = [slice(at, at + _GROUP) for at in range(0, len(data), _GROUP)]
        found = [self.responses(data[g], places[g])[:2] for g in groups]
        r, where = (np.concatenate(p) for p in zip(*found))
        x, count = self.combine(r, owner)
        h = np.maximum(x @ self.hidden + self.hidden_bias, 0)
        p = 1 / (1 + np.exp(np.clip(-(h @ self.out + self.out_bias[0]), -50, 50)))
        gz = (share * (p - y)).astype(np.float32)
        gh = np.outer(gz, self.out) * (h > 0)
        gx = gh @ self.hidden.T
        mean, top, low = gx[:, :FILTERS], gx[:, FILTERS : 2 * FILTERS], gx[:, 2 * FILTERS :]
        relu = np.maximum(r, 0)
        gr = (mean / count[:, None])[owner]
        gr += top[owner] * (relu == x[owner, FILTERS : 2 * FILTERS]) + low[owner] * (relu == x[owner, 2 * FILTERS :])
        gr = (gr * (r > 0)).astype(np.float32)
        gf, ge = np.zeros_like(self.filters), np.zeros_like(self.embed)
        for g in groups:
            # The bytes behind each largest response.
            at = np.arange(len(data[g]))[:, None, None]
            used = data[g][at, (where[g] * STEP)[:, :, None] + np.arange(WIDTH)]
            taken = self.embed[used].reshape(len(used), FILTERS, WIDTH * EMBED)
            gf += np.einsum("cf,cfk->kf", gr[g], taken)
            gw = gr[g][:, :, None] * self.filters.T[None]
            np.add.at(ge, used.reshape(-1), gw.reshape(-1, EMBED))
        return [ge, gf, gr.sum(0), x.T @ gh, gh.sum(0), h.T @ gz, np.array([gz.sum()], np.float32)]


def train(texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> ByteNetwork:
    """Fit by logistic loss and Adam."""
    net = ByteNetwork.start(seed)
    if not len(y) or y.min() == y.max():
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(y) else (3 if y[0] else -3)
        return net
    rng = np.random.default_rng(seed)
    share = np.ones(len(y))
    parts = net.parts()
    m, s = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step, size = 0, max(8, min(32, len(y) // 12))
    rounds = epochs * min(6, max(1, round(1500 / len(y))))  # small samples are gone through more often
    for k in range(rounds):
        order = rng.permutation(len(y))
        rate = 0.006 * (1 - k / rounds) + 0.0005
        for at in range(0, len(order), size):
            b = order[at : at + size]
            step += 1
            for p, g, m1, s1 in zip(parts, net.gradients([texts[i] for i in b], y[b], share[b] / len(b)), m, s):
                m1 += 0.1 * (g - m1)
                s1 += 0.01 * (g * g - s1)
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(s1 / (1 - 0.99**step)) + 1e-7)
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> ByteNetwork:
    """Learn from the whole texts of at most ``sample_rows`` labelled documents with ``sample_bytes`` in all.

    ``labels`` has doc_id and the 0/1 column ``label``; null labels and labels
    without a document are left out, repeated ones count each. Equal texts with
    one label count once, whether copies or rows that repeat a doc_id. Training
    runs inside a task.
    """
    ship(docs.sparkSession)
    chosen = bounded_sample(labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")), "doc_id", "y", sample_rows)
    # The number of chosen labels is bounded, whatever the table holds.
    few = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    few = few.groupBy("text", "y").agg(F.min("doc_id").alias("doc_id"))
    return learned(bounded_bytes(few, "text", ["doc_id", "y"], sample_bytes), learn)


def learn(table: pa.Table) -> ByteNetwork:
    """Train on a table with text, y and doc_id."""
    table = table.sort_by([("doc_id", "ascending"), ("y", "ascending")])
    offsets, data = buffers(table.column("text"))
    texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    return train(texts, np.array(table.column("y").to_pylist(), np.int64))


def where_good(docs: DataFrame, model: ByteNetwork, threshold: float) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, columns unchanged, in one pass without a shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(batch.column("text").cast(pa.string())) >= threshold))

    return docs.mapInArrow(frugal(keep), docs.schema)
