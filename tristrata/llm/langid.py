"""Language identification in two levels.

A softmax model over hashed byte n-grams picks the family of languages; inside
the family one-versus-one linear support vector machines, which only ever saw
closely related languages, vote for the language. Both only choose among the languages
learned, so whether a text is in the one they name at all is told by its familiar
share: how many of its byte runs occur in the learned texts of that language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_sample, frugal, learned, ship
from .text import NOT_LETTER, buffers

DIMS = 4096
#: Labelled rows to learn from, at most; spread evenly over the languages.
SAMPLE_ROWS = 4000
#: Families of well-known codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}
NO_LANGUAGE = "und"
#: Runs of this many bytes, hashed to 2^RUN_BITS slots, tell how familiar a text is.
RUN_BYTES = 4
RUN_BITS = 20
#: A run is familiar if so many learned texts of the language have it, and this share of them, so that passages
#: in another language do not make that one familiar.
RUN_TEXTS = 3
RUN_SHARE = 0.01
#: A score from which a language counts as decided.
SURE = 0.5
_PART = 1 << 20

# Letters in one case, all else as one gap. Bytes of longer code points are
# folded too: the second byte of Latin letters differs by 32 between the cases.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[NOT_LETTER] = 32
_FOLD[0x80:0x9F] += 32


def family_of(language: str) -> str:
    return next((f for f, codes in FAMILIES.items() if language in codes), f"only {language}")


def _features(data: np.ndarray) -> np.ndarray:
    """Logarithms of the counts of byte runs of length 1 to 3, hashed, at unit length."""
    total = np.zeros(DIMS)
    for at in range(0, len(data), _PART):
        b = _FOLD[data[at : at + _PART + 2]].astype(np.uint32)
        n = min(_PART, len(data) - at)
        one = b[:n]
        two = b[:-1][:n] << np.uint32(8) | b[1:][:n]
        three = two[: max(len(b) - 2, 0)] << np.uint32(8) | b[2:][:n]
        for k, grams in enumerate((one, two, three)):
            slots = ((grams + np.uint32(k << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(20)
            total += np.bincount(slots, minlength=DIMS)
    out = np.log1p(total)
    return (out / max(np.linalg.norm(out), 1e-12)).astype(np.float32)


def _packed(x: np.ndarray) -> bytes:
    """Places and values of what is not zero."""
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes()


def _runs(data: np.ndarray) -> np.ndarray:
    """Counts by slot of the byte runs of a text, as (slots, counts); gaps count as one, runs of a gap alone do not occur."""
    slots, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    last = np.array([32], np.uint8)
    for at in range(0, len(data), _PART):
        b = np.concatenate([last, _FOLD[data[at : at + _PART]], [32] if at + _PART >= len(data) else []]).astype(np.uint8)
        b = b[np.append(True, (b[1:] != 32) | (b[:-1] != 32))]
        last = b[-(RUN_BYTES - 1) :]
        if len(b) < RUN_BYTES:
            continue
        run = np.zeros(len(b) - RUN_BYTES + 1, np.uint32)
        for k in range(RUN_BYTES):
            run = run << np.uint32(8) | b[k : len(run) + k]
        found.append(np.unique((run * np.uint32(0x9E3779B1)) >> np.uint32(32 - RUN_BITS), return_counts=True))
    if found:
        slots, at = np.unique(np.concatenate([f[0] for f in found]).astype(np.int64), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([f[1] for f in found])).astype(np.int64)
    return np.stack([slots, counts])


def _share(runs: np.ndarray, seen: np.ndarray) -> float:
    """The share of a text's runs that are among those seen; of none, all."""
    return float((runs[1] * seen[runs[0]]).sum() / runs[1].sum()) if runs.shape[1] else 1.0


def _familiarity(runs: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Which runs are familiar, a column for each language, and the familiar share that a text in one of them has at least.

    Learned from every second text of a language and measured on the others:
    once for their own language, and once for texts of each language against
    all the other ones, as if it had not been learned. The border lies where the
    mean of both shares of errors is least, in the middle of the best stretch.
    With one language alone, it leaves out one in a thousand of its own texts.
    """

    def seen(rows: np.ndarray) -> np.ndarray:
        texts = np.zeros(1 << RUN_BITS, np.int32)
        for i in rows:
            texts[runs[i][0]] += 1
        return texts >= max(min(RUN_TEXTS, max(1, len(rows) // 2)), RUN_SHARE * len(rows))

    languages = sorted(set(y))
    rows = {v: np.flatnonzero(y == v) for v in languages}
    half = {v: seen(rows[v][::2]) for v in languages}
    own = [[_share(runs[i], half[v]) for i in rows[v][1::2]] for v in languages]
    foreign = [[max(_share(runs[i], half[o]) for o in languages if o != v) for i in rows[v][1::2]] for v in languages if len(languages) > 1]
    familiar = np.stack([seen(rows[v]) for v in languages], axis=1)
    # Every language counts the same, however many texts it has.
    own, foreign = [[(x, 1 / len(part)) for part in side if part for x in part] for side in (own, foreign)]
    if not own:
        return familiar, 0.0
    mine, other = np.array(sorted(own)), np.array(sorted(foreign)).reshape(-1, 2)
    if not len(other):
        return familiar, float(np.quantile(mine[:, 0], 0.001))
    cuts = np.unique(np.concatenate([mine[:, 0], other[:, 0]]))
    middles = np.concatenate([[0.0], (cuts[1:] + cuts[:-1]) / 2])

    def below(side: np.ndarray) -> np.ndarray:
        mass = np.concatenate([[0.0], np.cumsum(side[:, 1])]) / side[:, 1].sum()
        return mass[np.searchsorted(side[:, 0], middles)]

    wrong = below(mine) + 1 - below(other)
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    return familiar, float((middles[best[0]] + middles[best[-1]]) / 2)


def features(column: pa.Array) -> Iterator[tuple[bool, np.ndarray | None]]:
    """For each row whether it has a letter and, if so, its features."""
    for text in texts_of(column):
        letter = _has_letter(text)
        yield letter, _features(text) if letter else None


def _has_letter(text: np.ndarray) -> bool:
    if not NOT_LETTER[text[text < 128]].all():
        return True
    return len(text) > 0 and text.max() >= 128 and any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace"))


def texts_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each row."""
    offsets, data = buffers(column)
    return (data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def _descend(x: np.ndarray, gradient, shape: tuple[int, ...], rounds: int, rate: float) -> np.ndarray:
    """Accelerated gradient descent from zero."""
    w, last = np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    for k in range(rounds):
        ahead = w + (k / (k + 3)) * (w - last)
        last, w = w, ahead - rate * gradient(ahead)
    return w


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 2e-4, rounds: int = 120) -> np.ndarray:
    """A linear machine with squared hinge loss; ``y`` is 1 or -1, the last weight is the bias."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)

    def gradient(w):
        slack = np.maximum(0, 1 - y * (x @ w))
        return c * w - 2 * (x.T @ (share * y * slack))

    return _descend(x, gradient, (x.shape[1],), rounds, 0.2)


def train_softmax(x: np.ndarray, y: np.ndarray, classes: int, c: float = 1e-5, rounds: int = 120) -> np.ndarray:
    target = np.eye(classes, dtype=np.float32)[y]
    share = (1.0 / (np.bincount(y, minlength=classes)[y] * classes)).astype(np.float32)[:, None]

    def gradient(w):
        return c * w + x.T @ (share * (softmax(x @ w) - target))

    return _descend(x, gradient, (x.shape[1], classes), rounds, 1.5)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class LanguageModel:
    families: list[list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]
    familiar: np.ndarray  # slots x languages
    least: float

    def knows(self, text: np.ndarray, found: tuple[str, float] | None = None) -> bool:
        """Whether the bytes of a text are familiar enough in its language.

        ``found`` is what ``predict`` gives for it, looked up by default. Where the
        score is below ``SURE``, no language is likelier than all others together,
        and each of them may vouch for the text.
        """
        if found is None:
            languages, scores = self.predict(_features(text)[None])
            found = languages[0], scores[0]
        slots, counts = _runs(text)
        if not len(slots):
            return True
        shares = counts @ self.familiar[slots] / counts.sum()
        column = sorted(v for members in self.families for v in members).index(found[0])
        return (shares[column] if found[1] >= SURE else shares.max()) >= self.least

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of features: the family's probability times the mean confidence of the winner's duels."""
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        chance = softmax(x @ self.family_weights)
        pick = chance.argmax(1)
        languages, score = np.empty(len(x), object), np.zeros(len(x))
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(pick == f)
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(members)))
            sure = np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                margin = x[rows] @ self.pair_weights[members[a], members[b]]
                p = 1 / (1 + np.exp(np.clip(-4 * margin, -50, 50)))
                votes[:, a] += margin >= 0
                votes[:, b] += margin < 0
                sure[:, a] += p
                sure[:, b] += 1 - p
            best = (votes + sure / len(members)).argmax(1)
            duels = max(len(members) - 1, 1)
            confidence = sure[np.arange(len(rows)), best] / duels if len(members) > 1 else 1.0
            languages[rows] = np.array(members, object)[best]
            score[rows] = chance[rows, f] * confidence
        return languages.tolist(), np.clip(score, 0, 1)


def fit(docs: DataFrame, learn_from, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Learn from at most ``sample_rows`` rows where ``learn_from`` holds and lang is not null; None if there are none.

    Repeated rows and rows that repeat a doc_id count each. Training runs inside
    a task.
    """
    ship(docs.sparkSession)
    rows = docs.where(learn_from & F.col("lang").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    few = bounded_sample(rows, "doc_id", "lang", sample_rows)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_packed(x) if ok else None for ok, x in features(batch.column("text"))]
            runs = [_runs(t).astype("<i4").tobytes() for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id").cast(pa.string()), pa.array(found, pa.binary()), pa.array(runs, pa.binary())], ["lang", "doc_id", "x", "runs"])

    return learned(few.mapInArrow(frugal(vectors), "lang string, doc_id string, x binary, runs binary").where("x IS NOT NULL"), learn)


def learn(table: pa.Table) -> LanguageModel | None:
    """Train on a table with lang, doc_id, features and runs; None if it is empty."""
    if not table.num_rows:
        return None
    order = pc.sort_indices(table.select(["lang", "doc_id"]), [("lang", "ascending"), ("doc_id", "ascending")]).to_pylist()
    y = np.array(table.column("lang").to_pylist(), object)[order]
    x = np.zeros((len(y), DIMS + 1), np.float32)
    x[:, -1] = 1
    values = table.column("x")
    for row, i in zip(x, order):
        raw = values[i].as_buffer()
        count = len(raw) // 6
        row[np.frombuffer(raw, "<u2", count)] = np.frombuffer(raw, "<f4", count, 2 * count)
    groups: dict[str, list[str]] = {}
    for language in sorted(set(y)):
        groups.setdefault(family_of(language), []).append(language)
    families = [groups[k] for k in sorted(groups)]
    of = {language: f for f, members in enumerate(families) for language in members}
    family_weights = train_softmax(x, np.array([of[v] for v in y]), len(families))
    pairs = {}
    for members in families:
        for a, b in combinations(members, 2):
            rows = np.flatnonzero((y == a) | (y == b))
            pairs[a, b] = train_svm(x[rows], np.where(y[rows] == a, 1, -1).astype(np.float32))
    values = table.column("runs")
    runs = [np.frombuffer(values[i].as_buffer(), "<i4").reshape(2, -1) for i in order]
    return LanguageModel(families, family_weights, pairs, *_familiarity(runs, y))


def predict(model: LanguageModel | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every text of a column."""
    languages, scores = [NO_LANGUAGE] * len(column), np.zeros(len(column))
    wait: list[np.ndarray] = []
    at: list[int] = []

    def settle() -> None:
        found, score = model.predict(np.stack(wait))
        for i, language in zip(at, found):
            languages[i] = language
        scores[at] = score
        wait.clear()
        at.clear()

    for i, (ok, x) in enumerate(features(column)):
        if ok and model is not None:
            wait.append(x)
            at.append(i)
            if len(wait) == 512:
                settle()
    if wait:
        settle()
    return languages, scores


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from its whole text alone.

    A null text, one without a letter, or a missing model gives ``und`` and
    score 0. Repeated rows are judged each; equal scores go to the language
    that comes first by name.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = predict(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(judge), f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def where_known(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The rows of ``docs`` in a language that was learned, columns unchanged, in one pass without a shuffle.

    The language of a whole text is identified as in ``identify``: family, then
    duels. A row stays if its text has the familiar share that the model asks for
    in that language (in any, where the score leaves it open). Null texts, texts without a letter and all rows of a
    missing model go.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            named = zip(*predict(shared.value, texts))
            found = (shared.value is not None and _has_letter(t) and bool(shared.value.knows(t, v)) for t, v in zip(texts_of(texts), named))
            yield batch.filter(pa.array(found, pa.bool_()))

    return docs.mapInArrow(frugal(keep), docs.schema)
