"""Periodic runs of words, found online by a suffix automaton whose tree is kept in link-cut paths.

Each word appended to the automaton walks from its prefix to the root of the
suffix links. The walk is cut into segments whose states were last seen at the
same end; it recolours them with the new end. Where the distance to the end
before lies within the lengths of a segment, two equal neighbouring blocks of
that length (a square) end at the new word, and no shorter period explains
them. Squares of one period at consecutive ends are a run.

Only words that can lie in a run reach the automaton: a run of four periods
repeats each of its runs of ``GRAM`` words at least twice more, or within three
words. What is left of a document are stretches between words that do not, and
every run lies inside one of them, so the result is exact. A document is one
row: rows are spread over tasks, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import ship
from .text import SPACE, buffers, mix, ragged, word_slices

#: A run has this many periods and words at least. The filter before the
#: automaton relies on both, so they are no parameters.
PERIODS = 4
WORDS = 6
#: Words whose repetition the filter looks at: a run of 6 words has two of them one word apart.
GRAM = 5
PIECE = 1 << 18

SCHEMA = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


class LastEnds:
    """Suffix automaton of a growing word sequence; its link tree is split into paths with one last end each.

    A path is a splay tree ordered by depth. ``color`` is valid at the root of a
    splay tree and tells the last end of all its states; ``up`` is the parent in
    the splay tree, or at its root the state above the path.
    """

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.len = [0]
        self.link = [-1]
        self.last = 0
        self.end = -1
        self.up = [-1]
        self.above = [-1]
        self.below = [-1]
        self.color = [-1]

    def _state(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.len.append(length)
        self.link.append(-1)
        self.up.append(-1)
        self.above.append(-1)
        self.below.append(-1)
        self.color.append(-1)
        return len(self.len) - 1

    def append(self, word: int) -> list[int]:
        """Periods of the squares that end at this word and have no shorter period."""
        self.end += 1
        step, length, link = self.step, self.len, self.link
        new = self._state(self.end + 1, {})
        p = self.last
        self.last = new
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                link[new] = self._split(q, p, word)
        self.up[new] = link[new]
        return self._access(new)

    def _split(self, q: int, p: int, word: int) -> int:
        """A state for the shorter words of ``q``, put right above it on the same path."""
        step, link = self.step, self.link
        copy = self._state(self.len[p] + 1, dict(step[q]))
        self._splay(q)
        top = self.above[q]
        self.above[copy], self.above[q], self.up[copy] = top, copy, q
        if top >= 0:
            self.up[top] = copy
        link[copy], link[q] = link[q], copy
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    def _access(self, v: int) -> list[int]:
        """Joins the paths from ``v`` to the root into one that ends here; periods that lie within a segment's lengths."""
        up, below, color, length = self.up, self.below, self.color, self.len
        end, found = self.end, []
        done, w = v, up[v]
        while w >= 0:
            self._splay(w)
            over = up[w]
            period = end - color[w]
            if period <= length[w] and period > (length[over] if over >= 0 else 0):
                found.append(period)
            rest = below[w]
            if rest >= 0:
                color[rest] = color[w]
            below[w] = done
            up[done] = w
            done, w = w, over
        color[done] = end
        return found

    def _splay(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        old = x
        y = up[x]
        while y >= 0 and (above[y] == x or below[y] == x):
            z = up[y]
            if z >= 0 and (above[z] == y or below[z] == y):
                self._rotate(y if (above[z] == y) == (above[y] == x) else x)
                old = z
            else:
                old = y
            self._rotate(x)
            y = up[x]
        self.color[x] = self.color[old]

    def _rotate(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        y = up[x]
        z = up[y]
        if above[y] == x:
            c = below[x]
            above[y] = c
            below[x] = y
        else:
            c = above[x]
            below[y] = c
            above[x] = y
        if c >= 0:
            up[c] = y
        if z >= 0:
            if above[z] == y:
                above[z] = x
            elif below[z] == y:
                below[z] = x
        up[y] = x
        up[x] = z


def stretch_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of four periods and six words or more."""
    ends = LastEnds()
    squares: dict[int, list[int]] = {}
    out = []

    def close(period: int, first: int, last: int) -> None:
        length = last - first + 2 * period
        if length >= max(WORDS, PERIODS * period):
            out.append((first - 2 * period + 1, length, period))

    for i, word in enumerate(words):
        for period in ends.append(word):
            seen = squares.get(period)
            if seen is not None and seen[1] == i - 1:
                seen[1] = i
            else:
                if seen is not None:
                    close(period, *seen)
                squares[period] = [i, i]
    for period, seen in squares.items():
        close(period, *seen)
    return out


def stretches(ids: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) of the words that can lie in a run; ``row`` tells the texts apart, which follow one another.

    Each run of ``GRAM`` words within a run of the text repeats after its period.
    With a period up to three that is near by; with a longer one it occurs three
    times at least. Neighbouring ones of either kind make a stretch.
    """
    n = len(ids) - GRAM + 1
    if n < 2:
        return []
    gram = row[:n].astype(np.uint64)
    for k in range(GRAM):
        gram = mix(gram * np.uint64(0x9FB21C651E98DF25) + ids[k : n + k])
    whole = row[:n] == row[GRAM - 1 :]
    order = np.argsort(gram, kind="stable")
    bounds = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1], [True]]))
    often = np.zeros(n, bool)
    often[order] = np.repeat(np.diff(bounds) >= PERIODS - 1, np.diff(bounds))
    for d in range(1, PERIODS):
        near = np.flatnonzero(gram[:-d] == gram[d:]) if n > d else np.zeros(0, np.int64)
        often[near] = often[near + d] = True
    often &= whole
    opens = np.flatnonzero(often & ~np.concatenate([[False], often[:-1] & (row[: n - 1] == row[1:n])]))
    closes = np.flatnonzero(often & ~np.concatenate([often[1:] & (row[: n - 1] == row[1:n]), [False]]))
    return [(a, b + GRAM) for a, b in zip(opens.tolist(), closes.tolist()) if b + GRAM - a >= WORDS]


def periodic_tail(n: int, doc_id: int) -> tuple[int, int] | None:
    """(from, period) of the tail that the text of this id repeats in place of its words, if it does."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


@dataclass
class _Text:
    """Words of one text, each a place in ``data``."""

    doc_id: int | None
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ids: np.ndarray


def _texts(ids: pa.Array, column: pa.Array, tails: bool) -> Iterator[_Text]:
    """Texts one by one, with equal ids for equal words."""
    offsets, data = buffers(column)
    names = ids.to_pylist()
    parts: list[tuple] = []
    at, base = 0, int(offsets[0])

    def text() -> _Text:
        starts, ends, hashes, checks = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
        words = _tell_apart(hashes, checks, data, starts, ends)
        tail = periodic_tail(len(words), names[at]) if tails and names[at] is not None else None
        if tail:
            i = np.arange(len(words))
            i[tail[0] :] = tail[0] + (i[tail[0] :] - tail[0]) % tail[1]
            starts, ends, words = starts[i], ends[i], words[i]
        return _Text(names[at], data, starts, ends, words)

    for words in word_slices(column, SPACE):
        while at < words.first:
            yield text()
            parts, at = [], at + 1
        cuts = np.searchsorted(words.row, np.arange(words.first, words.last + 2))
        for k in range(words.last - words.first + 1):
            if at < words.first + k:
                yield text()
                parts, at = [], at + 1
            here = slice(cuts[k], cuts[k + 1])
            parts.append((words.start[here] + base, words.end[here] + base, words.hash[here], words.check[here]))
        base += len(words.data)
    while at < len(names):
        yield text()
        parts, at = [], at + 1


def _tell_apart(hashes: np.ndarray, checks: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes, if they tell the words apart; else numbers that do."""
    distinct, example, back = np.unique(hashes, return_index=True, return_inverse=True)
    if (checks == checks[example][back]).all():
        return hashes
    known: dict[bytes, int] = {}
    raw = [data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist())]
    return np.array([known.setdefault(w, len(known)) for w in raw], np.uint64)


def _joined_sha256(text: _Text, keep: np.ndarray) -> str:
    """Digest of the kept words with one space between, a bounded piece at a time."""
    digest = hashlib.sha256()
    length = text.end[keep] - text.start[keep] + 1
    start, ends = text.start[keep], np.cumsum(length)
    at = 0
    while at < len(start):
        # At least one word; a very long one is copied whole.
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        out = text.data[np.minimum(ragged(start[at:stop], length[at:stop]), len(text.data) - 1)]
        out[ends[at:stop] - (ends[at - 1] if at else 0) - 1] = 32
        digest.update((out if stop < len(start) else out[:-1]).tobytes())
        at = stop
    return digest.hexdigest()


def _digest(text: _Text, runs: list[tuple[int, int, int]]) -> tuple:
    runs.sort(key=lambda r: (r[0], r[2]))
    n = len(text.ids)
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(depth[:n]) == 0)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * length // period if runs else None
    return text.doc_id, n, len(runs), start, length, period, milli, hashlib.sha256(lines.encode()).hexdigest(), _joined_sha256(text, keep)


def _rows(texts: list[_Text]) -> list[tuple]:
    """Runs of several texts; the filter looks at all of them at once."""
    ids = np.concatenate([t.ids for t in texts])
    sizes = np.array([len(t.ids) for t in texts])
    row = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(ids, row):
        mine = int(row[a])
        shift = a - int(first[mine])
        runs[mine] += [(s + shift, length, period) for s, length, period in stretch_runs(ids[a:b].tolist())]
    return [_digest(t, r) for t, r in zip(texts, runs)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tails: bool = False) -> DataFrame:
    """Runs of repeated words of every text, and digests of the text without the repetitions.

    Words are what stands between ASCII white space. A run is a longest stretch
    of words with smallest period q and at least six words and four periods.
    Columns: doc_id, n_words, n_runs, then start, length, period and
    exponent_milli (1000 * length / period, rounded down) of the longest run
    (ties: smallest start, then period; null without a run), ``runs_sha256`` of
    all runs as lines and ``collapsed_sha256`` of the words kept: a run keeps
    its first period.

    Null and empty texts have no words, no runs and the digest of an empty
    text. A text is taken whole however long. Every row gives one row: repeated
    rows repeat, a null id stays null, an empty table gives none, and other
    columns are not looked at. ``tails`` first replaces the end of every tenth
    text by repetitions, as ``periodic_tail`` says of its id.
    """
    spark = docs.sparkSession
    ship(spark)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Slices of rows, so that a batch of long texts is not held as words at once.
            size = np.diff(buffers(batch.column("text"))[0])
            group = np.cumsum(size) // (4 << 20)
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(cuts, cuts[1:]):
                some = batch.slice(a, b - a)
                rows = _rows(list(_texts(some.column("doc_id"), some.column("text"), tails)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    given = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return given.mapInArrow(find, SCHEMA)
