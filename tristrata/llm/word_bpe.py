"""Fast ids of the public word tokenizer for whole Arrow columns.

That tokenizer drops white space and never merges across it, so a text's ids
are those of its words, one after another. Words are hashed in place, looked up
in a bounded cache, and only new words are merged, many at a time in numpy.
Words outside plain Latin text, very long words and those holding a special
token's text go through the tokenizer itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .text import ragged, word_slices

# The tokenizer's own pattern for the parts of a word.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# Words with these go through the tokenizer itself: special tokens, information separators, all but Latin letters.
ODD = regex.compile("<\\||[\x1c-\x1f\u0250-\U0010ffff]")

LONGEST = 64
CACHE_WORDS = 1 << 19
RECENT_WORDS = 1 << 16
NO_RANK = 1 << 30


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if it can be seen, else one past 255."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


class Merges:
    """Rank and result of a pair of ids, in an open hash table."""

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NO_RANK, np.int64)
        self.merged = np.zeros(1 << self.bits, np.int64)
        todo, at = np.arange(len(pairs)), self._slot(pairs)
        while len(todo):
            free = self.keys[at] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.rank[at[put]], self.merged[at[put]] = pairs[todo[put]], todo[put], merged[todo[put]]
            todo, at = todo[~put], (at[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        at = self._slot(key)
        wrong = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[(self.keys[at[wrong]] != key[wrong]) & (self.keys[at[wrong]] >= 0)]
        return at


class _Part:
    """Sorted hashes of words, their second hashes, and where the ids of each are in the pool."""

    def __init__(self, keys=None, checks=None, first=None, count=None, pool=None):
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.checks = np.zeros(0, np.uint64) if checks is None else checks
        self.first = np.zeros(0, np.int64) if first is None else first
        self.count = np.zeros(0, np.int64) if count is None else count
        self.pool = np.zeros(0, np.uint16) if pool is None else pool
        self.used = np.zeros(len(self.keys), bool)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def take(self, more: _Part) -> None:
        keys = np.concatenate([self.keys, more.keys])
        order = np.argsort(keys, kind="stable")
        self.checks = np.concatenate([self.checks, more.checks])[order]
        self.first = np.concatenate([self.first, more.first + len(self.pool)])[order]
        self.count = np.concatenate([self.count, more.count])[order]
        self.pool = np.concatenate([self.pool, more.pool])
        self.used = np.concatenate([self.used, np.zeros(len(more.keys), bool)])[order]
        self.keys = keys[order]

    def met_again(self) -> _Part:
        """The words that were looked up since they came here."""
        at = np.flatnonzero(self.used)
        count = self.count[at]
        return _Part(self.keys[at], self.checks[at], np.cumsum(count) - count, count, self.pool[ragged(self.first[at], count)])


class WordBpe:
    """Ids of words; ``special`` says whether a special token's text in a document is that token (the tokenizer's default)."""

    def __init__(self, path: str, special: bool = True):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        vocab, names = model["vocab"], _byte_names()
        pattern = [p.get("pattern", {}).get("Regex") for p in (whole.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        if PARTS not in pattern or max(vocab.values()) >= 1 << 16 or len(model["merges"]) >= 1 << 19:
            raise ValueError(f"{path} is not a word tokenizer of this kind")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(
            np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64),
            np.array([vocab[a + b] for a, b in pairs], np.int64),
        )
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + WORD_END] for c in names], np.int64)
        self.parts = regex.compile(PARTS)
        self.clear()

    def clear(self) -> None:
        """Forget all words. They are kept in a large and a small sorted part, of which only the small one is sorted anew often."""
        self.old, self.recent = _Part(), _Part()

    def by_row(self, column: pa.Array) -> Iterator[np.ndarray]:
        """One array of ids (uint16) for each row; null and empty texts have none."""
        parts: list[np.ndarray] = []
        at = 0
        for words in word_slices(column):
            if words.first > at:
                yield np.concatenate(parts)
                parts, at = [], at + 1
            ids, count = self._known(words)
            ends = np.concatenate([[0], np.cumsum(count)])
            cuts = ends[np.searchsorted(words.row, np.arange(words.first, words.last + 2))]
            for k in range(words.last - words.first):
                parts.append(ids[cuts[k] : cuts[k + 1]])
                yield np.concatenate(parts) if len(parts) > 1 else parts[0]
                parts, at = [], at + 1
            parts.append(ids[cuts[-2] : cuts[-1]])
        if len(column):
            yield np.concatenate(parts)

    def _known(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has, after learning the new words."""
        if not len(words.hash):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if len(self.old.keys) > CACHE_WORDS:
            # Most words of a large corpus occur once: what came again stays, if that makes room.
            self.old = self.old.met_again()
            if len(self.old.keys) > CACHE_WORDS // 2:
                self.clear()
        distinct, example, back = np.unique(words.hash, return_index=True, return_inverse=True)
        check = words.check[example]
        old, is_old = self.old.find(distinct)
        recent, is_recent = self.recent.find(distinct)
        if (
            (words.check != check[back]).any()
            or (self.old.checks[old[is_old]] != check[is_old]).any()
            or (self.recent.checks[recent[is_recent]] != check[is_recent]).any()
        ):
            return self._one_by_one(words)
        self.old.used[old[is_old]] = True
        new = ~is_old & ~is_recent
        if new.any():
            data = words.data.tobytes()
            at = example[new]
            self._learn(distinct[new], check[new], [data[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())])
            recent, is_recent = self.recent.find(distinct)
        first = np.where(is_old, self.old.first[old] if len(self.old.keys) else 0, 0)
        count = np.where(is_old, self.old.count[old] if len(self.old.keys) else 0, 0)
        if is_recent.any():
            first[is_recent] = self.recent.first[recent[is_recent]] + len(self.old.pool)
            count[is_recent] = self.recent.count[recent[is_recent]]
        small = ragged(first, count)
        pool = np.where(small < len(self.old.pool), self.old.pool[np.minimum(small, max(len(self.old.pool) - 1, 0))] if len(self.old.pool) else 0,
                        self.recent.pool[np.maximum(small - len(self.old.pool), 0)] if len(self.recent.pool) else 0).astype(np.uint16)
        begins = np.cumsum(count) - count
        if len(self.recent.keys) > RECENT_WORDS:
            self.old.take(self.recent)
            self.recent = _Part()
        return pool[ragged(begins[back], count[back])], count[back]

    def _one_by_one(self, words) -> tuple[np.ndarray, np.ndarray]:
        """The same without the cache, for a slice with different words of one hash."""
        data = words.data.tobytes()
        texts = [data[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]
        known = {raw: np.array(self.whole.encode(raw.decode("utf-8"), add_special_tokens=False).ids, np.uint16) for raw in set(texts)}
        return np.concatenate([known[raw] for raw in texts]), np.array([len(known[raw]) for raw in texts], np.int64)

    def _learn(self, keys: np.ndarray, checks: np.ndarray, texts: list[bytes]) -> None:
        pieces: list[bytes] = []
        owner: list[int] = []
        slow: dict[int, np.ndarray] = {}
        for i, raw in enumerate(texts):
            word = raw.decode("utf-8")
            if len(raw) > LONGEST or ODD.search(word):
                slow[i] = np.array(self.whole.encode(word, add_special_tokens=False).ids, np.uint16)
                continue
            word = word.lower()
            for part in (word,) if word.isalpha() else self.parts.findall(word):
                pieces.append(part.encode("utf-8"))
                owner.append(i)
        ids, counts = self._merge(pieces)
        total = np.bincount(np.array(owner, np.int64), weights=counts, minlength=len(texts)).astype(np.int64) if owner else np.zeros(len(texts), np.int64)
        first = np.cumsum(total) - total
        at, flat = len(ids), [ids]
        for i, found in slow.items():
            first[i], total[i] = at, len(found)
            flat.append(found)
            at += len(found)
        self.recent.take(_Part(keys, checks, first, total, np.concatenate(flat)))

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has.

        In each round every piece that can still be merged replaces the leftmost
        pair of least rank, as the rule of byte-pair encoding says.
        """
        if not pieces:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(length)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        done_ids: list[np.ndarray] = []
        done_of: list[np.ndarray] = []
        of = np.arange(len(pieces))
        while len(of):
            starts = ends - length
            key = np.full(len(sym), -2, np.int64)
            key[:-1] = sym[:-1] << 20 | sym[1:]
            key[ends - 1] = -2
            rank = np.full(len(sym), NO_RANK, np.int64)
            inner = np.flatnonzero(key >= 0)
            slot = self.merges.find(key[inner])
            hit = self.merges.keys[slot] == key[inner]
            rank[inner[hit]] = self.merges.rank[slot[hit]]
            best = rank * len(sym) + np.arange(len(sym)) - np.repeat(starts, length)  # rank, then place
            least = np.minimum.reduceat(best, starts)
            open_ = least < NO_RANK * len(sym)
            if not open_.all():
                over = np.repeat(~open_, length)
                done_ids.append(sym[over])
                done_of.append(np.repeat(of[~open_], length[~open_]))
                if not open_.any():
                    break
                sym, of, least, length_open = sym[~over], of[open_], least[open_], length[open_]
                place = least % len(rank)
                length = length_open
                ends = np.cumsum(length)
                starts = ends - length
            else:
                place = least % len(rank)
            at = starts + place
            pair = sym[at] << 20 | sym[at + 1]
            sym[at] = self.merges.merged[self.merges.find(pair)]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym = sym[keep]
            length = length - 1
            ends = np.cumsum(length)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_of)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint16), np.bincount(owner, minlength=len(pieces))


_loaded: dict[tuple[str, bool], WordBpe] = {}


def word_bpe(path: str, special: bool = True) -> WordBpe:
    """The tokenizer of this Python worker; loaded once."""
    if (path, special) not in _loaded:
        _loaded[path, special] = WordBpe(path, special)
    return _loaded[path, special]
