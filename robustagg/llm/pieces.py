"""Token ids of text columns, batch by batch, through public tokenizers.

A text is cut into pre-tokens on numpy arrays of code points by the vocabulary's
own pattern (letters, digits, white space and the rest, a leading blank joined,
English contractions apart); every distinct pre-token is encoded once per task by the
``tokenizers`` model and its ids are gathered for all places. The table of
known pre-tokens (arrays) is emptied when it reaches ``limit`` entries.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .words import Powers, mix, text_bytes

LETTER, NUMBER, SPACE, OTHER = range(4)
_POINTS = Powers(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 19


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    import regex

    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0x110000 - 1  # surrogates do not occur in texts
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    classes = np.full(len(points), OTHER, np.uint8)
    for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, text):
            classes[run.start():run.end()] = value
    return classes


def code_points(column: pa.Array) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts as one string, its code points, and n + 1 offsets of the texts."""
    data, texts = text_bytes(column)
    head = (data & 0xC0) != 0x80  # first bytes of characters
    before = np.concatenate([[0], np.cumsum(head)])
    joined = data.tobytes().decode("utf-8")
    return joined, np.frombuffer(joined.encode("utf-32-le"), np.uint32), before[texts]


def pretoken_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of all texts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[texts] = True  # text starts (and n)
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # White space before something else: its last character starts a token and a blank joins what follows.
    body = np.flatnonzero(run & (kind != SPACE) & ~edge[:n])
    body = body[kind[body - 1] == SPACE]
    start[body - 1] = True
    start[body[points[body - 1] == 0x20]] = False
    # Contractions: ' and s t m d re ve ll, where the ' starts a token.
    quote = np.flatnonzero(start & (points == 0x27))
    quote = quote[quote + 1 < n]
    quote = quote[~edge[quote + 1]]
    one, two = points[quote + 1], points[np.minimum(quote + 2, n - 1)]
    two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], two, 0)
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    size = np.where(pair, 3, size)
    quote, size = quote[size > 0], size[size > 0]
    start[quote + 1] = False
    after = quote + size
    after = after[after < n]
    start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start)


class Pieces:
    """Ids of distinct strings, kept from batch to batch. ``encode`` takes a list of
    strings and gives all their ids and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 18):
        self.encode, self.limit = encode, limit
        self.reset()

    def reset(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ordered by key
        self.ids, self.at = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)
        self.n = 0

    def lookup(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slots of the strings joined[start:end]."""
        if not len(starts):
            return np.zeros(0, np.int64)
        keys = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + _SEGMENT)))
            a, b = int(starts[i]), int(ends[j - 1])
            up, down = _POINTS.get(b - a + 1)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum((points[a:b].astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
            keys[i:j] = (total[ends[i:j] - a] - total[starts[i:j] - a]) * down[starts[i:j] - a]
            i = j
        keys = mix(keys)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at, new = self._find(distinct)
        if self.n + np.count_nonzero(new) > self.limit:
            self.reset()
            at, new = self._find(distinct)
        slots = np.empty(len(distinct), np.int64)
        slots[~new] = self.slots[at[~new]]
        slots[new] = self.n + np.arange(np.count_nonzero(new))
        if new.any():
            self.keys = np.insert(self.keys, at[new], distinct[new])
            self.slots = np.insert(self.slots, at[new], slots[new])
            self._grow(*self.encode([joined[a:b] for a, b in zip(
                starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]))
        return slots[inverse]

    def _find(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the known keys, and which are not known."""
        at = np.searchsorted(self.keys, distinct)
        new = at == self.n
        new[~new] = self.keys[at[~new]] != distinct[~new]
        return at, new

    def _grow(self, ids: np.ndarray, counts: np.ndarray) -> None:
        used, more = int(self.at[-1]), len(ids)
        if used + more > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.zeros(max(used // 4, more) + more, np.uint32)])
        self.ids[used:used + more] = ids
        self.at = np.concatenate([self.at, used + np.cumsum(counts)])
        self.n += len(counts)

    def counts(self, slots: np.ndarray) -> np.ndarray:
        return self.at[slots + 1] - self.at[slots]

    def gather(self, slots: np.ndarray) -> np.ndarray:
        """Ids of all slots, one after the other."""
        n = self.counts(slots)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.at[slots] - (ends - n), n) + np.arange(total)]


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself
    if it prints in Latin-1, else the next one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(rest)}


def flat_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, one after the other, and how many each list has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


def byte_bpe(path: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Encoder of pre-tokens by a byte-level vocabulary file of ``tokenizers``."""
    from tokenizers import Tokenizer

    model, table = Tokenizer.from_file(path).model, byte_alphabet()

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # All pieces are mapped at once, between bytes 0xFF, which UTF-8 never has.
        mapped = "\udcff".join(pieces).encode("utf-8", "surrogateescape").decode("latin-1").translate(table)
        return flat_ids([[t.id for t in model.tokenize(piece)] for piece in mapped.split("\xff")])
    return encode


class ByteTokens:
    """Ids of a text column by a byte-level vocabulary."""

    def __init__(self, path: str):
        self.pieces = Pieces(byte_bpe(path))

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        joined, points, texts = code_points(column)
        starts = pretoken_starts(points, texts)
        slots = self.pieces.lookup(joined, points, starts, np.append(starts[1:], len(points)))
        n = np.concatenate([[0], np.cumsum(self.pieces.counts(slots))])
        return self.pieces.gather(slots), np.diff(n[np.searchsorted(starts, texts)])


_TOKENS: dict[str, ByteTokens] = {}


def byte_tokens(path: str) -> ByteTokens:
    """One table per worker and vocabulary, until it is given up."""
    if path not in _TOKENS:
        _TOKENS[path] = ByteTokens(path)
    return _TOKENS[path]


def forget(path: str) -> None:
    """Give up the worker's table of a vocabulary and its model."""
    _TOKENS.pop(path, None)
    _POINTS.reset()
