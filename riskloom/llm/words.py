"""Words of many texts at once, by numpy on the Arrow buffers: byte positions and 64-bit hashes.

Used inside ``mapInArrow`` tasks. Texts are cut into slices of about CHUNK_BYTES, so the working
memory doesn't grow with the batch; one longer text makes one longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_GAP = np.uint64(0xBF58476D1CE4E5B9)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _GAP
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo 2**64; kept per process."""
    if len(_powers["up"]) < n:
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


@dataclass(frozen=True)
class WordKind:
    """Which bytes make words, and the value that each byte adds to a word's hash."""

    inside: np.ndarray
    code: np.ndarray


def word_kind(separators: bytes, fold: bool) -> WordKind:
    """Words are runs of bytes other than ``separators`` (ASCII); ``fold`` lower-cases A-Z first."""
    seen = np.arange(256, dtype=np.uint64)
    if fold:
        seen[65:91] += np.uint64(32)
    inside = ~np.isin(seen, np.frombuffer(separators, np.uint8))
    return WordKind(inside, mix(seen + np.uint64(0x51ED2701)))


WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but digits and lower-case letters; A-Z are folded before.
NO_LETTERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
PLAIN = word_kind(WHITE, fold=False)
FOLDED = word_kind(WHITE, fold=True)
LETTERS = word_kind(NO_LETTERS, fold=True)


@dataclass(frozen=True)
class Words:
    """Words of some texts: word k covers bytes starts[k]:ends[k]; text d has words first[d]:first[d + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def split_words(buf: np.ndarray, offsets: np.ndarray, kind: WordKind, hashed: bool = True) -> Words:
    """All words of the texts that lie one after another in ``buf``."""
    inside = kind.inside[buf]
    before = np.empty_like(inside)
    before[1:], before[:1] = inside[:-1], False
    before[offsets[:-1][offsets[:-1] < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    before[:-1], before[-1:] = inside[1:], False  # now: the byte after
    before[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    first = np.searchsorted(starts, offsets)
    return Words(starts, ends, _hash(buf, starts, ends, kind.code) if hashed else np.zeros(0, np.uint64), first)


def _hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Polynomial hashes from running sums, one segment of words after the other."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        origin = starts[k]
        to = max(k + 1, int(np.searchsorted(ends, origin + _SEGMENT, "right")))
        span = int(ends[to - 1] - origin)
        up, down = powers(max(span, _SEGMENT))
        sums = np.zeros(span + 1, np.uint64)
        np.cumsum(code[buf[origin : origin + span]] * up[:span], out=sums[1:])
        s, e = starts[k:to] - origin, ends[k:to] - origin
        out[k:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        k = to
    return out


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of ``width`` consecutive words of one text: (first word of each window, hash)."""
    n = len(words.hashes)
    last = np.repeat(words.first[1:], words.counts())
    at = np.flatnonzero(np.arange(n) + width <= last)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    out = np.empty(len(at), np.uint64)
    for lo in range(0, len(at), _SEGMENT):
        part = at[lo : lo + _SEGMENT]
        origin, end = part[0], part[-1] + width
        up, down = powers(max(int(end - origin), _SEGMENT + width))
        sums = np.zeros(end - origin + 1, np.uint64)
        np.cumsum(words.hashes[origin:end] * up[: end - origin], out=sums[1:])
        out[lo : lo + _SEGMENT] = mix((sums[part - origin + width] - sums[part - origin]) * down[part - origin])
    return at, out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges starts[k] .. starts[k] + lengths[k] - 1, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
