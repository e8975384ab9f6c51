"""Substring removal: Rabin-Karp hashes of every window of words, counted by Spark.

1. Documents are dealt to chunks by a hash of their id and text. Tasks hash every window of their
   documents and write, for each bucket of the hash space, the hashes by chunk and in order as one
   blob of differences. A hash that occurs often in a task is written once, with a mark.
2. Buckets are shuffled together. A hash that is marked or comes from two blobs is repeated; every
   chunk that holds it gets it back.
3. Documents meet the repeated hashes of their chunk, repeated windows merge into maximal removal
   intervals, and the other words are kept.

Buckets hold about BUCKET_WINDOWS hashes and chunks about CHUNK_MB of text at any input size: their
numbers follow the input. A passage in a third of all documents adds one entry to each blob only.
Hashes have 64 bits: n windows have about n * n / 2**65 pairs that collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import PLAIN, ranges, split_words, text_slices, windows

WINDOW = 35
BUCKET_WINDOWS = 1 << 20
CHUNK_MB = 8
_FLUSH = 2 << 20  # windows that a task holds before it writes its blobs

_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>, kept_text string"


def pack_sorted(values: np.ndarray) -> bytes:
    """64-bit values, mostly rising, as differences with their bytes by place: the upper ones are zeros, which shuffles compress."""
    steps = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins, and the end."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _blobs(hashes: list[np.ndarray], chunks: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    h, c = np.concatenate(hashes), np.concatenate(chunks)
    order = np.argsort(h)
    order = order[np.argsort(c[order], kind="stable")]
    h, c = h[order], c[order]
    at = _runs(h, c)
    again = np.diff(at) > 1
    h, c = h[at[:-1]], c[at[:-1]]
    b = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    order = np.argsort(b, kind="stable")
    h, c, b, again = h[order], c[order], b[order], again[order]
    segments, cut = _runs(b, c), _runs(b)
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        own = segments[np.searchsorted(segments, lo) : np.searchsorted(segments, hi) + 1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(b[lo : lo + 1].astype(np.int32)),
                pa.array([c[own[:-1]]], pa.list_(pa.int32())),
                pa.array([np.diff(own).astype(np.int32)], pa.list_(pa.int32())),
                pa.array([pack_sorted(h[lo:hi])], pa.binary()),
                pa.array([np.packbits(again[lo:hi]).tobytes()], pa.binary()),
            ],
            ["bucket", "chunks", "sizes", "hashes", "again"],
        )


def _hash_windows(width: int, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, chunks, held = [], [], 0
        for batch in batches:
            chunk = batch.column("chunk").to_numpy().astype(np.int32)
            for lo, hi, buf, offsets in text_slices(batch.column("text")):
                words = split_words(buf, offsets, PLAIN)
                at, h = windows(words, width)
                hashes.append(h)
                chunks.append(np.repeat(chunk[lo:hi], words.counts())[at])
                held += len(h)
                if held >= _FLUSH:
                    yield from _blobs(hashes, chunks, bits)
                    hashes, chunks, held = [], [], 0
        if held:
            yield from _blobs(hashes, chunks, bits)

    return work


def _repeated(table: pa.Table) -> pa.Table:
    """One bucket: the hashes that occur more than once, for each chunk that holds them."""
    h, c, again = [], [], []
    for chunks, sizes, blob, mark in zip(*(table.column(x).to_pylist() for x in ("chunks", "sizes", "hashes", "again")), strict=True):
        h.append(unpack_sorted(blob))
        c.append(np.repeat(np.array(chunks, np.int32), sizes))
        again.append(np.unpackbits(np.frombuffer(mark, np.uint8), count=len(h[-1])).astype(bool))
    h, c, again = np.concatenate(h), np.concatenate(c), np.concatenate(again)
    order = np.argsort(h)
    h, c, again = h[order], c[order], again[order]
    at = _runs(h)
    sizes = np.diff(at)
    twice = np.repeat((sizes > 1) | np.logical_or.reduceat(again, at[:-1]), sizes)
    h, c = h[twice], c[twice]
    order = np.argsort(c, kind="stable")
    h, c = h[order], c[order]
    cut = _runs(c) if len(c) else np.zeros(1, int)
    return pa.table(
        {
            "chunk": pa.array(c[cut[:-1]], pa.int32()),
            "hashes": pa.array([pack_sorted(np.unique(h[s:e])) for s, e in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
        }
    )


def _remove(width: int):
    def work(docs: pa.Table, found: pa.Table) -> pa.Table:
        known = [unpack_sorted(x) for x in found.column("hashes").to_pylist()] if found.num_rows else []
        known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        parts = []
        for lo, hi, buf, offsets in text_slices(docs.column("text")):
            words = split_words(buf, offsets, PLAIN)
            at, h = windows(words, width)
            place = np.searchsorted(known, h)
            hit = at[known[np.minimum(place, len(known) - 1)] == h] if len(known) else at[:0]
            edge = np.zeros(len(words.starts) + 1, np.int64)
            edge[hit] += 1
            edge[hit + width] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            parts.append(_kept(docs.column("doc_id").slice(lo, hi - lo), buf, words, gone))
        return pa.concat_tables(parts)

    return work


def _kept(doc_id: pa.ChunkedArray, buf: np.ndarray, words, gone: np.ndarray) -> pa.Table:
    """What stays of each text, its words joined by one space, and the intervals of words that go."""
    n = len(words.first) - 1
    text = np.repeat(np.arange(n), words.counts())
    removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | (text[1:] != text[:-1])
    closes = gone.copy()
    closes[:-1] &= ~gone[1:] | (text[1:] != text[:-1])
    begin, close = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    spans = pa.StructArray.from_arrays(
        [pa.array((begin - words.first[text[begin]]).astype(np.int64)), pa.array((close - words.first[text[begin]]).astype(np.int64))],
        ["start", "end"],
    )
    span_at = np.searchsorted(text[begin], np.arange(n + 1)).astype(np.int32)
    stay = np.flatnonzero(~gone)
    lengths = words.ends[stay] - words.starts[stay]
    out = np.full(int(lengths.sum()) + len(stay), 0x20, np.uint8)
    to = np.cumsum(lengths + 1) - lengths - 1  # each word, then a space
    out[ranges(to, lengths)] = buf[ranges(words.starts[stay], lengths)]
    first = np.searchsorted(text[stay], np.arange(n + 1))
    edges = np.append(to, len(out))[first]
    view = out.tobytes()
    kept = [view[edges[d] : max(edges[d], edges[d + 1] - 1)].decode() for d in range(n)]
    return pa.table(
        {
            "doc_id": doc_id,
            "n_words": pa.array(words.counts().astype(np.int64)),
            "n_removed": pa.array(np.diff(removed).astype(np.int64)),
            "removed": pa.ListArray.from_arrays(pa.array(span_at), spans),
            "kept_text": pa.array(kept, pa.string()),
        }
    )


def remove_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts anywhere else.

    ``docs`` has doc_id and text; other columns are ignored, join them by doc_id. Windows lie within
    one document and are judged on the input, so all places of a passage go. A null or empty text
    has no words; a text of fewer words than a window keeps all; repeated rows repeat each other's
    windows; null ids are kept as they are. Returns doc_id, n_words, n_removed, removed (intervals
    of words, end exclusive) and kept_text (words joined by one space).
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint")).first()[0]
    n_chunks = 1 + size // (CHUNK_MB << 20)
    bits = max(0, (size // 6 // BUCKET_WINDOWS).bit_length())  # a word takes about 6 bytes
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text", chunk)
    blobs = texts.select("chunk", "text").mapInArrow(_hash_windows(width, bits), "bucket int, chunks array<int>, sizes array<int>, hashes binary, again binary")
    found = blobs.groupBy("bucket").applyInArrow(_repeated, "chunk int, hashes binary")
    return texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_remove(width), _KEPT)
