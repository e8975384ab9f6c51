"""Packing by Karmarkar-Karp multiway differencing.

1. Tasks tokenise their documents and cut them into pieces: whole windows first, the rest into
   pieces of at most ``piece`` ids. Each piece carries a checksum of its ids; ids don't travel.
2. Pieces that fill a window are one. The others are dealt evenly to blocks of about BLOCK_PIECES.
3. A block starts with one partial partition per piece, ``k`` sums of which one isn't zero. The two
   with the largest differences are merged, the largest sums of one with the smallest of the other,
   until one partition is left: ``k`` windows of nearly equal size. ``k`` begins at the least number
   of windows that could hold the block and rises while the fullest window exceeds the capacity.

The pieces are written to the shared folder before they are dealt, so the number of a block and of a
sequence doesn't change when a task runs again.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tokens import tokenizer_path, word_memo
from riskloom.llm.words import text_slices
from riskloom.sources.scratch import save_scratch

CAPACITY = 4096
PIECE = 512
END_ID = 2
BLOCK_PIECES = 2048

_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, piece_no bigint"
_PACKED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: windows of ``capacity``, then pieces of nearly equal size."""
    whole = [(s, capacity) for s in range(0, n - capacity + 1, capacity)]
    at, rest = len(whole) * capacity, n % capacity
    parts = -(-rest // piece)
    edges = [at + rest * k // parts for k in range(parts + 1)] if parts else []
    return whole + [(s, e - s) for s, e in zip(edges, edges[1:], strict=False)]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Items (their places in ``sizes``) of ``k`` groups of nearly equal sums."""
    if k == 1:
        return [list(range(len(sizes)))]
    left, right = [-1] * len(sizes), [-1] * len(sizes)  # groups as trees: items, then merged pairs
    heap = []
    for i, size in enumerate(sizes):
        sums, bags = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], bags[0] = size, i
        heap.append((-size, i, sums, bags))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        t, b = t[::-1], b[::-1]
        sums, bags = s + t, np.where(a < 0, b, a)
        for j in np.flatnonzero((a >= 0) & (b >= 0)).tolist():
            left.append(int(a[j]))
            right.append(int(b[j]))
            bags[j] = len(left) - 1
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tie, sums, bags[order]))
    groups = []
    for bag in heap[0][3].tolist():
        items, open_ = [], [bag] if bag >= 0 else []
        while open_:
            x = open_.pop()
            if left[x] < 0:
                items.append(x)
            else:
                open_ += [right[x], left[x]]
        groups.append(sorted(items))
    return [g for g in groups if g]


def pack_block(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of at most ``capacity``: the number of windows rises while one is exceeded."""
    k = -(-sum(sizes) // capacity)
    while True:
        groups = differencing(sizes, k)
        if max(sum(sizes[i] for i in g) for g in groups) <= capacity:
            return groups
        k += max(1, k // 200)


def _cut(path: str, capacity: int, piece: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo(path)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, buf, offsets in text_slices(batch.column("text")):
                ids, first = memo.encode(buf, offsets)
                row, start, length, crc, total = [], [], [], [], []
                for d in range(hi - lo):
                    own = np.append(ids[first[d] : first[d + 1]], np.uint32(END_ID)).astype("<u4")
                    for s, n in cuts(len(own), capacity, piece):
                        row.append(lo + d)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(own[s : s + n]))
                        total.append(len(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row, pa.int64())),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                        pa.array(np.arange(number, number + len(row))),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece_no"],
                )
                number += len(row)

    return work


def _pack(capacity: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("piece_no", "ascending")])
        sizes = table.column("length").to_pylist()
        base = table.column("block")[0].as_py() << 24
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for w, group in enumerate(pack_block(sizes, capacity)):
            at = 0
            for i in group:
                sequence[i], offset[i] = base + w, at
                at += sizes[i]
        kept = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return work


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` ids.

    ``docs`` has doc_id and text; other columns are ignored. A document's ids are those of the
    tokenizer file ``path``, then END_ID; a null or empty text has END_ID only. Null and repeated
    doc_ids are packed row by row. An empty table gives no pieces. Returns doc_id, start, length,
    ids_crc32 (of the little-endian 32-bit ids), doc_tokens, sequence_id and offset.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    pieces = save_scratch(texts.mapInArrow(_cut(path or tokenizer_path(), capacity, piece), _PIECES), "pieces")
    full = F.col("length") == capacity
    blocks = 1 + pieces.where(~full).count() // BLOCK_PIECES
    alone = pieces.where(full).select(*pieces.columns[:5], (-1 - F.col("piece_no")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    dealt = pieces.where(~full).withColumn("block", F.pmod(F.xxhash64("piece_no"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(_pack(capacity), _PACKED).unionAll(alone)
