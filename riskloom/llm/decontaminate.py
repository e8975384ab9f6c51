"""Benchmark decontamination by suffix arrays over the training text.

Each task cuts its documents into shards. A shard's suffix array holds the word positions whose
first words occur in the benchmark (no other position can begin a match), sorted by the next
``window`` words. Every suffix of every benchmark item is looked up in it by binary search; the
range it finds are the verbatim occurrences, and occurrences that continue each other become one
longest match with its place in the document and in the item.

The benchmark's windows are made in tasks, in blocks of about ``BLOCK_WORDS`` words that are written
to the shared folder. The driver holds one finished block at a time and broadcasts it; a larger
benchmark means more passes over the documents, whose matches are written and put together.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import LETTERS, ranges, split_words, text_slices
from riskloom.sources.scratch import save_scratch

WINDOW = 13
BLOCK_WORDS = 500_000
_SHARD_BYTES = 8 << 20
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # LETTERS, before A-Z are folded

MATCHES = "array<struct<item_id:bigint,doc_start:bigint,item_start:bigint,n_words:bigint>>"


@dataclass(frozen=True)
class Block:
    """Benchmark suffixes of at most ``window`` words, as sorted keys of big-endian word numbers."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place + 1, 0 is any other word
    heads: np.ndarray  # sorted hashes of the first ``head`` words of the suffixes
    head: int
    low: np.ndarray  # distinct windows, filled up with the smallest bytes
    high: np.ndarray  # the same, filled up with the largest
    lengths: np.ndarray
    uses: np.ndarray  # for each window its (item, start) pairs: uses[first[k]:first[k + 1]]
    first: np.ndarray


def _head_hash(hashes: np.ndarray, at: np.ndarray, head: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(head):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[at + j]
    return out


def _keys(numbers: np.ndarray, fill: int) -> np.ndarray:
    """Rows of word numbers (-1: nothing) as byte strings that sort like the rows."""
    wide = np.where(numbers < 0, fill, numbers).astype(">u4")
    return np.ascontiguousarray(wide).view(f"S{4 * numbers.shape[1]}").ravel()


def build_block(items: np.ndarray, texts: pa.Array, window: int = WINDOW) -> Block:
    """The windows of some benchmark items; an item of fewer words is one window."""
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, buf, offsets in text_slices(texts):
        found = split_words(buf, offsets, LETTERS)
        parts.append(found.hashes)
        counts.append(found.counts())
    hashes, counts = np.concatenate(parts), np.concatenate(counts)
    first = np.cumsum(counts) - counts
    vocabulary = np.unique(hashes)
    starts = np.where(counts > 0, np.maximum(counts - window, 0) + 1, 0)  # windows of each item
    item = np.repeat(np.arange(len(counts)), starts)
    at = ranges(first, starts)
    near = at[:, None] + np.arange(window)
    inside = near < (first + counts)[item][:, None]
    words = np.searchsorted(vocabulary, hashes).astype(np.int64) + 1
    numbers = np.where(inside, words[np.where(inside, near, 0)], -1) if len(at) else np.zeros((0, window), np.int64)
    head = min(3, window, int(counts[counts > 0].min(initial=3)))
    low = _keys(numbers, 0)
    order = np.argsort(low, kind="stable")  # numbers begin at 1, so a shorter window has a key of its own
    new = np.append(True, low[order][1:] != low[order][:-1])[: len(order)]
    distinct = numbers[order[new]]
    return Block(
        vocabulary,
        np.unique(_head_hash(hashes, at, head)),
        head,
        _keys(distinct, 0),
        _keys(distinct, 0xFFFFFFFF),
        (distinct >= 0).sum(1),
        np.stack([items[item], at - first[item]], 1).astype(np.int64)[order],
        np.append(np.flatnonzero(new), len(order)),
    )


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which values of ``x`` are in ``sorted_values``; a bit table settles most of them."""
    bits = np.zeros(1 << 20, bool)
    bits[(sorted_values >> np.uint64(44)).astype(np.int64)] = True
    out = bits[(x >> np.uint64(44)).astype(np.int64)]
    maybe = np.flatnonzero(out)
    place = np.minimum(np.searchsorted(sorted_values, x[maybe]), len(sorted_values) - 1)
    out[maybe] = sorted_values[place] == x[maybe]
    return out


def shard_matches(block: Block, buf: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and matches (text, item, word in text, word in item, length) in a shard."""
    words = split_words(buf, offsets, LETTERS)
    none = np.zeros((0, 5), np.int64)
    if not len(block.low) or len(words.hashes) < block.head:
        return words.counts(), none
    known = _member(block.vocabulary, words.hashes)
    run = np.arange(len(known) - block.head + 1)
    for j in range(block.head):
        run = run[known[run + j]]
    text = np.repeat(np.arange(len(offsets) - 1), words.counts())
    run = run[text[run] == text[run + block.head - 1]]
    run = run[_member(block.heads, _head_hash(words.hashes, run, block.head))] if len(run) else run
    if not len(run):
        return words.counts(), none
    # the suffix array: positions in the order of the words that follow
    near = run[:, None] + np.arange(window)
    inside = near < words.first[text[run] + 1][:, None]
    near = np.where(inside, near, 0)
    number = np.minimum(np.searchsorted(block.vocabulary, words.hashes[near]), len(block.vocabulary) - 1)
    number = np.where(inside & (block.vocabulary[number] == words.hashes[near]), number + 1, 0)
    keys = _keys(number, 0)
    order = np.argsort(keys, kind="stable")
    keys, suffixes = keys[order], run[order]
    lo, hi = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return words.counts(), none
    place = suffixes[ranges(lo[found], hi[found] - lo[found])]
    which = np.repeat(found, hi[found] - lo[found])
    users = block.first[which + 1] - block.first[which]
    uses = block.uses[ranges(block.first[which], users)]
    place, length = np.repeat(place, users), np.repeat(block.lengths[which], users)
    item, item_word, in_text = uses[:, 0], uses[:, 1], text[place]
    doc_word = place - words.first[in_text]
    # occurrences on one diagonal, each a word further, are one match
    diagonal = doc_word - item_word
    order = np.lexsort((doc_word, diagonal, item, in_text))
    same = np.zeros(len(order), bool)
    same[1:] = (doc_word[order][1:] - doc_word[order][:-1] <= 1) & np.all(
        [x[order][1:] == x[order][:-1] for x in (diagonal, item, in_text)], axis=0
    )
    begin = np.flatnonzero(~same)
    end = np.append(begin[1:], len(order)) - 1
    b, e = order[begin], order[end]
    return words.counts(), np.stack([in_text[b], item[b], doc_word[b], item_word[b], doc_word[e] + length[e] - doc_word[b]], 1)


def _build(window: int):
    def build(table: pa.Table) -> pa.Table:
        block = build_block(table["item_id"].to_numpy(), table["text"], window)
        data = io.BytesIO()
        np.savez(data, **vars(block))
        return pa.table({"block": table["block"][:1].cast(pa.int32()), "data": pa.array([data.getvalue()], pa.binary())})

    return build


def _blocks(benchmark: DataFrame, block_words: int, window: int) -> Iterator[Block]:
    """Blocks of whole items, built in tasks and read one after another; an empty one if there are no items.

    Items are dealt by their hash to as many blocks as fill them to four fifths of ``block_words`` on
    average, or to a single one. Items aren't cut, so one of more words makes a larger block.
    """
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").where("item_id IS NOT NULL AND text <> ''").distinct()
    words = items.agg(F.sum(F.regexp_count("text", F.lit(_WORD)))).first()[0] or 0
    n = 1 if words <= block_words else math.ceil(1.25 * words / block_words)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    built = save_scratch(dealt.groupBy("block").applyInArrow(_build(window), "block int, data binary"), "benchmark-blocks")
    found = False
    for k in range(n):
        for row in built.where(F.col("block") == k).collect():  # one row
            with np.load(io.BytesIO(row["data"])) as arrays:
                block = Block(**{f: arrays[f] for f in arrays.files} | {"head": int(arrays["head"])})
            found = True
            yield block
    if not found:
        yield build_block(np.zeros(0, np.int64), pa.array([], pa.string()), window)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row its words and its longest verbatim matches with benchmark items.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored. A null
    or empty text has no words and no matches, an item without an id or words is never found, and
    repeated rows are each answered. Returns doc_id, copy (hash of the text), n_words, n_hit (words inside any occurrence
    of a window) and matches (item, first word in the document and in the item, length).
    """
    spark = docs.sparkSession
    schema = f"doc_id bigint, copy bigint, n_words bigint, n_hit bigint, matches {MATCHES}"
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    blocks, parts = _blocks(benchmark, block_words, window), []
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(block)
        found = texts.mapInArrow(_finder(shared, window), schema)
        if following is None and not parts:
            return found
        parts.append(save_scratch(found, "matches"))
        shared.destroy()
        block = following
    both = parts[0]
    for x in parts[1:]:
        both = both.unionAll(x)
    merged = both.groupBy("doc_id", "copy").agg(
        F.first("n_words").alias("n_words"),
        (F.count("*") / len(parts)).cast("int").alias("rows"),
        F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"),
    )
    each = F.explode(F.sequence(F.lit(1), "rows")).alias("row")
    return merged.select("doc_id", "copy", "n_words", _covered("matches").alias("n_hit"), "matches", each).drop("row")


def _covered(matches: str):
    """Words covered by at least one of the matches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["doc_start"].alias("s"), (m["doc_start"] + m["n_words"]).alias("e"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("sum"))
    return F.aggregate(
        spans,
        zero,
        lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["sum"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("sum")),
        lambda a: a["sum"],
    )


def _finder(shared, window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for lo, hi, buf, offsets in text_slices(batch.column("text"), _SHARD_BYTES):
                counts, found = shard_matches(block, buf, offsets, window)
                n_hit = np.zeros(hi - lo, np.int64)
                if len(found):
                    base = np.concatenate([[0], np.cumsum(counts)])
                    edge = np.zeros(base[-1] + 1, np.int64)
                    np.add.at(edge, base[found[:, 0]] + found[:, 2], 1)
                    np.add.at(edge, base[found[:, 0]] + found[:, 2] + found[:, 4], -1)
                    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
                    n_hit = covered[base[1:]] - covered[base[:-1]]
                each = np.concatenate([[0], np.cumsum(np.bincount(found[:, 0], minlength=hi - lo))]).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(found[:, j]) for j in (1, 2, 3, 4)], ["item_id", "doc_start", "item_start", "n_words"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("copy").slice(lo, hi - lo),
                        pa.array(counts.astype(np.int64)),
                        pa.array(n_hit.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(each), rows),
                    ],
                    ["doc_id", "copy", "n_words", "n_hit", "matches"],
                )

    return find


def contaminated(n_hit="n_hit", n_words="n_words"):
    """At least a twentieth of the document's words is benchmark text."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns, which may have any names.

    Every row is judged by its own text, also where rows share a doc_id or have none.
    """
    bad = benchmark_matches(docs, benchmark).where(contaminated()).select("doc_id", "copy").distinct()
    name = "contaminated_key"
    while name in docs.columns:
        name += "_"
    key = F.struct(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("copy"))
    return docs.join(bad.select(F.struct("doc_id", "copy").alias(name)), key == F.col(name), "left_anti")
