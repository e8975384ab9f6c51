"""Exact duplicates by composable polynomial fingerprints, confirmed chunk by chunk.

1. White space runs become one space. A text of at most CHUNK bytes gets its fingerprint where it is
   read, a longer one is cut into chunks that are dealt to all tasks. A chunk's fingerprint is a pair of
   polynomial hashes, its length and the powers of the bases at that length; two neighbours combine to
   ``left * base ** length(right) + right``, so a document's fingerprint is folded from those of its
   chunks, wherever they were computed, and doesn't depend on how it was cut.
2. Texts with equal fingerprints are candidates, nothing more. The one with the smallest doc_id leads,
   and the chunks of all others are joined with the leader's and compared byte by byte, a pair of
   chunks at a time. Large groups are dealt to slices, each with its own copy of the leader's chunks.
3. Texts that differ from their leader, which takes a collision, get a leader among themselves, until
   none is left over. So groups are exact whatever the fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import WHITE, text_slices
from riskloom.sources.scratch import save_scratch

CHUNK = 64 << 10  # bytes of normalised text
SLICE = 512  # rows of a group that are compared with one copy of its leader
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_027)
_READ = 1 << 20  # bytes of a long text that are normalised at a time
_SEND = 4 << 20  # bytes of chunks in a batch

_IS_WHITE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(WHITE, np.uint8))
_PRINT = ["h1", "h2", "length"]
_CUT = "row bigint, doc_id bigint, copy bigint, sha256 string, no int, chunk binary, h1 bigint, h2 bigint, length bigint"
_PIECE = "row bigint, no int, h1 bigint, h2 bigint, s1 bigint, s2 bigint, length bigint, doc_id bigint, copy bigint, sha256 string"
_CHUNKS = "row bigint, doc_id bigint, copy bigint, h1 bigint, h2 bigint, length bigint, slices bigint, leads boolean, no int, chunk binary"


def powers(prime: int, base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) <= n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[: n + 1]


def chunk_hashes(buf: np.ndarray, offsets: np.ndarray, prime: int, power: np.ndarray) -> np.ndarray:
    """Polynomial hash of each of the chunks that lie one after another in ``buf``; empty ones have 0."""
    lengths = np.diff(offsets)
    out = np.zeros(len(lengths), np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        exponent = np.repeat(offsets[1:], lengths) - 1 - np.arange(len(buf))
        terms = power[exponent] * (buf.astype(np.uint64) + np.uint64(1))
        out[some] = np.add.reduceat(terms, offsets[some]) % np.uint64(prime)
    return out


def combine(left: tuple[int, int], right: tuple[int, int], prime: int, base: int) -> tuple[int, int]:
    """(hash, length) of two neighbours from theirs."""
    return (left[0] * pow(base, right[1], prime) + right[0]) % prime, left[1] + right[1]


def one_space(buf: np.ndarray, offsets: np.ndarray, after_white: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space for each white space run; ``after_white``: the first continues such a run."""
    white = _IS_WHITE[buf]
    again = np.zeros(len(buf) + 1, bool)
    again[1:] = white
    again[offsets[:-1]] = False
    again[0] = after_white
    keep = ~(white & again[:-1])
    out = buf[keep]
    out[white[keep]] = 0x20
    return out, np.concatenate([[0], np.cumsum(keep)])[offsets]


def chunks_of(text: np.ndarray, size: int) -> Iterator[bytes]:
    """Chunks of ``size`` bytes of the normalised text, the last one shorter; an empty text has an empty one."""
    rest, white = b"", False
    for lo in range(0, len(text), _READ):
        part = text[lo : lo + _READ]
        rest += one_space(part, np.array([0, len(part)]), white)[0].tobytes()
        white = bool(_IS_WHITE[part[-1]])
        full = len(rest) - len(rest) % size
        yield from (rest[k : k + size] for k in range(0, full, size))
        rest = rest[full:]
    if rest or not len(text):
        yield rest


def _read(size: int, primes: tuple[int, int]):
    """Fingerprints of the texts of one chunk; the chunks of longer ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(p, b, size) for p, b in zip(primes, BASES, strict=True)]
        names = [c.split()[0] for c in _CUT.split(", ")]
        for batch in batches:
            own = batch.select(["row", "doc_id", "copy"])
            for lo, hi, buf, offsets in text_slices(batch.column("text")):
                short = np.flatnonzero(np.diff(offsets) <= size)
                for k in np.setdiff1d(np.arange(hi - lo), short):
                    yield from _long(own.slice(lo + k, 1), buf[offsets[k] : offsets[k + 1]], size, names)
                if not len(short):
                    continue
                if len(short) < hi - lo:
                    buf = np.concatenate([buf[offsets[k] : offsets[k + 1]] for k in short])
                    offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[short])])
                text, edges = one_space(buf, offsets)
                data = memoryview(text.tobytes())
                shas = [hashlib.sha256(data[s:e]).hexdigest() for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                hashes = [chunk_hashes(text, edges, p, t).astype(np.int64) for p, t in zip(primes, tables, strict=True)]
                n = len(short)
                mine = own.take(pa.array(short + lo))
                columns = [*mine.columns, pa.array(shas), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *map(pa.array, hashes), pa.array(np.diff(edges))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return work


def _long(own: pa.RecordBatch, text: np.ndarray, size: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Chunk rows of one text; the last one has the digest."""
    sha, part, first = hashlib.sha256(), [], 0

    def batch(digest: str | None) -> pa.RecordBatch:
        n = len(part)
        columns = [pa.array(own.column(c).to_pylist() * n, pa.int64()) for c in range(3)]
        columns += [pa.array([None] * (n - 1) + [digest], pa.string()), pa.array(range(first, first + n), pa.int32()), pa.array(part, pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, *[pa.nulls(n, pa.int64())] * 3], names)

    for chunk in chunks_of(text, size):
        if len(part) * size >= _SEND:
            yield batch(None)
            first += len(part)
            part = []
        sha.update(chunk)
        part.append(chunk)
    yield batch(sha.hexdigest())


def _hash_chunks(size: int, primes: tuple[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(p, b, size) for p, b in zip(primes, BASES, strict=True)]
        for batch in batches:
            column = batch.column("chunk").cast(pa.large_binary())
            for lo, hi, buf, offsets in text_slices(column.view(pa.large_string())):
                lengths = np.diff(offsets)
                hashes = [pa.array(chunk_hashes(buf, offsets, p, t).astype(np.int64)) for p, t in zip(primes, tables, strict=True)]
                shifts = [pa.array(t[lengths].astype(np.int64)) for t in tables]
                own = [batch.column(c).slice(lo, hi - lo) for c in ("row", "no", "doc_id", "copy", "sha256")]
                yield pa.RecordBatch.from_arrays(
                    [own[0], own[1], *hashes, *shifts, pa.array(lengths), *own[2:]],
                    ["row", "no", "h1", "h2", "s1", "s2", "length", "doc_id", "copy", "sha256"],
                )

    return work


def _chunks(size: int):
    """A row for each chunk of each text, with the other columns as they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.drop_columns(["text"])
            which, no, chunks, held = [], [], [], 0

            def made(own=own) -> pa.RecordBatch:
                columns = [*own.take(pa.array(which, pa.int64())).columns, pa.array(no, pa.int32()), pa.array(chunks, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, [*own.schema.names, "no", "chunk"])

            for lo, hi, buf, offsets in text_slices(batch.column("text")):
                for k in range(hi - lo):
                    for i, chunk in enumerate(chunks_of(buf[offsets[k] : offsets[k + 1]], size)):
                        which.append(lo + k)
                        no.append(i)
                        chunks.append(chunk)
                        held += len(chunk)
                        if held >= _SEND:
                            yield made()
                            which, no, chunks, held = [], [], [], 0
            if which:
                yield made()

    return work


def fingerprints(docs: DataFrame, chunk: int = CHUNK, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """row (a number), doc_id, copy (hash of the text as it is), sha256, h1, h2 and length of every row.

    ``sha256``, ``length`` (bytes) and the hashes h1 and h2 are those of the normalised text.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    cut = save_scratch(texts.mapInArrow(_read(chunk, primes), _CUT), "cut")
    out = ["row", "doc_id", "copy", "sha256", *_PRINT]
    pieces = cut.where("chunk IS NOT NULL").repartition("row", "no").mapInArrow(_hash_chunks(chunk, primes), _PIECE)
    folded = pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("copy").alias("copy"),
        F.max("sha256").alias("sha256"),
        F.array_sort(F.collect_list(F.struct("no", "h1", "h2", "s1", "s2", "length"))).alias("pieces"),  # a row per CHUNK bytes
    )

    def shifted(k: int):
        return F.aggregate("pieces", F.lit(0).cast("bigint"), lambda h, x: (h * x[f"s{k}"] + x[f"h{k}"]) % F.lit(primes[k - 1]))

    length = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, x: n + x["length"])
    folded = folded.select("row", "doc_id", "copy", "sha256", shifted(1).alias("h1"), shifted(2).alias("h2"), length.alias("length"))
    return save_scratch(cut.where("chunk IS NULL").select(*out).unionAll(folded.select(*out)), "prints")


def _least(*more: str):
    """Order of the rows of a group: rows without a doc_id come last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *more))


def _led(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of the groups that hold more than one, with the number of slices and whether they lead."""
    groups = save_scratch(rows.groupBy(*_PRINT).agg(_least(*key).alias("lead"), F.count("*").alias("size")).where("size > 1"), "groups")
    leads = reduce(and_, [F.col(c).eqNullSafe(F.col(f"lead.{c}")) for c in ("doc_id", *key)])
    return rows.join(groups, _PRINT).select(*rows.columns, F.ceil(F.col("size") / SLICE).alias("slices"), leads.alias("leads"))


def _candidates(docs: DataFrame, prints: DataFrame, chunk: int) -> DataFrame:
    """Chunks of all texts whose fingerprint stands more than once; ``row`` numbers these texts."""
    some = _led(prints.select("doc_id", "copy", *_PRINT), "copy").distinct()
    own = some.select(F.struct("doc_id", "copy").alias("key"), *_PRINT, "slices", "leads")  # in a struct, a null doc_id meets its own
    texts = docs.select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("copy")).alias("key"), "text")
    # they meet by shuffle at every size: what a broadcast would hold grows with the data
    texts = texts.join(save_scratch(own, "some").hint("merge"), "key").select(F.monotonically_increasing_id().alias("row"), "key.*", *_PRINT, "slices", "leads", "text")
    return save_scratch(texts.mapInArrow(_chunks(chunk), _CHUNKS), "chunks")


def _compared(chunks: DataFrame) -> DataFrame:
    """doc_id, copy, fingerprint and whether the text equals its leader's, for all texts."""
    leaders = chunks.where("leads").groupBy(*_PRINT, "no").agg(F.min_by("chunk", "row").alias("lead_chunk"), F.first("slices").alias("slices"))
    leaders = leaders.select(*_PRINT, "no", "lead_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"))
    others = chunks.withColumn("slice", F.pmod(F.xxhash64("row"), "slices"))
    met = others.join(leaders, [*_PRINT, "no", "slice"], "left")
    same = met.select("doc_id", "copy", *_PRINT, F.col("chunk").eqNullSafe(F.col("lead_chunk")).alias("same"))
    return save_scratch(same.groupBy("doc_id", "copy", *_PRINT).agg(F.min("same").alias("same")), "compared")


def exact_duplicates(docs: DataFrame, chunk: int = CHUNK, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """The group of equal texts of every row, and whether the row stays.

    ``docs`` has doc_id and text; other columns are ignored. Texts are equal when they are after each
    white space run has become one space; a null text is empty, and texts of nothing but white space
    equal each other. Of equal texts one row stays: that with the smallest doc_id, of rows that share
    it any one; rows without a doc_id stay only where no equal text has one. ``keep_id`` is the doc_id
    of the row that stays, null where it has none. An empty table gives no rows.
    Returns doc_id, copy (hash of the text as it is), keep_id, group_size, kept and sha256 (hex, of the
    normalised text).
    """
    prints = fingerprints(docs, chunk, primes)
    chunks = _candidates(docs, prints, chunk)
    identity = F.struct("doc_id", "copy", *_PRINT).alias("identity")
    apart, turn = None, 0
    while True:
        differ = _compared(chunks).where("NOT same").select(identity)
        turn += 1
        if not differ.head(1):
            break
        # what differs from its leader is a class of its own from here on; a later turn may split it again
        apart = differ.withColumn("class", F.lit(turn)) if apart is None else apart.unionAll(differ.withColumn("class", F.lit(turn)))
        chunks = chunks.withColumn("identity", identity).join(differ, "identity", "left_semi").drop("identity", "slices", "leads")
        led = _led(chunks.where("no = 0").select("row", "doc_id", "copy", *_PRINT), "copy")
        chunks = save_scratch(chunks.join(led.select("row", "slices", "leads"), "row"), "chunks")
    rows = prints.withColumn("class", F.lit(0))
    if apart is not None:
        last = apart.groupBy("identity").agg(F.max("class").alias("class"))
        rows = prints.withColumn("identity", identity).join(last, "identity", "left").drop("identity").fillna(0, "class")
    key = [*_PRINT, "class"]
    groups = rows.groupBy(*key).agg(_least("row").alias("keep"), F.count("*").alias("group_size")).where("group_size > 1")
    out = rows.join(save_scratch(groups, "groups"), key, "left")  # written, so that a hot group's side can be split
    return out.select(
        "doc_id",
        "copy",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep.row"), F.lit(True)).alias("kept"),
        "sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns, which may have any names."""
    judged = exact_duplicates(docs).groupBy("doc_id", "copy").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    judged = save_scratch(judged.where("NOT kept OR rows > 1"), "judged")
    key = F.struct(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("copy"))
    name = "exact_key"
    while name in docs.columns:
        name += "_"
    some = lambda condition: judged.where(condition).select(F.struct("doc_id", "copy").alias(name))
    alone = docs.join(some("TRUE"), key == F.col(name), "left_anti")
    repeated = docs.join(some("kept"), key == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"])
    return alone.unionAll(repeated)
