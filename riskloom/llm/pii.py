"""Personal data: base patterns, and terms that reveal what they found.

1. Tasks find e-mail addresses, IP addresses, card and phone numbers. Each value is a protected
   entity; all words of its document are its context, however far away.
2. Spark counts in how many documents a term stands with an entity (n_te) and, over the words of all
   texts, in how many it occurs at all (n_t). Who reads the term knows the entity up to -log2(p) bits,
   where p is the share of the term's documents that hold the entity. p is taken at its lower confidence
   bound (Wilson, Z), so few documents count for less than many, and chance for little: one document of
   two proves nothing, a word of one document leaves less than two bits open. A term that leaves at most
   DISCLOSURE bits is disclosing; the bar doesn't move with the number of documents.
3. Disclosing terms become spans. Sanitising replaces base values by their kind, removes terms that
   leave REMOVE bits or less and generalises the others to what they are.

Copies of a text are gathered before its words are paired with entities, and entities that stand in
the same texts are one: their counts are equal. So a long list of values that stand nowhere else
makes as many pairs as a single one.

The terms to look up in all texts are sent to the tasks as a bit table, sized by their number up to a
limit; what it lets through by chance is dropped by an exact join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import LETTERS, mix, split_words, text_slices
from riskloom.sources.scratch import save_scratch

KINDS = ["email", "ip", "card", "phone", "term"]
Z = 1.645  # one-sided 95 %
DISCLOSURE = 2.0  # bits of the entity that stay open
REMOVE = 1.0
TABLE_BITS = (16, 28)  # the least and the largest table: 8 KB and 32 MB

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

SPAN = "struct<kind:string,start:bigint,end:bigint,action:string>"
_FOUND = f"doc_id bigint, copy bigint, spans array<{SPAN}>, entities array<bigint>, terms array<bigint>"
_COUNTS = "term bigint, n bigint"
_SEEN = "doc_id bigint, copy bigint, term bigint, start bigint, end bigint, digits boolean"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in code points, by kind, then start. Linear in the text."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) < 3 or len(x) == 3 and int(x) <= 255 for x in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return out


def _entity(kind: str, value: str) -> int:
    """One number for the spellings of one value."""
    plain = value.lower() if kind in ("email", "ip") else _NO_DIGIT.sub("", value)
    code = np.frombuffer(f"{kind}:{plain}".encode(), np.uint8).astype(np.uint64)
    h = np.zeros(1, np.uint64)
    for c in code:
        h = mix(h + c + np.uint64(1))
    return int(h.view(np.int64)[0])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, entities, terms = [], [], []
        for lo, hi, buf, offsets in text_slices(batch.column("text")):
            words = None
            texts = batch.column("text").slice(lo, hi - lo).to_pylist()
            for d, text in enumerate(texts):
                found = base_spans(text) if text else []
                spans.append([{"kind": k, "start": s, "end": e, "action": "replace"} for k, s, e in found])
                entities.append(sorted({_entity(k, text[s:e]) for k, s, e in found}))
                if found and words is None:
                    words = split_words(buf, offsets, LETTERS)
                terms.append(_terms(text, found, int(offsets[d]), words, d) if found else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("copy"),
                pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("action", pa.string())]))),
                pa.array(entities, pa.list_(pa.int64())),
                pa.array(terms, pa.list_(pa.int64())),
            ],
            ["doc_id", "copy", "spans", "entities", "terms"],
        )


def _terms(text: str, found: list[tuple[str, int, int]], offset: int, words, d: int) -> np.ndarray:
    """The words of a text, but those inside any entity."""
    lo, hi = int(words.first[d]), int(words.first[d + 1])
    starts, ends, hashes = words.starts[lo:hi] - offset, words.ends[lo:hi] - offset, words.hashes[lo:hi].view(np.int64)
    places = np.array(sorted({p for _, s, e in found for p in (s, e)}))
    pieces = [text[a:b] for a, b in zip([0, *places[:-1]], places, strict=True)]
    at = dict(zip(places.tolist(), np.cumsum([len(x.encode()) for x in pieces]).tolist(), strict=True))
    free = np.ones(len(starts), bool)
    for _, s, e in found:
        free[np.searchsorted(ends, at[s], "right") : np.searchsorted(starts, at[e], "left")] = False
    return np.unique(hashes[free])


def _hits(table: np.ndarray, batch: pa.RecordBatch) -> Iterator[tuple]:
    """Words that the bit table lets through: first row, bytes, offsets, words, numbers of the words, their rows."""
    shift = np.uint64(64 - (len(table) - 1).bit_length())
    for lo, _, buf, offsets in text_slices(batch.column("text")):
        words = split_words(buf, offsets, LETTERS)
        hit = np.flatnonzero(table[(words.hashes >> shift).astype(np.int64)])
        if len(hit):
            yield lo, buf, offsets, words, hit, np.searchsorted(words.first, hit, "right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a batch's documents each word occurs."""
    for batch in batches:
        found = [np.zeros(0, np.int64)]
        for _, _, buf, offsets in text_slices(batch.column("text")):
            words = split_words(buf, offsets, LETTERS)
            term, number = np.unique(words.hashes, return_inverse=True)
            row = np.repeat(np.arange(len(offsets) - 1), words.counts())
            pairs = np.unique(row * max(len(term), 1) + number.ravel())
            found.append(term[pairs % max(len(term), 1)].view(np.int64))
        terms, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n.astype(np.int64))], ["term", "n"])


def _look_up(shared):
    """Where the terms stand, in code points."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for lo, buf, offsets, words, hit, row in _hits(table, batch):
                point = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # code points before each byte
                base = point[offsets[row]]
                digit = (buf[words.starts[hit]] >= 0x30) & (buf[words.starts[hit]] <= 0x39)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(pa.array(lo + row)) for c in ("doc_id", "copy")),
                        pa.array(words.hashes[hit].view(np.int64)),
                        pa.array((point[words.starts[hit]] - base).astype(np.int64)),
                        pa.array((point[words.ends[hit]] - base).astype(np.int64)),
                        pa.array(digit),
                    ],
                    ["doc_id", "copy", "term", "start", "end", "digits"],
                )

    return work


def _bit_table(terms: DataFrame) -> bytes:
    """A table with one bit set for each term, 16 bits a term or more as far as the limit allows."""
    least, most = TABLE_BITS
    bits = min(most, max(least, (16 * terms.count()).bit_length()))
    bit = F.shiftrightunsigned("term", 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))
    cells = terms.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(one).alias("bits"))
    table = np.zeros((1 << bits) // 64, np.int64)
    for cell, value in cells.toLocalIterator():
        table[cell] = value
    return table.tobytes()


def _beside(found: DataFrame) -> DataFrame:
    """(entity, n_e, term, n_te) for every term that stands in a text with an entity.

    Of entities that stand in the same texts, the first stands for all.
    """
    held = found.where(F.size("entities") > 0)
    copies = held.groupBy("copy").agg(F.count("*").alias("docs"))
    texts = save_scratch(held.select("copy", "entities", "terms").dropDuplicates(["copy"]).join(copies, "copy"), "held")
    of_entity = texts.select("copy", "docs", F.explode("entities").alias("entity"))
    alike = [F.sum("docs").alias("n_e"), F.count("*").alias("texts"), F.bit_xor("copy").alias("own")]
    first = of_entity.groupBy("entity").agg(*alike).groupBy("n_e", "texts", "own").agg(F.min("entity").alias("entity"))
    chosen = of_entity.join(first.select("entity", "n_e"), "entity").groupBy("copy").agg(F.collect_list(F.struct("entity", "n_e")).alias("chosen"))
    pairs = texts.join(chosen, "copy").select("docs", "terms", F.explode("chosen").alias("one")).select("docs", "one", F.explode("terms").alias("term"))
    return pairs.groupBy("one.entity", "one.n_e", "term").agg(F.sum("docs").alias("n_te"))


def bits_left(n_te: Column, n_t: Column) -> Column:
    """What stays open of an entity for who reads a term: -log2 of the lower bound of its share of n_te / n_t."""
    p, n, z = n_te / n_t, n_t, F.lit(Z)
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return -F.log2(bound)


def disclosing_terms(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(term, left): terms that give an entity away, and how many of its bits they leave open.

    Of a term's entities the one that it stands with most often counts. Both sides are summed up by term
    before they meet, so a word beside very many entities is one row.
    """
    docs = found.count()
    beside = _beside(found).where(F.col("n_e") < docs).groupBy("term").agg(F.max("n_te").alias("n_te"))
    of_term = texts.select("text").mapInArrow(_count, _COUNTS).groupBy("term").agg(F.sum("n").alias("n_t"))
    both = save_scratch(beside, "beside").join(of_term, "term")
    left = both.select("term", bits_left(F.col("n_te"), F.col("n_t")).alias("left"))
    return left.where(F.col("left") <= DISCLOSURE)


def personal_spans(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every document row: doc_id, copy (hash of the text) and spans.

    ``docs`` has doc_id and text; other columns are ignored. A null or empty text has none. Spans are
    in code points, the end exclusive; base kinds may overlap each other, terms are never inside one.
    Every row is judged by its own text, repeated rows get the same spans.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    found = save_scratch(texts.mapInArrow(_find, _FOUND), "personal")
    told = save_scratch(disclosing_terms(texts, found), "disclosing")
    shared = spark.sparkContext.broadcast(_bit_table(told))
    terms = texts.mapInArrow(_look_up(shared), _SEEN).join(told, "term")
    action = F.when(F.col("left") <= REMOVE, "remove").when(F.col("digits"), "number").otherwise("word")
    span = F.struct(F.lit("term").alias("kind"), "start", "end", action.alias("action"))
    # a set, because repeated rows find theirs again; nothing keeps a word of very many places in one task
    terms = terms.groupBy("doc_id", "copy").agg(F.array_sort(F.collect_set(span)).alias("terms"))
    right = terms.select(F.struct("doc_id", "copy").alias("key"), "terms")
    rows = found.drop("entities", "terms").join(right, F.struct("doc_id", "copy").eqNullSafe(F.col("key")), "left")
    own = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return rows.select("doc_id", "copy", F.concat("spans", F.coalesce(own, F.array().cast(f"array<{SPAN}>"))).alias("spans"))


def _replaced(spans_column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(spans_column).to_pylist(), strict=True):
                parts, at = [], 0
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["end"] <= at:
                        continue
                    if s["start"] >= at:
                        parts.append(text[at : s["start"]])
                        if s["action"] != "remove":
                            parts.append(f"[{(s['kind'] if s['action'] == 'replace' else s['action']).upper()}]")
                    at = s["end"]
                out.append("".join([*parts, text[at:]]) if spans else text)
            names = [c for c in batch.schema.names if c != spans_column]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    return work


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with their spans replaced, generalised or removed; all columns, n_chars follows the text.

    Other columns may have any names.
    """
    mark = "_" * max(len(c) for c in docs.columns)  # longer than any name of the table with it
    name_key, name_spans = f"personal_key{mark}", f"personal_spans{mark}"
    some = personal_spans(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "copy"])
    right = some.select(F.struct("doc_id", "copy").alias(name_key), F.col("spans").alias(name_spans))
    key = F.struct(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("copy"))
    rows = docs.join(right, key.eqNullSafe(F.col(name_key)), "left").drop(name_key)
    out = rows.mapInArrow(_replaced(name_spans), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
