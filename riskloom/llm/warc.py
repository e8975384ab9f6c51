"""WARC archives of pages, written and read by Spark, with payloads as a table of chunks.

Writing: each page is a ``response`` record, or a ``revisit`` of the response with the same payload.
Payloads of more than CHUNK code points go on in ``continuation`` records, the segments of the WARC
standard. Records are rows of Spark's text writer, so tasks write their archive files side by side
and a lost task's files are replaced whole.

Reading: Spark splits the archives at the line that begins a record, several tasks to a file. No
segment holds that line: a payload is also cut inside every place where it could be read. So a row is
one segment, and no task ever holds a whole oversized payload. ``read_chunks`` gives (record, chunk
number) rows in order, each with the digest and the length of the payload up to there: native for
records of one chunk, an incremental SHA-1 over the sorted stream of chunks for the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.scratch import save_scratch

CHUNK = 1 << 16
REVISIT_BYTES = 1000
FIRST_LINE = "WARC/1.1\r\n"
BETWEEN = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Places inside a payload where its end and the next bytes could be taken for a new record.
_CUT = "(?<=(?:^(?:\\r\\n)?|\\r\\n\\r\\n)WA)(?=RC/1\\.1)"
_CHUNKS = "record_id string, chunk_no int, chunk string, payload_digest string, payload_bytes bigint, last boolean"


def _segments(payload: Column, chunk: int) -> Column:
    plain = (F.length(payload) <= chunk) & ~F.contains(payload, F.lit("WARC/1.1"))
    parts = F.regexp_extract_all(payload, F.lit(f"[\\s\\S]{{1,{chunk}}}"), F.lit(0))
    return F.when(plain, F.array(payload)).otherwise(F.flatten(F.transform(parts, lambda p: F.split(p, _CUT))))


def _uri(url: Column) -> Column:
    """The url without characters that end a header line."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x20\\x7F]+", "%20")


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines of the fields that aren't null."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields])


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", chunk: int = CHUNK, least: int = REVISIT_BYTES) -> None:
    """Write one WARC record, or its segments, for every row of ``pages`` (page_id, url, html).

    A null html is an empty payload, a null url an empty one; other columns are ignored. Of rows with
    equal payloads of at least ``least`` bytes, those with the largest page_id are responses and the
    others revisit it; smaller ones and those without any page_id are responses. Repeated rows are
    records of their own. An empty table makes archives without records.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), _uri(F.col("url")).alias("uri"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("bigint"), "digest": F.sha1("payload")})
    again = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = save_scratch(again.drop("n"), "again")  # written, so that the join knows how small it is
    rows = rows.join(again, "digest", "left").withColumn("row", F.monotonically_increasing_id())
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("revisit", revisit).withColumn("segments", F.when(revisit, F.array(F.lit(""))).otherwise(_segments(F.col("payload"), chunk)))
    many = F.size("segments") > 1
    rows = rows.select("*", many.alias("many"), F.size("segments").alias("count"), F.posexplode("segments").alias("at", "part")).drop("payload", "segments")
    origin = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.col("row").cast("string"))
    record = F.concat(origin, F.when(F.col("at") > 0, F.concat(F.lit(":"), F.col("at").cast("string"))).otherwise(""), F.lit(">"))
    block = F.when(F.col("at") == 0, F.concat(F.lit(HTTP), F.col("part"))).otherwise(F.col("part"))
    kind = F.when(F.col("revisit"), "revisit").when(F.col("at") > 0, "continuation").otherwise("response")
    last = F.col("many") & (F.col("at") == F.col("count") - 1)
    header = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", record),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("uri")),
        ("Content-Type", F.when(F.col("at") == 0, "application/http; msgtype=response").otherwise("application/octet-stream")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Payload-Length", F.col("size")),
        ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        ("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))),
        ("WARC-Segment-Number", F.when(F.col("many"), F.col("at") + 1)),
        ("WARC-Segment-Origin-ID", F.when(F.col("at") > 0, F.concat(origin, F.lit(">")))),
        ("WARC-Segment-Total-Length", F.when(last, F.col("size") + len(HTTP))),
        ("Content-Length", F.octet_length(block)),
    )
    out = rows.select(F.concat(F.lit(FIRST_LINE), header, F.lit(BETWEEN), block).alias("value"))
    out.write.option("lineSep", BETWEEN).text(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives: its fields, and its part of the payload."""
    rows = spark.read.option("lineSep", BETWEEN + FIRST_LINE).schema("value string").text(folder)
    value = F.when(F.startswith("value", F.lit(FIRST_LINE)), F.substring("value", F.lit(len(FIRST_LINE) + 1), F.length("value"))).otherwise(F.col("value"))
    rows = rows.select(value.alias("value")).where("value <> ''")
    head = F.substring_index("value", BETWEEN, 1)
    rows = rows.select(head.alias("head"), F.substring("value", F.length(head) + len(BETWEEN) + 1, F.length("value")).alias("block"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", f"(?:^|\\r\\n){name}: ([^\\r\\n]*)", 1)
        return F.when(found != "", found)

    rows = rows.withColumns(
        {
            "kind": field("WARC-Type"),
            "id": field("WARC-Record-ID"),
            "origin": field("WARC-Segment-Origin-ID"),
            "segment": field("WARC-Segment-Number").cast("int"),
            "total": field("WARC-Segment-Total-Length").cast("bigint"),
            "length": field("Content-Length").cast("bigint"),
            "uri": field("WARC-Target-URI"),
            "stated_digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""),
            "stated_bytes": field("WARC-Payload-Length").cast("bigint"),
            "refers_to": F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), "<urn:page:(-?[0-9]+)>", 1),
        }
    )
    # the last record of a file also has the empty lines that end it
    block = F.when(F.octet_length("block") > F.col("length"), F.left("block", F.length("block") - len(BETWEEN))).otherwise(F.col("block"))
    part = F.when(F.col("segment") > 1, block).otherwise(F.substring(block, F.lit(len(HTTP) + 1), F.length(block)))
    page = F.regexp_extract("id", "^<urn:page:(-?[0-9]+):", 1)
    return rows.select(
        F.coalesce("origin", "id").alias("record_id"),
        F.when(page != "", page).cast("bigint").alias("page_id"),
        "kind",
        "uri",
        F.coalesce("segment", F.lit(1)).alias("chunk_no"),
        F.col("segment").isNotNull().alias("many"),
        (F.col("segment").isNull() | F.col("total").isNotNull()).alias("last"),
        part.alias("chunk"),
        "stated_digest",
        "stated_bytes",
        F.when(F.col("refers_to") != "", F.col("refers_to")).cast("bigint").alias("refers_to"),
    )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length of each payload up to each of its chunks, which come in order."""
    record, digest, size = None, None, 0
    for batch in batches:
        digests, sizes = [], []
        for own, chunk in zip(batch.column("record_id").to_pylist(), batch.column("chunk").cast(pa.binary()), strict=True):
            if own != record:
                record, digest, size = own, hashlib.sha1(usedforsecurity=False), 0
            digest.update(chunk.as_buffer())
            size += len(chunk.as_buffer())
            digests.append(digest.hexdigest())
            sizes.append(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), batch.column("chunk_no"), batch.column("chunk"), pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), batch.column("last")],
            ["record_id", "chunk_no", "chunk", "payload_digest", "payload_bytes", "last"],
        )


def read_chunks(segments: DataFrame) -> DataFrame:
    """Payloads of all responses as (record_id, chunk_no) rows, chunk_no from 1.

    payload_digest and payload_bytes are those of the payload up to that chunk; at the row marked
    ``last`` they are those of the whole payload.
    """
    parts = segments.where("kind IN ('response', 'continuation')")
    single = parts.where("NOT many").select("record_id", "chunk_no", "chunk", F.sha1("chunk").alias("payload_digest"), F.octet_length("chunk").cast("bigint").alias("payload_bytes"), "last")
    many = parts.where("many").select("record_id", "chunk_no", "chunk", "last")
    many = many.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return single.unionByName(many.mapInArrow(_running, _CHUNKS))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page of the archives: page_id, uri, payload_bytes, payload_digest, record_type, refers_to, intact.

    Digest and length are computed from the chunks read; for revisits they are the stated ones.
    ``intact`` tells whether they are what the record states.
    """
    segments = read_segments(spark, folder)
    whole = read_chunks(segments).where("last").select("record_id", "payload_digest", "payload_bytes")
    heads = segments.where("chunk_no = 1").select("record_id", "page_id", "uri", "kind", "stated_digest", "stated_bytes", "refers_to")
    rows = heads.join(whole, "record_id", "left")
    seen = F.col("kind") == "revisit"
    return rows.select(
        "page_id",
        "uri",
        F.when(seen, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(seen, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
        (seen | F.coalesce((F.col("payload_digest") == F.col("stated_digest")) & (F.col("payload_bytes") == F.col("stated_bytes")), F.lit(False))).alias("intact"),
    )
