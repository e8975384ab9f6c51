"""Positions of rows within their key, without gathering a key in one task.

Rows are dealt to ranges of (key, order), so a key of any size spreads over tasks. What has to meet
per key is one small row for each range that the key touches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.scratch import save_scratch

_PREFIX = 32  # code points of a text that help to find the ranges; ranges are sampled by the driver
_GROUP = 1024  # rows that are run through together


def in_order(rows: DataFrame, key: str, order: Sequence[str], texts: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Rows with ``at``, which rises with (key, order, texts); nulls come first. Without the columns ``drop``.

    Only rows that are equal in key and order and in the beginnings of the texts are sure to be together.
    """
    columns = [F.col(c).asc_nulls_first() for c in (key, *order)]
    begins = [F.substring(c, 1, _PREFIX).asc_nulls_first() for c in texts]
    ranged = rows.repartitionByRange(*columns, *begins).sortWithinPartitions(*columns, *[F.col(c).asc_nulls_first() for c in texts])
    return save_scratch(ranged.withColumn("at", F.monotonically_increasing_id()).drop(*drop), "ordered")


def positions(ordered: DataFrame, key: str) -> DataFrame:
    """The rows of ``in_order`` with ``pos``, 1 for the first of a key. Keys aren't null."""
    part = F.shiftright("at", 33)
    parts = ordered.withColumn("part", part)
    runs = parts.groupBy(key, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(key, "part", (F.coalesce(before, F.lit(0).cast("bigint")) - F.col("first") + 1).alias("shift"))
    return parts.join(runs, [key, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "shift")


def before_or_after(rows: DataFrame, key: str, step: str, columns: dict[str, Column], after: bool = False) -> DataFrame:
    """Rows with aggregates, by name, over the key's other rows of smaller (``after``: larger) ``step``.

    A key's rows are run through in groups of _GROUP steps; per key only the groups' results meet. Each
    aggregate is of the column of its name, and is null where there is no other row.
    """
    group = F.col(step).cast("bigint") / _GROUP
    rows = rows.withColumn("group", F.floor(group))
    whole = rows.groupBy(key, "group").agg(*[c.alias(name) for name, c in columns.items()])
    edge = (1, Window.unboundedFollowing) if after else (Window.unboundedPreceding, -1)
    over = Window.partitionBy(key).orderBy("group").rowsBetween(*edge)
    whole = whole.select(key, "group", *[c.over(over).alias(f"{name}_far") for name, c in columns.items()])
    near = Window.partitionBy(key, "group").orderBy(step).rowsBetween(*edge)
    kept = [c for c in rows.columns if c not in columns]
    both = rows.join(whole, [key, "group"])
    return both.select(*[c for c in kept if c != "group"], *columns, *[c.over(near).alias(f"{name}_near") for name, c in columns.items()], *[f"{name}_far" for name in columns])


def joined_sha256(rows: DataFrame, key: Sequence[str], order: Sequence[str], value: str, separator: str, name: str) -> DataFrame:
    """key and hex SHA-256 of each key's values, in order, joined by the separator.

    Values stream through the digest: a key meets in one task, but is never held.
    """
    dealt = rows.select(*key, *order, value).repartition(*key).sortWithinPartitions(*key, *order).select(*key, value)
    kinds = dealt.select(*key).schema
    mark = separator.encode()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha, schema = None, None, None
        for batch in batches:
            schema = pa.schema([*[batch.schema.field(c) for c in key], pa.field(name, pa.string())])
            out: list[tuple] = []
            for now, text in zip(zip(*[batch.column(c).to_pylist() for c in key], strict=True), batch.column(value).to_pylist(), strict=True):
                if now == own:
                    sha.update(mark + text.encode())
                    continue
                if sha is not None:
                    out.append((*own, sha.hexdigest()))
                own, sha = now, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*own, sha.hexdigest()), strict=True))], schema)

    return dealt.mapInArrow(work, kinds.add(name, "string"))
