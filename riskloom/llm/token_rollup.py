"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A store is a folder with four tables, each with one sub-folder per batch, named ``run=first-end``
by the batches that it holds:

* ``upserts``, ``changed``: counts of a batch's new and revised documents, so that they are counted
  once only, and the ids that it changes.
* ``ledger-B``: signed documents and tokens per document and tokenizer, in B buckets by the hash of
  doc_id. A document's count is the sum of its rows, so a delete adds their negative, and a revision
  that and the new count. A batch reads the buckets of its own ids only.
* ``rollup``: the same, added up by source, language and tokenizer. Totals are sums of it.

As soon as ``fanout`` batches, ``fanout`` times as many, and so on, are committed, their ledgers and
rollups are added up into one run. So n batches are read as at most fanout folders for each power of
fanout in n, and a row is written again once for each power. A run is derived from what it covers,
which stays: a missing one is replaced by its parts and made when its last batch is sent again.

A batch reads committed batches with smaller numbers only and replaces its own folders; it counts
once its rollup is complete. So a batch that broke off is repeated, and one that is committed is not
applied again: either way the totals are those of applying it once. A store has one writer at a time;
two that send the same batch at once are not kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.tokens import WORD_BPE, tokenizer_path, word_memo
from riskloom.llm.words import PLAIN, split_words, text_slices

GROUP = ["source", "lang", "tokenizer"]
#: Buckets of a new store's ledger, and how many runs make a longer one.
BUCKETS, FANOUT = 256, 16
_LEDGER = "doc_id bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint"


def _count(path: str, name: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo(path)
        for batch in batches:
            bpe, plain = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, buf, offsets in text_slices(batch.column("text")):
                bpe.append(np.diff(memo.encode(buf, offsets)[1]))
                plain.append(split_words(buf, offsets, PLAIN, hashed=False).counts())
            for tokenizer, counts in ((name, bpe), ("white-space-1", plain)):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array([tokenizer] * n), pa.array(np.ones(n, np.int64)), pa.array(np.concatenate(counts).astype(np.int64))],
                    ["doc_id", "source", "lang", "tokenizer", "docs", "tokens"],
                )

    return work


def token_counts(docs: DataFrame, tokenizer: str = WORD_BPE, path: str | None = None) -> DataFrame:
    """Tokens of every document by two tokenizer versions: a public file, and words between white space.

    A null text has none; rows that share a doc_id are each counted, and an empty table has no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "source", "lang", "text")
    return texts.mapInArrow(_count(path or tokenizer_path(tokenizer), tokenizer.split(".")[0]), _LEDGER)


class RollupStore:
    """Additive token totals in a folder that all executors share.

    An existing store keeps the number of ``buckets`` that it was begun with; ``fanout`` may change.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, fanout: int = FANOUT):
        if buckets < 1 or fanout < 2:
            raise ValueError("a store has at least one bucket and a fanout of at least two")
        self.spark, self.folder, self.fanout = spark, folder, fanout
        begun = [int(name.removeprefix("ledger-")) for name in self._names("") if name.startswith("ledger-")]
        self.buckets = begun[0] if begun else buckets
        self.ledger = f"ledger-{self.buckets}"

    def _at(self, place: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{place}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, place: str) -> list[str]:
        files, path = self._at(place)
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def _complete(self, table: str, first: int, end: int) -> bool:
        files, path = self._at(f"{table}/run={first}-{end}/_SUCCESS")
        return files.exists(path)

    def committed(self, batch: int) -> bool:
        return self._complete("rollup", batch, batch + 1)

    def _runs(self, table: str, first: int, end: int) -> list[str]:
        """The longest complete runs that cover the committed batches first .. end - 1."""
        out = []
        while first < end:
            widths, width = [1], self.fanout
            while first % width == 0 and first + width <= end:
                widths.append(width)
                width *= self.fanout
            width = next(w for w in reversed(widths) if w == 1 or self._complete(table, first, first + w))
            out.append(f"{first}-{first + width}")
            first += width
        return out

    def _read(self, table: str, runs: list[str]) -> DataFrame:
        fields = _LEDGER.split(", ", 1)[1] if table == "rollup" else "doc_id bigint" if table == "changed" else _LEDGER
        fields += ", bucket int" if table == self.ledger else ""
        if not runs:
            return self.spark.createDataFrame([], fields)
        files = self.spark.read.schema(f"{fields}, run string").option("basePath", f"{self.folder}/{table}")
        return files.parquet(*[f"{self.folder}/{table}/run={run}" for run in runs]).drop("run")

    def _bucket(self):
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write(self, table: str, first: int, end: int, rows: DataFrame) -> None:
        """Replace a folder; sums of the ledger go to its buckets, in files of an even size."""
        keys = {self.ledger: ["doc_id", *GROUP], "rollup": GROUP}.get(table)
        if keys:
            sums = [F.sum(c).alias(c) for c in ("docs", "tokens")]
            rows = rows.groupBy(*keys).agg(*sums).where("docs <> 0 OR tokens <> 0")
        if table == self.ledger:
            rows = rows.select("*", self._bucket()).hint("rebalance", "bucket")
        out = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy("bucket") if table == self.ledger else out).parquet(f"{self.folder}/{table}/run={first}-{end}")

    def _before(self, batch: int) -> DataFrame:
        """Ledger rows of the ids that a batch changes, from the buckets of these ids."""
        changed = self._read("changed", [f"{batch}-{batch + 1}"])
        touched = [r["bucket"] for r in changed.select(self._bucket()).distinct().collect()]  # at most one row a bucket
        rows = self._read(self.ledger, self._runs(self.ledger, 0, batch))
        return rows.where(F.col("bucket").isin(touched)).join(changed, "doc_id", "left_semi").drop("bucket")

    def _compact(self, batch: int) -> None:
        """Make the longer runs that end with a committed batch, as far as they are missing."""
        end, width = batch + 1, self.fanout
        while end % width == 0:
            for table in (self.ledger, "rollup"):
                if not self._complete(table, end - width, end):
                    parts = [r for w in range(end - width, end, width // self.fanout) for r in self._runs(table, w, w + width // self.fanout)]
                    self._write(table, end - width, end, self._read(table, parts))
            width *= self.fanout

    def apply(self, batch: int, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Commit batch number ``batch`` (0, 1, 2, ...); False if it was committed before.

        ``upserts`` has the columns of ``token_counts``: new and revised documents. ``deletes`` has
        doc_id. Rows of one batch that share a doc_id add up, and a later batch replaces them
        together; a null doc_id is only ever added. Null sources and languages are groups of their
        own. A delete of an unknown document and an empty batch change nothing.
        """
        if self.committed(batch):
            self._compact(batch)
            return False
        if batch and not self.committed(batch - 1):
            raise ValueError(f"batch {batch - 1} is not committed")
        upserts = self.spark.createDataFrame([], _LEDGER) if upserts is None else upserts
        new = upserts.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in _LEDGER.split(", ")])
        signed, this = new, [f"{batch}-{batch + 1}"]
        if batch:
            self._write("upserts", batch, batch + 1, new)
            new = self._read("upserts", this)
            ids = new.select("doc_id")
            ids = ids if deletes is None else ids.unionAll(deletes.select(F.col("doc_id").cast("bigint")))
            self._write("changed", batch, batch + 1, ids.where("doc_id IS NOT NULL").distinct())
            back = self._before(batch).select("doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
            signed = new.unionAll(back)
        self._write(self.ledger, batch, batch + 1, signed)
        self._write("rollup", batch, batch + 1, self._read(self.ledger, this))
        self._compact(batch)
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer over all committed batches."""
        ends = [int(name.split("-")[1]) for name in self._names("rollup")]
        end = max(ends, default=0)
        end -= bool(end) and not self.committed(end - 1)  # the last one may have broken off
        sums = self._read("rollup", self._runs("rollup", 0, end)).groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")
