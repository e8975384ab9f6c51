"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed. A line that occurs in many different texts of one host is that
host's furniture: it is removed, and a document of which most words go that way is rejected. Copies
of one text count once, so that a document doesn't fall because it was copied; removing copies is
another operator's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.sources.scratch import save_scratch

MIN_TEXTS = 10  # a line in fewer texts of its host always stays
HOST_PERCENT = 10  # and so does one in less than this share of the host's texts
MANY_TEXTS = 1_000  # in the pipeline, a line in so many texts goes whatever the share
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_REMOVED_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

WHITE = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def normalised(line: Column) -> Column:
    """Lower case, white space as one space. Digits stay: rows of numbers aren't one line."""
    return F.trim(F.regexp_replace(F.lower(line), WHITE, " "))


def repeat_words(words: str, grams: str, order: str) -> tuple[Column, Column, Column]:
    """Three steps, each on the columns of the one before: hashes of 3-word windows (``grams``), the same
    in order of hash (``order``, null if none repeats), words inside windows found twice or more.
    """
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0)))
    gram = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.when(F.size(words) >= 3, gram).otherwise(F.array().cast("array<bigint>"))
    numbered = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.array_sort(numbered))
    near = lambda x, k: F.coalesce(x["h"] == F.get(order, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(order, k + 1)["h"], F.lit(False))
    again = F.sort_array(F.transform(F.filter(order, near), lambda x: x["i"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    covered = F.aggregate(again, zero, lambda a, i: F.struct((i + 3).alias("end"), (a["sum"] + i + 3 - F.greatest(a["end"], i)).alias("sum")), lambda a: a["sum"])
    return windows, ordered, F.coalesce(covered, F.lit(0))


def base_measures(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    A null or empty text has no words and fails. The table's own columns of these names are replaced, all
    others stay, whatever they are called.
    """
    docs = docs.drop(*MEASURES, "base_failed")
    words, kept, grams, order = (_free(x, docs.columns) for x in ("words", "lines", "grams", "order"))
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]")))
    windows, ordered, covered = repeat_words(words, grams, order)
    out = docs.withColumns({words: words_of(text), kept: lines}).withColumn(grams, windows).withColumn(order, ordered)
    long = lambda x: x.cast("bigint")
    measures = F.struct(
        long(F.size(words)).alias("n_words"),
        long(F.length(F.array_join(words, ""))).alias("word_chars"),
        long(F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).alias("n_symbols"),
        long(F.size(kept) - F.size(F.array_distinct(kept))).alias("n_dup_lines"),
        long(covered).alias("n_repeat_words"),
    )
    # by way of a generator: a filter on a measure would otherwise be pushed below and computed per word
    out = out.select(*[docs[c] for c in docs.columns], F.inline(F.array(measures)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _free(name: str, taken: list[str]) -> str:
    """A name for a working column that the table doesn't have."""
    while name in taken:
        name += "_"
    return name


def host_lines(docs: DataFrame) -> DataFrame:
    """Lines of each host's texts: host, copy (hash of the text), line number, hash and words, in the shared folder.

    A null source is the host ''; lines without words are left out; copies of a text are one.
    """
    line = F.posexplode(F.split("text", "\n", -1)).alias("at", "raw")
    rows = docs.select(F.coalesce("source", F.lit("")).alias("host"), F.xxhash64("text").alias("copy"), line)
    rows = rows.withColumn("line", normalised(F.col("raw"))).where("line <> ''")
    words = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    return save_scratch(rows.select("host", "copy", "at", F.xxhash64("line").alias("hash"), words.alias("words")).distinct(), "lines")


def frequent_lines(lines: DataFrame, min_texts: int = MIN_TEXTS, percent: int = HOST_PERCENT, many: int | None = None) -> DataFrame:
    """(host, hash) of the lines in too many different texts of their host: by share, or ``many`` at least."""
    per_line = lines.groupBy("host", "hash").agg(F.count_distinct("copy").alias("texts")).where(F.col("texts") >= min_texts)
    per_host = lines.groupBy("host").agg(F.count_distinct("copy").alias("all_texts"))
    frequent = 100 * F.col("texts") >= percent * F.col("all_texts")
    if many is not None:
        frequent = frequent | (F.col("texts") >= many)
    return per_line.join(per_host, "host").where(frequent).select("host", "hash")


def quality_verdicts(docs: DataFrame, many: int | None = None) -> DataFrame:
    """Measures and verdict for every document row, and the hashes of the lines to remove.

    ``docs`` has text and source; all its columns are kept, but those named like a new one are replaced:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
    removed_lines, kept. Repeated rows are each judged. An empty table gives no rows. ``many``: as in
    ``frequent_lines``.
    """
    docs = docs.drop(*MEASURES, "base_failed", "removed_words", "removed_lines", "kept")
    host, copy = (_free(x, docs.columns) for x in ("host", "copy"))
    lines = host_lines(docs)
    hits = lines.join(frequent_lines(lines, many=many), ["host", "hash"]).groupBy(F.col("host").alias(host), F.col("copy").alias(copy))
    hits = hits.agg(F.sum("words").cast("bigint").alias("removed_words"), F.collect_set("hash").alias("removed_lines"))
    judged = base_measures(docs).withColumns({host: F.coalesce("source", F.lit("")), copy: F.xxhash64("text")})
    judged = judged.join(hits, [host, copy], "left").drop(host, copy)
    judged = judged.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
    depleted = 100 * F.col("removed_words") > MAX_REMOVED_PERCENT * F.col("n_words")
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean_text(text: Column, removed: Column) -> Column:
    """The text without the lines whose hashes are in ``removed`` (null: none)."""
    stays = F.filter(F.split(text, "\n", -1), lambda x: ~F.array_contains(removed, F.xxhash64(normalised(x))))
    return F.when(removed.isNull(), text).otherwise(F.array_join(stays, "\n"))


def keep_quality(docs: DataFrame, many: int | None = MANY_TEXTS) -> DataFrame:
    """Documents that pass, without their host's frequent lines; all columns, n_chars follows the text.

    Other columns may have any names: the verdict travels with hashes of text and source only.
    """
    key = [F.coalesce("source", F.lit("")).alias("host"), F.xxhash64("text").alias("copy")]
    verdicts = quality_verdicts(docs.select("source", "text"), many).where("kept").select(*key, "removed_lines").dropDuplicates(["host", "copy"])
    name = _free("quality_key", docs.columns)
    right = verdicts.select(F.struct("host", "copy").alias(name), "removed_lines")
    joined = docs.join(right, F.struct(*key) == F.col(name))
    text = clean_text(docs["text"], right["removed_lines"])
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return joined.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
