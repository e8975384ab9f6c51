"""The registered queries of this subpackage and, where SQL can express them, the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.chat import format_turns, read_back
from riskloom.llm.conversation_repair import repair
from riskloom.llm.decontaminate import benchmark_matches, contaminated
from riskloom.llm.exact_dedup import exact_duplicates
from riskloom.llm.html_extract import extract_articles
from riskloom.llm.near_dedup import near_duplicates
from riskloom.llm.ordered import joined_sha256
from riskloom.llm.packing import pack
from riskloom.llm.pii import KINDS, personal_spans
from riskloom.llm.prefix_trie import prefix_trie, turn_ids
from riskloom.llm.quality_lines import quality_verdicts
from riskloom.llm.substring_dedup import remove_repeats
from riskloom.llm.token_rollup import RollupStore, token_counts
from riskloom.llm.warc import read_records, write_archives
from riskloom.sources.scratch import save_scratch, scratch_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation, and one that speaks the template's own marks, formatted and read back."""
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_turns(turns))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets share at least 85 % of their union."""
    return near_duplicates(table(spark, sf, "documents"), width=3, percent=85).drop("copy")


def op3_packed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's pieces in windows of 4096 ids."""
    return pack(table(spark, sf, "documents"))


def op4_token_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Token totals after three batches: all documents come, toxic ones go, poor ones are revised.

    A revised document has lost its repeated lines. The second batch is sent twice. The ids of both
    are written first: joins then know how few they are and leave the texts where they are.
    """
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    store = RollupStore(spark, f"{scratch_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    toxic = save_scratch(labels.where("toxic = 1").select("doc_id").distinct(), "toxic")
    store.apply(0, token_counts(docs))
    store.apply(1, deletes=toxic)
    store.apply(1, deletes=toxic)
    poor = save_scratch(labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti"), "poor")
    once = F.array_join(F.array_distinct(F.split("text", "\n", -1)), "\n")
    store.apply(2, token_counts(docs.join(poor, "doc_id", "left_semi").withColumn("text", once)))
    return store.totals()


def op5_disclosure_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document: base patterns, and terms that reveal them."""
    found = personal_spans(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op6_suffix_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark words and items in every document, by suffix arrays over the documents."""
    found = benchmark_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    items = F.array_sort(F.transform(F.array_distinct("matches.item_id"), lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op7_article_text(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page, by the consensus paths of its host."""
    return extract_articles(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op8_repeated_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Words that repeated 35-word windows cover, removed from every document."""
    kept = remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("removed").cast("bigint").alias("n_intervals"))


def op9_warc_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to WARC archives, and the records read back."""
    folder = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf, "pages"), folder)
    return read_records(spark, folder).drop("uri")


def op10_line_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of every document and whether it stays without its host's frequent lines."""
    judged = quality_verdicts(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return judged.drop("source", "text", "removed_lines")


#: A conversation begins like the first of its CLAN; how many of those turns it repeats is below BORROWED.
CLAN, BORROWED = 20, 4


def rebuilt_turns(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turn ids of the rebuilt conversations, and all conv_ids, those that are left without turns too.

    Each conversation c begins with the first h turns of conversation c - c % 20, as far as there are
    any, and goes on with its own after the first h; h = crc32(c) % 4.
    """
    base = F.col("conv_id") - F.col("conv_id") % CLAN
    borrowed = F.crc32(F.col("conv_id").cast("string")) % BORROWED
    convs = ids.select("conv_id").distinct()
    heads = ids.where((F.col("conv_id") % CLAN == 0) & (F.col("pos") < BORROWED)).withColumnRenamed("conv_id", "base")
    begun = convs.select("conv_id", base.alias("base"), borrowed.alias("h")).join(heads, "base").where("pos <= h").select("conv_id", "pos", "turn_id")
    there = heads.groupBy("base").agg(F.max("pos").alias("there"))
    own = ids.withColumns({"base": base, "h": borrowed}).where("pos > h").join(there, "base", "left")
    shift = F.least(F.col("h"), F.coalesce("there", F.lit(0).cast("bigint"))) - F.col("h")
    return begun.unionAll(own.select("conv_id", (F.col("pos") + shift).alias("pos"), "turn_id")), convs


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """The trie of all conversations, which are rebuilt to share beginnings."""
    ids = save_scratch(turn_ids(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")), "turn-ids")
    return prefix_trie(*rebuilt_turns(ids))


def op12_exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """The group of every document among texts that are equal but for white space runs."""
    return exact_duplicates(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Turns with faults, dealt by crc32 of conv_id:turn; nulls count as one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    rows = turns.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair(damaged_turns(turns))
    said = repaired.turns.withColumn("said", F.concat("role", F.lit(":"), "text"))
    digests = joined_sha256(said, ["conv_id"], ["pos", "k"], "said", "\n", "repaired_sha256")
    whole = save_scratch(repaired.audits.join(digests, "conv_id", "left"), "repaired")
    convs = turns.select("conv_id").distinct().select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"))
    out = convs.join(whole.withColumnRenamed("conv_id", "conv"), "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_near_duplicates, op3_packed_windows, op4_token_rollup, op5_disclosure_spans, op6_suffix_decontamination, op7_article_text, op8_repeated_windows, op9_warc_chunks, op10_line_frequency, op11_prefix_trie, op12_exact_duplicates, op13_conversation_repair)}

OP10_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d
), grams AS (
    SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), again AS (
    SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN again USING (r, g)) GROUP BY r
), lines AS (
    SELECT r, host, t, l, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
    FROM (SELECT r, host, t, unnest(ls) AS l FROM w)
), worded AS (
    SELECT *, len(string_split(line, ' ')) AS words FROM lines WHERE line <> ''
), frequent AS (
    SELECT host, line FROM worded JOIN (SELECT host, count(DISTINCT t) AS n FROM worded GROUP BY host) USING (host)
    GROUP BY host, line, n HAVING count(DISTINCT t) >= 10 AND 100 * count(DISTINCT t) >= 10 * n
), removed AS (
    SELECT r, sum(words) AS n FROM worded JOIN frequent USING (host, line) GROUP BY r
), dup AS (
    SELECT r, count(*) - count(DISTINCT l) AS n FROM worded GROUP BY r
), m AS (
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS removed_words
    FROM w LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_words <= 50 * n_words AS kept
FROM m
"""

OP1_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, length(role) + length(text) + 9 + length(regexp_replace(role || text, '[^<\\\[]', '', 'g')) + length(regexp_replace(role, '[^\n]', '', 'g')) AS n FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP9_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), o AS (
    SELECT html, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY html HAVING count(*) > 1
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to, true AS intact
FROM p LEFT JOIN o USING (html)
"""

OP2_SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), sets AS (
    SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)
), sizes AS (
    SELECT r, doc_id, count(g) AS n FROM d LEFT JOIN sets USING (r) GROUP BY 1, 2
), common AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n FROM sets a JOIN sets b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2
), links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM common c JOIN sizes x ON x.r = c.a JOIN sizes y ON y.r = c.b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), reach AS (
    SELECT doc_id AS node, doc_id AS to_id FROM d UNION SELECT node, b FROM reach JOIN links ON a = to_id
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT node AS doc_id, min(to_id) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""

OP6_SQL = r"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
), k AS (
    SELECT item_id, ws, least(13, len(ws)) AS width FROM b WHERE len(ws) > 0
), item AS (
    SELECT DISTINCT item_id, width, array_to_string(ws[i:i + width - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS i FROM k)
), here AS (
    SELECT r, i, width, array_to_string(ws[i:i + width - 1], ' ') AS g
    FROM (SELECT r, ws, width, unnest(range(1, len(ws) - width + 2)) AS i FROM w, (SELECT DISTINCT width FROM k) WHERE len(ws) >= width)
), hit AS (
    SELECT DISTINCT r, i, width, item_id FROM here JOIN item USING (width, g)
), words AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + width)) AS p FROM hit) GROUP BY 1
), items AS (
    SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY 1
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP8_SQL = r"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)
), covered AS (
    SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows JOIN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1) USING (g)
), gone AS (
    SELECT r, count(*) AS n, count(*) FILTER (WHERE before IS DISTINCT FROM p - 1) AS runs, list(p) AS at
    FROM (SELECT *, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM covered) GROUP BY r
), words AS (
    SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN covered USING (r, p) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(gone.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256, coalesce(runs, 0)::BIGINT AS n_intervals
FROM w LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
    SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

#: CRC-32 of a decimal number, a bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"""

OP11_SQL = r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, md5(concat(length(role), ':', role, text)) AS id,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, CRC % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
), rebuilt AS (
    SELECT c.conv_id, 0 AS part, t.pos, id, words FROM c JOIN t ON t.conv_id = base AND pos <= h
    UNION ALL SELECT c.conv_id, 1, t.pos, id, words FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
), p AS (
    SELECT c.conv_id, coalesce(list(id ORDER BY part, pos) FILTER (WHERE id IS NOT NULL), []) AS ids,
        coalesce(list(words ORDER BY part, pos) FILTER (WHERE id IS NOT NULL), []) AS ws
    FROM c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY 1
), steps AS (
    SELECT conv_id, d, md5(array_to_string(ids[1:d], ',')) AS k, md5(array_to_string(ids[1:d - 1], ',')) AS up, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, d = len(ids) AS ends
    FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM p)
), nodes AS (
    SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ended
    FROM steps GROUP BY 1, 2
), children AS (
    SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2
), valued AS (
    SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, k)
), above AS (
    SELECT s.d, s.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * v.w) AS saved FROM valued v JOIN steps s ON s.conv_id = v.conv_id AND s.d <= v.d GROUP BY 1, 2
)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(v.ended, '')) AS ends_sha256
FROM valued v JOIN above USING (d, k) LEFT JOIN nodes u ON u.d = v.d - 1 AND u.k = v.up
""".replace("CRC", _CRC.format("conv_id"))

ORACLE: dict[str, str] = {
    "op9_warc_chunks": OP9_SQL,
    "op1_chat_format": OP1_SQL,
    "op10_line_frequency": OP10_SQL,
    "op2_near_duplicates": OP2_SQL,
    "op6_suffix_decontamination": OP6_SQL,
    "op8_repeated_windows": OP8_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_exact_duplicates": OP12_SQL,
}
