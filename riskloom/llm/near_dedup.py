"""Near-duplicates by SuperMinHash signatures, banding, verification and union-find.

1. Tasks hash the distinct word shingles of every document and fold them into a SuperMinHash
   signature: each shingle walks the slots of the signature in a random order of its own and offers
   them rising ranks (round + fraction). Once the largest rank of a document is below the round,
   nothing that follows can change it, so long documents need one or two rounds.
2. Documents with the same set are one class from here on; its smallest doc_id stands for it.
3. Bands of the signature are hashed to buckets. Bands are chosen so that a pair at the threshold
   misses all of them with a probability below MISS.
4. No bucket is expanded into its pairs. Members are verified against one leader of their bucket, on
   full sets; union-find joins what is linked. Buckets whose members are still apart get another
   leader. At last, the members outside a bucket's largest component are compared with all members
   that ever share a bucket with that component, block by block inside tasks, which return links
   only. So every pair that shares a bucket is either verified or already in one component, and
   components are those of all such links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.words import FOLDED, mix, ranges, split_words, text_slices
from riskloom.sources.scratch import save_scratch, session_settings

SLOTS = 128
MISS = 1e-5
BLOCK = 256  # documents on either side of a comparison by blocks
BATCH_ROWS = 1000  # texts that Spark hands to Python at once; it holds a batch as a whole on either side
SLICE = 1 << 19  # bytes of text whose shingles are made at once
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_PART = 1 << 17  # shingles that are folded together

_SETS = "doc_id bigint, copy bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def band_rows(percent: int, slots: int = SLOTS) -> int:
    """Signature values per band: as many as keep the chance to miss a pair at the threshold below MISS."""
    t = percent / 100
    return max(r for r in range(1, slots + 1) if r == 1 or (1 - t**r) ** (slots // r) <= MISS)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and where each begins.

    A shingle is ``width`` words of one text; a text of fewer words has its whole sequence as one.
    """
    words = split_words(buf, offsets, FOLDED)
    counts = words.counts()
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(text)) + width <= words.first[1:][text])
    short = np.flatnonzero((counts > 0) & (counts < width))
    hashes = np.zeros(len(at), np.uint64)
    for j in range(width):
        hashes = mix(hashes + words.hashes[at + j] + _GOLDEN)
    few = np.zeros(len(short), np.uint64)
    for j in range(width - 1):
        more = counts[short] > j
        few[more] = mix(few[more] + words.hashes[words.first[short[more]] + j] + _GOLDEN)
    owner = np.concatenate([text[at], short])
    hashes = np.concatenate([hashes, mix(few ^ _GOLDEN)])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set: a row of ``slots`` ranks, the round in the upper bits, the fraction below."""
    n = len(first) - 1
    out = np.full((n, slots), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    for lo in range(0, len(hashes), _PART):
        _fold(out, owner[lo : lo + _PART], hashes[lo : lo + _PART], slots)
    return out


def _fold(out: np.ndarray, owner: np.ndarray, seed: np.ndarray, slots: int) -> None:
    flat = out.reshape(-1)
    walk = None  # the order in which each shingle still alive visits the slots
    for step in range(slots):
        if step:  # texts whose ranks are all below this round are done
            texts = np.unique(owner)
            open_ = texts[(out[texts].max(1) >> np.uint64(56)) >= step]
            alive = np.isin(owner, open_)
            if not alive.any():
                return
            if not alive.all():
                owner, seed = owner[alive], seed[alive]
                walk = walk[alive]
        draw = mix(seed + np.uint64((step + 1) * int(_GOLDEN) % (1 << 64)))
        fraction = draw >> np.uint64(8)
        pick = step + (mix(draw) >> np.uint64(32)).astype(np.int64) * (slots - step) // (1 << 32)
        if walk is None:
            walk = _Walks(len(seed), slots)
        slot = walk.swap(step, pick)
        np.minimum.at(flat, owner * slots + slot, (np.uint64(step) << np.uint64(56)) | fraction)


class _Walks:
    """Fisher-Yates orders of the slots, one per shingle; tables are made from the second round on."""

    def __init__(self, n: int, slots: int):
        self.slots, self.first, self.table = slots, None, None
        self.n = n

    def __getitem__(self, alive: np.ndarray) -> _Walks:
        kept = _Walks(int(alive.sum()), self.slots)
        kept.first = self.first[alive]
        kept.table = None if self.table is None else self.table[alive]
        return kept

    def swap(self, step: int, pick: np.ndarray) -> np.ndarray:
        if step == 0:
            self.first = pick
            return pick
        rows = np.arange(self.n)
        if self.table is None:
            self.table = np.tile(np.arange(self.slots, dtype=np.uint8 if self.slots <= 256 else np.uint16), (self.n, 1))
            self.table[rows, self.first] = 0
            self.table[:, 0] = self.first
        slot = self.table[rows, pick].astype(np.int64)
        self.table[rows, pick] = self.table[:, step]
        self.table[:, step] = slot
        return slot


def _describe(width: int, rows: int, slots: int):
    bands = slots // rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in text_slices(batch.column("text"), SLICE):
                hashes, first = shingle_sets(buf, offsets, width)
                n = np.diff(first)
                ranks = signatures(hashes, first, slots)
                keys = np.zeros((hi - lo, bands), np.uint64)
                for r in range(rows):
                    keys = mix(keys + ranks[:, r * bands : (r + 1) * bands] + _GOLDEN)
                keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (mix(hashes), mix(hashes ^ _GOLDEN))]
                a, b = ((s[first[1:]] - s[first[:-1]]) for s in sums)
                some = n > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("copy").slice(lo, hi - lo),
                        pa.array(n.astype(np.int64)),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)), pa.array(keys[some].view(np.int64).ravel())
                        ),
                    ],
                    ["doc_id", "copy", "n_shingles", "set_a", "set_b", "bands"],
                )

    return work


def _verify(width: int, percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            linked = np.zeros(len(a), bool)
            for lo, hi, buf, offsets in text_slices(batch.column("text_b")):
                own, first = shingle_sets(buf, offsets, width)
                new = np.ones(hi - lo, bool)  # rows of one leader mostly follow each other
                new[1:] = a[lo + 1 : hi] != a[lo : hi - 1]
                leads = []
                for _, _, text, edges in text_slices(batch.column("text_a").take(pa.array(lo + np.flatnonzero(new)))):
                    sets, at = shingle_sets(text, edges, width)
                    leads += [sets[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
                for d, k in enumerate(np.cumsum(new) - 1):
                    mine, lead = own[first[d] : first[d + 1]], leads[k]
                    place = np.minimum(np.searchsorted(lead, mine), len(lead) - 1)
                    common = int((lead[place] == mine).sum())
                    linked[lo + d] = 100 * common >= percent * (len(mine) + len(lead) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], ["a", "b"])

    return work


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return save_scratch(both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, percent), "a bigint, b bigint"), "links")


def components(edges: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Smallest reachable node of every node of an edge: (node, component).

    ``before`` is the answer for earlier edges; it stands for them, so few new edges need few steps.

    Union-find by alternating steps on all edges: every node's larger neighbours are hung under its
    smallest one, then its smaller ones, until nothing changes. A node's edges are never gathered:
    only its smallest neighbour is, which tasks find before the shuffle.
    """
    if before is not None:
        edges = edges.select("a", "b").unionAll(before.select("node", "component"))
    tree = save_scratch(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(tree.select("v", "v").distinct())
        seen = state
        both = tree.unionAll(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = save_scratch(large.where("u <> v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        tree = save_scratch(small.where("u <> v").distinct(), "edges")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, slots: int = SLOTS) -> DataFrame:
    """Class, component and whether it is kept for every document row.

    ``docs`` has doc_id and text; other columns are ignored. Texts are lower-cased (A-Z), words lie
    between white space. Two documents are linked if their shingle sets share at least ``percent``
    per cent of their union; a null or empty text has no shingles and no links. The component is the
    smallest doc_id reachable, and that document is kept. Every row is judged by its own text, also
    where rows share a doc_id, and equal rows get the same answer. A null doc_id has no component,
    is linked with nothing and is kept.
    Returns doc_id, copy (hash of the text), n_shingles, component_id and kept.
    """
    with session_settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return _judged(docs, width, percent, slots)


def _judged(docs: DataFrame, width: int, percent: int, slots: int) -> DataFrame:
    """All that runs Python is written inside; what is returned only joins."""
    rows = band_rows(percent, slots)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("copy"), "text")
    sets = save_scratch(texts.mapInArrow(_describe(width, rows, slots), _SETS), "sets")
    some = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["set_a", "set_b", "n_shingles"]
    classes = save_scratch(some.groupBy(*key).agg(F.min(F.struct("doc_id", "copy", "bands")).alias("first")).select(*key, "first.*"), "classes")
    members = classes.select(F.col("doc_id").alias("node"), "copy", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("lead"), F.max("node").alias("last"))
    members = save_scratch(members.join(shared.where("lead.node < last").drop("last"), "bucket"), "members")
    wanted = members.select("node", "copy").distinct()
    texts = texts.withColumnRenamed("doc_id", "node").join(wanted, ["node", "copy"], "left_semi").dropDuplicates(["node", "copy"])
    texts = save_scratch(texts.select("node", "text"), "texts")

    alike = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"  # else their sets can't be
    tested, found = [], None
    for turn in range(2):
        lead = members if turn == 0 else _leaders(_apart(members.drop("lead"), found))
        pairs = _ordered(lead.where("lead.node <> node")).where(alike).select("a", "b").distinct()
        if tested:
            pairs = pairs.join(tested[0], ["a", "b"], "left_anti")
        tested.append(save_scratch(pairs, "pairs"))
        found = components(_links(tested[-1], texts, width, percent), found)
    found = components(_strangers(_apart(members.drop("lead"), found), texts, width, percent), found)
    named = classes.join(found, classes["doc_id"] == found["node"], "left")
    named = named.select(*key, F.coalesce("component", "doc_id").alias("component"))
    out = sets.join(named, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "copy", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Documents without shingles and rows without a doc_id stay. Of rows that are equal in doc_id and
    text one stays.
    """
    judged = near_duplicates(docs, width, percent).groupBy("doc_id", "copy").agg(F.min("kept").alias("kept"), F.count("*").alias("rows"))
    judged = save_scratch(judged.where("doc_id IS NOT NULL AND (NOT kept OR rows > 1)"), "judged")
    key = F.struct(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("copy"))
    name = "near_key"
    while name in docs.columns:
        name += "_"
    some = lambda condition: judged.where(condition).select(F.struct("doc_id", "copy").alias(name))
    alone = docs.join(some("TRUE"), key == F.col(name), "left_anti")
    repeated = docs.join(some("kept"), key == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"])
    return alone.unionAll(repeated)


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that still hold more than one component, with it."""
    named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = save_scratch(named.select("bucket", "node", "n", "component"), "named")
    split = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    return named.join(split, "bucket", "left_semi")


def _leaders(apart: DataFrame) -> DataFrame:
    """A leader by chance for each bucket, with its members of other components."""
    lead = apart.groupBy("bucket").agg(F.min_by(F.struct("node", "n", "component"), F.xxhash64("node", "bucket")).alias("lead"))
    return apart.join(lead, "bucket").where("component <> lead.component")


def _strangers(apart: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of the members outside their bucket's largest component.

    A group is a component that is the largest of some buckets, with all members of these buckets.
    Its strangers and its members are dealt to blocks, and each pair of blocks is one small task.
    """
    sizes = apart.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("size", "component")).alias("group"))
    near = save_scratch(apart.join(largest, "bucket").select("group", "node", "component").distinct(), "near")
    strange = F.col("component") != F.col("group")
    blocks = near.groupBy("group").agg(F.ceil(F.sum(strange.cast("int")) / BLOCK).alias("left"), F.ceil(F.count("*") / BLOCK).alias("right"))
    rows = near.join(blocks, "group").join(texts, "node")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    base = [F.col(x) for x in ("group", "node", "component", "text")]
    dealt = rows.where(strange).select(*base, own("left").alias("i"), each("right").alias("j"), F.lit(True).alias("stranger"))
    dealt = dealt.unionAll(rows.select(*base, each("left").alias("i"), own("right").alias("j"), F.lit(False).alias("stranger")))
    found = dealt.groupBy("group", "i", "j").applyInArrow(_compare(width, percent), "a bigint, b bigint")
    return save_scratch(found, "links")


def _compare(width: int, percent: int):
    """One pair of blocks: for each stranger one link into every component that it is linked with."""

    def work(table: pa.Table) -> pa.Table:
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        stranger = table.column("stranger").to_numpy(zero_copy_only=False).astype(bool)
        hashes, counts = [], []
        for _, _, buf, offsets in text_slices(table.column("text")):
            own, first = shingle_sets(buf, offsets, width)
            hashes.append(own)
            counts.append(np.diff(first))
        counts = np.concatenate(counts)
        number = np.unique(np.concatenate(hashes), return_inverse=True)[1].ravel()
        first = np.concatenate([[0], np.cumsum(counts)])
        right = np.flatnonzero(~stranger)
        a, b = [], []
        if len(right):
            edges = np.concatenate([[0], np.cumsum(counts[right])[:-1]])
            members = number[ranges(first[right], counts[right])]
            seen = np.zeros(len(number) + 1, np.int64)
            for x in np.flatnonzero(stranger):
                mine = number[first[x] : first[x + 1]]
                seen[mine] = 1
                common = np.add.reduceat(seen[members], edges)
                seen[mine] = 0
                linked = (100 * common >= percent * (counts[right] + len(mine) - common)) & (component[right] != component[x])
                to = right[linked]
                to = to[np.unique(component[to], return_index=True)[1]]
                a += [node[x]] * len(to)
                b += node[to].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs of a node and its lead, smaller id first."""
    first = F.col("lead.node") < F.col("node")
    return pairs.select(
        F.least("lead.node", "node").alias("a"),
        F.greatest("lead.node", "node").alias("b"),
        F.when(first, F.col("lead.n")).otherwise(F.col("n")).alias("n_a"),
        F.when(first, F.col("n")).otherwise(F.col("lead.n")).alias("n_b"),
    )
