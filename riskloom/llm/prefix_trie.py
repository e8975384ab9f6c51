"""Trie of the beginnings that conversations share, by ROLLUP over positional turn-id columns.

1. Turns get an id from role and text, and their place in the conversation, which is found by ranges:
   no conversation is gathered in one task.
2. WIDTH turns of a conversation make a block, a row with a column per place. GROUP BY block, prior
   node, ROLLUP(t1 .. t8) counts every prefix at once, partly before the shuffle, so a beginning that
   very many conversations share costs its tasks a row each; grouping_id tells a prefix's depth. A long
   conversation goes on in further blocks, whose key is the node in which the block before ended. A
   node's key is the exclusive or of 2 x 64 bits for each (place, turn id) on its path: blocks know
   their prior node without waiting for each other.
3. What a subtree sums up is given to the smallest member of each node, which is a member of all nodes
   above as well. A second ROLLUP over these members adds it up for all prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.ordered import before_or_after, in_order, joined_sha256, positions
from riskloom.sources.scratch import save_scratch

WIDTH = 8
_SLOTS = range(1, WIDTH + 1)
_NODE = ["depth", "n1", "n2"]
_NODE_DDL = "depth bigint, n1 bigint, n2 bigint"


def turn_ids(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1) and turn_id of every turn.

    Turns are taken by ``turn``, nulls first, then by role and text; null roles and texts are empty.
    Rows without a conv_id belong to no conversation and are left out. An id is 128 bits of a digest of
    role and text, and the number of words of the text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint"), "turn", role.alias("role"), text.alias("text"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    rows = rows.withColumn("turn_id", F.concat(F.substring(digest, 1, 32), F.lit(":"), words.cast("string")))
    return positions(in_order(rows, "conv_id", ["turn"], ["role", "text"], drop=["turn", "role", "text"]), "conv_id").drop("at")


def _bits(place: Column, turn_id: Column) -> tuple[Column, Column]:
    return F.xxhash64(place, turn_id), F.xxhash64(F.lit("second"), turn_id, place)


def _xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def _blocks(ids: DataFrame) -> DataFrame:
    """conv_id, block, p1, p2 (the node before the block) and t1 .. t8."""
    a, b = _bits(F.col("pos"), F.col("turn_id"))
    slot = (F.col("pos") - 1) % WIDTH + 1
    rows = ids.groupBy("conv_id", F.floor((F.col("pos") - 1) / WIDTH).alias("block")).agg(
        F.bit_xor(a).alias("p1"), F.bit_xor(b).alias("p2"), *[F.max(F.when(slot == k, F.col("turn_id"))).alias(f"t{k}") for k in _SLOTS]
    )
    rows = before_or_after(rows, "conv_id", "block", {"p1": F.bit_xor("p1"), "p2": F.bit_xor("p2")})
    prior = [F.coalesce(f"{p}_near", F.lit(0)).bitwiseXOR(F.coalesce(f"{p}_far", F.lit(0))).alias(p) for p in ("p1", "p2")]
    return rows.select("conv_id", "block", *prior, *[f"t{k}" for k in _SLOTS])


def _rolled_up(blocks: DataFrame, measures: str) -> DataFrame:
    """The measures of every prefix: its node, its parent, its last turn's id, and ``here``, its depth in the block."""
    slots = ", ".join(f"t{k}" for k in _SLOTS)
    query = f"SELECT block, p1, p2, {slots}, {WIDTH} - bit_count(grouping_id()) AS here, {measures} FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({slots})"
    rolled = blocks.sparkSession.sql(query, blocks=blocks)
    last = F.get(F.array(*[f"t{k}" for k in _SLOTS]), F.col("here") - 1)
    # a prefix longer than its conversation ends in an empty column; the whole block before is counted there
    rolled = rolled.withColumn("last", last).where("last IS NOT NULL OR (here = 0 AND block = 0)")
    place = [F.col("block") * WIDTH + k for k in _SLOTS]
    path = [[F.when(F.col("here") >= k, bits).otherwise(F.lit(0)) for bits in _bits(place[k - 1], F.col(f"t{k}"))] for k in _SLOTS]
    own = [F.when(F.col("here") > 0, bits).otherwise(F.lit(0)) for bits in _bits(F.col("block") * WIDTH + F.col("here"), F.col("last"))]
    n1, n2 = (_xor([F.col(p), *[both[i] for both in path]]) for i, p in enumerate(("p1", "p2")))
    rolled = rolled.withColumns({"depth": F.col("block") * WIDTH + F.col("here"), "n1": n1, "n2": n2})
    return rolled.withColumns({"q1": F.col("n1").bitwiseXOR(own[0]), "q2": F.col("n2").bitwiseXOR(own[1])})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each run of rows of one node, joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in _NODE])
        new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])
        at = np.flatnonzero(new)
        ids = pa.ListArray.from_arrays(pa.array(np.append(at, len(new)).astype(np.int32)), batch.column("conv_id").cast(pa.string()))
        first = pa.array(at)
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(first) for c in (*_NODE, "conv_id")], pc.binary_join(ids, ",")], [*_NODE, "first", "piece"])


def _ends(ids: DataFrame, conversations: DataFrame) -> DataFrame:
    """Digest of the conversations that end in each node.

    Ids are first joined within ranges of ids, whatever their node, so that a node in which very many
    conversations end is a few long strings when its digest, which can't be split, is computed.
    """
    a, b = _bits(F.col("pos"), F.col("turn_id"))
    paths = ids.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor(a).alias("n1"), F.bit_xor(b).alias("n2"))
    paths = conversations.join(paths, "conv_id", "left").fillna(0, _NODE)
    pieces = paths.repartitionByRange("conv_id").sortWithinPartitions(*_NODE, "conv_id")
    pieces = save_scratch(pieces.select(*_NODE, "conv_id").mapInArrow(_pieces, f"{_NODE_DDL}, first bigint, piece string"), "pieces")
    return joined_sha256(pieces, _NODE, ["first"], "piece", ",", "ends_sha256")


def _subtree_sums(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of every node but a childless root, from the values of single nodes."""
    slot = (F.col("depth") - 1) % WIDTH + 1
    saved = (F.col("n_convs") - 1) * F.col("words")
    own = nodes.where("depth > 0").select("conv_id", F.floor((F.col("depth") - 1) / WIDTH).alias("block"), slot.alias("slot"), saved.alias("saved"), F.col("n_children").isNull().alias("leaf"))
    values = own.groupBy("conv_id", "block").agg(F.sum("saved").alias("total"), *[F.coalesce(F.sum(F.when(F.col("slot") == k, F.col("saved"))), F.lit(0)).alias(f"v{k}") for k in _SLOTS])
    firsts = own.groupBy("conv_id").agg(F.max(F.col("leaf").cast("int")).alias("leaf"))
    rows = blocks.join(firsts, "conv_id").join(values, ["conv_id", "block"], "left").fillna(0, ["total", *[f"v{k}" for k in _SLOTS]])
    rows = before_or_after(rows, "conv_id", "block", {"total": F.sum("total")}, after=True)
    later = F.coalesce("total_near", F.lit(0)) + F.coalesce("total_far", F.lit(0))
    sums = [(later + reduce(lambda a, b: a + b, [F.col(f"v{j}") for j in _SLOTS if j >= k])).alias(f"s{k}") for k in _SLOTS]
    rows = save_scratch(rows.select("block", "p1", "p2", *[f"t{k}" for k in _SLOTS], "leaf", *sums), "weights")
    measures = ", ".join(["sum(leaf) AS n_leaves", *[f"sum(s{k}) AS s{k}" for k in _SLOTS]])
    rolled = _rolled_up(rows, measures)
    saved = F.get(F.array(*[f"s{k}" for k in _SLOTS]), F.greatest(F.col("here"), F.lit(1)) - 1)
    return rolled.select(*_NODE, "n_leaves", saved.alias("saved_tokens"))


def prefix_trie(ids: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Every distinct beginning of the conversations as a node of a trie, the empty one being the root.

    ``ids`` has conv_id, pos and turn_id like the result of ``turn_ids``, positions without gaps from 1;
    ``conversations`` has distinct conv_ids, among them those without turns, and is taken from ``ids``
    if it isn't given. Without conversations there is no root either.
    Returns conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs (members),
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the subtree, each node's
    (n_convs - 1) times the words of its last turn) and ends_sha256 (of the ids of the conversations that
    end there, numerically ascending, joined by commas).
    """
    ids = save_scratch(ids.select("conv_id", F.col("pos").cast("bigint"), "turn_id"), "turn-ids")
    conversations = ids.select("conv_id").distinct() if conversations is None else conversations.select(F.col("conv_id").cast("bigint"))
    silent = conversations.join(ids.select("conv_id").distinct(), "conv_id", "left_anti")
    none = [F.lit(0).cast("bigint").alias(c) for c in ("block", "p1", "p2")] + [F.lit(None).cast("string").alias(f"t{k}") for k in _SLOTS]
    blocks = save_scratch(_blocks(ids).unionAll(silent.select("conv_id", *none)), "blocks")
    words = F.coalesce(F.split_part("last", F.lit(":"), F.lit(2)).cast("bigint"), F.lit(0))
    nodes = _rolled_up(blocks, "min(conv_id) AS conv_id, count(*) AS n_convs")
    nodes = save_scratch(nodes.select(*_NODE, "q1", "q2", "conv_id", "n_convs", words.alias("words")), "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("n1"), F.col("q2").alias("n2")).agg(F.count("*").alias("n_children"))
    nodes = save_scratch(nodes.join(children, _NODE, "left"), "nodes")
    parents = nodes.where("n_children IS NOT NULL").select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    out = save_scratch(nodes.join(parents, ["depth", "q1", "q2"], "left"), "parents")
    out = out.join(_subtree_sums(blocks, nodes), _NODE, "left").join(_ends(ids, conversations), _NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
