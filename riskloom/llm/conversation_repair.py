"""Repair of conversation structure by a rank-convergence parallel Viterbi.

A repaired conversation is empty, or an optional system turn and then user and assistant turns by
turns. Rows are kept, given another role or deleted, and empty turns are inserted, at least cost.

1. Rows get their place and their faults. A conversation of any length is cut into chunks of CHUNK
   rows, each a string with a letter per row.
2. Costs of what follows are computed backwards, a vector over the four states of the grammar for each
   row. All chunks start at once, from a speculative vector at their end.
3. Fix-up passes give each chunk the vector that its successor really begins with. It is run again
   from its end, until its vectors differ from those of the run before by a constant only; all before
   are right up to that constant. Passes end when no chunk's vector was wrong, mostly after one or two.
4. The constants between neighbours are stitched into the cost of the conversation. The cheapest
   edits, the least string of them first, are traced forwards for each state in which a chunk can be
   entered, all chunks at once; then the states are chained and one trace of each is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.ordered import in_order, positions
from riskloom.sources.scratch import save_scratch

CHUNK = 128
WHITE = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_TURN = np.array([2, 2, 3, 2])  # state after the turn that is due, as inserted or given another role
_DUE = ["user", "user", "assistant", "user"]
_NEVER = 1 << 20
_INITIALS = ["s", "u", "a"]  # any other is the fourth kind
_FIRST = 97  # a row's letter: "a" + 3 * kind + (0 sound, 1 has to go, 2 truncated)

_CHUNKS = "conv string, chunk bigint, last boolean, codes string, illegal bigint, vectors binary, head array<int>, tail array<int>"
_TRACES = "conv string, chunk bigint, last boolean, codes string, audits array<string>, exits array<int>"
_ENTRIES = "conv string, chunk bigint, entry int, illegal bigint"
_EDITS = "conv string, pos bigint, k int, edit string, new_role string"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost and next state of keeping, cost of another role, by letter and state."""
    cost, to, rerole = np.full((12, 4), _NEVER), np.zeros((12, 4), np.int64), np.full(12, _NEVER)
    moves = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}
    for kind, by_state in moves.items():
        for fault, extra in ((0, 0), (2, TRUNCATED)):
            rerole[3 * kind + fault] = REROLE + extra
            for state, after in by_state.items():
                cost[3 * kind + fault, state], to[3 * kind + fault, state] = extra, after
    return cost, to, rerole


_KEEP, _AFTER, _REROLE = _tables()
_END = np.array([0, 2 * INSERT, INSERT, 0])  # of a whole conversation


def _letters(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters as numbers, a row for each chunk, and the chunks' lengths."""
    rows = [np.frombuffer(c.encode(), np.uint8) for c in codes.to_pylist()]
    lengths = np.array([len(r) for r in rows])
    out = np.full((len(rows), max(lengths, default=0)), _FIRST, np.uint8)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out - _FIRST, lengths


def _back(after: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Costs from before a row on, of those from after it on."""
    keep = _KEEP[letters] + np.take_along_axis(after, _AFTER[letters], 1)
    out = np.minimum(np.minimum(after + DELETE, keep), _REROLE[letters][:, None] + after[:, _TURN])
    for _ in range(2):
        out = np.minimum(out, INSERT + out[:, _TURN])
    return out


def backward(letters: np.ndarray, lengths: np.ndarray, tail: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Cost vectors of chunks: [chunk, row, state], from the vectors ``tail`` behind their last rows.

    With ``before``, the vectors of an earlier run, a chunk is left where its new vector differs from
    the old one by a constant, which is added to all that lie before.
    """
    n, width = letters.shape
    out = np.empty((n, width + 1, 4), np.int64)
    out[np.arange(n), lengths] = tail
    running = np.ones(n, bool)
    for i in range(width - 1, -1, -1):
        now = np.flatnonzero(running & (i < lengths))
        if not len(now):
            continue
        out[now, i] = _back(out[now, i + 1], letters[now, i])
        if before is not None:
            shift = out[now, i] - before[now, i]
            same = (shift == shift[:, :1]).all(1)
            done = now[same]
            out[done, :i] = before[done, :i] + shift[same, :1][:, None]
            running[done] = False
    return out


def trace(letters: np.ndarray, lengths: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inserts before each row, letter of its edit, and the state at the end, by the state at the beginning.

    Of the cheapest edits those of the least string: D, I, K, R.
    """
    n, width = letters.shape
    state = np.tile(np.arange(4), (n, 1))
    inserts, edits = np.zeros((n, width, 4), np.uint8), np.zeros((n, width, 4), np.uint8)
    for i in range(width):
        now = np.flatnonzero(i < lengths)
        here, after, own, s = costs[now, i], costs[now, i + 1], letters[now, i][:, None], state[now]
        for _ in range(2):
            left = np.take_along_axis(here, s, 1)
            gone = DELETE + np.take_along_axis(after, s, 1) == left
            add = ~gone & (INSERT + np.take_along_axis(here, _TURN[s], 1) == left)
            s = np.where(add, _TURN[s], s)
            inserts[now, i] += add
        left = np.take_along_axis(here, s, 1)
        gone = DELETE + np.take_along_axis(after, s, 1) == left
        kept = ~gone & (_KEEP[own, s] + np.take_along_axis(after, _AFTER[own, s], 1) == left)
        edits[now, i] = np.where(gone, ord("D"), np.where(kept, ord("K"), ord("R")))
        state[now] = np.where(gone, s, np.where(kept, _AFTER[own, s], _TURN[s]))
    return inserts, edits, state


def _chunk_batch(own: pa.RecordBatch, lengths: np.ndarray, costs: np.ndarray) -> list[pa.Array]:
    """Vectors as bytes, the first and the last one of each chunk."""
    n = np.arange(len(lengths))
    vectors = [costs[k, : lengths[k] + 1].astype("<i4").tobytes() for k in n]
    ends = [pa.array(x.astype(np.int32).tolist(), pa.list_(pa.int32())) for x in (costs[:, 0], costs[n, lengths])]
    return [pa.array(vectors, pa.binary()), *ends]


def _vectors(column: pa.Array, lengths: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(lengths), width + 1, 4), np.int64)
    for k, v in enumerate(column.to_pylist()):
        out[k, : lengths[k] + 1] = np.frombuffer(v, "<i4").reshape(-1, 4)
    return out


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors from the true end of a conversation's last chunk, from zeros elsewhere."""
    for whole in batches:
        for own in _parts(whole):
            letters, lengths = _letters(own.column("codes"))
            last = own.column("last").to_numpy(zero_copy_only=False).astype(bool)
            costs = backward(letters, lengths, np.where(last[:, None], _END, 0))
            kind = letters // 3
            pairs = np.arange(1, letters.shape[1]) < lengths[:, None]
            illegal = (pairs & ~_follows(kind[:, :-1], kind[:, 1:])).sum(1)
            columns = [*own.select(["conv", "chunk", "last", "codes"]).columns, pa.array(illegal), *_chunk_batch(own, lengths, costs)]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "chunk", "last", "codes", "illegal", "vectors", "head", "tail"])


def _follows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((b == 1) & ((a == 0) | (a == 2))) | ((a == 1) & (b == 2))


def _parts(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks run again from ``incoming``."""
    names = ["conv", "chunk", "last", "codes", "illegal", "vectors", "head", "tail"]
    for whole in batches:
        for own in _parts(whole):
            letters, lengths = _letters(own.column("codes"))
            before = _vectors(own.column("vectors"), lengths, letters.shape[1])
            costs = backward(letters, lengths, np.array(own.column("incoming").to_pylist()), before)
            yield pa.RecordBatch.from_arrays([*own.select(names[:5]).columns, *_chunk_batch(own, lengths, costs)], names)


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for own in _parts(whole):
            letters, lengths = _letters(own.column("codes"))
            inserts, edits, state = trace(letters, lengths, _vectors(own.column("vectors"), lengths, letters.shape[1]))
            written = np.stack([np.where(inserts > 0, ord("I"), 0), np.where(inserts > 1, ord("I"), 0), edits], -1).astype(np.uint8)
            last = own.column("last").to_pylist()
            first = [c == 0 for c in own.column("chunk").to_pylist()]
            audits = []
            for k in range(len(lengths)):
                strings = []
                for entry in range(1 if first[k] else 4):
                    marks = written[k, : lengths[k], entry].ravel()
                    end = "I" * int(_END[state[k, entry]] // INSERT) if last[k] else ""
                    strings.append(marks[marks > 0].tobytes().decode() + end)
                audits.append(strings)
            columns = [*own.select(["conv", "chunk", "last", "codes"]).columns, pa.array(audits, pa.list_(pa.string())), pa.array(state.astype(np.int32).tolist(), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "chunk", "last", "codes", "audits", "exits"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is entered, and illegal pairs across its beginning; chunks come in order."""
    conv, state, end = None, 0, None
    for batch in batches:
        out = []
        for name, chunk, exits, first, last in zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "exits", "first", "last")], strict=True):
            if name != conv:
                conv, state, end = name, 0, None
            kinds = [(ord(x) - _FIRST) // 3 for x in (end or first, first)]
            out.append((name, chunk, state, int(end is not None and not _follows(*map(np.array, kinds)))))
            state, end = exits[state], last
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv", "chunk", "entry", "illegal"])


def _edits(size: int):
    """A row for each turn that is left or inserted: place, what was done, and the role where it is new."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for own in _parts(whole):
                out = []
                for conv, chunk, codes, audit, state in zip(*[own.column(c).to_pylist() for c in ("conv", "chunk", "codes", "audit", "entry")], strict=True):
                    pos, k = chunk * size + 1, 0
                    for edit in audit:
                        if edit in "IR":
                            out.append((conv, pos, k, edit, _DUE[state]))
                            state = _TURN[state]
                        elif edit == "K":
                            out.append((conv, pos, k, edit, None))
                            state = _AFTER[ord(codes[pos - chunk * size - 1]) - _FIRST, state]
                        pos, k = (pos, k + 1) if edit == "I" else (pos + 1, 0)
                columns = list(zip(*out, strict=True)) or [(), (), (), (), ()]
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["conv", "pos", "k", "edit", "new_role"])

    return work


@dataclass(frozen=True)
class Repair:
    """``audits``: a row per conversation; ``turns``: the repaired ones, in the order of pos and k."""

    audits: DataFrame
    turns: DataFrame


def _converged(chunks: DataFrame) -> DataFrame:
    """Chunks with right vectors, and ``shift``, the constant by which their successor's frame differs."""
    single = chunks.where("last AND chunk = 0")
    rest = save_scratch(chunks.where("NOT (last AND chunk = 0)"), "chunks")
    incoming = lambda rows: rows.select("conv", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("incoming"))
    apart = " OR ".join(f"incoming[{k}] - incoming[0] <> tail[{k}] - tail[0]" for k in range(1, 4))
    while True:
        met = rest.join(incoming(rest), ["conv", "chunk"], "left")  # nothing comes after a last chunk
        wrong = save_scratch(met.where(apart), "wrong")
        if not wrong.head(1):
            break
        kept = met.where(f"incoming IS NULL OR NOT ({apart})").drop("incoming").select(*chunks.columns)
        rest = save_scratch(kept.unionAll(wrong.mapInArrow(_fix_up, _CHUNKS)), "chunks")
    shift = F.coalesce(F.col("incoming")[0] - F.col("tail")[0], F.lit(0)).cast("bigint")
    return save_scratch(single.withColumn("shift", F.lit(0).cast("bigint")).unionAll(met.withColumn("shift", shift).drop("incoming").select(*chunks.columns, "shift")), "converged")


def repair(turns: DataFrame, size: int = CHUNK) -> Repair:
    """Faults, cheapest edits and repaired turns of every conversation.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Rows are taken by turn, nulls
    first, then by role and text; a null role or text is one space. Rows without a conv_id are one
    conversation. A row's first fault counts: blank (nothing but white space), duplicate (role and text
    seen earlier), truncated (the last character but white space isn't one of . ! ?). Keep costs 0, another
    role (user or assistant) 1, delete 2, which blank and duplicate rows need, insert 5; truncated rows
    that stay add 5. Roles count by their first character, and an empty role can't be kept.
    ``audits``: conv_id (as a string, '' where it is null), gaps (turns missing between the first and the
    last number), blank, duplicate, truncated, illegal (neighbours that may not follow each other), cost
    and audit, the first letters of the cheapest edits, of several the least string.
    ``turns``: conv_id, pos, k, edit, role and text; inserted texts are empty. An empty table gives none.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    rows = in_order(rows, "conv", ["turn"], ["role", "text"])
    ending = F.rtrim("text", F.lit(WHITE))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    facts = rows.select("conv", "at", "turn", F.substring("role", 1, 1).alias("initial"), (ending == "").alias("blank"), (~F.right(ending, F.lit(1)).isin(ENDS)).alias("truncated"), same.alias("same"))
    facts = save_scratch(positions(facts, "conv"), "facts")
    firsts = facts.groupBy("conv", "same").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("first"))
    facts = facts.join(firsts, ["conv", "pos"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    number = kind * 3 + F.when(fault.isin("blank", "duplicate"), 1).when(fault == "truncated", 2).otherwise(0)
    facts = save_scratch(facts.select("conv", "at", "turn", "pos", fault.alias("fault"), F.char(number + _FIRST).alias("code")), "facts")

    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    found = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    counts = save_scratch(facts.groupBy("conv").agg(F.coalesce(spread, F.lit(0)).cast("bigint").alias("gaps"), *found, F.count("*").alias("n")), "counts")
    chunk = F.floor((F.col("pos") - 1) / size)
    chunks = facts.groupBy("conv", chunk.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    chunks = chunks.join(counts.select("conv", "n"), "conv")
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    chunks = chunks.select("conv", "chunk", ((F.col("chunk") + 1) * size >= F.col("n")).alias("last"), codes.alias("codes"))
    chunks = _converged(save_scratch(chunks.mapInArrow(_first_pass, _CHUNKS), "chunks"))

    traces = save_scratch(chunks.mapInArrow(_traces, _TRACES), "traces")
    long = traces.where("NOT (last AND chunk = 0)").select("conv", "chunk", "exits", F.left("codes", F.lit(1)).alias("first"), F.right("codes", F.lit(1)).alias("last"))
    entries = save_scratch(long.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_chain, _ENTRIES), "entries")
    taken = traces.join(entries.select("conv", "chunk", "entry"), ["conv", "chunk"], "left").withColumn("entry", F.coalesce("entry", F.lit(0)))
    taken = save_scratch(taken.select("conv", "chunk", "codes", "entry", F.get("audits", "entry").alias("audit")), "taken")
    whole = taken.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    begun = F.when(F.col("chunk") == 0, F.col("head")[0]).otherwise(0)
    costs = chunks.groupBy("conv").agg(F.sum("shift") + F.sum(begun), F.sum("illegal")).toDF("conv", "cost", "inside")
    across = entries.groupBy("conv").agg(F.sum("illegal").alias("across"))
    audits = counts.join(costs, "conv").join(whole, "conv").join(across, "conv", "left")
    audits = audits.select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", (F.col("inside") + F.coalesce("across", F.lit(0))).alias("illegal"), "cost", "audit"
    )

    edits = save_scratch(taken.mapInArrow(_edits(size), _EDITS), "edits")
    old = edits.where("edit <> 'I'").join(facts.select("conv", "pos", "at"), ["conv", "pos"]).drop("conv").join(rows, "at")
    kept = old.select(F.col("conv").alias("conv_id"), "pos", "k", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    new = edits.where("edit = 'I'").select(F.col("conv").alias("conv_id"), "pos", "k", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repair(audits, kept.unionAll(new))
