"""One kernel for the models of all geos, so that rows are read, routed and scored in one scan.

A book holds what the kernel needs, by geo: where each input stands among the inputs of all geos, how
empty numbers and texts are coded, and the fitted model as plain arrays. It is broadcast once; its size
is bounded by geos x (rounds x 2^depth nodes) for trees and by geos x inputs for linear models, plus the
text labels, of which there are at most ``prepare.MAX_LABELS`` per column; columns of more are hashed.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.models.attribution import contributions, staged_margins

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXPLAINED = "struct<margin:double,place:array<int>,contribution:array<double>>"


def inputs_of(book: dict) -> list[Column]:
    """Numbers (NaN where empty) and texts of a row, in the order of the book."""
    missing = F.lit(float("nan"))
    numbers = [F.coalesce(F.col(c).cast("double"), missing) for c in book["numbers"]]
    return [
        F.array(*numbers).cast("array<double>").alias("n"),
        F.array(*[F.col(c) for c in book["texts"]]).cast("array<string>").alias("t"),
    ]


def encode(model: dict, numbers: np.ndarray, texts: list[pa.Array]) -> np.ndarray:
    """rows x inputs of one geo: filled numbers, and the place of a text among its labels or codes."""
    out = np.empty((len(numbers), len(model["inputs"])))
    for k, (is_text, place) in enumerate(model["inputs"]):
        if is_text:
            out[:, k] = _coded(model["labels"][k], texts[place])
        else:
            x = numbers[:, place]
            out[:, k] = np.where(np.isnan(x), model["fill"][k], x)
    return out


def _coded(labels: list[str] | int, texts: pa.Array) -> np.ndarray:
    """A text's place among the labels, or its hash bucket; empty and unseen texts come last."""
    if isinstance(labels, int):
        return hash_buckets(texts, labels)
    found = pc.index_in(texts, pa.array(labels, pa.string()))
    return pc.fill_null(found, len(labels)).to_numpy(zero_copy_only=False)


def hash_buckets(texts: pa.Array, buckets: int) -> np.ndarray:
    """CRC-32 of the distinct texts modulo the number of buckets; empty ones get the last number."""
    coded = texts.dictionary_encode()
    words = coded.dictionary.to_pylist()
    table = np.array([zlib.crc32(w.encode()) % buckets for w in words] + [buckets], np.int64)
    return table[pc.fill_null(coded.indices, len(words)).to_numpy(zero_copy_only=False)]


def margins(model: dict, x: np.ndarray) -> np.ndarray:
    """Log-odds of class 1."""
    if "trees" in model:
        return staged_margins(model["trees"], x, [model["trees"]["rounds"]])[:, 0]
    return model["base"] + shares(model, x).sum(1)


def shares(model: dict, x: np.ndarray) -> np.ndarray:
    """Contribution of each input to the log-odds: rows x inputs."""
    if "trees" in model:
        return contributions(model["trees"], x)
    out = np.empty(x.shape)
    for k, weights in enumerate(model["weights"]):
        numeric = not model["inputs"][k][0]
        out[:, k] = weights[0] * (x[:, k] - model["means"][k]) if numeric else weights[x[:, k].astype(np.int64)] - model["means"][k]
    return out


def _by_geo(geos: pa.Array, numbers: pa.Array, texts: pa.Array, book: dict) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(geo, its rows, their encoded inputs) of a batch."""
    n, t = len(book["numbers"]), len(book["texts"])
    matrix = np.asarray(numbers.flatten().to_numpy(zero_copy_only=False), float).reshape(len(geos), n)
    flat = texts.flatten()
    columns = [flat.take(pa.array(np.arange(len(geos)) * t + k)) for k in range(t)]
    coded = geos.dictionary_encode()
    of = coded.indices.to_numpy(zero_copy_only=False)
    for k, geo in enumerate(coded.dictionary.to_pylist()):
        rows = np.flatnonzero(of == k)
        mine = pa.array(rows)
        yield geo, rows, encode(book["geos"][geo], matrix[rows], [c.take(mine) for c in columns])


def scorer(shared, rounds: list[int] | None = None) -> Callable:
    """(geo, numbers, texts) -> log-odds, or with ``rounds`` those after each number of rounds."""

    def run(geo: pa.Array, n: pa.Array, t: pa.Array) -> pa.Array:
        book = shared.value
        out = np.empty((len(geo), len(rounds) if rounds else 1))
        for name, rows, x in _by_geo(geo, n, t, book):
            model = book["geos"][name]
            out[rows] = staged_margins(model["trees"], x, rounds) if rounds else margins(model, x)[:, None]
        if not rounds:
            return pa.array(out[:, 0])
        return pa.ListArray.from_arrays(np.arange(len(geo) + 1, dtype=np.int32) * len(rounds), out.ravel())

    return F.arrow_udf(run, "array<double>" if rounds else "double")


def explainer(shared, top_k: int | None) -> Callable:
    """(geo, numbers, texts) -> log-odds and the strongest contributions, by place among the names of the book."""

    def run(geo: pa.Array, n: pa.Array, t: pa.Array) -> pa.Array:
        book = shared.value
        total, sizes = np.empty(len(geo)), np.zeros(len(geo), np.int64)
        place, parts = [None] * len(geo), [None] * len(geo)
        for name, rows, x in _by_geo(geo, n, t, book):
            model = book["geos"][name]
            total[rows] = margins(model, x)
            by_name = np.argsort(model["names"], kind="stable")  # of equal contributions the first name leads
            found = shares(model, x)[:, by_name]
            order = np.argsort(-np.abs(found), axis=1, kind="stable")[:, :top_k]
            chosen, values = model["names"][by_name][order], np.take_along_axis(found, order, 1)
            sizes[rows] = order.shape[1]
            for k, r in enumerate(rows):
                place[r], parts[r] = chosen[k], values[k]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        flat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        lists = [pa.ListArray.from_arrays(offsets, flat(x, kind)) for x, kind in ((place, np.int32), (parts, float))]
        return pa.StructArray.from_arrays([pa.array(total), *lists], ["margin", "place", "contribution"])

    return F.arrow_udf(run, EXPLAINED)


def driver_sums(shared) -> Callable:
    """Function for ``mapInArrow``: one row per batch, geo and input with the sum of its absolute contributions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            for geo, rows, x in _by_geo(*[batch.column(c) for c in ("geo", "n", "t")], book):
                names = book["geos"][geo]["features"]
                sums = np.abs(shares(book["geos"][geo], x)).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([geo] * len(names)), pa.array(names), pa.array(sums), pa.array([len(rows)] * len(names))], ["geo", "feature", "total", "n"]
                )

    return run


def curve_sums(shared, rounds: int) -> Callable:
    """Function for ``mapInArrow``: losses of a batch after every round, by geo and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for batch in batches:
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(float)
            held = batch.column("is_eval").to_numpy(zero_copy_only=False).astype(bool)
            for geo, rows, x in _by_geo(*[batch.column(c) for c in ("geo", "n", "t")], book):
                trees = book["geos"][geo]["trees"]
                steps = np.arange(1, min(rounds, trees["rounds"]) + 1)
                staged = staged_margins(trees, x, steps.tolist())
                loss = np.logaddexp(0, np.where(target[rows, None] == 1, -staged, staged))
                for part in (False, True):
                    mine = held[rows] == part
                    if mine.any():
                        n = len(steps)
                        columns = [pa.array([geo] * n), pa.array([part] * n), pa.array(steps), pa.array(loss[mine].sum(0)), pa.array([int(mine.sum())] * n)]
                        yield pa.RecordBatch.from_arrays(columns, ["geo", "is_eval", "iteration", "total", "n"])

    return run
