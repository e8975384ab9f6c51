"""Per-variable contributions of boosted trees.

Path-dependent Shapley values (Lundberg, Erion, Lee, arXiv:1802.03888), arranged by leaf. On the
way to a leaf at most ``depth`` features are tested, and what the leaf adds to each of them
depends only on which of these tests the row passes. So every leaf gets a table
[feature, passed tests], and a batch of rows is explained by table look-ups: ``bits`` turns the
bin of a feature into its bit of the table's index.
"""

from __future__ import annotations

import sys
from functools import lru_cache
from math import factorial

import numpy as np
from pyspark import cloudpickle

# The kernel travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def contributions(explainer: dict, x: np.ndarray) -> np.ndarray:
    """Contribution of each feature (rows x features) to the log-odds of class 1."""
    leaves, bins = explainer["leaves"], bins_of(explainer, x).T
    out = np.zeros((explainer["n_features"], len(x)))
    for features, bits, table in leaves:
        passed = bits[0].take(bins[features[0]])
        for f, bit in zip(features[1:], bits[1:]):
            passed += bit.take(bins[f])
        for f, share in zip(features, table):
            out[f] += share.take(passed)
    return out.T


def bins_of(explainer: dict, x: np.ndarray) -> np.ndarray:
    """Bin of each tested feature (rows x features): where a number lies among the cuts, a category itself."""
    out = np.zeros(x.shape, np.int64)
    for f in explainer["tested"]:
        out[:, f] = np.searchsorted(explainer["cuts"][f], x[:, f]) if f in explainer["cuts"] else x[:, f]
    return out


def staged_margins(explainer: dict, x: np.ndarray, rounds: list[int]) -> np.ndarray:
    """Log-odds after each of the numbers of rounds, which rise: rows x len(rounds).

    All rows walk down one tree at a time; a leaf leads to itself.
    """
    walk, found = explainer["walk"], bins_of(explainer, x)
    every, total, out = np.arange(len(x)), np.zeros(len(x)), []
    wanted = iter(rounds)
    upto = next(wanted)
    for done, (root, depth) in enumerate(walk["roots"], 1):
        node = np.full(len(x), root)
        for _ in range(depth):
            left = walk["goes"][walk["at"][node] + found[every, walk["feature"][node]]]
            node = np.where(left, walk["left"][node], walk["right"][node])
        total = total + walk["value"][node]
        while upto is not None and (upto == done or done == len(walk["roots"])):
            out.append(total)
            upto = next(wanted, None)
    return np.stack(out, 1)


@lru_cache(maxsize=None)
def _shapley_weights(k: int) -> np.ndarray:
    """[passed, feature, coalition]: weight of a coalition's value in the feature's share.

    A coalition that contains a failed test has value zero.
    """
    weights = np.zeros((1 << k, k, 1 << k))
    for coalition in range(1 << k):
        size = coalition.bit_count()
        passed = [m for m in range(1 << k) if coalition & ~m == 0]
        for j in range(k):
            if coalition >> j & 1:
                share = factorial(size - 1) * factorial(k - size) / factorial(k)
            else:
                share = -factorial(size) * factorial(k - size - 1) / factorial(k)
            weights[passed, j, coalition] = share
    return weights


def _leaf_table(value: float, ratios: np.ndarray) -> np.ndarray:
    k = len(ratios)
    inside = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    worth = np.where(inside, 1.0, ratios).prod(axis=1)  # a coalition without a test meets it by its share of rows
    return value * (_shapley_weights(k) @ worth)


def build_explainer(nodes: list[dict], tree_weights: list[float], n_features: int) -> dict:
    """Leaf tables of a model, as plain arrays that can be broadcast.

    ``nodes``: one dict per tree node (tree, id, prediction, cover, left, right, feature, split,
    n_categories). ``split`` holds the categories that go left, or one threshold when
    ``n_categories`` is -1. ``base`` is the mean margin without any knowledge of the row.
    """
    trees: dict[int, dict[int, dict]] = {}
    thresholds: dict[int, set[float]] = {}
    sizes: dict[int, int] = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["id"]] = n
        if n["left"] >= 0:
            if n["n_categories"] < 0:
                thresholds.setdefault(n["feature"], set()).add(n["split"][0])
            else:
                sizes[n["feature"]] = n["n_categories"]
    cuts = {f: np.array(sorted(ts)) for f, ts in thresholds.items()}

    def goes_left(node: dict) -> np.ndarray:
        if node["n_categories"] < 0:
            return np.arange(len(cuts[node["feature"]]) + 1) <= np.searchsorted(cuts[node["feature"]], node["split"][0])
        return np.isin(np.arange(sizes[node["feature"]]), node["split"])

    walk = _walk(trees, tree_weights, goes_left, max([len(c) + 1 for c in cuts.values()] + [*sizes.values(), 1]))
    leaves: list[tuple] = []
    base = 0.0
    for tree, by_id in trees.items():
        scale = 2.0 * tree_weights[tree]  # the margin counts twice in the log-odds
        todo = [(by_id[0], {}, {})]
        while todo:
            node, allowed, ratio = todo.pop()
            if node["left"] < 0:
                value = scale * node["prediction"]
                base += value * float(np.prod(list(ratio.values())))
                if allowed:
                    features = sorted(allowed)
                    bits = [allowed[f].astype(np.int64) << j for j, f in enumerate(features)]
                    table = _leaf_table(value, np.array([ratio[f] for f in features]))
                    leaves.append((features, bits, np.ascontiguousarray(table.T)))
                continue
            f, left = node["feature"], goes_left(node)
            for child, passes in ((by_id[node["left"]], left), (by_id[node["right"]], ~left)):
                todo.append(
                    (
                        child,
                        {**allowed, f: allowed[f] & passes if f in allowed else passes},
                        {**ratio, f: ratio.get(f, 1.0) * child["cover"] / node["cover"]},
                    )
                )
    tested = sorted({*cuts, *sizes})
    return {"cuts": cuts, "leaves": leaves, "base": base, "n_features": n_features, "walk": walk, "tested": tested, "rounds": len(trees)}


def _walk(trees: dict[int, dict[int, dict]], weights: list[float], goes_left, widest: int) -> dict:
    """All trees' nodes as arrays: tested feature, place of its bins in ``goes``, children, value."""
    feature, at, left, right, value, goes, roots = [], [], [], [], [], [np.ones(widest + 1, bool)], []
    size = widest + 1
    for tree, by_id in sorted(trees.items()):
        first, depths = len(feature), {0: 0}
        place = {i: first + k for k, i in enumerate(sorted(by_id))}
        for i in sorted(by_id):  # parents have smaller numbers than their children
            node = by_id[i]
            inner = node["left"] >= 0
            feature.append(node["feature"] if inner else 0)
            left.append(place[node["left"]] if inner else place[i])
            right.append(place[node["right"]] if inner else place[i])
            value.append(2.0 * weights[tree] * node["prediction"])
            at.append(size if inner else 0)
            if inner:
                depths[node["left"]] = depths[node["right"]] = depths[i] + 1
                table = goes_left(node)
                goes.append(np.concatenate([table, np.zeros(1, bool)]))  # a category beyond the fitted ones goes right
                size += len(table) + 1
        roots.append((place[0], max(depths.values())))
    arrays = {k: np.array(v) for k, v in (("feature", feature), ("at", at), ("left", left), ("right", right), ("value", value))}
    return {**arrays, "goes": np.concatenate(goes), "roots": roots}
