"""T401-T417 per geo, from metrics that are observed while the outputs are written.

``DataFrame.observe`` counts inside the tasks that write a table, so the checks cost no scan. What is
expected comes from the inputs: rows by geo, feature lists, cut-offs; nothing has to be pinned by hand.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, Observation
from pyspark.sql import functions as F

BUCKETS = ("RED", "AMBER", "GREEN")
RED_SHARE, AMBER_SHARE = (0.03, 0.20), (0.10, 0.35)


@dataclass(frozen=True)
class Verdict:
    geo: str
    test_id: str
    expected: str
    observed: str
    status: str


def _named(geos: list[str], metrics: Callable[[str], dict[str, Column]]) -> list[Column]:
    return [column.alias(f"{name}_{k}") for k, geo in enumerate(geos) for name, column in metrics(geo).items()]


def metrics_of(observation: Observation) -> dict:
    """What was observed; nothing where Spark knew that there were no rows and left the node out."""
    found = observation._jo.getAsJava()
    return {name: found[name] for name in found}


def by_geo(geos: list[str], observed: dict) -> dict[str, dict]:
    """Observed metrics as geo -> name -> value, 0 where nothing was observed."""
    out: dict[str, dict] = {g: defaultdict(int) for g in geos}
    for key, value in observed.items():
        name, _, k = key.rpartition("_")
        if k.isdigit():
            out[geos[int(k)]][name] = value
    return out


def input_metrics(geos: list[str], lists: dict[str, list[str]]) -> list[Column]:
    """Of the rows to be scored: how many each geo's model gets, with empty inputs, and rows that no geo gets."""

    def of(geo: str) -> dict[str, Column]:
        own = F.col("GEO").isNull() | (F.col("GEO") == geo)
        empty = F.exists(F.array(*[F.col(c).isNull() for c in lists[geo]]), lambda x: x)
        return {"want": F.count_if(own), "blank": F.count_if(own & empty)}

    return [*_named(geos, of), F.count_if(F.col("GEO").isNotNull() & ~F.col("GEO").isin(geos)).alias("unrouted")]


def employee_metrics(geos: list[str], cutoffs: dict[str, tuple]) -> list[Column]:
    score, bucket = F.col("risk_score"), F.col("risk_bucket")

    def of(geo: str) -> dict[str, Column]:
        own = F.col("geo") == geo
        red, amber = cutoffs.get(geo, (None, None))
        right = F.when(score >= F.lit(red), "RED").when(score >= F.lit(amber), "AMBER").otherwise("GREEN")
        count = {
            "n": F.count_if(own),
            "bad": F.count_if(own & (score.isNull() | F.isnan(score) | (score < 0) | (score > 1))),
            "wrong": F.count_if(own & ~bucket.eqNullSafe(right)),
            "mute": F.count_if(own & (bucket == "RED") & F.col("top_risk_drivers").isNull()),
        }
        for b in BUCKETS:
            mine = own & (bucket == b)
            count |= {b.lower(): F.count_if(mine), f"known{b}": F.count_if(mine & F.col("target").isNotNull()), f"hits{b}": F.count_if(mine & (F.col("target") == 1))}
        return count

    return _named(geos, of)


def variable_metrics(geos: list[str], lists: dict[str, list[str]], plain_geo: str, telemetry_prefix: str) -> list[Column]:
    rank, value = F.col("driver_rank"), F.col("risk_contribution")

    def of(geo: str) -> dict[str, Column]:
        own = F.col("geo") == geo
        telemetry = F.col("feature").startswith(telemetry_prefix) & (F.lit(geo) == plain_geo)
        return {
            "reasons": F.count_if(own),
            "lowering": F.count_if(own & ~(value > 0)),
            "outside": F.count_if(own & ~F.col("feature").isin(lists[geo])),
            "valueless": F.count_if(own & F.col("feature_value").isNull()),
            "lo": F.min(F.when(own, rank)),
            "hi": F.max(F.when(own, rank)),
            "telemetry": F.count_if(own & telemetry),
        }

    return _named(geos, of)


def _share(part: int, whole: int) -> str:
    return f"{100 * part / whole:.1f}%" if whole else "n/a"


def _inside(part: int, whole: int, limits: tuple[float, float]) -> bool:
    return not whole or limits[0] <= part / whole <= limits[1]


def judge(geo: str, m: dict, n_inputs: tuple[int, int], n_drivers: int, n_features: int, fresh: bool) -> list[Verdict]:
    """Verdicts of one geo. ``m``: its metrics; ``n_inputs``: expected and found inputs of its model."""
    exact = lambda test, want, got: Verdict(geo, test, str(want), str(got), "PASS" if want == got else "FAIL")
    ruled = lambda test, want, got, ok: Verdict(geo, test, want, got, "PASS" if ok else "FAIL")
    n, some = m["n"], m["want"] > 0
    rows = [
        exact("T401", m["want"], n),
        exact("T403", 0, m["bad"]),
        exact("T404", 0, m["wrong"]),
        ruled("T405", "3% - 20%", _share(m["red"], n), _inside(m["red"], n, RED_SHARE)),
        ruled("T406", "10% - 35%", _share(m["amber"], n), _inside(m["amber"], n, AMBER_SHARE)),
        exact("T407", 0, m["lowering"]),
        exact("T408", 0, m["outside"]),
        exact("T409", 0, m["valueless"]) if not m["blank"] else Verdict(geo, "T409", "INFO: inputs are empty in the data", str(m["valueless"]), "INFO"),
        ruled("T410", "min 1, max <= 10", f"min {m['lo']}, max {m['hi']}", not m["reasons"] or (m["lo"] == 1 and m["hi"] <= 10)),
        exact("T411", 0, m["telemetry"]),
        exact("T412", n_inputs[0], n_inputs[1]),
        ruled("T413", f"1 - {n_features}", str(n_drivers), not some or 0 < n_drivers <= n_features),
        ruled("T414", "renewed", "renewed" if fresh else "missing", fresh or not some),
        exact("T415", 0, m["mute"]),
    ]
    return rows


#: Shares of a small geo vary by chance: they hold a geo back only if the share of all rows is out of bounds too.
SHARES = ("T405", "T406")


def held_back(verdicts: list[Verdict], totals: dict[str, str]) -> dict[str, list[str]]:
    """geo -> failed checks that keep it from being released."""
    out: dict[str, list[str]] = {}
    for v in verdicts:
        if v.status == "FAIL" and (v.test_id not in SHARES or totals.get(v.test_id) == "FAIL"):
            out.setdefault(v.geo, []).append(v.test_id)
    return out


def totals(metrics: dict[str, dict], models: dict[str, tuple[int, int]], with_drivers: list[str], fresh: list[str], plain_geo: str, leftovers: int) -> list[tuple]:
    """Check rows over all geos: (test_id, scenario, expected, observed, ok or None)."""
    every = list(metrics.values())
    total = lambda name: sum(m[name] or 0 for m in every)
    sizes = lambda name: [m[name] for m in every if m[name]]
    spread = lambda ns: f"{len(ns)} geos, min {min(ns)}, max {max(ns)}" if ns else "0 geos"
    n, geos = total("n"), [g for g, m in metrics.items() if m["want"]]
    rate = lambda b: f"{total(f'hits{b}') / total(f'known{b}'):.3f}" if total(f"known{b}") else "n/a"
    listed = lambda k: ", ".join(f"{name}:{pair[k]}" for name, pair in sorted(models.items()))
    lo, hi = [m["lo"] for m in every if m["lo"]], [m["hi"] for m in every if m["hi"]]
    ranks = (f"min {min(lo)}, max {max(hi)}", min(lo) == 1 and max(hi) <= 10) if lo else ("none", True)
    valueless = "INFO: inputs are empty in the data" if total("blank") else "0"
    return [
        ("T401", "employees scored", str(total("want")), str(n)),
        ("T402", "geos, smallest and largest", spread(sizes("want")), spread(sizes("n"))),
        ("T403", "scores missing or outside 0..1", "0", str(total("bad"))),
        ("T404", "buckets that contradict the cut-offs", "0", str(total("wrong"))),
        ("T405", "RED share", "3% - 20%", _share(total("red"), n), _inside(total("red"), n, RED_SHARE)),
        ("T406", "AMBER share", "10% - 35%", _share(total("amber"), n), _inside(total("amber"), n, AMBER_SHARE)),
        ("T407", "drivers that do not raise the risk", "0", str(total("lowering"))),
        ("T408", "drivers outside the geo's feature list", "0", str(total("outside"))),
        ("T409", "drivers without a value", valueless, str(total("valueless"))),
        ("T410", "driver ranks", "min 1, max <= 10", *ranks),
        ("T411", f"telemetry drivers in {plain_geo}", "0", str(total("telemetry"))),
        ("T412", "inputs per production model", listed(0), listed(1)),
        ("T413", "geos with overall drivers", str(len(geos)), str(len(set(geos) & set(with_drivers)))),
        ("T414", "geos whose cut-offs were renewed", str(len(geos)), str(len(set(geos) & set(fresh)))),
        ("T415", "RED employees without a driver", "0", str(total("mute"))),
        ("T416", "event rate RED | AMBER | GREEN", "INFO: RED above GREEN shows a useful order", " | ".join(rate(b) for b in BUCKETS)),
        ("T417", "versions of this month that no release refers to", "0", str(leftovers)),
    ]
