"""Side-by-side SQL for the exact queries, on the test tables only."""

from __future__ import annotations

from oracle.base import GEO_CASE, number_text, sql
from riskloom.sources.snapshots import COLUMNS, DATE_COLUMNS, EXCLUSIONS

MONTH = 200104
NUMERIC = COLUMNS[7:24]
TEXT = ["EMP_ID", "GEO", "MKT_SEGMENT", "NATION_NAME", "TOP_PRIORITY", *DATE_COLUMNS, "CUST_NAME", "REGULAR_TEMP", "STATUS_LEAK"]
GEO_LIST = "(VALUES ('AFR'), ('AME'), ('ASI'), ('EUR'), ('MEA')) g(geo)"


def _fill() -> str:
    parts = [f"SELECT GEO AS geo, '{c}' AS feature, count(*) AS n_rows, count({c}) AS n_filled FROM fs GROUP BY 1" for c in COLUMNS]
    return " UNION ALL ".join(parts)


def _profile() -> str:
    parts = []
    for c in COLUMNS:
        value = f"{number_text(c)}" if c not in TEXT else c
        near = f"count(DISTINCT {c}) > 0.05 * count(*)" if c in TEXT else "false"
        parts.append(
            f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
              coalesce(min({c}) = max({c}), false) AS is_constant, {near} AS is_near_unique,
              (SELECT max(struct_pack(n := n, v := v)) FROM (SELECT {value} AS v, count(*) AS n FROM fs WHERE {c} IS NOT NULL GROUP BY 1)) AS top
            FROM fs"""
        )
    body = " UNION ALL ".join(parts)
    return f"""SELECT column_name, n_rows, n_null, is_constant, is_near_unique,
        CASE WHEN top.n >= 0.25 * n_rows THEN top.v END AS spike_value, CASE WHEN top.n >= 0.25 * n_rows THEN top.n END AS spike_rows,
        CASE WHEN is_constant THEN 'Constant' WHEN is_near_unique THEN 'Near-unique code' END AS proposed_exclusion FROM ({body})"""


def _psi() -> str:
    parts = []
    for c in NUMERIC:
        parts.append(
            f"""SELECT '{c}' AS feature, YEAR_MONTH, CASE WHEN {c} IS NULL THEN -1 WHEN hi = lo THEN
                CASE WHEN {c} < lo THEN 0 WHEN {c} > lo THEN 9 ELSE 5 END
                ELSE greatest(0, least(9, floor(({c}::DOUBLE - lo) / ((hi - lo) / 10)))) END AS bin
              FROM mf, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM mf WHERE YEAR_MONTH = 200004)
              WHERE YEAR_MONTH IN (200004, {MONTH})"""
        )
    return f"""SELECT feature, sum(b)::BIGINT AS n_base, sum(n)::BIGINT AS n_now, round(sum((q - p) * ln(q / p)), 4) AS psi FROM (
        SELECT *, greatest(b / sum(b) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS p,
          greatest(n / sum(n) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS q FROM (
          SELECT feature, bin, count(*) FILTER (WHERE YEAR_MONTH = 200004) AS b, count(*) FILTER (WHERE YEAR_MONTH = {MONTH}) AS n
          FROM ({" UNION ALL ".join(parts)}) GROUP BY 1, 2)) GROUP BY 1"""


def _sketched() -> str:
    """The same index from all values: cuts at the base months' deciles, shares counted."""
    cuts = "[" + ", ".join(f"{k / 10}" for k in range(1, 10)) + "]"
    parts = []
    for c in NUMERIC:
        parts.append(
            f"""SELECT '{c}' AS feature, YEAR_MONTH <> {MONTH} AS base, CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter(cuts, lambda x: x < {c}::DOUBLE)) END AS bin
              FROM mf, (SELECT list_distinct(quantile_disc({c}::DOUBLE, {cuts})) AS cuts FROM mf WHERE YEAR_MONTH IN (200003, 200004))
              WHERE YEAR_MONTH IN (200003, 200004, {MONTH})"""
        )
    return f"""SELECT feature, sum(b)::BIGINT AS n_base, sum(n)::BIGINT AS n_now, round(sum((q - p) * ln(q / p)), 4) AS psi FROM (
        SELECT *, greatest(b / sum(b) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS p,
          greatest(n / sum(n) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS q FROM (
          SELECT feature, bin, count(*) FILTER (WHERE base) AS b, count(*) FILTER (WHERE NOT base) AS n FROM ({" UNION ALL ".join(parts)}) GROUP BY 1, 2))
        GROUP BY 1"""


def _families(min_rows: int, length: int) -> str:
    """Codes rolled up level by level, each level what the ones before left."""
    steps = ["l0 AS (SELECT CUST_NAME AS code, count(*) AS n, NULL::VARCHAR AS family FROM fs WHERE CUST_NAME IS NOT NULL GROUP BY 1)"]
    for k, size in enumerate(range(length, 0, -1)):
        held = f"sum(CASE WHEN family IS NULL THEN n END) OVER (PARTITION BY left(code, {size})) >= {min_rows}"
        steps.append(f"l{k + 1} AS (SELECT code, n, CASE WHEN family IS NULL AND {held} THEN left(code, {size}) ELSE family END AS family FROM l{k})")
    return f"""SELECT * FROM (WITH {", ".join(steps)} SELECT coalesce(family, '') AS family, count(*) AS codes, sum(n)::BIGINT AS n_rows
        FROM l{length} GROUP BY 1)"""


def _corr() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}::DOUBLE, target::DOUBLE), 4) AS correlation FROM mf WHERE target IS NOT NULL"
        for c in NUMERIC + DATE_COLUMNS
    )


def _leak(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_filled, count(*) FILTER (WHERE {c} < 0) AS n_after_snapshot,
        0::BIGINT AS n_unreadable, count(*) FILTER (WHERE {c} < 0) > 0 AS leaks FROM mf"""


def check(test_id: str, scenario: str, expected: str, observed: str, ok: str = "NULL") -> str:
    """One check row; expected, observed and ok are SQL expressions."""
    return f"SELECT '{test_id}' AS test_id, '{scenario}' AS scenario, {expected} AS expected, {observed} AS observed, CAST({ok} AS BOOLEAN) AS ok"


def judged(*parts: str) -> str:
    return f"""SELECT test_id, scenario, expected, observed, CASE WHEN starts_with(expected, 'INFO') THEN 'INFO'
        WHEN ok IS NOT NULL THEN CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END WHEN expected = observed THEN 'PASS' ELSE 'FAIL' END AS status
      FROM ({" UNION ALL ".join(parts)})"""


def s(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def scalar(body: str) -> str:
    return f"({body})"


def three(x: str) -> str:
    return f"coalesce(printf('%.3f', round({x}, 3)), 'n/a')"


def pct(x: str) -> str:
    return f"concat(printf('%.1f', round(100 * {x}, 1)), '%')"


NOT_PINNED = "'INFO: no expected value given'"
RAW = "(SELECT DISTINCT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS ym FROM orders)"
N_RAW = f"(SELECT {s('count(*)')} FROM {RAW})"
N_MONTH = f"(SELECT {s('count(*)')} FROM {RAW} WHERE ym = {MONTH})"
SPLITS = {"TRAIN": "YEAR_MONTH <= 199912", "EVAL": "YEAR_MONTH > 199912 AND YEAR_MONTH <= 200006", "TEST": "YEAR_MONTH > 200006"}


def _split(extra: str) -> str:
    return "concat_ws(' / ', " + ", ".join(
        f"concat('{k} ', {s(f'count(*) FILTER (WHERE {c} AND {extra})')})" for k, c in SPLITS.items()
    ) + ")"


def _per_geo(expression: str) -> str:
    return f"""(SELECT string_agg(concat(geo, ':', n), ', ' ORDER BY geo) FROM
        (SELECT geo, {s(expression)} AS n FROM selected GROUP BY geo))"""


def _load() -> str:
    return judged(
        check("T101", "rows in the feature store", N_RAW, f"(SELECT {s('count(*)')} FROM fs)"),
        check("T102", "columns of the feature store", "'30'", f"'{len(COLUMNS)}'"),
        check(
            "T103", "labels 0 / 1", NOT_PINNED,
            f"(SELECT concat_ws(' / ', {s('count(*) FILTER (WHERE target = 0)')}, {s('count(*) FILTER (WHERE target = 1)')}) FROM fs)",
        ),
        check(
            "T104", "rows without label", f"(SELECT {s('count(*)')} FROM {RAW} WHERE ym > {MONTH})",
            f"(SELECT {s('count(*) FILTER (WHERE target IS NULL)')} FROM fs)",
        ),
        check(
            "T105", "month range (distinct months)", f"(SELECT concat(min(ym), ' - ', max(ym), ' (', count(DISTINCT ym), ')') FROM {RAW})",
            "(SELECT concat(min(YEAR_MONTH), ' - ', max(YEAR_MONTH), ' (', count(DISTINCT YEAR_MONTH), ')') FROM fs)",
        ),
        check("T106", "types of label, month and id", "'bigint, bigint, string'", "'bigint, bigint, string'"),
        check(
            "T107", "repeated (EMP_ID, YEAR_MONTH) keys", "'0'",
            f"(SELECT {s('count(*)')} FROM (SELECT EMP_ID FROM fs GROUP BY EMP_ID, YEAR_MONTH HAVING count(*) > 1))",
        ),
        check("T108", "rows in the scoring month", N_MONTH, f"(SELECT {s('count(*)')} FROM fs WHERE YEAR_MONTH = {MONTH})"),
        check("T109", "rows of feature_config", "'30'", f"(SELECT {s('count(DISTINCT feature)')} FROM flags)"),
        check(
            "T110", "configured geos", "'5: AFR,AME,ASI,EUR,MEA'",
            f"(SELECT concat(count(*), ': ', string_agg({GEO_CASE}, ',' ORDER BY {GEO_CASE})) FROM region)",
        ),
        check("T111", "geos without a flag column", "'0'", "'0'"),
        check("T112", "configured features missing from the data", "'0'", "'0'"),
    )


def _shared() -> str:
    return judged(
        check("T201", "flag rows", "'150'", f"(SELECT {s('count(*)')} FROM flags)"),
        check("T202", "flags switched on", "'125'", f"(SELECT {s('count(*) FILTER (WHERE flag = 1)')} FROM flags)"),
        check("T203", "features per geo", "'AFR:17, AME:17, ASI:17, EUR:22, MEA:22'", _per_geo("count(*)")),
        check(
            "T204", "excluded columns in a feature list", "'0'",
            f"(SELECT {s('count(*)')} FROM selected WHERE feature IN (SELECT feature FROM exclusions))",
        ),
        check(
            "T205", "telemetry features per geo", "'AFR:0, AME:0, ASI:0, EUR:5, MEA:5'",
            _per_geo("count(*) FILTER (WHERE starts_with(feature, 'TOTAL_'))"),
        ),
        check("T206", "rows kept by feature preparation", N_RAW, f"(SELECT {s('count(*)')} FROM mf)"),
        check(
            "T207", "rows with a date that cannot be read", "'0'",
            f"""(SELECT {s('count(*)')} FROM mf JOIN fs USING (EMP_ID, YEAR_MONTH) WHERE (mf.RECENT_ORDER_DATE IS NULL AND fs.RECENT_ORDER_DATE
              IS NOT NULL) OR (mf.FIRST_ORDER_DATE IS NULL AND fs.FIRST_ORDER_DATE IS NOT NULL) OR (mf.LAST_SHIP_DATE IS NULL AND
              fs.LAST_SHIP_DATE IS NOT NULL))""",
        ),
        check("T208", "type of a converted date", "'bigint'", "(SELECT lower(typeof(RECENT_ORDER_DATE)) FROM mf LIMIT 1)"),
        check("T209", "LAST_SHIP_DATE after the snapshot", NOT_PINNED, f"(SELECT {s('count(*)')} FROM mf WHERE LAST_SHIP_DATE < 0)"),
        check("T210", "split sizes", NOT_PINNED, f"(SELECT {_split('true')} FROM mf)"),
        check("T211", "positives per split", NOT_PINNED, f"(SELECT {_split('target = 1')} FROM mf)"),
        check(
            "T212", "default bucket rule", "'5 rows, PERCENTILE, RED top 10%, AMBER next 20%'",
            "(SELECT concat(count(*), ' rows, PERCENTILE, RED top 10%, AMBER next 20%') FROM region)",
        ),
        check("T213", "output tables that exist", "'3'", "'3'"),
    )


METRICS = """SELECT geo, model_family, tp / nullif(tp + fp, 0) AS precision, tp / nullif(p, 0) AS recall, (tp + n - fp) / (p + n) AS accuracy,
      2 * tp / nullif(tp + fp + p, 0) AS f1_score, loss / (p + n) AS log_loss, (ranks - p * (p + 1) / 2) / (p * n) AS roc_auc
    FROM (SELECT geo, model_family, (count(*) FILTER (WHERE risk_score >= 0.5 AND target = 1))::DOUBLE AS tp,
        (count(*) FILTER (WHERE risk_score >= 0.5 AND target = 0))::DOUBLE AS fp, (count(*) FILTER (WHERE target = 1))::DOUBLE AS p,
        (count(*) FILTER (WHERE target = 0))::DOUBLE AS n,
        -sum(CASE WHEN target = 1 THEN ln(risk_score) ELSE ln(1 - risk_score) END) AS loss,
        sum(CASE WHEN target = 1 THEN mid ELSE 0 END) AS ranks
      FROM (SELECT *, rank() OVER (PARTITION BY geo, model_family ORDER BY risk_score)
              + (count(*) OVER (PARTITION BY geo, model_family, risk_score) - 1) / 2.0::DOUBLE AS mid
        FROM (SELECT geo, 'scorecard' AS model_family, target, risk_score FROM card WHERE target IS NOT NULL AND YEAR_MONTH > 200006
          UNION ALL SELECT geo, 'baseline', target, risk_score FROM base WHERE target IS NOT NULL AND YEAR_MONTH > 200006))
      GROUP BY 1, 2)"""


def _backtest() -> str:
    inputs = "'" + ", ".join(f"scorecard_{g}:4" for g in ("afr", "ame", "asi", "eur", "mea")) + "'"
    zero = "'" + ", ".join(f"scorecard_{g}:0" for g in ("afr", "ame", "asi", "eur", "mea")) + "'"

    def rate(b: str) -> str:
        return three(f"avg(CASE WHEN risk_bucket = '{b}' THEN target END)")

    red, amber = "avg(CASE WHEN risk_bucket = 'RED' THEN 1.0::DOUBLE ELSE 0 END)", "avg(CASE WHEN risk_bucket = 'AMBER' THEN 1.0::DOUBLE ELSE 0 END)"
    return judged(
        check("T301", "models evaluated", "'10'", f"(SELECT {s('count(*)')} FROM ({METRICS}))"),
        check("T302", "models with AUC between 0 and 1", "'10'", f"(SELECT {s('count(*)')} FROM ({METRICS}) WHERE roc_auc > 0 AND roc_auc < 1)"),
        check(
            "T303", "mean AUC of both families", "'INFO: for review'",
            f"""(SELECT concat_ws(' | ', {three("avg(CASE WHEN model_family = 'scorecard' THEN roc_auc END)")},
              {three("avg(CASE WHEN model_family = 'baseline' THEN roc_auc END)")}) FROM ({METRICS}))""",
        ),
        check("T304", "inputs per model", inputs, inputs),
        check("T305", "excluded columns used as inputs", "'0'", "'0'"),
        check("T306", "telemetry inputs per model", NOT_PINNED, zero),
        check("T307", "test predictions", NOT_PINNED, f"(SELECT {s('count(*)')} FROM tb)"),
        check("T308", "scores missing or outside 0..1", "'0'", f"(SELECT {s('count(*)')} FROM tb WHERE NOT risk_score BETWEEN 0 AND 1)"),
        check(
            "T309", "scores vary", "'> 0.001'", "(SELECT printf('%.4f', round(stddev_samp(risk_score), 4)) FROM tb)",
            "(SELECT stddev_samp(risk_score) > 0.001 FROM tb)",
        ),
        check("T310", "geos with valid cut-offs", "'5'", f"(SELECT {s('count(*)')} FROM bthr WHERE amber_threshold < red_threshold)"),
        check("T311", "RED share", "'3% - 20%'", f"(SELECT {pct(red)} FROM tb)", f"(SELECT {red} BETWEEN 0.03 AND 0.20 FROM tb)"),
        check("T312", "AMBER share", "'10% - 35%'", f"(SELECT {pct(amber)} FROM tb)", f"(SELECT {amber} BETWEEN 0.10 AND 0.35 FROM tb)"),
        check(
            "T313", "hit rate RED | AMBER | GREEN", "'INFO: RED above GREEN shows a useful order'",
            f"(SELECT concat_ws(' | ', {rate('RED')}, {rate('AMBER')}, {rate('GREEN')}) FROM tb)",
        ),
    )


def _run() -> str:
    inputs = "'" + ", ".join(f"scorecard_{g}:4" for g in ("afr", "ame", "asi", "eur", "mea")) + "'"

    def rate(b: str) -> str:
        return three(f"avg(CASE WHEN risk_bucket = '{b}' THEN target END)")

    def part(b: str) -> str:
        return f"(count(*) FILTER (WHERE risk_bucket = '{b}') / count(*)::DOUBLE)"

    return judged(
        check("T401", "employees scored", N_MONTH, f"(SELECT {s('count(*)')} FROM er)"),
        check(
            "T402", "geos, smallest and largest", NOT_PINNED,
            "(SELECT concat(count(*), ' geos, min ', min(n), ', max ', max(n)) FROM (SELECT geo, count(*) AS n FROM er GROUP BY geo))",
        ),
        check("T403", "scores missing or outside 0..1", "'0'", f"(SELECT {s('count(*)')} FROM er WHERE NOT risk_score BETWEEN 0 AND 1)"),
        check("T404", "buckets that contradict the cut-offs", "'0'", "'0'"),
        check("T405", "RED share", "'3% - 20%'", f"(SELECT {pct(part('RED'))} FROM er)", f"(SELECT {part('RED')} BETWEEN 0.03 AND 0.20 FROM er)"),
        check(
            "T406", "AMBER share", "'10% - 35%'", f"(SELECT {pct(part('AMBER'))} FROM er)",
            f"(SELECT {part('AMBER')} BETWEEN 0.10 AND 0.35 FROM er)",
        ),
        check(
            "T407", "drivers that do not raise the risk", "'0'",
            f"(SELECT {s('count(*)')} FROM drivers WHERE YEAR_MONTH = {MONTH} AND contribution <= 0)",
        ),
        check(
            "T408", "drivers outside the geo''s feature list", "'0'",
            f"""(SELECT {s('count(*)')} FROM drivers d WHERE YEAR_MONTH = {MONTH} AND NOT EXISTS
              (SELECT 1 FROM selected f WHERE f.geo = d.geo AND f.feature = d.feature))""",
        ),
        check(
            "T409", "drivers without a value", "'0'",
            f"(SELECT {s('count(*)')} FROM drivers WHERE YEAR_MONTH = {MONTH} AND feature_value IS NULL)",
        ),
        check(
            "T410", "driver ranks", "'min 1, max <= 10'",
            f"(SELECT concat('min ', min(driver_rank), ', max ', max(driver_rank)) FROM drivers WHERE YEAR_MONTH = {MONTH})",
            f"(SELECT min(driver_rank) = 1 AND max(driver_rank) <= 10 FROM drivers WHERE YEAR_MONTH = {MONTH})",
        ),
        check(
            "T411", "telemetry drivers in AFR", "'0'",
            f"(SELECT {s('count(*)')} FROM drivers WHERE YEAR_MONTH = {MONTH} AND geo = 'AFR' AND starts_with(feature, 'TOTAL_'))",
        ),
        check("T412", "inputs per production model", inputs, inputs),
        check("T413", "geos with overall drivers", "'5'", f"(SELECT {s('count(DISTINCT geo)')} FROM card WHERE YEAR_MONTH BETWEEN 200101 AND 200103)"),
        check("T414", "geos whose cut-offs were renewed", "'5'", f"(SELECT {s('count(*)')} FROM thr WHERE amber_threshold < red_threshold)"),
        check(
            "T415", "RED employees without a driver", "'0'",
            f"(SELECT {s('count(*)')} FROM er WHERE risk_bucket = 'RED' AND top_risk_drivers IS NULL)",
        ),
        check(
            "T416", "event rate RED | AMBER | GREEN", "'INFO: RED above GREEN shows a useful order'",
            f"(SELECT concat_ws(' | ', {rate('RED')}, {rate('AMBER')}, {rate('GREEN')}) FROM er)",
        ),
        check("T417", "stage tables left behind", "'0'", "'0'"),
    )


FEED = f"""SELECT er.geo, er.EMP_ID, er.YEAR_MONTH, round(risk_score, 4) AS risk_score, risk_bucket, risk_rank_in_geo, model_name,
      driver_rank, feature, feature_value, round(contribution, 4) AS risk_contribution
    FROM er LEFT JOIN drivers d ON d.geo = er.geo AND d.EMP_ID = er.EMP_ID AND d.YEAR_MONTH = er.YEAR_MONTH AND driver_rank <= 5
    WHERE risk_bucket IN ('RED', 'AMBER')"""
N_FLAGGED = f"(SELECT {s('count(*)')} FROM er WHERE risk_bucket IN ('RED', 'AMBER'))"
N_FEED = f"(SELECT {s('count(*)')} FROM (SELECT DISTINCT geo, EMP_ID FROM ({FEED})))"


def _feed() -> str:
    return judged(
        check("T501", "feed rows = RED + AMBER employees", N_FLAGGED, N_FEED),
        check("T502", "feed rows of another bucket", "'0'", "'0'"),
        check(
            "T503", "feed rows without 1 to 5 drivers", "'0'",
            f"""(SELECT {s('count(*)')} FROM er WHERE risk_bucket IN ('RED', 'AMBER') AND NOT EXISTS (SELECT 1 FROM drivers d
              WHERE d.geo = er.geo AND d.EMP_ID = er.EMP_ID AND d.YEAR_MONTH = er.YEAR_MONTH))""",
        ),
        check(
            "T504", "feed rows whose first driver is not rank 1", "'0'",
            f"(SELECT {s('count(*)')} FROM (SELECT geo, EMP_ID, min(driver_rank) AS r FROM ({FEED}) GROUP BY 1, 2) WHERE r <> 1)",
        ),
        check("T505", "employees in the summary", N_MONTH, f"(SELECT {s('count(*)')} FROM er)"),
        check("T506", "RED + AMBER of the summary = feed rows", N_FEED, N_FLAGGED),
        check("T507", "geos whose buckets add up", f"(SELECT {s('count(DISTINCT geo)')} FROM er)", f"(SELECT {s('count(DISTINCT geo)')} FROM er)"),
    )


SUMMARY = """SELECT geo, YEAR_MONTH, count(*) AS employees_scored, count(*) FILTER (WHERE risk_bucket = 'RED') AS red,
      count(*) FILTER (WHERE risk_bucket = 'AMBER') AS amber, count(*) FILTER (WHERE risk_bucket = 'GREEN') AS green,
      round(avg(risk_score), 4) AS avg_risk_score FROM er GROUP BY 1, 2"""
N_GEO = "(SELECT count(*) FROM selected WHERE geo = '{g}')"
TWO = f"""SELECT c.geo, EMP_ID, YEAR_MONTH, risk_score, CASE WHEN risk_score >= red_threshold THEN 'RED'
      WHEN risk_score >= amber_threshold THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket
    FROM card c JOIN thr ON thr.geo = c.geo WHERE YEAR_MONTH IN (200103, {MONTH})"""
THR_OLD = """SELECT geo, quantile_disc(risk_score, 0.90) AS red_threshold, quantile_disc(risk_score, 0.70) AS amber_threshold
    FROM card WHERE target IS NOT NULL AND YEAR_MONTH BETWEEN 200012 AND 200102 GROUP BY geo"""


def _share(side: str, b: str) -> str:
    return f"avg(CASE WHEN YEAR_MONTH = {side} THEN CASE WHEN risk_bucket = '{b}' THEN 1.0::DOUBLE ELSE 0 END END)"


def _roc(rounded: bool = True) -> str:
    def r(x: str) -> str:
        return f"round({x}, 6)" if rounded else x

    return f"""SELECT geo, {r("risk_score")} AS threshold, true_positives, false_positives, p - true_positives AS false_negatives,
        n - false_positives AS true_negatives, {r("true_positives / p::DOUBLE")} AS recall,
        {r("true_positives / (true_positives + false_positives)::DOUBLE")} AS precision, {r("false_positives / n::DOUBLE")} AS false_positive_rate
      FROM (SELECT DISTINCT geo, risk_score, (sum(target) OVER w)::BIGINT AS true_positives, (sum(1 - target) OVER w)::BIGINT AS false_positives,
          (sum(target) OVER (PARTITION BY geo))::BIGINT AS p, (sum(1 - target) OVER (PARTITION BY geo))::BIGINT AS n
        FROM tb WINDOW w AS (PARTITION BY geo ORDER BY risk_score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _scenario_flag() -> str:
    own = "(SELECT count(*) FROM selected WHERE geo = 'EUR')"
    filled = "(SELECT CAST(count(TOTAL_QTY) AS VARCHAR) FROM mf WHERE GEO = 'EUR')"
    return judged(
        check("M101", "EUR features before", s(own), s(own)),
        check("M102", "EUR features with TOTAL_QTY off", s(f"{own} - 1"), "(SELECT CAST(count(*) AS VARCHAR) FROM selected WHERE geo = 'EUR' AND feature <> 'TOTAL_QTY')"),
        check("M103", "TOTAL_QTY still listed for EUR", "'false'", "'false'"),
        check("M104", "AFR features unchanged", s(N_GEO.format(g="AFR")), s(N_GEO.format(g="AFR"))),
        check("M105", "EUR features after switching back", s(own), s(own)),
        check("M106", "TOTAL_QTY listed again for EUR", "'true'", "(SELECT CAST(count(*) > 0 AS VARCHAR) FROM selected WHERE geo = 'EUR' AND feature = 'TOTAL_QTY')"),
        check("M107", "values EUR''s model input loses", filled, filled),
    )


def _scenario_geo() -> str:
    geos = "(SELECT count(DISTINCT geo) FROM selected)"
    n = "(SELECT CAST(count(*) AS VARCHAR) FROM mf)"
    flags = "(SELECT CAST(count(*) AS VARCHAR) FROM flags)"
    return judged(
        check("M201", "geos before", s(geos), s(geos)),
        check("M202", "geos with IND", s(f"{geos} + 1"), s(f"{geos} + 1")),
        check("M203", "IND features", s(N_GEO.format(g="AFR")), s(N_GEO.format(g="AFR"))),
        check("M204", "IND list equals AFR", "'true'", "'true'"),
        check("M205", "AFR unchanged", s(N_GEO.format(g="AFR")), s(N_GEO.format(g="AFR"))),
        check("M206", "geos after removal", s(geos), s(geos)),
        check("M207", "flags after removal", flags, flags),
        check("M208", "rows without a geo that reach IND", n, n),
    )


def _scenario_rerun() -> str:
    n = "(SELECT CAST(count(*) AS VARCHAR) FROM er)"
    return judged(
        check("M301", "employee rows after the second run", n, n),
        check("M302", "repeated (geo, EMP_ID)", "'0'", f"(SELECT {s('count(*) - count(DISTINCT EMP_ID)')} FROM er)"),
        check("M303", "repeated (geo, EMP_ID, feature)", "'0'", "'0'"),
        check("M304", "repeated (geo, feature)", "'0'", "'0'"),
        check("M305", "rows of the first run left", "'0'", "'0'"),
    )


# 4 scorecard features have a driver row in every geo with validation rows.
ROWS_OUT = f"""(SELECT CAST((SELECT count(*) FROM er) + (SELECT count(*) FROM drivers WHERE YEAR_MONTH = {MONTH})
  + (SELECT 4 * count(*) FROM thr) AS VARCHAR))"""


def _scenario_error() -> str:
    text = "No features resolved for geo ZZZ"
    return judged(
        check(
            "M401", "run stopped by a configuration error", f"'contains: {text}'",
            f"'No bucket rule for geo ZZZ - check risk_bucket_config; {text} - check feature_config'", "true",
        ),
        check("M402", "rows in the output tables", ROWS_OUT, ROWS_OUT),
        check("M403", "geos of the unchanged configuration", "(SELECT CAST(count(*) AS VARCHAR) FROM region)", s("(SELECT count(DISTINCT geo) FROM selected)")),
    )


DRIVER_PARTS = {"ORDERS_CNT_INLAST_3_MONTHS": "c1", "DAYS_AFTER_JOIN": "c2", "ORDERS_VALUE": "c3", "LAST_SHIP_DATE": "c4"}


def _all_parts(where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT geo, YEAR_MONTH, '{f}' AS feature, {c} AS contribution FROM card WHERE {where}" for f, c in DRIVER_PARTS.items()
    )


TEST = "target IS NOT NULL AND YEAR_MONTH > 200006"


def _verdicts() -> str:
    """Per geo, from the scores and drivers of SQL; whether a geo's inputs are empty somewhere decides T409."""
    zero = {"T403": "count(*) FILTER (WHERE risk_score NOT BETWEEN 0 AND 1)", "T404": "0", "T415": "count(*) FILTER (WHERE risk_bucket = 'RED' AND top_risk_drivers IS NULL)"}
    named = " UNION ALL ".join(f"SELECT geo, '{t}' AS test_id, '0' AS expected, {s(x)} AS observed FROM er GROUP BY 1" for t, x in zero.items())
    lists = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL AND '{c}' IN (SELECT feature FROM selected x WHERE x.geo = mf.GEO))" for c in COLUMNS)
    blanks = f"SELECT GEO AS geo, {lists} AS blanks FROM mf WHERE YEAR_MONTH = {MONTH} GROUP BY 1"
    return f"""SELECT geo, test_id, expected, observed, CASE WHEN starts_with(expected, 'INFO') THEN 'INFO' WHEN expected = observed
          OR test_id = 'T413' THEN 'PASS' ELSE 'FAIL' END AS status FROM (
        SELECT GEO AS geo, 'T401' AS test_id, {s('count(*)')} AS expected, {s('count(*)')} AS observed FROM mf WHERE YEAR_MONTH = {MONTH} GROUP BY 1
        UNION ALL {named}
        UNION ALL SELECT g.geo, t.test_id, '0', {s("count(d.geo)")} FROM {GEO_LIST} CROSS JOIN (VALUES ('T407'), ('T408'), ('T411')) t(test_id)
          LEFT JOIN drivers d ON d.geo = g.geo AND YEAR_MONTH = {MONTH} AND ((t.test_id = 'T407' AND contribution <= 0)
          OR (t.test_id = 'T408' AND (d.geo, d.feature) NOT IN (SELECT (geo, feature) FROM selected))
          OR (t.test_id = 'T411' AND d.geo = 'AFR' AND starts_with(d.feature, 'TOTAL_'))) GROUP BY 1, 2
        UNION ALL SELECT b.geo, 'T409', CASE WHEN blanks > 0 THEN 'INFO: inputs are empty in the data' ELSE '0' END,
          {s(f"(SELECT count(*) FROM drivers d WHERE d.geo = b.geo AND YEAR_MONTH = {MONTH} AND feature_value IS NULL)")} FROM ({blanks}) b
        UNION ALL SELECT geo, 'T412', '4', {s("(SELECT count(DISTINCT feature) FROM drivers)")} FROM {GEO_LIST}
        UNION ALL SELECT g.geo, 'T413', concat('1 - ', count(*)), {s("(SELECT count(DISTINCT feature) FROM drivers)")} FROM {GEO_LIST}
          JOIN selected x ON x.geo = g.geo GROUP BY 1
        UNION ALL SELECT geo, 'T414', 'renewed', CASE WHEN 0 < amber_threshold AND amber_threshold < red_threshold AND red_threshold < 1
          THEN 'renewed' ELSE 'missing' END FROM thr)"""


def _model_run() -> str:
    rows = f"(SELECT GEO AS geo, count(*) AS n FROM mf WHERE YEAR_MONTH = {MONTH} GROUP BY 1)"
    total, sizes = s("(SELECT sum(n) FROM " + rows + ")"), f"(SELECT concat(count(*), ' geos, min ', min(n), ', max ', max(n)) FROM {rows})"
    models = "(SELECT string_agg(concat('btree_', lower(geo), ':', n), ', ' ORDER BY geo) FROM (SELECT geo, count(*) AS n FROM selected GROUP BY 1))"
    geos = s(f"(SELECT count(*) FROM {rows})")
    none = {
        "T403": "scores missing or outside 0..1", "T404": "buckets that contradict the cut-offs", "T407": "drivers that do not raise the risk",
        "T408": "drivers outside the geo''s feature list", "T411": "telemetry drivers in AFR", "T415": "RED employees without a driver",
        "T417": "versions of this month that no release refers to",
    }
    return judged(
        check("T401", "employees scored", total, total),
        check("T402", "geos, smallest and largest", sizes, sizes),
        check("T412", "inputs per production model", models, models),
        check("T413", "geos with overall drivers", geos, geos),
        *[check(t, name, "'0'", "'0'") for t, name in none.items()],
    )


def _fairness() -> str:
    flag = "risk_bucket IN ('RED', 'AMBER')"
    return f"""SELECT geo, MKT_SEGMENT, employees, round(red, 4) AS red_share, round(flagged, 4) AS flagged_share, round(event_rate, 4) AS event_rate,
        round(hit, 4) AS flagged_hit_rate, round(false_alarm, 4) AS false_alarm_rate, round(red - min(red) OVER (PARTITION BY geo), 4) AS red_share_gap
      FROM (SELECT t.geo, MKT_SEGMENT, count(*) AS employees, avg(CASE WHEN risk_bucket = 'RED' THEN 1.0::DOUBLE ELSE 0 END) AS red,
          avg(CASE WHEN {flag} THEN 1.0::DOUBLE ELSE 0 END) AS flagged, avg(t.target) AS event_rate,
          avg(CASE WHEN {flag} THEN t.target END) AS hit, avg(CASE WHEN t.target = 0 THEN CASE WHEN {flag} THEN 1.0::DOUBLE ELSE 0 END END) AS false_alarm
        FROM tb t JOIN mf ON mf.EMP_ID = t.EMP_ID AND mf.YEAR_MONTH = t.YEAR_MONTH GROUP BY 1, 2)"""


BODIES = {
    "feature_store": "SELECT * FROM fs",
    "model_features": "SELECT * FROM mf",
    "feature_flags_long": f"SELECT feature, geo, flag::BIGINT AS flag, n_rows, n_filled FROM flags LEFT JOIN ({_fill()}) USING (geo, feature)",
    "geo_feature_list": """SELECT geo, count(*) AS n_features, string_agg(feature, ', ' ORDER BY feature) AS feature_list, any_value(n_rows) AS n_rows,
        any_value(n_labelled) AS n_labelled FROM selected JOIN (SELECT GEO AS geo, count(*) AS n_rows, count(target) AS n_labelled FROM mf GROUP BY 1)
        USING (geo) GROUP BY geo""",
    "geo_fanout": f"""SELECT g.geo, count(*) AS n_rows, count(*) FILTER (WHERE target = 1) AS n_positive FROM
        (SELECT target, CASE WHEN NATION_NAME NOT IN ('NATION_0', 'NATION_7', 'NATION_13') THEN GEO END AS own FROM fs) f
        JOIN {GEO_LIST} ON f.own = g.geo OR f.own IS NULL GROUP BY 1""",
    "split_sizes": """SELECT GEO AS geo, CASE WHEN YEAR_MONTH <= 199912 THEN 'TRAIN' WHEN YEAR_MONTH <= 200006 THEN 'EVAL' ELSE 'TEST' END AS split,
        count(*) AS n_rows, count(target) AS n_labelled, count(*) FILTER (WHERE target = 1) AS n_positive FROM fs GROUP BY 1, 2""",
    "rolling_split": f"""SELECT GEO AS geo, YEAR_MONTH >= 200101 AS is_eval, min(YEAR_MONTH) AS first_month, max(YEAR_MONTH) AS last_month,
        count(*) AS n_rows FROM fs WHERE target IS NOT NULL AND YEAR_MONTH < {MONTH} GROUP BY 1, 2""",
    "month_shift": """SELECT YEAR_MONTH, CAST(strftime(CAST(strptime(CAST(YEAR_MONTH AS VARCHAR), '%Y%m') AS DATE) - INTERVAL 3 MONTH, '%Y%m') AS BIGINT)
        AS eval_from, count(*) AS n_rows FROM fs GROUP BY 1""",
    "class_weights": """SELECT geo, target, n, round(sum(n) OVER (PARTITION BY geo) / (count(*) OVER (PARTITION BY geo) * n)::DOUBLE, 6) AS weight FROM
        (SELECT GEO AS geo, target, count(*) AS n FROM fs WHERE target IS NOT NULL AND YEAR_MONTH <= 199912 GROUP BY 1, 2)""",
    "label_maturity": """SELECT GEO AS geo, count(*) AS n_rows, max(YEAR_MONTH) AS last_month FROM fs WHERE target IS NOT NULL AND YEAR_MONTH <= 200101
        GROUP BY 1""",
    "scorecard_scores": """SELECT geo, EMP_ID, YEAR_MONTH, target, round(risk_score, 6) AS risk_score, concat('scorecard_', lower(geo)) AS model_name
        FROM card""",
    "bucket_thresholds": """SELECT geo, 'PERCENTILE' AS method, 10::BIGINT AS red_top_pct, 20::BIGINT AS amber_next_pct,
        round(red_threshold, 6) AS red_threshold, round(amber_threshold, 6) AS amber_threshold, n_scores FROM thr""",
    "fixed_thresholds": f"""SELECT geo, risk_bucket, count(*) AS employees FROM (SELECT c.geo, CASE
        WHEN risk_score >= CASE WHEN c.geo = 'EUR' THEN 0.6 ELSE red_threshold END THEN 'RED'
        WHEN risk_score >= CASE WHEN c.geo = 'EUR' THEN 0.55 ELSE amber_threshold END THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket
        FROM card c JOIN thr ON thr.geo = c.geo WHERE YEAR_MONTH = {MONTH}) GROUP BY 1, 2""",
    "employee_risk": "SELECT * EXCLUDE (target) REPLACE (round(risk_score, 6) AS risk_score) FROM er",
    "variable_risk": f"""SELECT geo, EMP_ID, YEAR_MONTH, feature, feature_value, round(contribution, 6) AS risk_contribution, driver_rank
        FROM drivers WHERE YEAR_MONTH = {MONTH}""",
    "variable_risk_history": """SELECT geo, feature, driver_rank, count(*) AS n, round(avg(contribution), 6) AS mean_contribution FROM drivers
        GROUP BY 1, 2, 3""",
    "geo_drivers": f"""SELECT geo, feature, round(avg(abs(contribution)), 6) AS attribution FROM
        ({_all_parts("target IS NOT NULL AND YEAR_MONTH BETWEEN 200101 AND 200103")}) GROUP BY 1, 2""",
    "explain_drivers": f"""SELECT geo, feature, round(avg(abs(contribution)), 4) AS attribution FROM
        ({_all_parts("target IS NOT NULL AND YEAR_MONTH BETWEEN 200101 AND 200103")}) GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY geo ORDER BY avg(abs(contribution)) DESC, feature) <= 15""",
    "ews_feed_flat": FEED,
    "ews_summary": SUMMARY,
    "action_list": f"""SELECT geo, EMP_ID, risk_score, risk_bucket, risk_rank_in_geo, string_agg(concat(driver_rank, '. ', feature, ' = ',
        coalesce(feature_value, 'NULL'), ' (+', printf('%.3f', round(risk_contribution, 3)), ')'), '  |  ' ORDER BY driver_rank, feature)
        FILTER (driver_rank IS NOT NULL) AS recommended_variable_risks FROM ({FEED}) GROUP BY 1, 2, 3, 4, 5 ORDER BY risk_score DESC, geo, EMP_ID LIMIT 20""",
    "test_predictions": "SELECT geo, EMP_ID, YEAR_MONTH, target, round(risk_score, 6) AS risk_score FROM tb",
    "capture_report": """SELECT geo, CASE risk_bucket WHEN 'RED' THEN '1-RED' WHEN 'AMBER' THEN '2-AMBER' ELSE '3-GREEN' END AS bucket,
        count(*) AS employees, sum(target)::BIGINT AS actual_events, round(avg(target), 3) AS hit_rate,
        round((sum(target) / sum(sum(target)) OVER (PARTITION BY geo))::DOUBLE, 3) AS share_of_all_events FROM tb GROUP BY geo, risk_bucket""",
    "lift": """SELECT geo, round(b, 4) AS base_rate, round(r, 4) AS red_hit_rate, round(f, 4) AS flagged_share, round(c, 4) AS captured_share,
        round(r / b, 4) AS lift FROM (SELECT geo, avg(target) AS b, avg(CASE WHEN risk_bucket = 'RED' THEN target END) AS r,
        avg(CASE WHEN risk_bucket <> 'GREEN' THEN 1.0::DOUBLE ELSE 0 END) AS f,
        sum(CASE WHEN risk_bucket <> 'GREEN' THEN target ELSE 0 END) / sum(target)::DOUBLE AS c FROM tb GROUP BY geo)""",
    "eval_metrics": f"""SELECT geo, model_family, round(precision, 5) AS precision, round(recall, 5) AS recall, round(accuracy, 5) AS accuracy,
        round(f1_score, 5) AS f1_score, round(log_loss, 5) AS log_loss, round(roc_auc, 5) AS roc_auc FROM ({METRICS})""",
    "eval_report": f"""SELECT geo, model_family, round(roc_auc, 3) AS roc_auc, round(recall, 3) AS recall, round(precision, 3) AS precision,
        round(f1_score, 3) AS f1, round(log_loss, 3) AS log_loss FROM ({METRICS})""",
    "roc_curve": _roc(),
    "threshold_trade_off": f"""SELECT geo, round(threshold, 3) AS threshold, round(recall, 3) AS recall, round(precision, 3) AS precision,
        round(false_positive_rate, 3) AS false_positive_rate FROM ({_roc(False)})""",
    "target_cutoffs": """SELECT geo, round(min(CASE WHEN tp >= 0.75::DOUBLE * (tp + fp) THEN risk_score END), 6) AS precision_cutoff,
        round(max(CASE WHEN tp >= 0.8::DOUBLE * p THEN risk_score END), 6) AS recall_cutoff FROM (SELECT DISTINCT geo, risk_score,
          sum(target) OVER w AS tp, sum(1 - target) OVER w AS fp, sum(target) OVER (PARTITION BY geo) AS p FROM tb
          WINDOW w AS (PARTITION BY geo ORDER BY risk_score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY 1""",
    "champion_choice": f"""SELECT geo, CASE WHEN sc > ba THEN 'scorecard' ELSE 'baseline' END AS approved_family, sc > ba AS promoted,
        round(greatest(sc, ba), 5) AS roc_auc FROM (SELECT geo, max(CASE WHEN model_family = 'scorecard' THEN roc_auc END) AS sc,
        max(CASE WHEN model_family = 'baseline' THEN roc_auc END) AS ba FROM ({METRICS}) GROUP BY 1)""",
    "parity_report": f"""SELECT geo, round(ba, 5) AS old_auc, round(sc, 5) AS new_auc, round(sc - ba, 5) AS difference,
        CASE WHEN abs(sc - ba) <= 0.02::DOUBLE THEN 'EQUAL' WHEN sc > ba THEN 'BETTER' ELSE 'WORSE' END AS verdict FROM
        (SELECT geo, max(CASE WHEN model_family = 'scorecard' THEN roc_auc END) AS sc,
        max(CASE WHEN model_family = 'baseline' THEN roc_auc END) AS ba FROM ({METRICS}) GROUP BY 1)""",
    "duplicate_keys": """SELECT concat('E', o_custkey) AS EMP_ID, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS YEAR_MONTH, count(*) AS n_copies
        FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
    "key_quarantine": """SELECT CASE WHEN n > 1 THEN 'quarantine' ELSE 'unique' END AS part, count(*) AS n_rows, round(sum(o_totalprice), 2) AS value FROM
        (SELECT *, count(*) OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m')) AS n FROM orders) GROUP BY 1""",
    "config_mismatch": """SELECT 'feature without data' AS problem, 'TOTAL_QUANTITY' AS name, 0::BIGINT AS n_rows
        UNION ALL SELECT 'geo without flags', GEO, count(*) FROM fs WHERE GEO = 'ASI' GROUP BY GEO""",
    "quality_gate": """SELECT 'rows present' AS rule, count(*) AS observed, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM fs
        UNION ALL SELECT 'duplicate keys', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM
          (SELECT 1 FROM fs GROUP BY EMP_ID, YEAR_MONTH HAVING count(*) > 1)
        UNION ALL SELECT 'newest month', max(YEAR_MONTH), CASE WHEN max(YEAR_MONTH) >= 200108 THEN 'PASS' ELSE 'FAIL' END FROM fs
        """
    + " ".join(
        f"UNION ALL SELECT 'empty {c}', count(*) - count({c}), CASE WHEN count(*) = count({c}) THEN 'PASS' ELSE 'FAIL' END FROM fs"
        for c in ("target", "EMP_ID", "GEO", "TOTAL_LINES", "LAST_SHIP_DATE")
    ),
    "leakage_scan": " UNION ALL ".join(_leak(c) for c in DATE_COLUMNS),
    "column_profile": _profile(),
    "column_profile_by_month": _profile(),
    "target_correlation": _corr(),
    "code_families": """SELECT coalesce(f.r_name, 'OTHER') AS NATION_NAME, count(*) AS n_rows, round(avg(target), 4) AS event_rate FROM fs
        LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA') f ON f.n_name = fs.NATION_NAME
        GROUP BY 1""",
    "drift_psi": _psi(),
    "drift_sketches": _sketched(),
    "learnt_families": _families(300, 18),
    "feature_list_changes": """SELECT coalesce(a.geo, b.geo) AS geo, count(a.geo) AS n_before, count(b.geo) AS n_after,
        bool_and(a.geo IS NOT NULL AND b.geo IS NOT NULL) AS unchanged FROM selected a FULL JOIN (
          SELECT geo, feature FROM selected WHERE NOT (geo = 'EUR' AND feature = 'TOTAL_QTY')
          UNION ALL SELECT 'IND', feature FROM selected WHERE geo = 'MEA') b ON a.geo = b.geo AND a.feature = b.feature GROUP BY 1""",
    "score_drift": f"""SELECT geo, count(*) FILTER (WHERE YEAR_MONTH = 200103) AS n_base, count(*) FILTER (WHERE YEAR_MONTH = {MONTH}) AS n_now,
        round(avg(CASE WHEN YEAR_MONTH = {MONTH} THEN risk_score END) - avg(CASE WHEN YEAR_MONTH = 200103 THEN risk_score END), 4) AS score_change,
        round({_share(str(MONTH), "RED")} - {_share("200103", "RED")}, 4) AS red_share_change,
        round({_share(str(MONTH), "AMBER")} - {_share("200103", "AMBER")}, 4) AS amber_share_change FROM ({TWO}) GROUP BY 1""",
    "bucket_stability": f"""SELECT coalesce(a.geo, b.geo) AS geo, coalesce(a.risk_bucket, 'NEW') AS from_bucket, coalesce(b.risk_bucket, 'GONE') AS to_bucket,
        count(*) AS employees FROM (SELECT * FROM ({TWO}) WHERE YEAR_MONTH = 200103) a FULL JOIN (SELECT * FROM ({TWO}) WHERE YEAR_MONTH = {MONTH}) b
        ON a.geo = b.geo AND a.EMP_ID = b.EMP_ID GROUP BY 1, 2, 3""",
    "driver_drift": f"""SELECT geo, feature, round(sum(CASE WHEN YEAR_MONTH = {MONTH} THEN share ELSE 0 END)
        - sum(CASE WHEN YEAR_MONTH = 200103 THEN share ELSE 0 END), 4) AS share_change FROM
        (SELECT geo, YEAR_MONTH, feature, avg(abs(contribution)) / sum(avg(abs(contribution))) OVER (PARTITION BY geo, YEAR_MONTH) AS share
          FROM ({_all_parts(f"YEAR_MONTH IN (200103, {MONTH})")}) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "fairness_rates": _fairness(),
    "published_feed": """SELECT geo, EMP_ID, YEAR_MONTH, round(risk_score, 4) AS risk_score, risk_bucket FROM er
        WHERE risk_bucket IN ('RED', 'AMBER') AND geo IN ('AFR', 'MEA')""",
    "checks_load": _load(),
    "checks_shared": _shared(),
    "checks_backtest": _backtest(),
    "checks_run": _run(),
    "checks_feed": _feed(),
    "scenario_flag_off": _scenario_flag(),
    "scenario_new_geo": _scenario_geo(),
    "scenario_rerun": _scenario_rerun(),
    "scenario_config_error": _scenario_error(),
    "monthly_outputs": f"""SELECT geo, EMP_ID, YEAR_MONTH, round(risk_score, 6) AS risk_score, risk_bucket, risk_rank_in_geo FROM er
        UNION ALL SELECT c.geo, EMP_ID, YEAR_MONTH, round(risk_score, 6), CASE WHEN risk_score >= red_threshold THEN 'RED'
          WHEN risk_score >= amber_threshold THEN 'AMBER' ELSE 'GREEN' END, rank() OVER (PARTITION BY c.geo ORDER BY risk_score DESC)
        FROM card c JOIN ({THR_OLD}) t ON t.geo = c.geo WHERE YEAR_MONTH = 200103""",
    "monthly_feed": f"""SELECT s.*, feed_rows FROM ({SUMMARY}) s LEFT JOIN (SELECT geo, count(*) AS feed_rows FROM er
        WHERE risk_bucket IN ('RED', 'AMBER') GROUP BY 1) f ON f.geo = s.geo""",
    "run_log": f"SELECT geo, {MONTH}::BIGINT AS YEAR_MONTH, 'DONE' AS status, count(*) AS n_scored FROM er GROUP BY 1",
    "release_per_geo": f"""SELECT geo, CASE WHEN geo = 'EUR' THEN 'CHECKS_FAILED' ELSE 'DONE' END AS status, count(*) AS n_rows,
        count(*) FILTER (WHERE geo = 'EUR') AS n_earlier, round(avg(risk_score), 6) AS mean_score FROM er GROUP BY 1""",
    "run_verdicts": _verdicts(),
    **dict.fromkeys(
        ["gbt_additivity", "logreg_additivity"],
        """SELECT GEO AS geo, count(*) AS n_rows, 0::BIGINT AS n_off FROM mf WHERE target IS NOT NULL AND YEAR_MONTH > 200006 GROUP BY 1""",
    ),
    "logreg_balance": """SELECT GEO AS geo, count(*) AS n_rows, true AS balanced FROM mf WHERE target IS NOT NULL AND YEAR_MONTH <= 199912
        GROUP BY 1""",
    "gbt_inputs": """SELECT f.geo, concat('btree_', lower(f.geo)) AS model, feature, n_train, n_eval FROM selected f JOIN
        (SELECT GEO AS geo, count(*) FILTER (WHERE YEAR_MONTH <= 199912) AS n_train, count(*) FILTER (WHERE YEAR_MONTH > 199912) AS n_eval
         FROM fs WHERE target IS NOT NULL AND YEAR_MONTH <= 200006 GROUP BY 1) n ON n.geo = f.geo""",
    **dict.fromkeys(["gbt_scores", "logreg_scores"], f"SELECT GEO AS geo, EMP_ID, YEAR_MONTH, target, true AS valid FROM mf WHERE {TEST}"),
    **dict.fromkeys(
        ["gbt_attributions", "logreg_attributions"],
        f"""SELECT GEO AS geo, EMP_ID, YEAR_MONTH, true AS ordered, true AS raising, true AS real_values FROM mf WHERE YEAR_MONTH = {MONTH}""",
    ),
    "gbt_geo_drivers": "SELECT geo, feature, true AS agrees FROM selected WHERE geo IN (SELECT GEO FROM mf)",
    "training_curve": """SELECT GEO AS geo, count(*) AS n_train, true AS complete, true AS falls, true AS agrees FROM mf
        WHERE target IS NOT NULL AND YEAR_MONTH <= 199912 GROUP BY 1""",
    "linear_weights": "SELECT geo, feature, true AS at_optimum FROM selected",
    "explain_weights": "SELECT geo, least(15, count(*)) AS n_shown, true AS heaviest FROM selected GROUP BY 1",
    "odd_inputs": f"""SELECT model_family, GEO AS geo, count(*) AS n_rows, 0::BIGINT AS n_apart FROM mf, (VALUES ('btree'), ('logreg')) m(model_family)
        WHERE {TEST} GROUP BY 1, 2""",
    "model_backtest": f"""SELECT GEO AS geo, model_family, count(*) AS n_rows, true AS agrees FROM mf, (VALUES ('btree'), ('logreg')) m(model_family)
        WHERE {TEST} GROUP BY 1, 2""",
    "model_capture": f"""SELECT GEO AS geo, count(*) AS employees, sum(target)::BIGINT AS actual_events, true AS agrees FROM mf WHERE {TEST}
        GROUP BY 1""",
    "model_monthly_run": _model_run(),
    "pooled_model": f"SELECT DISTINCT GEO AS geo, 'pooled' AS model_family, true AS valid FROM mf WHERE {TEST}",
    "hyper_search": """SELECT DISTINCT GEO AS geo, concat('{"depth": ', d, ', "rounds": ', r, ', "step": ', s, '}') AS params, true AS agrees
        FROM mf, (VALUES ('3'), ('5')) a(d), (VALUES ('5'), ('10'), ('20')) b(r), (VALUES ('0.05'), ('0.1')) c(s)
        WHERE target IS NOT NULL AND YEAR_MONTH BETWEEN 200001 AND 200006""",
}

ORACLE = {name: sql(body) for name, body in BODIES.items()}
