"""Shared SQL for the side-by-side check: snapshots, model features and scorecard scores."""

from __future__ import annotations

from riskloom.sources.snapshots import COLUMNS, EXCLUSIONS, GEOS, PROFILE_FLAGS

CNT = "PARTITION BY o_custkey ORDER BY month_no RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING"


def _last(measure: str, n: int, digits: int) -> str:
    name = "INLAST_MONTH" if n == 1 else f"INLAST_{n}_MONTHS"
    return f"round(coalesce(sum({measure}) OVER ({CNT.format(n=n)}), 0.0), {digits})::DOUBLE AS {measure}_{name}"


def _flags(geo: str) -> str:
    side = 0 if geo in ("AFR", "AME", "ASI") else 1
    return ", ".join(f"('{c}', '{geo}', {PROFILE_FLAGS.get(c, (1, 1))[side]})" for c in COLUMNS)


def to_date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}.*') THEN try_cast(left({text}, 10) AS DATE) "
        f"ELSE CAST(try_strptime({text}, '%m/%d/%Y %H:%M') AS DATE) END"
    )


def number_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(30,6)) AS VARCHAR), '\\.?0+$', '')"


def _days(column: str) -> str:
    return f"date_diff('day', {to_date(column)}, snapshot_date) AS {column}"


GEO_CASE = "CASE WHEN r_name = 'MIDDLE EAST' THEN 'MEA' ELSE left(r_name, 3) END"

CTES = {
    "lines": """SELECT l_orderkey, count(*)::DOUBLE AS lines, sum(l_quantity) AS qty,
        round(sum(l_extendedprice * l_discount), 4) AS discount,
        (count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS returned, max(l_shipdate) AS last_ship
      FROM lineitem GROUP BY l_orderkey""",
    "monthly": """SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS YEAR_MONTH,
        CAST(strftime(o_orderdate, '%Y') AS BIGINT) * 12 + CAST(strftime(o_orderdate, '%m') AS BIGINT) AS month_no,
        min(o_orderpriority) AS TOP_PRIORITY, min(o_orderdate) AS first_in_month, max(o_orderdate) AS last_in_month,
        count(*)::DOUBLE AS ORDERS_CNT, round(sum(o_totalprice), 2) AS ORDERS_VALUE,
        sum(lines) AS TOTAL_LINES, sum(qty) AS TOTAL_QTY, round(sum(discount), 4) AS TOTAL_DISCOUNT,
        sum(returned) AS TOTAL_RETURNED, max(last_ship) AS last_ship,
        concat(CASE WHEN bool_or(o_orderstatus = 'F') THEN 'F' ELSE '' END,
               CASE WHEN bool_or(o_orderstatus = 'O') THEN 'O' ELSE '' END,
               CASE WHEN bool_or(o_orderstatus = 'P') THEN 'P' ELSE '' END) AS STATUS_LEAK
      FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "rolled": f"""SELECT *, min(first_in_month) OVER (PARTITION BY o_custkey) AS first_order,
        CAST(CASE WHEN YEAR_MONTH <= 200104 THEN CASE WHEN count(*) OVER
          (PARTITION BY o_custkey ORDER BY month_no RANGE BETWEEN 1 FOLLOWING AND 3 FOLLOWING) > 0
          THEN 0 ELSE 1 END END AS BIGINT) AS target,
        {", ".join(_last("ORDERS_CNT", n, 0) for n in (1, 2, 3, 4))},
        {", ".join(_last("ORDERS_VALUE", n, 2) for n in (1, 2, 3))}, {_last("TOTAL_QTY", 3, 0)},
        CAST(last_day(CAST(strptime(CAST(YEAR_MONTH AS VARCHAR), '%Y%m') AS DATE)) AS DATE) AS snapshot_date
      FROM monthly""",
    "fsd": f"""SELECT target, YEAR_MONTH, concat('E', CAST(r.o_custkey AS VARCHAR)) AS EMP_ID, {GEO_CASE} AS GEO,
        c_mktsegment AS MKT_SEGMENT, n_name AS NATION_NAME, TOP_PRIORITY, c_acctbal AS ACCT_BAL,
        date_diff('day', CAST(first_order AS DATE), snapshot_date) AS DAYS_AFTER_JOIN, ORDERS_CNT,
        ORDERS_CNT_INLAST_MONTH, ORDERS_CNT_INLAST_2_MONTHS, ORDERS_CNT_INLAST_3_MONTHS, ORDERS_CNT_INLAST_4_MONTHS,
        ORDERS_VALUE, ORDERS_VALUE_INLAST_MONTH, ORDERS_VALUE_INLAST_2_MONTHS, ORDERS_VALUE_INLAST_3_MONTHS,
        round(ORDERS_VALUE / ORDERS_CNT, 4) AS AVG_ORDER_VALUE, TOTAL_LINES, TOTAL_QTY, TOTAL_DISCOUNT, TOTAL_RETURNED,
        TOTAL_QTY_INLAST_3_MONTHS, strftime(last_in_month, '%-m/%-d/%Y %-H:%M') AS RECENT_ORDER_DATE,
        strftime(first_order, '%Y-%m-%dT%H:%M:%S') AS FIRST_ORDER_DATE,
        strftime(last_ship, '%-m/%-d/%Y %-H:%M') AS LAST_SHIP_DATE, c_name AS CUST_NAME, 'R' AS REGULAR_TEMP, STATUS_LEAK,
        snapshot_date
      FROM rolled r JOIN customer ON c_custkey = r.o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey""",
    "fs": "SELECT * EXCLUDE (snapshot_date) FROM fsd",
    "mf": f"""SELECT * EXCLUDE (snapshot_date) REPLACE ({_days("RECENT_ORDER_DATE")}, {_days("FIRST_ORDER_DATE")},
        {_days("LAST_SHIP_DATE")}) FROM fsd""",
    "flags": f"""SELECT * FROM (VALUES {", ".join(_flags(g) for g in GEOS)}) t(feature, geo, flag)
        WHERE geo IN (SELECT {GEO_CASE} FROM region)""",
    "exclusions": "SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{r}')" for f, r in EXCLUSIONS) + ") t(feature, reason)",
    "present": "SELECT column_name AS feature FROM (DESCRIBE SELECT * FROM mf)",
    "selected": """SELECT geo, feature FROM flags WHERE flag = 1
        AND feature NOT IN (SELECT feature FROM exclusions)""",
    "parts": """SELECT GEO AS geo, EMP_ID, YEAR_MONTH, target, ORDERS_CNT_INLAST_3_MONTHS, DAYS_AFTER_JOIN, ORDERS_VALUE,
        LAST_SHIP_DATE,
        coalesce(-0.4::DOUBLE * (ORDERS_CNT_INLAST_3_MONTHS - 0.37::DOUBLE) / 0.61::DOUBLE, 0.0::DOUBLE) AS c1,
        coalesce(-0.2::DOUBLE * (DAYS_AFTER_JOIN::DOUBLE - 1000::DOUBLE) / 695::DOUBLE, 0.0::DOUBLE) AS c2,
        coalesce(0.3::DOUBLE * (ORDERS_VALUE - 267000::DOUBLE) / 163000::DOUBLE, 0.0::DOUBLE) AS c3,
        coalesce(0.1::DOUBLE * (LAST_SHIP_DATE::DOUBLE + 720::DOUBLE) / 866::DOUBLE, 0.0::DOUBLE) AS c4
      FROM mf""",
    "card": """SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.2::DOUBLE + c1 + c2 + c3 + c4))) AS risk_score FROM parts""",
    "base": """SELECT geo, EMP_ID, YEAR_MONTH, target, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.5::DOUBLE
        + coalesce(-0.3::DOUBLE * (ORDERS_CNT_INLAST_3_MONTHS - 0.37::DOUBLE) / 0.61::DOUBLE, 0.0::DOUBLE)
        + coalesce(0.05::DOUBLE * (ORDERS_VALUE - 267000::DOUBLE) / 163000::DOUBLE, 0.0::DOUBLE)))) AS risk_score FROM mf""",
    "drivers": f"""SELECT geo, EMP_ID, YEAR_MONTH, feature, feature_value, contribution,
        rank() OVER (PARTITION BY geo, EMP_ID, YEAR_MONTH ORDER BY contribution DESC) AS driver_rank
      FROM (SELECT geo, EMP_ID, YEAR_MONTH, 'ORDERS_CNT_INLAST_3_MONTHS' AS feature,
              {number_text("ORDERS_CNT_INLAST_3_MONTHS")} AS feature_value, c1 AS contribution FROM card
        UNION ALL SELECT geo, EMP_ID, YEAR_MONTH, 'DAYS_AFTER_JOIN', {number_text("DAYS_AFTER_JOIN")}, c2 FROM card
        UNION ALL SELECT geo, EMP_ID, YEAR_MONTH, 'ORDERS_VALUE', {number_text("ORDERS_VALUE")}, c3 FROM card
        UNION ALL SELECT geo, EMP_ID, YEAR_MONTH, 'LAST_SHIP_DATE', {number_text("LAST_SHIP_DATE")}, c4 FROM card)
      WHERE contribution > 0""",
    "thr": """SELECT geo, quantile_disc(risk_score, 0.90) AS red_threshold, quantile_disc(risk_score, 0.70) AS amber_threshold,
        count(*) AS n_scores FROM card WHERE target IS NOT NULL AND YEAR_MONTH BETWEEN 200101 AND 200103 GROUP BY geo""",
    "bthr": """SELECT geo, quantile_disc(risk_score, 0.90) AS red_threshold, quantile_disc(risk_score, 0.70) AS amber_threshold
      FROM card WHERE target IS NOT NULL AND YEAR_MONTH BETWEEN 200001 AND 200006 GROUP BY geo""",
    "er": """SELECT c.geo, EMP_ID, YEAR_MONTH, target, risk_score,
        CASE WHEN risk_score >= red_threshold THEN 'RED' WHEN risk_score >= amber_threshold THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket,
        rank() OVER (PARTITION BY c.geo ORDER BY risk_score DESC) AS risk_rank_in_geo,
        (SELECT string_agg(feature, ', ' ORDER BY contribution DESC, feature) FROM
          (SELECT feature, contribution FROM drivers d WHERE d.geo = c.geo AND d.EMP_ID = c.EMP_ID
             AND d.YEAR_MONTH = c.YEAR_MONTH ORDER BY contribution DESC, feature LIMIT 3)) AS top_risk_drivers,
        concat('scorecard_', lower(c.geo)) AS model_name
      FROM card c JOIN thr ON thr.geo = c.geo WHERE YEAR_MONTH = 200104""",
    "tb": """SELECT c.*, red_threshold, amber_threshold,
        CASE WHEN risk_score >= red_threshold THEN 'RED' WHEN risk_score >= amber_threshold THEN 'AMBER' ELSE 'GREEN' END AS risk_bucket
      FROM card c JOIN bthr ON bthr.geo = c.geo WHERE target IS NOT NULL AND YEAR_MONTH > 200006""",
}


def sql(body: str) -> str:
    """Put the shared tables in front of a query."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in CTES.items() if name != "present") + "\n" + body
