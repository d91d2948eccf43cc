"""DuckDB SQL of the registered queries.

Common table expressions are kept by name and put in front of each query with what they need.
They follow the rules directly (grids, unrolled steps, ordered picks), not the Spark plans.
"""

from __future__ import annotations

import re


P, HOLDOUT, CHURN, YEAR = "DATE '2001-08-01'", "DATE '2001-07-01'", "DATE '2001-05-01'", "DATE '2000-08-01'"
START, END = "DATE '1995-01-01'", "DATE '2001-07-31'"

CTES: dict[str, str] = {}


def r(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0"


def months(first: str, last: str) -> str:
    span = f"generate_series(CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP), INTERVAL 1 MONTH)"
    return f"CAST(unnest({span}) AS DATE)"


# --- inputs mapped from the given tables ---

CTES["fx_shipments"] = """
SELECT o.o_custkey AS site_use_id, CAST(o.o_orderdate AS DATE) AS ordered_day, l.l_extendedprice AS cost_rub,
       l.l_quantity AS volume, CAST(p.p_size AS DOUBLE) AS weight, p.p_retailprice AS med_amn, l.l_tax AS nds_rate,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS web_order_flag,
       CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS dlo_id, l.l_partkey AS cd_m,
       CASE WHEN o.o_orderstatus <> 'P' THEN 1 ELSE 2 END AS oper_tp_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey"""
CTES["fx_products"] = """
SELECT p_partkey AS medicine_code, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS own_mark FROM part"""
CTES["fx_links"] = """
SELECT c_custkey AS site_id_link, c_custkey AS customers, CAST(floor(c_acctbal) AS BIGINT) AS value, p.plan_period,
       c_name AS customer_name, CASE WHEN c_custkey % 11 <> 0 THEN n_name END AS current_sale_loc
FROM customer JOIN nation ON c_nationkey = n_nationkey,
     (VALUES (DATE '2001-06-01'), (DATE '2001-07-01')) p(plan_period)"""
CTES["fx_customers"] = """
SELECT c_custkey AS customers, m.k * CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 0e0
         WHEN c_custkey % 19 = 0 THEN 1e0 ELSE 100000e0 + abs(c_acctbal) * 500 END AS turnover,
       CASE WHEN c_custkey % 20 = 19 THEN 'I' ELSE 'A' END AS bill_status
FROM customer JOIN (VALUES (1e0), (3e0)) m(k) ON m.k = 1 OR c_custkey % 10 = 0"""
CTES["fx_partners"] = """
SELECT c_custkey AS site_use_id, c_custkey AS segment,
       c_mktsegment || ' (' || CAST(c_custkey % 7 AS VARCHAR) || ')' AS manager, c_mktsegment AS subsegment_tp,
       CAST(c_custkey % 3 AS INT) AS ltk,
       CAST(CASE WHEN c_custkey % 8 <> 0 THEN (c_custkey % 4) * 7 END AS INT) AS claim_period,
       CAST(c_custkey % 5 AS INT) AS period_shipment, CAST(c_custkey % 6 AS INT) AS current_discount_2k,
       CASE WHEN c_custkey % 50 = 0 THEN 'Y' ELSE 'N' END AS service_flag,
       CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS regional_capital,
       CASE WHEN c_custkey % 6 = 1 THEN 'Y' ELSE 'N' END AS strong_med,
       CASE WHEN c_custkey % 200 = 0 THEN 'RARE' ELSE 'L' || CAST(c_custkey % 3 AS VARCHAR) END AS license_tp,
       CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS federal,
       CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END END AS inet_flag,
       CASE WHEN c_custkey % 25 = 24 THEN 'I' ELSE 'A' END AS site_status,
       CASE WHEN c_custkey % 40 = 38 THEN 'Other' ELSE 'Коммерция' END AS activity
FROM customer"""
CTES["fx_site_branch"] = """
SELECT c_custkey AS segment, 'NATION_0' AS sale_loc, DATE '2000-01-01' AS updated FROM customer
UNION ALL SELECT c_custkey, n_name, DATE '2001-01-01' FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN n_name END, DATE '2001-06-01'
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_plan = "floor(CAST(sum({c}) AS DOUBLE) / 12 * (0.6e0 + 0.15e0 * ((n_nationkey + {k}) % 10)))"
CTES["fx_branch_plans"] = f"""
SELECT n_name AS sale_loc, m.plan_month, {_plan.format(c='c', k=0)} AS plan_value,
       {_plan.format(c='own', k=3)} AS plan_value_stm, {_plan.format(c='own', k=5)} AS plan_value_oz,
       {_plan.format(c='own', k=7)} AS plan_value_onls
FROM (SELECT s.site_use_id, CAST(s.cost_rub AS DECIMAL(18,2)) AS c,
             CASE WHEN f.own_mark = 1 THEN CAST(s.cost_rub AS DECIMAL(18,2)) ELSE 0 END AS own
      FROM fx_shipments s JOIN fx_products f ON s.cd_m = f.medicine_code
      WHERE s.ordered_day BETWEEN {YEAR} AND {END} AND s.oper_tp_id = 1)
JOIN customer ON site_use_id = c_custkey JOIN nation ON c_nationkey = n_nationkey,
     (VALUES (DATE '2001-07-01'), (DATE '2001-08-01')) m(plan_month)
WHERE n_nationkey <> 7 GROUP BY n_name, n_nationkey, m.plan_month"""
CTES["fx_calendar"] = f"""
SELECT d AS day, h AS is_holiday, CASE WHEN h = 0 AND isodow(d) <= 5 THEN 1 ELSE 0 END AS is_working_day
FROM (SELECT d, CASE WHEN strftime(d, '%m-%d') IN ('01-01','01-02','01-03','01-04','01-05','01-06','01-07','01-08',
        '02-23','03-08','05-01','05-09','06-12','11-04') THEN 1 ELSE 0 END AS h
      FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-31', INTERVAL 1 DAY)) AS DATE)
            AS d))"""
CTES["fx_recode"] = """
SELECT * FROM (VALUES ('NATION_22','NATION_0'), ('NATION_23','NATION_1'), ('NATION_24','NATION_2')) x(old, new)"""

# --- panel and classes ---

CTES["lines"] = f"""
SELECT * FROM fx_shipments WHERE ordered_day BETWEEN {START} AND {END} AND oper_tp_id = 1 AND site_use_id IS NOT NULL"""
CTES["monthly"] = """
SELECT site_use_id AS segment, CAST(date_trunc('month', ordered_day) AS DATE) AS month,
       CAST(sum(CAST(trunc(cost_rub) AS BIGINT)) AS BIGINT) AS target, avg(volume) AS volume, avg(weight) AS weight,
       avg(volume) / nullif(avg(weight), 0) AS density, avg(med_amn) AS med_amn, avg(nds_rate) AS nds,
       sum(CASE WHEN web_order_flag = 1 THEN 1 ELSE 0 END) / count(*) AS web_order_rel,
       sum(CASE WHEN dlo_id = 1 THEN 1 ELSE 0 END) / count(*) AS market_rel, count(DISTINCT cd_m) AS position_count
FROM lines GROUP BY ALL"""
CTES["own_monthly"] = """
SELECT site_use_id AS segment, CAST(date_trunc('month', ordered_day) AS DATE) AS month,
       CAST(sum(CAST(trunc(cost_rub) AS BIGINT)) AS BIGINT) AS target
FROM lines WHERE cd_m IN (SELECT medicine_code FROM fx_products WHERE own_mark = 1) GROUP BY ALL"""
CTES["cards"] = f"""
SELECT l.site_id_link, p.segment, any_value(l.customers) AS customers, any_value(l.value) AS value,
       any_value(l.plan_period) AS plan_period, any_value(l.customer_name) AS customer_name, avg(c.turnover) AS turnover,
       any_value(l.current_sale_loc) AS current_sale_loc,
       lower(regexp_replace(any_value(p.manager), '[0-9,()]+', '', 'g')) AS manager,
       any_value(p.subsegment_tp) AS subsegment_tp, any_value(p.ltk) AS ltk, any_value(p.claim_period) AS claim_period,
       any_value(p.period_shipment) AS period_shipment, any_value(p.current_discount_2k) AS current_discount_2k,
       any_value(p.service_flag) AS service_flag, any_value(p.regional_capital) AS regional_capital,
       any_value(p.strong_med) AS strong_med, any_value(p.license_tp) AS license_tp, any_value(p.federal) AS federal,
       any_value(p.inet_flag) AS inet_flag
FROM fx_links l LEFT JOIN fx_customers c ON l.customers = c.customers
     LEFT JOIN fx_partners p ON l.site_id_link = p.site_use_id
WHERE l.plan_period = {HOLDOUT} AND c.bill_status = 'A' AND p.site_status = 'A' AND p.activity = 'Коммерция'
GROUP BY l.site_id_link, p.segment"""
CTES["panel"] = "SELECT * FROM monthly WHERE segment IN (SELECT site_id_link FROM cards)"
CTES["own_panel"] = "SELECT * FROM own_monthly WHERE segment IN (SELECT site_id_link FROM cards)"


def _classes(panel: str, low: int) -> str:
    return f"""
SELECT segment, CASE WHEN s = 0 THEN 'churned' WHEN m <= {low} THEN 'low' WHEN n < 6 THEN 'rare' ELSE 'active' END
       AS segment_class
FROM (SELECT segment, coalesce(sum(CASE WHEN month >= {CHURN} THEN target END), 0) AS s,
             max(CASE WHEN month >= {CHURN} THEN target END) AS m, count(DISTINCT month) AS n
      FROM {panel} GROUP BY segment)"""


CTES["classes"] = _classes("panel", 30000)
CTES["own_classes"] = _classes("own_panel", 500)


def _active(panel: str, classes: str) -> str:
    values = "target volume weight density med_amn nds web_order_rel market_rel position_count".split()
    values = values if panel == "panel" else ["target"]
    columns = ", ".join(f"coalesce(p.{v}, 0) AS {v}" for v in values)
    return f"""
SELECT g.segment, g.month, {columns}
FROM (SELECT segment, {months('min(month)', 'max(month)')} AS month FROM {panel}
      WHERE segment IN (SELECT segment FROM {classes} WHERE segment_class = 'active') GROUP BY segment) g
LEFT JOIN {panel} p ON g.segment = p.segment AND g.month = p.month"""


CTES["active"] = _active("panel", "classes")
CTES["own_active"] = _active("own_panel", "own_classes")
CTES["grid"] = f"""
SELECT s.segment, m.month, a.target
FROM (SELECT DISTINCT segment FROM active) s
CROSS JOIN (SELECT {months('min(month)', 'max(month)')} AS month FROM active) m
LEFT JOIN active a ON a.segment = s.segment AND a.month = m.month"""
CTES["year_grid"] = f"""
SELECT s.segment, m.month, coalesce(p.target, 0) AS target
FROM (SELECT DISTINCT segment FROM panel JOIN classes USING (segment)
      WHERE segment_class IN ('active', 'rare') AND month >= {YEAR}) s
CROSS JOIN (SELECT {months(YEAR, P)} AS month) m
LEFT JOIN panel p ON p.segment = s.segment AND p.month = m.month"""
CTES["quantiles"] = """
SELECT segment, unnest(range(30, 80)) AS q, unnest(v) AS quantile
FROM (SELECT segment, quantile_cont(CAST(target AS DOUBLE), [{}]) AS v FROM year_grid GROUP BY segment)""".format(
    ", ".join(f"{q / 100}e0" for q in range(30, 80))
)


def _class_forecasts(panel: str, classes: str, low: int) -> str:
    return f"""
SELECT segment, CASE segment_class WHEN 'rare' THEN greatest(coalesce(m, {low}), {low}) WHEN 'low' THEN {low} ELSE 0 END
       AS target
FROM (SELECT c.segment, c.segment_class, avg(CASE WHEN month >= {CHURN} THEN target END) AS m
      FROM {classes} c JOIN {panel} USING (segment) WHERE segment_class <> 'active' GROUP BY ALL)"""


CTES["class_forecast"] = _class_forecasts("panel", "classes", 30000)
CTES["own_class_forecast"] = _class_forecasts("own_panel", "own_classes", 500)

# --- features ---

CTES["month_days"] = """
SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(is_holiday) AS BIGINT) AS holidays,
       CAST(sum(is_working_day) AS BIGINT) AS work_day
FROM fx_calendar GROUP BY ALL"""
CTES["future"] = f"""
SELECT g.segment, g.month, a.target
FROM (SELECT segment, {months('min(month)', P)} AS month FROM active GROUP BY segment) g
LEFT JOIN active a ON a.segment = g.segment AND a.month = g.month"""


def _rolling(shift: int) -> str:
    out = []
    for w in (3, 6):
        frame = f"OVER (PARTITION BY segment ORDER BY month ROWS BETWEEN {w - 1 + shift} PRECEDING AND {shift} PRECEDING)"
        if shift == 0:
            frame = frame.replace("0 PRECEDING)", "CURRENT ROW)")
        for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            out.append(f"CAST(coalesce({f}(target) {frame}, 0) AS DOUBLE) AS {name}_{w}")
        out.append(f"CAST(coalesce(max(target) {frame} - min(target) {frame}, 0) AS DOUBLE) AS minmax_{w}")
    end = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    frame = f"OVER (PARTITION BY segment ORDER BY month ROWS BETWEEN {11 + shift} PRECEDING AND {end})"
    out.append(f"CAST(coalesce(max(target) {frame} - min(target) {frame}, 0) AS DOUBLE) AS minmax_12")
    return f"SELECT segment, month, {', '.join(out)} FROM future"


CTES["rolling"] = _rolling(1)
CTES["rolling_0"] = _rolling(0)

# --- clusters and categories ---

CTES["levels"] = "SELECT segment, min(month) AS first_month, avg(target) AS mean_target FROM active GROUP BY segment"
GROUPED = "current_sale_loc service_flag subsegment_tp regional_capital strong_med license_tp federal inet_flag".split()
CTES["shares"] = "SELECT name, val, n, n / sum(n) OVER (PARTITION BY name) AS share FROM ({})".format(
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, {c} AS val, count(*) AS n FROM cards WHERE {c} IS NOT NULL GROUP BY {c}" for c in GROUPED
    )
)
CTES["modes"] = """
SELECT name, val FROM (SELECT name, val, row_number() OVER (PARTITION BY name ORDER BY n DESC, val) AS k
                       FROM shares WHERE share >= 0.01) WHERE k = 1"""

# --- forecasts ---


def _scores(active: str) -> str:
    windows = (1, 3, 6, 12)
    preds = ", ".join(
        f"avg(target) OVER (PARTITION BY segment ORDER BY month ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS sma{w}"
        for w in windows
    )
    models = " UNION ALL ".join(
        f"SELECT segment, month, target, 'sma{w}' AS model, sma{w} AS pred, abs(target - sma{w}) AS err FROM f"
        for w in windows
    )
    return f"""
WITH g AS (SELECT s.segment, m.month, CAST(coalesce(a.target, 0) AS DOUBLE) AS target
           FROM (SELECT DISTINCT segment FROM {active}) s
           CROSS JOIN (SELECT {months('min(month)', P)} AS month FROM {active}) m
           LEFT JOIN {active} a ON a.segment = s.segment AND a.month = m.month),
     f AS (SELECT segment, month, target, {preds} FROM g),
     u AS ({models}),
     e AS (SELECT segment, model, max(CASE WHEN month = DATE '2001-06-01' THEN err END) AS e1,
                  max(CASE WHEN month = DATE '2001-05-01' THEN err END) AS e2,
                  max(CASE WHEN month = DATE '2001-04-01' THEN err END) AS e3,
                  max(CASE WHEN month = {HOLDOUT} THEN pred END) AS hd_preds,
                  max(CASE WHEN month = {P} THEN pred END) AS final_preds FROM u GROUP BY segment, model),
     k AS (SELECT *, (e1 + e2 + e3) / 3e0 AS mean FROM e)
SELECT segment, model, trunc(mean + sqrt(((e1 - mean) * (e1 - mean) + (e2 - mean) * (e2 - mean)
       + (e3 - mean) * (e3 - mean)) / 2e0)) AS mae, hd_preds, final_preds
FROM k WHERE NOT (model = 'sma1' AND hd_preds = 0)"""


CTES["scores"] = _scores("active")
CTES["own_scores"] = _scores("own_active")


def _chosen(scores: str, active: str) -> str:
    return f"""
WITH facts AS (SELECT segment, min(CASE WHEN month > {YEAR} THEN target END) AS lo,
                      max(CASE WHEN month > {YEAR} THEN target END) AS hi,
                      coalesce(sum(CASE WHEN month = {HOLDOUT} THEN target END), 0) AS actual
               FROM {active} GROUP BY segment),
     rated AS (SELECT s.*, f.actual, abs(f.actual - s.hd_preds) AS mae_hd,
                      s.mae * 0.33e0 + abs(f.actual - s.hd_preds) * 0.66e0 AS error
               FROM {scores} s JOIN facts f USING (segment)
               WHERE final_preds <> 0 AND hd_preds <> 0 AND final_preds BETWEEN lo AND hi * 0.95e0),
     best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY error, mae_hd, model) AS k
                             FROM rated) WHERE k = 1)
SELECT segment, model, hd_preds, CAST(actual AS BIGINT) AS actual, CAST(trunc(final_preds) AS BIGINT) AS target FROM best
UNION ALL
SELECT segment, NULL, NULL, NULL, CAST(trunc(final_preds) AS BIGINT) FROM {scores}
WHERE model = 'sma6' AND segment NOT IN (SELECT segment FROM best)"""


CTES["chosen"] = _chosen("scores", "active")
CTES["own_chosen"] = _chosen("own_scores", "own_active")
CTES["forecast"] = """
SELECT segment, CAST(target AS DOUBLE) AS target FROM chosen
UNION ALL SELECT segment, CAST(target AS DOUBLE) FROM class_forecast"""
CTES["own_forecast"] = """
SELECT segment, CAST(target AS DOUBLE) AS target FROM own_chosen
UNION ALL SELECT segment, CAST(target AS DOUBLE) FROM own_class_forecast"""

# --- wallet share and stages ---

CTES["known_branch"] = """
SELECT segment, arg_max(sale_loc, updated) AS sale_loc FROM fx_site_branch WHERE sale_loc IS NOT NULL GROUP BY segment"""
CTES["wallet"] = """
WITH a AS (SELECT f.segment, f.target AS t, coalesce(c.current_sale_loc, b.sale_loc) AS loc,
                  CASE WHEN c.turnover IS NULL OR c.turnover IN (0, 1) THEN f.target * 5 ELSE c.turnover END AS s
           FROM forecast f LEFT JOIN cards c ON c.site_id_link = f.segment LEFT JOIN known_branch b ON b.segment = f.segment),
     b AS (SELECT segment, t, loc, CASE WHEN t / nullif(s, 0) > 1 THEN t * 5 ELSE s END AS s FROM a)
SELECT segment, CASE WHEN t BETWEEN 1 AND 30000 THEN 30000e0 ELSE t END AS target,
       CASE WHEN t BETWEEN 1 AND 30000 THEN 30000e0 WHEN t = 0 THEN 0e0 ELSE s END AS soz,
       coalesce(x.new, loc) AS sale_loc,
       CASE WHEN t BETWEEN 1 AND 30000 OR t = 0 THEN 1e0 ELSE t / nullif(s, 0) END AS fact_soz
FROM b LEFT JOIN fx_recode x ON x.old = b.loc"""
CTES["entire_plans"] = f"SELECT sale_loc, plan_value AS plan FROM fx_branch_plans WHERE plan_month = {P}"
CTES["own_plans"] = f"SELECT sale_loc, plan_value_stm AS plan FROM fx_branch_plans WHERE plan_month = {P}"


# parameters of each attempt, written out here and not taken from the library
_NAMES = "x(level, p_low, p5, p10, p15, p20, p25, p_max, p_big)"
CTES["params"] = f"""
SELECT * FROM (VALUES (0, 1.1e0, 0.1e0, 0.15e0, 0.2e0, 0.25e0, 0.25e0, 0.05e0, 0.15e0)) {_NAMES}
UNION ALL
SELECT i, 1.1e0 + i / 50e0, 0.1e0, 0.15e0 + i / 50e0, 0.2e0 + i / 50e0, 0.25e0 + i / 50e0, 0.25e0, 0.1e0 + i / 50e0, 0.18e0 + i / 50e0
FROM (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i)"""
CTES["base_params"] = f"SELECT * FROM (VALUES (0, 1.1e0, 0.1e0, 0.15e0, 0.2e0, 0.25e0, 0.25e0, 0.05e0, 0.15e0)) {_NAMES}"
CTES["band_params"] = f"SELECT * FROM (VALUES (0, 1.1e0, 0.1e0, 0.15e0, 0.2e0, 0.25e0, 0.25e0, 0.22e0, 0.15e0)) {_NAMES}"
REACH = {"very_low": 0, "to_5": 1, "to_10": 2, "to_15": 3, "to_20": 3, "to_25": 5}
BANDS = [(0.05, "p5"), (0.1, "p10"), (0.15, "p15"), (0.2, "p20"), (0.25, "p25")]


def raised(reach: int) -> str:
    bands = " ".join(f"WHEN f < {b}e0 THEN {p}" for b, p in BANDS[:reach])
    value = f"CASE WHEN f < 0 THEN f WHEN f < 0.01e0 THEN f * p_low {bands} ELSE f END"
    return f"({value})" if reach == 0 else f"(CASE WHEN f < 0.25e0 AND ({value}) > 0.25e0 THEN 0.25e0 ELSE {value} END)"


def total(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,9))) AS DOUBLE)"


def big(t: str, f: str) -> str:
    return f"({t} > 2e5 AND {f} > 0.01e0)"


def _rows(params: str) -> str:
    stages = ", ".join(f"{raised(reach)} * soz AS c_{name}" for name, reach in REACH.items())
    return f"""
SELECT *, base_f * soz AS base, band,
       CASE WHEN band IS NULL THEN base_f ELSE band_from + p_max END AS top_f,
       (CASE WHEN band IS NULL THEN base_f ELSE band_from + p_max END) * soz AS top
FROM (SELECT w.segment, w.sale_loc, w.target AS t, w.soz, p.plan, v.*, coalesce(w.target / nullif(w.soz, 0), 1) AS f,
             {stages}, {raised(5)} AS base_f
      FROM wallet w JOIN entire_plans p ON p.sale_loc = w.sale_loc CROSS JOIN {params} v)
LEFT JOIN (SELECT n AS band, CASE WHEN n = 25 THEN 0.250001e0 ELSE n / 100 END AS band_from
           FROM (SELECT unnest(range(25, 99)) AS n))
  ON base_f BETWEEN band_from AND band_from + 0.009999e0 AND (band > 25 OR base_f < 0.26e0)"""


CTES["rows"] = _rows("params")
CTES["base_rows"] = _rows("base_params")
CTES["band_rows"] = _rows("band_params")


def stage_sql(value: str, passes: str) -> str:
    """One stage on every branch: ``passes`` sees b (plan), s (total) and c (raised total)."""
    return f"""
SELECT segment, sale_loc, passed,
       {r("t + CASE WHEN passed THEN (c_row - t) * coalesce((b - s) / nullif(c - s, 0), 0) ELSE 0 END", 4)} AS target
FROM (SELECT segment, sale_loc, t, {value} AS c_row FROM base_rows)
JOIN (SELECT *, coalesce({passes}, false) AS passed
      FROM (SELECT sale_loc, plan AS b, {total('t')} AS s, {total(value)} AS c FROM base_rows GROUP BY ALL)) USING (sale_loc)"""


# --- the ladder over all levels ---

CTES["sums"] = "SELECT sale_loc, level, plan AS b, p_big, {} FROM rows GROUP BY ALL".format(
    ", ".join(
        [f"{total('t')} AS s", f"coalesce({total('CASE WHEN ' + big('t', 'f') + ' THEN t END')}, 0) AS s_big"]
        + [f"{total('c_' + n)} AS s_{n}" for n in REACH]
        + [f"{total('base')} AS s_base", f"{total('top')} AS s_top"]
        + [f"coalesce({total('CASE WHEN ' + big('top', 'top_f') + ' THEN top END')}, 0) AS s_top_big"]
    )
)


def _band_stops(rows: str) -> str:
    return f"""
SELECT sale_loc, level, min(n) AS band_stop, arg_min(c, n) AS band_total
FROM (SELECT sale_loc, level, plan, n, {total('CASE WHEN band <= n THEN top ELSE base END')} AS c
      FROM {rows} CROSS JOIN (SELECT unnest(range(25, 99)) AS n) GROUP BY ALL)
WHERE c > plan GROUP BY ALL"""


CTES["band_stops"] = _band_stops("rows")
CTES["one_band_stop"] = _band_stops("band_rows")
CTES["early"] = """
SELECT u.*, k.band_stop, k.band_total,
       CASE WHEN (b - s) / nullif(s_big, 0) > 0 AND (b - s) / nullif(s_big, 0) < 0.24e0 THEN 'big_init'
            WHEN b / nullif(s, 0) < 1 THEN 'scale' {}
            WHEN band_stop IS NOT NULL THEN 'bands'
            WHEN 1 - s_top / nullif(b, 0) <= p_big THEN 'big_finish' END AS stage
FROM sums u LEFT JOIN band_stops k ON k.sale_loc = u.sale_loc AND k.level = u.level""".format(
    " ".join(f"WHEN s_{n} > b THEN '{n}'" for n in REACH)
)


def _uplift(t: str) -> str:
    return f"CASE WHEN {t} = 0 THEN 0 WHEN {t} = 30000 THEN 30000 ELSE greatest({t}, coalesce(quantile, {t})) END"


CTES["late_rows"] = f"""
SELECT segment, sale_loc, level, b, p_big, s_top, soz, top, q, u, u / nullif(soz, 0) AS u_f
FROM (SELECT w.segment, w.sale_loc, w.level, e.b, e.p_big, e.s_top, w.soz, w.top, n.q, {_uplift('w.top')} AS u
      FROM rows w JOIN early e ON e.sale_loc = w.sale_loc AND e.level = w.level AND e.stage IS NULL
      CROSS JOIN (SELECT unnest(range(30, 80)) AS q) n
      LEFT JOIN quantiles z ON z.segment = w.segment AND z.q = n.q)"""
CTES["late"] = f"""
WITH a AS (SELECT sale_loc, level, b, p_big, s_top, q, {total('u')} AS c,
                  coalesce({total('CASE WHEN ' + big('u', 'coalesce(u_f, 1)') + ' THEN u END')}, 0) AS c_big
           FROM late_rows GROUP BY ALL),
     k AS (SELECT sale_loc, level, b, p_big, s_top, min(CASE WHEN c > b THEN q END) AS q_stop,
                  max(CASE WHEN q = 79 THEN c END) AS c79, max(CASE WHEN q = 79 THEN c_big END) AS big79
           FROM a GROUP BY ALL)
SELECT k.*, a.c AS c_stop, CASE WHEN q_stop IS NOT NULL THEN 'quantile' WHEN 1 - c79 / nullif(k.b, 0) <= k.p_big
       THEN 'big_last' ELSE 'failed' END AS stage
FROM k LEFT JOIN a ON a.sale_loc = k.sale_loc AND a.level = k.level AND a.q = k.q_stop"""
CTES["outcomes"] = """
SELECT sale_loc, level, stage FROM early WHERE stage IS NOT NULL
UNION ALL SELECT sale_loc, level, stage FROM late"""
CTES["picked"] = """
SELECT sale_loc, level, stage FROM (
  SELECT *, row_number() OVER (PARTITION BY sale_loc ORDER BY CASE WHEN stage <> 'failed' THEN level ELSE 100 - level END) AS k
  FROM outcomes) WHERE k = 1"""
CTES["early_result"] = """
SELECT w.segment, w.sale_loc, w.level, e.stage, CASE e.stage
  WHEN 'big_init' THEN t + CASE WHEN {bt} THEN t / s_big * (b - s) ELSE 0 END
  WHEN 'scale' THEN t * (b / s) {stages}
  WHEN 'bands' THEN base + (CASE WHEN band <= band_stop THEN top ELSE base END - base) * (b - s_base) / (band_total - s_base)
  WHEN 'big_finish' THEN top + CASE WHEN {btop} THEN top / nullif(s_top_big, 0) * (b - s_top) ELSE 0 END END AS target
FROM rows w JOIN picked k ON k.sale_loc = w.sale_loc AND k.level = w.level
JOIN early e ON e.sale_loc = w.sale_loc AND e.level = w.level AND e.stage IS NOT NULL""".format(
    bt=big("t", "f"),
    btop=big("top", "top_f"),
    stages=" ".join(f"WHEN '{n}' THEN t + (c_{n} - t) * (b - s) / (s_{n} - s)" for n in REACH),
)
CTES["late_result"] = f"""
SELECT w.segment, w.sale_loc, w.level, l.stage, CASE l.stage
  WHEN 'quantile' THEN top + (u - top) * (w.b - w.s_top) / (c_stop - w.s_top)
  WHEN 'big_last' THEN u + CASE WHEN {big('u', 'coalesce(u_f, 1)')} THEN u / nullif(big79, 0) * (w.b - c79) ELSE 0 END
  ELSE u END AS target
FROM late_rows w JOIN picked k ON k.sale_loc = w.sale_loc AND k.level = w.level
JOIN late l ON l.sale_loc = w.sale_loc AND l.level = w.level AND w.q = coalesce(l.q_stop, 79)"""
CTES["allocated"] = """
SELECT segment, sale_loc, level, stage, target FROM early_result
UNION ALL SELECT segment, sale_loc, level, stage, target FROM late_result
UNION ALL SELECT segment, sale_loc, NULL, 'no_plan', target FROM wallet
WHERE sale_loc IS NULL OR sale_loc NOT IN (SELECT sale_loc FROM entire_plans)"""

# --- own-brand goods ---


def _own_filled(entire: str) -> str:
    return f"""
SELECT f.segment, f.target, b.sale_loc FROM (
  SELECT segment, target FROM own_forecast
  UNION ALL SELECT segment, CASE WHEN target > 1 THEN 500e0 ELSE target END FROM {entire}
  WHERE segment NOT IN (SELECT segment FROM own_forecast)) f LEFT JOIN known_branch b ON b.segment = f.segment"""


CTES["own_filled"] = _own_filled("wallet")
CTES["own_filled_after"] = _own_filled("allocated")


def _own_prepared(filled: str) -> str:
    return f"""
SELECT f.segment, coalesce(x.new, f.sale_loc) AS sale_loc, f.target AS t,
       coalesce(m.mean3, 500 / 0.03e0 * f.target) AS mean3, coalesce(f.target / nullif(m.mean3, 0), 1) AS rel,
       coalesce(d.lo, f.target) AS lo, coalesce(d.hi, f.target) AS hi
FROM {filled} f
LEFT JOIN (SELECT segment, CAST(floor(sum(target) / 3) AS DOUBLE) AS mean3 FROM panel WHERE month > {CHURN} GROUP BY segment) m
  ON m.segment = f.segment
LEFT JOIN (SELECT segment, CAST(min(target) AS DOUBLE) AS lo, CAST(max(target) AS DOUBLE) AS hi FROM own_panel
           WHERE month > {YEAR} GROUP BY segment) d ON d.segment = f.segment
LEFT JOIN fx_recode x ON x.old = f.sale_loc"""


CTES["own_prepared"] = _own_prepared("own_filled")
CTES["own_prepared_after"] = _own_prepared("own_filled_after")


def _own_rows(prepared: str) -> str:
    return f"""
SELECT o.*, p.plan AS b,
       CASE WHEN rel < 0.03e0 THEN least(coalesce(0.03e0 / nullif(rel, 0) * t, t), hi) ELSE t END AS v,
       CASE WHEN rel < 0.03e0 AND t <= 500 THEN 1e0 ELSE rel END AS rel0
FROM {prepared} o JOIN own_plans p ON p.sale_loc = o.sale_loc"""


CTES["own_rows"] = _own_rows("own_prepared")
CTES["own_rows_after"] = _own_rows("own_prepared_after")


def _own_border(rows: str) -> str:
    return f"""
SELECT *, CASE WHEN b / nullif(s, 0) < 1 THEN 'scale' WHEN c > b THEN 'border' ELSE 'open' END AS stage
FROM (SELECT sale_loc, b, {total('t')} AS s, {total('v')} AS c FROM {rows} GROUP BY ALL)"""


CTES["own_border"] = _own_border("own_rows")
CTES["own_border_after"] = _own_border("own_rows_after")
CTES["own_steps"] = """
SELECT 0 AS level, 0.015e0 AS step
UNION ALL SELECT i, 0.02e0 + i / 50e0 FROM (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i)"""
CTES["one_step"] = "SELECT 0 AS level, 0.06e0 AS step"


def _own_states(rows: str, steps: str, only: str) -> str:
    """Share of each client after each ratchet band, by recursion over the bands."""
    factor = "CASE WHEN n + 1 = 3 THEN 0.031e0 ELSE (n + 1) / 100 END"
    return f"""
SELECT segment, sale_loc, level, n, t, b,
       least(CASE WHEN mean3 = 0 THEN t ELSE rel * mean3 END, hi) AS value
FROM (WITH RECURSIVE walk AS (
        SELECT o.segment, o.sale_loc, s.level, s.step, 2 AS n, o.rel0 AS rel, o.t, o.mean3, o.hi, o.b
        FROM {rows} o CROSS JOIN {steps} s {only}
        UNION ALL
        SELECT segment, sale_loc, level, step, n + 1,
               CASE WHEN rel BETWEEN {factor} AND {factor} + 0.009999e0 AND t > 500 THEN {factor} + step ELSE rel END,
               t, mean3, hi, b
        FROM walk WHERE n < 96)
      SELECT * FROM walk WHERE n >= 3)"""


_open = "JOIN {} k ON k.sale_loc = o.sale_loc AND k.stage = 'open'"
CTES["own_states"] = _own_states("own_rows", "own_steps", _open.format("own_border"))
CTES["own_states_after"] = _own_states("own_rows_after", "own_steps", _open.format("own_border_after"))
CTES["one_step_states"] = _own_states("own_rows", "one_step", "")


def _own_stops(states: str) -> str:
    return f"""
SELECT sale_loc, level, b, any_value(s) AS s, min(CASE WHEN c > b THEN n END) AS n_stop
FROM (SELECT sale_loc, level, b, n, {total('t')} AS s, {total('value')} AS c FROM {states} GROUP BY ALL) GROUP BY ALL"""


CTES["own_stops"] = _own_stops("own_states")
CTES["own_stops_after"] = _own_stops("own_states_after")
CTES["one_step_stops"] = _own_stops("one_step_states")


def _own_ratchet(states: str, stops: str, choose: bool) -> str:
    order = "CASE WHEN n_stop IS NOT NULL THEN level ELSE 100 - level END"
    picked = f"SELECT *, row_number() OVER (PARTITION BY sale_loc ORDER BY {order}) AS k FROM {stops}"
    return f"""
SELECT w.segment, w.sale_loc, w.level, k.n_stop,
       CASE WHEN k.n_stop IS NULL THEN w.value ELSE t + (w.value - t) * coalesce((w.b - k.s) / nullif(z.c - k.s, 0), 0) END AS target
FROM {states} w JOIN ({picked}) k ON k.sale_loc = w.sale_loc AND k.level = w.level AND k.k = 1
     AND w.n = coalesce(k.n_stop, 96)
JOIN (SELECT sale_loc, level, n, {total('value')} AS c FROM {states} GROUP BY ALL) z
  ON z.sale_loc = w.sale_loc AND z.level = w.level AND z.n = w.n"""


CTES["own_ratchet"] = _own_ratchet("own_states", "own_stops", True)
CTES["own_ratchet_after"] = _own_ratchet("own_states_after", "own_stops_after", True)
CTES["one_step_ratchet"] = _own_ratchet("one_step_states", "one_step_stops", False)


def _own_allocated(rows: str, border: str, ratchet: str, prepared: str) -> str:
    return f"""
SELECT o.segment, o.sale_loc, 0 AS level, k.stage,
       CASE k.stage WHEN 'scale' THEN t * (k.b / k.s) ELSE t + (v - t) * (k.b - k.s) / (k.c - k.s) END AS target
FROM {rows} o JOIN {border} k ON k.sale_loc = o.sale_loc AND k.stage <> 'open'
UNION ALL SELECT segment, sale_loc, level, CASE WHEN n_stop IS NULL THEN 'failed' ELSE 'ratchet' END, target FROM {ratchet}
UNION ALL SELECT segment, sale_loc, NULL, 'no_plan', t FROM {prepared}
WHERE sale_loc IS NULL OR sale_loc NOT IN (SELECT sale_loc FROM own_plans)"""


CTES["own_allocated"] = _own_allocated("own_rows", "own_border", "own_ratchet", "own_prepared")
CTES["own_allocated_after"] = _own_allocated(
    "own_rows_after", "own_border_after", "own_ratchet_after", "own_prepared_after"
)


def with_ctes(body: str, **replaced: str) -> str:
    """Put the expressions a query needs in front of it, each after those it needs itself.

    ``replaced`` are other texts for some of them.
    """
    ordered: list[str] = []
    ctes = CTES | replaced
    # some names are also column names: only a table position counts
    table_position = re.compile(r"(?:FROM|JOIN)\s+(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")

    def add(text: str) -> None:
        for name in table_position.findall(text):
            if name not in ordered:
                add(ctes[name])
                if name not in ordered:
                    ordered.append(name)

    add(body)
    if not ordered:
        return body.strip()
    # steps of a tree read the one before more than once
    kept = lambda n: "AS MATERIALIZED" if n.startswith("gb_") else "AS"
    return "WITH " + ",\n".join(f"{n} {kept(n)} ({ctes[n]})" for n in ordered) + "\n" + body.strip()


def _status(allocated: str, plans: str) -> str:
    return f"""
SELECT a.sale_loc, level, stage, stage NOT IN ('failed', 'no_plan') AS passed, count(*) AS clients,
       {r(total('a.target'), 3)} AS total, p.plan
FROM {allocated} a LEFT JOIN {plans} p ON p.sale_loc = a.sale_loc GROUP BY a.sale_loc, level, stage, p.plan"""


def _moved(table: str, *more: str) -> str:
    columns = ", ".join(("segment", "sale_loc", *more))
    return f"SELECT {columns}, {r('target', 4)} AS target FROM {table}"


EXOG = "web_order_rel volume weight density med_amn nds position_count market_rel".split()
ROLLING = [f"{n}_{w}" for w in (3, 6) for n in ("mean", "std", "min", "max", "minmax")] + ["minmax_12"]
NUMERIC = "value ltk claim_period turnover period_shipment current_discount_2k".split()
OVER = "OVER (PARTITION BY segment ORDER BY month)"


def _strided(name: str, offsets: tuple[int, ...]) -> str:
    lags = [f"lag(target, {k}) {OVER}" for k in offsets]
    value = f"({' + '.join(f'coalesce({x}, 0)' for x in lags)}) / nullif({' + '.join(f'CAST({x} IS NOT NULL AS INT)' for x in lags)}, 0)"
    return f"{r(f'coalesce({value}, 0)', 4)} AS {name}"


def _ratio(name: str, a: str, b: str) -> str:
    return f"{r(f'{a} / nullif({b}, 0)')} AS {name}"


BODIES: dict[str, str] = {
    "cards_join": f"""SELECT site_id_link, segment, customers, value, plan_period, customer_name,
        {r('turnover', 4)} AS turnover, current_sale_loc, manager, subsegment_tp, ltk, license_tp FROM cards""",
    "monthly_shipments": "SELECT segment, month, target, position_count, {} FROM monthly".format(
        ", ".join(f"{r(c)} AS {c}" for c in EXOG if c != "position_count")
    ),
    "own_brand_shipments": "SELECT * FROM own_monthly",
    "client_branch_last": "SELECT segment, sale_loc FROM known_branch",
    "plan_by_type": " UNION ALL ".join(
        f"SELECT sale_loc, plan_month, {c} AS plan_value, '{k}' AS plan_type FROM fx_branch_plans WHERE plan_month = {P}"
        for k, c in (
            ("entire", "plan_value"),
            ("own_brand", "plan_value_stm"),
            ("oz", "plan_value_oz"),
            ("onls", "plan_value_onls"),
        )
    ),
    "segment_classes": "SELECT segment, segment_class FROM classes",
    "gap_filled_panel": "SELECT segment, month, target, position_count, {} FROM active".format(
        ", ".join(f"{r(c)} AS {c}" for c in ("volume", "density", "market_rel"))
    ),
    "global_grid_panel": "SELECT segment, month, target FROM grid",
    "quantile_grid": "SELECT segment, month, target FROM year_grid",
    "client_quantiles": f"SELECT segment, CAST(q AS INT) AS q, {r('quantile')} AS quantile FROM quantiles",
    "class_forecasts": f"SELECT segment, {r('target')} AS target FROM class_forecast",
    "calendar_features": "SELECT a.segment, month, a.target, holidays, work_day FROM active a JOIN month_days USING (month)",
    "lag_features": "SELECT segment, month, {} FROM active".format(
        ", ".join(
            [f"lag(target, {k}) {OVER} AS lag_{k}" for k in (1, 3, 6)]
            + [f"{r(f'lag({c}, 1) {OVER}')} AS lag_{c}_1" for c in EXOG]
        )
    ),
    "rolling_features": "SELECT segment, month, {} FROM rolling".format(", ".join(f"{r(c, 4)} AS {c}" for c in ROLLING)),
    "rolling_features_unshifted": "SELECT segment, month, {} FROM rolling_0".format(
        ", ".join(f"{r(c, 4)} AS {c}" for c in ROLLING)
    ),
    "seasonal_means": f"SELECT segment, month, {_strided('mean_23', (1, 4))}, {_strided('mean_32', (1, 3, 5))} FROM future",
    "mad_feature": f"""
        SELECT x.segment, x.month, {r('coalesce(avg(abs(y.target - x.m)), 0)', 4)} AS mad_3
        FROM (SELECT segment, month, avg(target) OVER (PARTITION BY segment ORDER BY month
                     ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m FROM future) x
        LEFT JOIN future y ON y.segment = x.segment AND y.month < x.month AND y.month >= x.month - INTERVAL 3 MONTH
        GROUP BY x.segment, x.month""",
    "ratio_features": "SELECT segment, month, {} FROM rolling".format(
        ", ".join(
            [
                f"CAST(coalesce(minmax_{w} / nullif(mean_{w}, 0) > 1, false) AS INT) AS minmax_mean_rel_{w}_flag"
                for w in (3, 6)
            ]
            + [
                _ratio(f"{n}_{w}", f"{a}_{w}", f"{b}_{w}")
                for w in (3, 6)
                for n, a, b in (
                    ("minmax_mean_rel", "minmax", "mean"),
                    ("minmax_rel", "min", "max"),
                    ("min_rel", "min", "mean"),
                    ("max_rel", "max", "mean"),
                )
            ]
        )
    ),
    "date_flags": """SELECT segment, month, target, CAST(month(month) AS INT) AS month_number,
        CAST(CASE WHEN month(month) IN (12, 1, 2) THEN 1 WHEN month(month) <= 5 THEN 2 WHEN month(month) <= 8 THEN 3
        ELSE 4 END AS INT) AS season_number, CAST(year(month) AS INT) AS year_number FROM active""",
    "future_rows": """SELECT f.segment, f.month, f.target FROM future f
        JOIN (SELECT segment, min(month) AS m FROM monthly GROUP BY segment) s ON s.segment = f.segment AND f.month >= s.m""",
    "running_manager_mean": f"""
        SELECT a.segment, a.month, c.manager, {r('m.mean', 4)} AS manager_mean
        FROM active a JOIN cards c ON c.segment = a.segment
        LEFT JOIN (SELECT d.manager, d.month, avg(a2.target) AS mean
                   FROM (SELECT DISTINCT c1.manager, a1.month FROM active a1 JOIN cards c1 ON c1.segment = a1.segment) d
                   JOIN cards c2 ON c2.manager = d.manager
                   JOIN active a2 ON a2.segment = c2.segment AND a2.month < d.month
                   GROUP BY ALL) m ON m.manager = c.manager AND m.month = a.month""",
    "cohort_decile_clusters": """
        SELECT segment, CAST(year(first_month) - 1995 AS VARCHAR) || '_q' ||
               CAST(1 + (SELECT count(*) FROM (SELECT unnest(e) AS edge) WHERE edge < mean_target) AS VARCHAR) AS comb
        FROM levels CROSS JOIN (SELECT quantile_cont(mean_target, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
                                FROM levels) z""",
    "category_shares": f"SELECT name, val, n, {r('share', 9)} AS share FROM shares",
    "rare_category_impute": """
        SELECT a.segment, max(a.month) AS last_month, {}, {}, any_value(c.manager) AS manager
        FROM active a JOIN cards c ON c.segment = a.segment GROUP BY a.segment""".format(
        ", ".join(
            f"""coalesce((SELECT s.val FROM shares s WHERE s.name = '{c}' AND s.val = any_value(c.{c}) AND s.share >= 0.01),
            (SELECT val FROM modes WHERE name = '{c}')) AS {c}"""
            for c in GROUPED
        ),
        ", ".join(f"CAST(trunc(coalesce(any_value(c.{c}), 0)) AS BIGINT) AS {c}" for c in NUMERIC),
    ),
    "sma_forecasts": f"""SELECT segment, model, mae, {r('hd_preds')} AS hd_preds, {r('final_preds')} AS final_preds
        FROM scores""",
    "sma_backtest": """
        SELECT segment, 'sma' || CAST(w AS VARCHAR) AS model, month, actual, {0} AS forecast, {1} AS abs_error
        FROM (SELECT s.segment, w, f.month, coalesce((SELECT a.target FROM active a WHERE a.segment = s.segment
                AND a.month = f.month), 0) AS actual,
                coalesce((SELECT sum(a.target) FROM active a WHERE a.segment = s.segment AND a.month < f.month
                AND a.month >= f.month - to_months(w)), 0) / w AS forecast
              FROM (SELECT DISTINCT segment FROM active) s
              CROSS JOIN (SELECT unnest([1, 3, 6, 12]) AS w)
              CROSS JOIN (VALUES (DATE '2001-06-01'), (DATE '2001-05-01'), (DATE '2001-04-01')) f(month))""".format(
        r("forecast"), r("abs(actual - forecast)")
    ),
    "model_selection": f"SELECT segment, model, {r('hd_preds')} AS hd_preds, actual, target FROM chosen",
    "model_mix_report": f"""SELECT model, count(*) AS clients, {r('count(*) / sum(count(*)) OVER ()', 9)} AS share
        FROM chosen WHERE model IS NOT NULL GROUP BY model""",
    "model_score_summary": f"""SELECT {r('median(x)')} AS median_score, {r('avg(x)')} AS mean_score,
        {r('stddev_samp(x)')} AS std_score
        FROM (SELECT abs(actual - hd_preds) / actual AS x FROM chosen WHERE model IS NOT NULL AND actual > 0)""",
    "wallet_share": f"""SELECT segment, {r('target')} AS target, {r('soz', 4)} AS soz, sale_loc,
        {r('fact_soz', 9)} AS fact_soz FROM wallet""",
    "stretch_very_low": stage_sql("c_very_low", "c > b"),
    "stretch_bands": " UNION ALL ".join(
        f"SELECT segment, sale_loc, '{n}' AS stage, passed, target FROM ({stage_sql('c_' + n, 'c > b')})"
        for n in list(REACH)[1:]
    ),
    "stretch_to_20_own_parameter": stage_sql(f"({raised(4)} * soz)", "c > b"),
    "stretch_cumulative_bands": f"""
        SELECT w.segment, w.sale_loc, k.band_stop IS NOT NULL AS passed, CAST(k.band_stop AS INT) AS stop_band, {r('''
          CASE WHEN k.band_stop IS NULL THEN top
               ELSE base + (CASE WHEN band <= k.band_stop THEN top ELSE base END - base)
                    * coalesce((plan - s.base_total) / nullif(k.band_total - s.base_total, 0), 0) END''', 4)} AS target
        FROM band_rows w LEFT JOIN one_band_stop k ON k.sale_loc = w.sale_loc
        JOIN (SELECT sale_loc, {total('base')} AS base_total FROM band_rows GROUP BY sale_loc) s ON s.sale_loc = w.sale_loc""",
    "big_client_fill": stage_sql(
        f"(CASE WHEN {big('t', 'f')} THEN t * 2 ELSE t END)",
        "(b - s) / nullif(c - s, 0) > 0 AND (b - s) / nullif(c - s, 0) < 0.24e0",
    ),
    "big_client_finish": stage_sql(
        f"(CASE WHEN {big('t', 'f')} THEN t * 2 ELSE t END)", "1 - s / nullif(b, 0) <= 0.15e0"
    ),
    "scale_down": stage_sql("(t * 2)", "b / nullif(s, 0) < 1"),
    "quantile_uplift": f"""
        SELECT * FROM (WITH x AS (SELECT w.segment, w.sale_loc, w.t, w.plan, n.q, {_uplift('w.t')} AS u
                   FROM base_rows w CROSS JOIN (SELECT unnest(range(30, 80)) AS q) n
                   LEFT JOIN quantiles z ON z.segment = w.segment AND z.q = n.q),
             a AS (SELECT sale_loc, plan, q, {total('t')} AS s, {total('u')} AS c FROM x GROUP BY ALL),
             k AS (SELECT sale_loc, min(CASE WHEN c > plan THEN q END) AS q_stop FROM a GROUP BY sale_loc)
        SELECT x.segment, x.sale_loc, q_stop IS NOT NULL AS passed, CAST(q_stop AS INT) AS stop_quantile,
               {r('CASE WHEN q_stop IS NULL THEN u ELSE t + (u - t) * coalesce((a.plan - s) / nullif(c - s, 0), 0) END', 4)} AS target
        FROM x JOIN k ON k.sale_loc = x.sale_loc AND x.q = coalesce(q_stop, 79)
        JOIN a ON a.sale_loc = x.sale_loc AND a.q = x.q)""",
    "branch_allocation": _moved("allocated", "CAST(level AS INT) AS level", "stage"),
    "branch_status": _status("allocated", "entire_plans"),
    "own_brand_prepare": f"""SELECT segment, sale_loc, {r('t', 4)} AS target, {r('mean3', 4)} AS entire_mean,
        {r('lo', 4)} AS least, {r('hi', 4)} AS greatest, {r('rel', 9)} AS rel FROM own_prepared""",
    "own_brand_border_fill": f"""
        SELECT o.segment, o.sale_loc, k.stage, {r('''CASE k.stage WHEN 'scale' THEN t * (k.b / k.s)
               WHEN 'border' THEN t + (v - t) * (k.b - k.s) / nullif(k.c - k.s, 0) ELSE t END''', 4)} AS target
        FROM own_rows o JOIN own_border k ON k.sale_loc = o.sale_loc""",
    "own_brand_ratchet": f"""SELECT segment, sale_loc, n_stop IS NOT NULL AS passed, CAST(n_stop AS INT) AS stop_band,
        {r('target', 4)} AS target FROM one_step_ratchet""",
    "own_brand_allocation": _moved("own_allocated", "CAST(level AS INT) AS level", "stage"),
    "own_brand_status": _status("own_allocated", "own_plans"),
    "entire_plan_sma": _moved("allocated"),
    "own_brand_plan_sma": _moved("own_allocated_after"),
}

# --- boosted models: the whole feature frame, cut points, and two trees of two levels written out ---

CTES["gb_categories"] = BODIES["rare_category_impute"]
CTES["gb_clusters"] = BODIES["cohort_decile_clusters"]
CTES["gb_mad"] = BODIES["mad_feature"]
CTES["gb_history"] = f"""
SELECT u.segment, u.month, u.target, {", ".join(f"a.{c}" for c in EXOG)}
FROM future u LEFT JOIN active a ON a.segment = u.segment AND a.month = u.month"""
CTES["gb_managers"] = """
SELECT d.manager, d.month, avg(a2.target) AS mean
FROM (SELECT DISTINCT c1.manager, f.month FROM future f JOIN gb_categories c1 ON c1.segment = f.segment) d
JOIN gb_categories c2 ON c2.manager = d.manager JOIN active a2 ON a2.segment = c2.segment AND a2.month < d.month
GROUP BY ALL"""
_kept_rolling = [c for c in ROLLING if c not in ("min_3", "max_3", "min_6", "max_6")]
_ratios = [
    (f"{n}_{w}", f"rolling.{a}_{w} / nullif(rolling.{b}_{w}, 0)")
    for w in (3, 6)
    for n, a, b in (("minmax_mean_rel", "minmax", "mean"), ("minmax_rel", "min", "max"), ("min_rel", "min", "mean"), ("max_rel", "max", "mean"))
]
_frame = (
    [(f"lag_{k}", f"h.lag_{k}") for k in (1, 3, 6)]
    + [(f"lag_{c}_1", f"h.lag_{c}_1") for c in EXOG]
    + [(c, f"rolling.{c}") for c in _kept_rolling]
    + [("mean_23", "h.mean_23"), ("mean_32", "h.mean_32"), ("mad_3", "gb_mad.mad_3"), ("segment_mean", "h.segment_mean")]
    + [("month_number", "month(h.month)"), ("year_number", "year(h.month)")]
    + [("season_number", "CASE WHEN month(h.month) IN (12, 1, 2) THEN 1 WHEN month(h.month) <= 5 THEN 2 WHEN month(h.month) <= 8 THEN 3 ELSE 4 END")]
    + _ratios
    + [(f"minmax_mean_rel_{w}_flag", f"CAST(coalesce(rolling.minmax_{w} / nullif(rolling.mean_{w}, 0) > 1, false) AS INT)") for w in (3, 6)]
    + [("holidays", "d.holidays"), ("work_day", "d.work_day"), ("manager_mean", "m.mean")]
    + [(c, f"c.{c}") for c in NUMERIC]
)
CTES["gb_frame"] = f"""
SELECT h.segment, h.month, CAST(coalesce(h.target, 0) AS DOUBLE) AS target, k.comb, {", ".join(f"c.{c}" for c in GROUPED)},
       {", ".join(f"{r(f'coalesce({value}, 0)', 4)} AS {name}" for name, value in _frame)}
FROM (SELECT segment, month, target, {", ".join(f"lag(target, {k}) {OVER} AS lag_{k}" for k in (1, 3, 6))},
             {", ".join(f"lag({c}, 1) {OVER} AS lag_{c}_1" for c in EXOG)}, {_strided("mean_23", (1, 4))},
             {_strided("mean_32", (1, 3, 5))},
             avg(target) OVER (PARTITION BY segment ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS segment_mean
      FROM gb_history) h
JOIN rolling ON rolling.segment = h.segment AND rolling.month = h.month
JOIN gb_mad ON gb_mad.segment = h.segment AND gb_mad.month = h.month
JOIN month_days d ON d.month = h.month JOIN gb_categories c ON c.segment = h.segment
JOIN gb_clusters k ON k.segment = h.segment
LEFT JOIN gb_managers m ON m.manager = c.manager AND m.month = h.month"""
_SHORT = "mad_3 mean_3 std_3 minmax_3 minmax_mean_rel_3 minmax_rel_3 minmax_mean_rel_3_flag min_rel_3 max_rel_3 mean_32".split()
NUMBERS = sorted(name for name, _ in _frame)
SQUARED_INPUTS = [c for c in NUMBERS if c not in (*_SHORT, "manager_mean", "segment_mean")]
CTES["gb_long"] = f"""
SELECT segment, month, comb, target, name, v FROM gb_frame UNPIVOT (v FOR name IN ({", ".join(SQUARED_INPUTS)}))"""
CTES["gb_cuts"] = f"""
SELECT comb, name, quantile_disc(v, [{", ".join(f"{k / 32}e0" for k in range(1, 32))}]) AS cuts
FROM gb_long WHERE month < {P} GROUP BY comb, name"""
CTES["gb_bins"] = """
SELECT l.segment, l.month, l.name, len(list_filter(list_distinct(cuts), lambda x: x < v)) AS bin
FROM gb_long l JOIN gb_cuts c ON c.comb = l.comb AND c.name = l.name"""
CTES["gb_rows"] = f"""
SELECT * FROM (
  SELECT comb, kind, segment, month, CAST(floor(target * 100 + 0.5e0) AS BIGINT) AS y, month < border AS train,
         bool_or(month < border) OVER w AND bool_or(month = border) OVER w AS usable
  FROM gb_frame CROSS JOIN (VALUES ('fold1', DATE '2001-06-01'), ('fold2', DATE '2001-05-01'), ('fold3', DATE '2001-04-01'),
       ('holdout', {HOLDOUT}), ('final', {P})) k(kind, border)
  WHERE month <= border WINDOW w AS (PARTITION BY comb, kind))
WHERE usable"""
CTES["gb_value0"] = """
SELECT r.*, CAST(floor(CAST(s AS DOUBLE) / n + 0.5e0) AS BIGINT) AS value
FROM gb_rows r JOIN (SELECT comb, kind, sum(y) AS s, count(*) AS n FROM gb_rows WHERE train GROUP BY ALL) m
  ON m.comb = r.comb AND m.kind = r.kind"""
# of the small family: trees, levels, rows of a leaf at least, step
TREES, LEVELS, LEAST, STEP = 2, 2, 5, "0.1e0"
for _t in range(TREES):
    CTES[f"gb_node{_t}_0"] = f"SELECT *, y - value AS res, 0 AS node FROM gb_value{_t}"
    for _l in range(LEVELS):
        CTES[f"gb_split{_t}_{_l}"] = f"""
WITH h AS (SELECT comb, kind, node, b.name, b.bin, CAST(sum(res) AS DOUBLE) AS g, count(*) AS c
           FROM gb_node{_t}_{_l} x JOIN gb_bins b ON b.segment = x.segment AND b.month = x.month WHERE train GROUP BY ALL),
     s AS (SELECT comb, kind, node, name, bin, sum(g) OVER w AS gl, sum(c) OVER w AS nl,
                  sum(g) OVER p AS gt, sum(c) OVER p AS nt
           FROM h WINDOW p AS (PARTITION BY comb, kind, node, name), w AS (PARTITION BY comb, kind, node, name ORDER BY bin)),
     v AS (SELECT *, gl * gl / nl + (gt - gl) * (gt - gl) / (nt - nl) AS gain, gt * gt / nt AS parent
           FROM s WHERE nl >= {LEAST} AND nt - nl >= {LEAST})
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comb, kind, node ORDER BY gain DESC, name, bin) AS k FROM v WHERE gain > parent)
WHERE k = 1"""
        CTES[f"gb_node{_t}_{_l + 1}"] = f"""
SELECT x.* REPLACE (CASE WHEN s.name IS NULL THEN x.node WHEN b.bin <= s.bin THEN 2 * x.node + 1 ELSE 2 * x.node + 2 END AS node)
FROM gb_node{_t}_{_l} x LEFT JOIN gb_split{_t}_{_l} s ON s.comb = x.comb AND s.kind = x.kind AND s.node = x.node
LEFT JOIN gb_bins b ON b.segment = x.segment AND b.month = x.month AND b.name = s.name"""
    CTES[f"gb_value{_t + 1}"] = f"""
SELECT x.* EXCLUDE (res, node) REPLACE (x.value + CAST(floor({STEP} * (CAST(s AS DOUBLE) / n) + 0.5e0) AS BIGINT) AS value)
FROM gb_node{_t}_{LEVELS} x
JOIN (SELECT comb, kind, node, sum(res) AS s, count(*) AS n FROM gb_node{_t}_{LEVELS} WHERE train GROUP BY ALL) l
  ON l.comb = x.comb AND l.kind = x.kind AND l.node = x.node"""
CTES["gb_forecasts"] = f"""
SELECT comb, segment, kind, CAST(y AS DOUBLE) / 100 AS actual,
       CASE WHEN kind = 'final' THEN CAST(value AS DOUBLE) ELSE greatest(CAST(value AS DOUBLE), 0) END / 100 AS forecast
FROM gb_value{TREES} WHERE NOT train"""
CTES["gb_scores"] = """
SELECT segment, 'lgb_ms' AS model, mean + coalesce(dev, 0) AS mae, hd_preds, final_preds
FROM (SELECT segment, avg(CASE WHEN kind LIKE 'fold%' THEN abs(actual - forecast) END) AS mean,
             stddev_samp(CASE WHEN kind LIKE 'fold%' THEN abs(actual - forecast) END) AS dev,
             max(CASE WHEN kind = 'holdout' THEN forecast END) AS hd_preds,
             max(CASE WHEN kind = 'final' THEN forecast END) AS final_preds FROM gb_forecasts GROUP BY segment)
WHERE mean IS NOT NULL AND hd_preds IS NOT NULL"""
CTES["gb_all_scores"] = "SELECT * FROM scores UNION ALL SELECT * FROM gb_scores"
CTES["gb_chosen"] = _chosen("gb_all_scores", "active").replace(
    "WHERE final_preds <> 0",
    "WHERE (model <> 'lgb_ms' OR hd_preds / nullif(final_preds, 0) BETWEEN 0.25e0 AND 1.75e0) AND final_preds <> 0",
)
_gains = " UNION ALL ".join(
    f"SELECT comb, name, gain - parent AS gain FROM gb_split{t}_{l} WHERE kind = 'holdout'" for t in range(TREES) for l in range(LEVELS)
)
BODIES |= {
    "boosting_frame": f"SELECT segment, month, target, comb, {', '.join(GROUPED)}, {', '.join(NUMBERS)} FROM gb_frame",
    "feature_cuts": """SELECT comb, name AS feature, CAST(unnest(range(1, 32)) AS INT) AS k, unnest(cuts) + 0.0 AS cut
        FROM gb_cuts""",
    "gbt_small_forecasts": f"SELECT comb, segment, kind, {r('actual', 2)} AS actual, {r('forecast', 2)} AS forecast FROM gb_forecasts",
    "gbt_small_importances": f"""
        SELECT * FROM (WITH g AS ({_gains}),
             u AS (SELECT DISTINCT comb, f.name FROM gb_rows
                   CROSS JOIN (SELECT unnest({SQUARED_INPUTS}) AS name) f WHERE kind = 'holdout')
        SELECT u.comb, u.name AS feature, {r("coalesce(sum(gain), 0) / coalesce(nullif(any_value(t), 0), 1)")} AS importance
        FROM u LEFT JOIN g ON g.comb = u.comb AND g.name = u.name
        LEFT JOIN (SELECT comb, sum(gain) AS t FROM g GROUP BY comb) z ON z.comb = u.comb GROUP BY u.comb, u.name)""",
    "boosted_model_selection": f"SELECT segment, model, {r('hd_preds', 4)} AS hd_preds, actual, target FROM gb_chosen",
}


def oracle_sql() -> dict[str, str]:
    found = {name: with_ctes(body) for name, body in BODIES.items()}
    # the same plan from a choice that has boosted forecasts in it
    boosted = CTES["forecast"].replace("FROM chosen", "FROM gb_chosen")
    found["entire_plan_boosted_small"] = with_ctes(_moved("allocated"), forecast=boosted)
    return found
