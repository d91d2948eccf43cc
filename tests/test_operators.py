import math
import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from salesloom.context import PlanContext, shift_months
from salesloom.operators import categories, clusters, features, moving_average, selection
from salesloom.operators.month_calendar import day_spine, month_days
from salesloom.operators.own_brand import fill_missing_clients, prepare_own_brand
from salesloom.operators.panel import common_grid, fill_gaps, monthly_shipments, year_grid
from salesloom.operators.segments import class_forecasts, segment_classes, with_segment_class
from salesloom.operators.wallet import wallet_share
from salesloom.sources.loaders import client_branches, client_cards, own_brand_lines, shipment_lines

CTX = PlanContext.from_month("2023-10-01")
PANEL = "segment bigint, month date, target bigint"


def m(back):
    """Month start ``back`` months before the plan month."""
    return shift_months(CTX.plan_month, -back)


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def line(site, day, cost, product=1, kind=1, web=0, market=0, volume=1.0, weight=2.0):
    return (site, day, cost, volume, weight, 5.0, 0.1, web, market, product, kind)


LINES = (
    "site_use_id bigint, ordered_day date, cost_rub double, volume double, weight double, med_amn double, "
    "nds_rate double, web_order_flag int, dlo_id int, cd_m bigint, oper_tp_id int"
)


def test_monthly_aggregate(spark):
    lines = spark.createDataFrame(
        [
            line(1, date(2023, 9, 1), 1.7, product=1, web=1, volume=4.0),
            line(1, date(2023, 9, 30), 2.6, product=1, market=1, volume=2.0),
            line(1, date(2023, 9, 15), -0.9, product=2, web=None),
            line(1, date(2023, 10, 1), 100.0),
            line(1, date(2017, 10, 31), 100.0),
            line(1, date(2023, 9, 2), 100.0, kind=2),
            line(None, date(2023, 9, 2), 100.0),
            line(2, date(2017, 11, 1), 5.0, weight=0.0),
        ],
        LINES,
    )
    rows = {r["segment"]: r for r in monthly_shipments(shipment_lines(lines, CTX)).collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    # each cost is cut to an integer before the sum
    assert (one["target"], one["position_count"], one["month"]) == (3, 2, date(2023, 9, 1))
    assert one["volume"] == pytest.approx(7 / 3)
    assert one["density"] == pytest.approx(7 / 3 / 2)
    # lines without a flag count in the denominator
    assert one["web_order_rel"] == pytest.approx(1 / 3)
    assert one["market_rel"] == pytest.approx(1 / 3)
    assert rows[2]["density"] is None


def test_lines_are_shuffled_once(spark):
    lines = spark.createDataFrame([line(1, date(2023, 9, 1), 10.0)], LINES)
    plan = monthly_shipments(shipment_lines(lines, CTX))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_own_brand_lines_keep_listed_products_once(spark):
    lines = spark.createDataFrame([line(1, date(2023, 9, 1), 10.0, product=p) for p in (1, 2, 3)], LINES)
    products = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "medicine_code bigint, own_mark int")
    assert [r["cd_m"] for r in own_brand_lines(lines, products, CTX).collect()] == [1]


def test_class_borders(spark):
    rows = []
    rows += [(1, m(1), 500), (1, m(2), -500)]  # net zero by returns
    rows += [(2, m(4), 90000)]  # nothing recent
    rows += [(3, m(k), 30000) for k in range(1, 9)]  # greatest month equals the threshold
    rows += [(4, m(k), 30001) for k in range(1, 6)]  # five months
    rows += [(5, m(k), 30001) for k in range(1, 7)]  # six months
    rows += [(6, m(1), 10)]  # low and rare: low wins
    rows += [(7, m(3), 50000), *[(7, m(k), 1) for k in range(4, 12)]]  # the churn month itself counts
    want = {1: "churned", 2: "churned", 3: "low", 4: "rare", 5: "active", 6: "low", 7: "active"}
    df = panel(spark, rows)
    assert {r[0]: r[1] for r in segment_classes(df, CTX, 30000.0).collect()} == want
    classed = with_segment_class(df, CTX, 30000.0)
    assert {r["segment"]: r["segment_class"] for r in classed.collect()} == want
    forecasts = {r[0]: r[1] for r in class_forecasts(classed, CTX, 30000.0).collect()}
    assert forecasts == {1: 0.0, 2: 0.0, 3: 30000.0, 4: 30001.0, 6: 30000.0}


def test_rare_forecast_has_a_floor(spark):
    rows = [(1, m(1), 40000), (1, m(3), 100), (1, m(4), 10**6)]
    classed = with_segment_class(panel(spark, rows), CTX, 30000.0)
    assert class_forecasts(classed, CTX, 30000.0).collect()[0]["target"] == 30000.0
    assert class_forecasts(classed, CTX, 500.0).collect()[0]["target"] == pytest.approx(20050.0)


def test_grids(spark):
    df = panel(spark, [(1, m(5), 7), (1, m(2), None), (1, m(1), 9), (2, m(3), 4)])
    filled = [tuple(r) for r in fill_gaps(df).orderBy("segment", "month").collect()]
    assert filled == [(1, m(5), 7), (1, m(4), 0), (1, m(3), 0), (1, m(2), 0), (1, m(1), 9), (2, m(3), 4)]
    grid = {(r[0], r[1]): r[2] for r in common_grid(fill_gaps(df)).collect()}
    assert len(grid) == 10
    assert grid[2, m(5)] is None and grid[2, m(1)] is None and grid[2, m(3)] == 4
    zero = {(r[0], r[1]): r[2] for r in common_grid(fill_gaps(df), fill_zero=True).collect()}
    assert zero[2, m(5)] == 0
    year = year_grid(panel(spark, [(1, m(13), 5), (2, m(12), 6), (3, m(1), 7)]), CTX)
    found = {(r[0], r[1]): r[2] for r in year.collect()}
    assert len(found) == 26 and found[2, m(12)] == 6 and found[3, m(0)] == 0


def test_calendar(spark):
    ctx = PlanContext.from_month("2023-03-01", history_start=date(2023, 1, 1))
    assert day_spine(spark, ctx).count() == 31 + 28 + 31
    marks = spark.createDataFrame(
        [(date(2023, 1, 1), 1, 0), (date(2023, 1, 2), 0, 1), (date(2023, 3, 31), None, 1)],
        "day date, is_holiday int, is_working_day int",
    )
    found = {r["month"].month: (r["holidays"], r["work_day"]) for r in month_days(marks, ctx).collect()}
    assert found == {1: (1, 1), 2: (0, 0), 3: (0, 1)}


def window_by_hand(values, at, size, shift):
    frame = values[max(0, at - size + 1 - shift) : max(0, at + 1 - shift)]
    return [v for v in frame if v is not None]


@pytest.mark.parametrize("shift", [0, 1])
def test_window_features_by_hand(spark, shift):
    rng = random.Random(3)
    series = {
        1: [100],
        2: [100, 50],
        3: [5, 5, 5, 5],
        4: [rng.randint(-50, 400) for _ in range(20)],
        5: [0, 0, 0, 90],
    }
    rows = [(s, m(len(v) - k), x) for s, v in series.items() for k, x in enumerate(v)]
    found = features.window_features(
        panel(spark, rows).withColumns({c: F.lit(1.0) for c in features.EXOGENOUS}), CTX, shift
    )
    got = {(r["segment"], r["month"]): r for r in found.collect()}
    for s, values in series.items():
        values = values + [None]  # the plan month
        for at in range(len(values)):
            row = got[s, m(len(values) - 1 - at)]
            for w in (3, 6):
                frame = window_by_hand(values, at, w, shift)
                mean = sum(frame) / len(frame) if frame else 0.0
                spread = max(frame) - min(frame) if frame else 0.0
                assert row[f"mean_{w}"] == pytest.approx(mean)
                assert row[f"std_{w}"] == pytest.approx(statistics.stdev(frame) if len(frame) > 1 else 0.0)
                assert row[f"minmax_{w}"] == pytest.approx(spread)
                if mean:
                    assert row[f"minmax_mean_rel_{w}"] == pytest.approx(spread / mean)
                    assert row[f"max_rel_{w}"] == pytest.approx(max(frame) / mean)
                else:
                    assert row[f"minmax_mean_rel_{w}"] is None and row[f"minmax_mean_rel_{w}_flag"] == 0
            frame = window_by_hand(values, at, 3, shift)
            mean = sum(frame) / len(frame) if frame else 0.0
            mad = sum(abs(v - mean) for v in frame) / len(frame) if frame else 0.0
            assert row["mad_3"] == pytest.approx(mad)
            strided = [values[at - shift - j * 2] for j in range(3) if at - shift - j * 2 >= 0]
            strided = [v for v in strided if v is not None]
            assert row["mean_32"] == pytest.approx(sum(strided) / len(strided) if strided else 0.0)
            assert row["lag_3"] == (values[at - 3] if at >= 3 else None)
            frame = window_by_hand(values, at, 12, shift)
            assert row["minmax_12"] == pytest.approx(max(frame) - min(frame) if frame else 0.0)
        assert "min_3" not in got[s, m(0)]


def test_running_category_mean_looks_back_only(spark):
    rows = [(1, m(3), 10, "a"), (2, m(3), 30, "a"), (1, m(2), 50, "a"), (3, m(2), 7, "b"), (1, m(0), None, "a")]
    df = spark.createDataFrame(rows, PANEL + ", manager string")
    found = {(r["segment"], r["month"]): r["mean"] for r in features.running_category_mean(df, "manager", "mean").collect()}
    assert found == {(1, m(3)): None, (2, m(3)): None, (1, m(2)): 20.0, (3, m(2)): None, (1, m(0)): 30.0}


def test_decile_labels_on_edges_and_ties(spark):
    levels = spark.createDataFrame(
        [(k, date(2017 + k % 8, 3, 1), float(k)) for k in range(11)], "segment bigint, first_month date, mean_target double"
    )
    found = {r[0]: r[1] for r in clusters.cohort_decile_clusters(levels, CTX).collect()}
    # the edges are 1..9; a value on an edge belongs to the lower label, the minimum to the first
    assert [found[k].split("_")[1] for k in range(11)] == ["q1", "q1", *[f"q{k}" for k in range(2, 11)]]
    assert found[7].startswith("7_")  # 2024 lies after the source's last cohort
    tied = levels.withColumn("mean_target", F.lit(5.0))
    assert {r[1].split("_")[1] for r in clusters.cohort_decile_clusters(tied, CTX).collect()} == {"q1"}


def test_rare_categories(spark):
    # "edge" is exactly 1 %, "rare" below it; "x" and "y" tie for the most frequent value
    values = ["x"] * 98 + ["y"] * 98 + ["edge"] * 2 + ["rare"] + ["rare2"] + [None] * 10
    rows = [(k, v, None if k == 0 else 2.7, "mgr") for k, v in enumerate(values)]
    cards = spark.createDataFrame(rows, "segment bigint, kind string, size double, manager string")
    cards = cards.withColumn("empty", F.lit(None).cast("string"))
    cleaned = categories.clean_categories(cards, ["kind", "empty"], ["size"])
    counts = {r["kind"]: r["count"] for r in cleaned.groupBy("kind").count().collect()}
    assert counts == {"x": 98 + 12, "y": 98, "edge": 2}
    assert {r["size"] for r in cleaned.collect()} == {0, 2}
    assert cleaned.filter("empty is not null").isEmpty()


def test_moving_average_scores(spark):
    values = [40, 0, 70, 10, 90, 20, 60, 30, 80, 50, 15, 25, 35, 45, 55, 65]  # oldest first
    rows = [(1, m(len(values) - k), v) for k, v in enumerate(values) if v]
    rows += [(2, m(1), 1000)]
    found = {(r["segment"], r["model"]): r for r in moving_average.moving_average_scores(panel(spark, rows), CTX).collect()}
    for w in (1, 3, 6, 12):
        at = lambda back: sum(values[len(values) - back - w : len(values) - back]) / w
        row = found[1, f"sma{w}"]
        assert row["hd_preds"] == pytest.approx(at(1)) and row["final_preds"] == pytest.approx(at(0))
        errors = [abs(values[-1 - k] - at(k + 1)) for k in (1, 2, 3)]
        assert row["mae"] == math.trunc(statistics.mean(errors) + statistics.stdev(errors))
    # no holdout forecast of the last-month model for a client that starts in the holdout month
    assert (2, "sma1") not in found and found[2, "sma12"]["final_preds"] == pytest.approx(1000 / 12)


SCORES = "segment bigint, model string, mae double, hd_preds double, final_preds double"
FACTS = "segment bigint, least bigint, greatest bigint, actual bigint"


def choose(spark, scores, facts):
    rows = selection.choose_models(spark.createDataFrame(scores, SCORES), spark.createDataFrame(facts, FACTS)).collect()
    return {r["segment"]: (r["model"], r["target"]) for r in rows}


def test_selection(spark):
    scores = [
        # a tie on blended error goes to the smaller holdout error, then to the name
        (1, "sma3", 100.0, 90.0, 50.9), (1, "sma12", 100.0, 90.0, 40.0), (1, "sma6", 900.0, 100.0, 60.0),
        # nothing is usable: the fallback's value, even if it is zero
        (2, "sma6", 1.0, 0.0, 0.0), (2, "sma3", 1.0, 5.0, 99.0),
        # nothing is usable and there is no fallback
        (3, "sma3", 1.0, 0.0, 10.0),
        # a boosted forecast on the borders of the holdout-to-final ratio, and beyond
        (4, "cb_ms", 1.0, 25.0, 100.0), (4, "sma6", 5000.0, 90.0, 90.0),
        (5, "lgb_ms", 1.0, 24.9, 100.0), (5, "sma6", 5000.0, 90.0, 90.0),
        (6, "cb_ms", 1.0, 175.0, 100.0), (6, "sma6", 5000.0, 90.0, 90.0),
        # equal to the least month, to .95 of the greatest, and above it
        (7, "sma3", 1.0, 10.0, 10.0), (8, "sma3", 1.0, 10.0, 95.0), (9, "sma3", 1.0, 10.0, 95.1), (9, "sma6", 1.0, 1.0, 5.0),
    ]
    facts = [(k, 10, 1000, 100) for k in (1, 4, 5, 6)] + [(k, 10, 100, 100) for k in (2, 3, 7, 8, 9)]
    assert choose(spark, scores, facts) == {
        1: ("sma12", 40), 2: (None, 0), 4: ("cb_ms", 100), 5: ("sma6", 90), 6: ("cb_ms", 100),
        7: ("sma3", 10), 8: ("sma3", 95), 9: (None, 5),
    }


def test_selection_facts_count_gaps_after_the_year_start(spark):
    rows = [(1, m(12), 1), (1, m(11), 50), (1, m(9), 70), (1, m(1), 60)]  # gaps inside
    rows += [(2, m(14), 1), *[(2, m(k), 10 + k) for k in range(1, 13)]]  # a gap before the year only
    rows += [(3, m(4), -5), (3, m(2), -7), (4, m(3), 8), (5, m(20), 9), (6, m(30), 4), (6, m(2), 5)]
    rows += [(7, m(5), None), (7, m(4), 3)]
    sparse = panel(spark, rows)
    found = {r["segment"]: tuple(r)[1:] for r in selection.selection_facts(sparse, CTX).collect()}
    assert found == {
        1: (0, 70, 60), 2: (11, 21, 11), 3: (-7, 0, 0), 4: (8, 8, 0), 5: (None, None, 0), 6: (0, 5, 0), 7: (0, 3, 0),
    }
    filled = selection.selection_facts(fill_gaps(sparse), CTX).collect()
    assert {r["segment"]: tuple(r)[1:] for r in filled} == found


def test_wallet_share(spark):
    targets = {1: 50000.0, 2: 50000.0, 3: 50000.0, 4: 50000.0, 5: 1.0, 6: 30000.0, 7: 0.0, 8: 0.5, 9: 50000.0}
    turnover = {1: None, 2: 0.0, 3: 1.0, 4: 40000.0, 5: 1e6, 6: 1e6, 7: 1e6, 8: 10.0, 9: 1e6}
    forecast = spark.createDataFrame(list(targets.items()), "segment bigint, target double")
    cards = spark.createDataFrame(
        [(s, v, None if s == 4 else "A") for s, v in turnover.items()],
        "site_id_link bigint, turnover double, current_sale_loc string",
    )
    branches = spark.createDataFrame([(4, "OLD"), (9, "B")], "segment bigint, sale_loc string")
    recode = spark.createDataFrame([("OLD", "NEW")], "old string, new string")
    found = {r["segment"]: tuple(r)[1:] for r in wallet_share(forecast, cards, branches, recode).collect()}
    assert found == {
        1: (50000.0, 250000.0, "A", 0.2),
        2: (50000.0, 250000.0, "A", 0.2),
        3: (50000.0, 250000.0, "A", 0.2),
        4: (50000.0, 250000.0, "NEW", 0.2),
        5: (30000.0, 30000.0, "A", 1.0),
        6: (30000.0, 30000.0, "A", 1.0),
        7: (0.0, 0.0, "A", 1.0),
        8: (0.5, 10.0, "A", 0.05),
        9: (50000.0, 1e6, "A", 0.05),
    }


def test_own_brand_completion_and_share(spark):
    own = spark.createDataFrame([(1, 900.0), (2, 0.0), (5, 40.0)], "segment bigint, target double")
    entire = spark.createDataFrame([(1, 5e4), (3, 0.5), (4, 2.0)], "segment bigint, target double")
    branches = spark.createDataFrame([(k, "A") for k in range(1, 6)], "segment bigint, sale_loc string")
    filled = fill_missing_clients(own, entire, branches, CTX)
    assert {r["segment"]: r["target"] for r in filled.collect()} == {1: 900.0, 2: 0.0, 3: 0.5, 4: 500.0, 5: 40.0}
    # the churn month is left out of the sum, which is still divided by three
    shipments = panel(spark, [(1, m(3), 10**6), (1, m(2), 20001), (1, m(1), 10000), (2, m(1), 300), (5, m(1), 1)])
    own_panel = panel(spark, [(1, m(12), 1), (1, m(11), 700), (1, m(1), 1200)])
    recode = spark.createDataFrame([], "old string, new string")
    rows = {r["segment"]: r for r in prepare_own_brand(filled, shipments, own_panel, recode, CTX).collect()}
    assert (rows[1]["entire_mean"], rows[1]["least"], rows[1]["greatest"]) == (10000.0, 700.0, 1200.0)
    assert rows[1]["rel"] == pytest.approx(0.09)
    assert rows[2]["rel"] == 0.0
    assert (rows[4]["rel"], rows[4]["least"], rows[4]["greatest"]) == (1.0, 500.0, 500.0)
    assert rows[4]["entire_mean"] == pytest.approx(500 / 0.03 * 500)
    assert (rows[5]["entire_mean"], rows[5]["rel"]) == (0.0, 1.0)


def test_cards_and_branches(spark):
    links = spark.createDataFrame(
        [(1, 10, 5, date(2023, 9, 1), "n", "A"), (1, 10, 5, date(2023, 8, 1), "n", "B"), (2, 20, 5, date(2023, 9, 1), "n", "A"),
         (3, 30, 5, date(2023, 9, 1), "n", "A")],
        "site_id_link bigint, customers bigint, value bigint, plan_period date, customer_name string, current_sale_loc string",
    )
    customers = spark.createDataFrame(
        [(10, 100.0, "A"), (10, 300.0, "A"), (10, 900.0, "I"), (20, 5.0, "I"), (30, 7.0, "A")],
        "customers bigint, turnover double, bill_status string",
    )
    partners = spark.createDataFrame(
        [(1, 1, "Petrov (3)", "A", CTX.activity), (2, 2, "X", "A", CTX.activity), (3, 3, "X", "A", "Other")],
        "site_use_id bigint, segment bigint, manager string, site_status string, activity string",
    )
    (row,) = client_cards(links, customers, partners, CTX).collect()
    assert (row["site_id_link"], row["turnover"], row["manager"]) == (1, 200.0, "petrov ")
    dated = spark.createDataFrame(
        [(1, "A", date(2023, 1, 1)), (1, "B", date(2023, 2, 1)), (1, None, date(2023, 3, 1)), (None, "C", date(2023, 1, 1))],
        "segment bigint, sale_loc string, updated date",
    )
    assert [tuple(r) for r in client_branches(dated).collect()] == [(1, "B")]
