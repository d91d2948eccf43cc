"""Registered queries: each runs one operator, or a whole plan, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import EXOGENOUS, GROUPED_CATEGORIES, PLAN_VALUE_COLUMN, AllocationLevel, entire_levels
from salesloom.operators import allocation, bins, boosting, categories, clusters, features, moving_average
from salesloom.operators import own_brand as own
from salesloom.operators import selection, stretch
from salesloom.operators.month_calendar import with_month_days
from salesloom.operators.panel import common_grid, monthly_own_brand, monthly_shipments, with_card, year_grid
from salesloom.operators.segments import class_forecasts, segment_classes
from salesloom.operators.tuning import SearchBudget, TreeParams
from salesloom.operators.wallet import wallet_share
from salesloom.plans.entire import boosted, client_forecast, entire_plan
from salesloom.plans.own_brand import own_brand_plan
from salesloom.plans.panels import active_panel, cards_of, load_panel, sales_only
from salesloom.session import stage
from salesloom.sources import fixtures
from salesloom.sources.loaders import (
    branch_plans_for,
    client_branches,
    own_brand_lines,
    shipment_lines,
)

CTX = fixtures.FIXTURE_CONTEXT
# no client of the test tables reaches the usual limit of a big client
LEVELS = entire_levels(big_target=2e5)
# all three rings over a family's own ranges
SEARCHED = SearchBudget()


def rounded(name: str, digits: int = 6) -> Column:
    # adding zero turns a negative zero into zero
    return (F.round(F.col(name).cast("double"), digits) + 0.0).alias(name)


class Inputs:
    """Inputs of one query run, built on demand."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.sources = fixtures.fixture_sources(spark, root)

    @cached_property
    def cards(self) -> DataFrame:
        return cards_of(self.sources, CTX)

    @cached_property
    def classed(self) -> DataFrame:
        return load_panel(self.sources, CTX, "entire", self.cards)

    @cached_property
    def active(self) -> DataFrame:
        return active_panel(self.classed)

    @cached_property
    def active_target(self) -> DataFrame:
        return active_panel(self.classed, target_only=True)

    @cached_property
    def scores(self) -> DataFrame:
        return moving_average.moving_average_scores(self.classed.filter("segment_class = 'active'"), CTX)

    @cached_property
    def sales(self) -> DataFrame:
        """The classed panel with sales only, staged."""
        return stage(sales_only(self.classed), "panel")

    @cached_property
    def wallet(self) -> DataFrame:
        forecast = client_forecast(self.sales, CTX, CTX.low_value)
        branches = client_branches(self.sources.site_branch)
        return stage(wallet_share(forecast, self.cards, branches, self.sources.branch_recode), "wallet")

    @cached_property
    def plans(self) -> DataFrame:
        return stage(branch_plans_for(self.sources.branch_plans, "entire", CTX), "plans")

    @cached_property
    def years(self) -> DataFrame:
        clients = self.sales.filter("segment_class in ('active', 'rare')")
        return stage(allocation.client_year(clients, CTX), "years")

    @cached_property
    def own_plans(self) -> DataFrame:
        return stage(branch_plans_for(self.sources.branch_plans, "own_brand", CTX), "own-plans")

    @cached_property
    def own_prepared(self) -> DataFrame:
        wallet = self.wallet
        classed = stage(load_panel(self.sources, CTX, "own_brand", self.cards), "own-panel")
        forecast = client_forecast(classed, CTX, CTX.own_brand_low_value)
        branches = client_branches(self.sources.site_branch)
        # the unallocated forecast of all goods stands in for the entire plan
        filled = own.fill_missing_clients(forecast, wallet, branches, CTX)
        prepared = own.prepare_own_brand(filled, self.sales, classed, self.sources.branch_recode, CTX)
        return stage(prepared, "own-prepared")


Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame], key: str | None = None) -> Callable[[Inputs], DataFrame]:
    REGISTRY[key or build.__name__] = lambda spark, root: build(Inputs(spark, root))
    return build


def query_as(key: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    """For keys whose name an imported operator already has."""
    return lambda build: query(build, key)


# --- sources, panel and classes ---


@query
def cards_join(i: Inputs) -> DataFrame:
    return i.cards.select(
        "site_id_link",
        "segment",
        "customers",
        "value",
        "plan_period",
        "customer_name",
        rounded("turnover", 4),
        "current_sale_loc",
        "manager",
        "subsegment_tp",
        "ltk",
        "license_tp",
    )


@query_as("monthly_shipments")
def monthly_shipments_panel(i: Inputs) -> DataFrame:
    panel = monthly_shipments(shipment_lines(i.sources.shipments, CTX))
    numbers = [c for c in EXOGENOUS if c != "position_count"]
    return panel.select("segment", "month", "target", "position_count", *map(rounded, numbers))


@query
def own_brand_shipments(i: Inputs) -> DataFrame:
    return monthly_own_brand(own_brand_lines(i.sources.shipments, i.sources.products, CTX))


@query
def client_branch_last(i: Inputs) -> DataFrame:
    return client_branches(i.sources.site_branch)


@query
def plan_by_type(i: Inputs) -> DataFrame:
    found = None
    for plan_type in PLAN_VALUE_COLUMN:
        part = branch_plans_for(i.sources.branch_plans, plan_type, CTX)
        part = part.withColumn("plan_type", F.lit(plan_type))
        found = part if found is None else found.unionByName(part)
    return found


@query_as("segment_classes")
def segment_class_table(i: Inputs) -> DataFrame:
    panel = with_card(monthly_shipments(shipment_lines(i.sources.shipments, CTX)), i.cards)
    return segment_classes(panel, CTX, CTX.low_value)


@query
def gap_filled_panel(i: Inputs) -> DataFrame:
    return i.active.select(
        "segment", "month", "target", "position_count", *map(rounded, ("volume", "density", "market_rel"))
    )


@query
def global_grid_panel(i: Inputs) -> DataFrame:
    return common_grid(i.active_target)


@query
def quantile_grid(i: Inputs) -> DataFrame:
    return year_grid(i.classed.filter("segment_class in ('active', 'rare')"), CTX)


@query
def client_quantiles(i: Inputs) -> DataFrame:
    return allocation.client_quantiles(i.years).select("segment", "q", rounded("quantile"))


@query_as("class_forecasts")
def class_forecast_table(i: Inputs) -> DataFrame:
    return class_forecasts(i.classed, CTX, CTX.low_value).select("segment", rounded("target"))


# --- features ---


@query
def calendar_features(i: Inputs) -> DataFrame:
    return with_month_days(i.active_target, i.sources.calendar, CTX)


@query
def lag_features(i: Inputs) -> DataFrame:
    found = i.active.withColumns(features.lag_features(horizon=CTX.horizon))
    lags = [f"lag_{c}_{CTX.horizon}" for c in EXOGENOUS]
    return found.select("segment", "month", "lag_1", "lag_3", "lag_6", *map(rounded, lags))


ROLLING = [f"{name}_{w}" for w in (3, 6) for name in ("mean", "std", "min", "max", "minmax")] + ["minmax_12"]


@query
def rolling_features(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX).withColumns(features.rolling_features())
    return rows.select("segment", "month", *[rounded(c, 4) for c in ROLLING])


@query
def rolling_features_unshifted(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX).withColumns(features.rolling_features(shift=0))
    return rows.select("segment", "month", *[rounded(c, 4) for c in ROLLING])


@query
def seasonal_means(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX).withColumns(features.seasonal_means())
    return rows.select("segment", "month", rounded("mean_23", 4), rounded("mean_32", 4))


@query
def mad_feature(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX).withColumns(features.mad_feature())
    return rows.select("segment", "month", rounded("mad_3", 4))


@query
def ratio_features(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX).withColumns(features.rolling_features())
    found = features.ratio_features(rows)
    flags = ["minmax_mean_rel_3_flag", "minmax_mean_rel_6_flag"]
    ratios = [f"{n}_{w}" for w in (3, 6) for n in ("minmax_mean_rel", "minmax_rel", "min_rel", "max_rel")]
    return found.select("segment", "month", *flags, *map(rounded, ratios))


@query
def date_flags(i: Inputs) -> DataFrame:
    return i.active_target.withColumns(features.date_flags())


@query
def future_rows(i: Inputs) -> DataFrame:
    rows = features.with_future_rows(i.active_target, CTX)
    shipments = monthly_shipments(shipment_lines(i.sources.shipments, CTX))
    return features.since_first_month(rows, features.first_months(shipments))


@query
def running_manager_mean(i: Inputs) -> DataFrame:
    panel = i.active_target.join(i.cards.select("segment", "manager"), "segment")
    found = features.running_category_mean(panel, "manager", "manager_mean")
    return found.select("segment", "month", "manager", rounded("manager_mean", 4))


@query
def cohort_decile_clusters(i: Inputs) -> DataFrame:
    levels = stage(clusters.client_levels(i.active_target), "levels")
    return clusters.cohort_decile_clusters(levels, CTX)


@query
def category_shares(i: Inputs) -> DataFrame:
    shares = categories.value_shares(stage(i.cards, "cards"), GROUPED_CATEGORIES)
    return shares.select("name", "val", "n", rounded("share", 9))


@query
def rare_category_impute(i: Inputs) -> DataFrame:
    cleaned = categories.clean_categories(stage(i.cards, "cards"))
    last = i.active_target.groupBy("segment").agg(F.max("month").alias("last_month"))
    return categories.with_categories(last, cleaned)


# --- forecasts ---


@query
def sma_forecasts(i: Inputs) -> DataFrame:
    return i.scores.select("segment", "model", "mae", rounded("hd_preds"), rounded("final_preds"))


@query
def sma_backtest(i: Inputs) -> DataFrame:
    active = i.classed.filter("segment_class = 'active'")
    found = moving_average.moving_average_backtest(active, CTX)
    return found.select("segment", "model", "month", "actual", rounded("forecast"), rounded("abs_error"))


def _chosen(i: Inputs) -> DataFrame:
    active = i.classed.filter("segment_class = 'active'")
    return selection.choose_models(i.scores, selection.selection_facts(active, CTX))


@query
def model_selection(i: Inputs) -> DataFrame:
    return _chosen(i).select("segment", "model", rounded("hd_preds"), "actual", "target")


@query
def model_mix_report(i: Inputs) -> DataFrame:
    return selection.model_mix(_chosen(i)).select("model", "clients", rounded("share", 9))


@query
def model_score_summary(i: Inputs) -> DataFrame:
    found = selection.score_summary(stage(_chosen(i), "chosen"))
    return found.select(rounded("median_score"), rounded("mean_score"), rounded("std_score"))


def _boosting_frame(i: Inputs) -> tuple[DataFrame, DataFrame]:
    cards = stage(i.cards, "cards")
    labels = categories.frequent_values(cards, GROUPED_CATEGORIES)
    return boosting.boosting_frame(i.active, cards, i.sources.calendar, CTX, labels=labels), cards


@query_as("boosting_frame")
def boosting_frame_table(i: Inputs) -> DataFrame:
    return _boosting_frame(i)[0]


@query_as("feature_cuts")
def feature_cut_table(i: Inputs) -> DataFrame:
    frame, _ = _boosting_frame(i)
    names = boosting.family_inputs(boosting.model_inputs(frame), boosting.squared_family())
    cuts = bins.feature_cuts(frame, names, CTX)
    each = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("cuts")) for c in names))
    found = cuts.select("comb", F.inline(each)).select("comb", "feature", F.posexplode("cuts"))
    return found.select("comb", "feature", (F.col("pos") + 1).alias("k"), (F.col("col") + F.lit(0.0)).alias("cut"))


def _fitted(i: Inputs, *families: boosting.Family) -> list[boosting.BoostingResult]:
    return boosting.fit_families(i.active, stage(i.cards, "cards"), i.sources.calendar, families, CTX)


# a family small enough to be written out in SQL
SMALL_FAMILY = boosting.squared_family(TreeParams(trees=2, depth=2, min_rows=5))


@query
def gbt_small_forecasts(i: Inputs) -> DataFrame:
    (found,) = _fitted(i, SMALL_FAMILY)
    return found.forecasts.select("comb", "segment", "kind", rounded("actual", 2), rounded("forecast", 2))


@query
def gbt_small_importances(i: Inputs) -> DataFrame:
    (found,) = _fitted(i, SMALL_FAMILY)
    return found.importances.select("comb", "feature", rounded("importance"))


@query
def boosted_model_selection(i: Inputs) -> DataFrame:
    """Choice between the moving averages and a boosted family, with the ratio test of the latter."""
    (found,) = _fitted(i, SMALL_FAMILY)
    active = i.classed.filter("segment_class = 'active'")
    scores = i.scores.unionByName(found.scores.select(*i.scores.columns))
    chosen = selection.choose_models(scores, selection.selection_facts(active, CTX))
    return chosen.select("segment", "model", rounded("hd_preds", 4), "actual", "target")


@query
def gbt_cluster_forecast(i: Inputs) -> DataFrame:
    first, second = _fitted(i, boosting.absolute_family(), boosting.squared_family())
    return first.scores.unionByName(second.scores)


@query
def feature_importances(i: Inputs) -> DataFrame:
    (found,) = _fitted(i, boosting.squared_family())
    return found.importances.orderBy("comb", F.desc("importance"), "feature")


@query
def parameter_search_trials(i: Inputs) -> DataFrame:
    (found,) = _fitted(i, boosting.squared_family(budget=SEARCHED))
    return found.trials


# --- allocation to branch plans ---


@query_as("wallet_share")
def wallet_share_table(i: Inputs) -> DataFrame:
    return i.wallet.select("segment", rounded("target"), rounded("soz", 4), "sale_loc", rounded("fact_soz", 9))


def _moved(df: DataFrame, *more: str) -> DataFrame:
    return df.select("segment", "sale_loc", *more, rounded("target", 4))


@query
def stretch_very_low(i: Inputs) -> DataFrame:
    return _moved(stretch.stretch_stage(i.wallet, i.plans, "very_low"), "passed")


@query
def stretch_bands(i: Inputs) -> DataFrame:
    found = None
    for step in stretch.STAGES[1:]:
        part = stretch.stretch_stage(i.wallet, i.plans, step).withColumn("stage", F.lit(step))
        found = part if found is None else found.unionByName(part)
    return _moved(found, "stage", "passed")


@query
def stretch_to_20_own_parameter(i: Inputs) -> DataFrame:
    return _moved(stretch.stretch_stage(i.wallet, i.plans, "to_20", strict_bands=False), "passed")


@query
def stretch_cumulative_bands(i: Inputs) -> DataFrame:
    level = AllocationLevel(level=0, band_step=0.22)
    return _moved(allocation.stretch_upper_bands(i.wallet, i.plans, level), "passed", "stop_band")


@query
def big_client_fill(i: Inputs) -> DataFrame:
    return _moved(stretch.fill_big_clients(i.wallet, i.plans, LEVELS[0]), "passed")


@query
def big_client_finish(i: Inputs) -> DataFrame:
    return _moved(stretch.fill_big_clients(i.wallet, i.plans, LEVELS[0], finish=True), "passed")


@query
def scale_down(i: Inputs) -> DataFrame:
    return _moved(stretch.scale_down(i.wallet, i.plans), "passed")


@query
def quantile_uplift(i: Inputs) -> DataFrame:
    return _moved(allocation.uplift_to_quantiles(i.wallet, i.plans, i.years), "passed", "stop_quantile")


def _allocated(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return allocation.allocate(i.wallet, i.plans, i.years, LEVELS)


@query
def branch_allocation(i: Inputs) -> DataFrame:
    return _moved(_allocated(i)[0], "level", "stage")


@query
def branch_status(i: Inputs) -> DataFrame:
    result, decisions = _allocated(i)
    found = allocation.branch_status(result, decisions)
    return found.select("sale_loc", "level", "stage", "passed", "clients", rounded("total", 3), "plan")


# --- own-brand goods ---


@query
def own_brand_prepare(i: Inputs) -> DataFrame:
    numbers = ["target", "entire_mean", "least", "greatest"]
    return i.own_prepared.select(
        "segment", "sale_loc", *[rounded(c, 4) for c in numbers], rounded("rel", 9)
    )


@query
def own_brand_border_fill(i: Inputs) -> DataFrame:
    return _moved(own.border_fill(i.own_prepared, i.own_plans, CTX.own_brand_border), "stage")


@query
def own_brand_ratchet(i: Inputs) -> DataFrame:
    found = own.ratchet_fill(i.own_prepared, i.own_plans, CTX.own_brand_border, 0.06)
    return _moved(found, "passed", "stop_band")


@query
def own_brand_allocation(i: Inputs) -> DataFrame:
    return _moved(own.allocate_own_brand(i.own_prepared, i.own_plans, CTX)[0], "level", "stage")


@query
def own_brand_status(i: Inputs) -> DataFrame:
    result, decisions = own.allocate_own_brand(i.own_prepared, i.own_plans, CTX)
    found = allocation.branch_status(result, decisions)
    return found.select("sale_loc", "level", "stage", "passed", "clients", rounded("total", 3), "plan")


# --- whole plans ---


@query
def entire_plan_sma(i: Inputs) -> DataFrame:
    return entire_plan(CTX, i.sources, levels=LEVELS).result.select("segment", "sale_loc", rounded("target", 4))


@query
def own_brand_plan_sma(i: Inputs) -> DataFrame:
    plan = own_brand_plan(CTX, i.sources, entire_plan(CTX, i.sources, levels=LEVELS))
    return plan.result.select("segment", "sale_loc", rounded("target", 4))


@query
def entire_plan_result(i: Inputs) -> DataFrame:
    families = [boosting.absolute_family(), boosting.squared_family()]
    return entire_plan(CTX, i.sources, boosted(families), LEVELS).result


@query
def entire_plan_boosted_small(i: Inputs) -> DataFrame:
    plan = entire_plan(CTX, i.sources, boosted([SMALL_FAMILY]), LEVELS)
    return plan.result.select("segment", "sale_loc", rounded("target", 4))


__all__ = ["CTX", "Inputs", "REGISTRY"]
