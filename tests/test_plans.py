import pytest

from salesloom.context import PlanContext
from salesloom.operators.boosting import squared_family
from salesloom.operators.panel import monthly_both, monthly_own_brand, monthly_shipments, own_months
from salesloom.operators.tuning import TreeParams
from salesloom.plans import entire_plan, own_brand_plan
from salesloom.plans.entire import boosted
from salesloom.plans.job import parse, run
from salesloom.plans.panels import cards_of, load_months
from salesloom.sources import SCHEMAS, fixtures
from salesloom.sources.loaders import marked_lines, own_brand_lines, shipment_lines
from tests.conftest import DATA

CTX = fixtures.FIXTURE_CONTEXT


@pytest.fixture(scope="module")
def both(spark):
    sources = fixtures.fixture_sources(spark, DATA)
    entire = entire_plan(CTX, sources)
    return entire, own_brand_plan(CTX, sources, entire)


def test_one_row_per_client(both):
    for plan in both:
        assert plan.result.columns == ["segment", "target", "sale_loc"]
        assert plan.result.count() == plan.result.select("segment").distinct().count()
        assert plan.result.filter("target is null").isEmpty()
    entire, own = both
    assert entire.result.count() == entire.panel.select("segment").distinct().count()
    assert own.result.count() == entire.result.count()


def test_passed_branches_meet_their_plan(both):
    for plan in both:
        for row in plan.status.collect():
            if row["passed"] and row["stage"] not in ("big_finish", "big_last"):
                assert row["total"] == pytest.approx(row["plan"], rel=1e-9)


def test_boosted_plan_covers_the_same_clients(spark, both):
    sources = fixtures.fixture_sources(spark, DATA)
    families = boosted([squared_family(TreeParams(trees=1, depth=1))])
    plan = entire_plan(CTX, sources, families)
    assert plan.result.select("segment").subtract(both[0].result.select("segment")).isEmpty()
    assert plan.result.count() == both[0].result.count()


def test_job_writes_its_tables(spark, tmp_path):
    sources = fixtures.fixture_sources(spark, DATA)
    for name in SCHEMAS:
        getattr(sources, name).write.parquet(str(tmp_path / "in" / name))
    out = tmp_path / "out"
    run(parse(["--input", str(tmp_path / "in"), "--output", str(out), "--plan-month", "2001-08-01",
               "--history-start", "1995-01-01", "--models", "sma"]))
    for name in ("res_entire", "forecast_entire", "res_own_brand", "forecast_own_brand", "models_entire", "model_mix", "score_summary"):
        written = spark.read.option("header", "true").csv(str(out / name))
        assert written.count() > 0 and {"segment", "model", "mean_score"} & set(written.columns)


def test_context_is_the_fixture_month():
    assert CTX == PlanContext.from_month("2001-08-01", history_start=CTX.history_start)


def test_lines_are_scanned_once(spark):
    sources = fixtures.fixture_sources(spark, DATA)
    months = load_months(sources, CTX, cards_of(sources, CTX), averages=True)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")

    assert scans(months) == scans(sources.shipments) > 0


def test_both_panels_from_one_pass_equal_the_separate_ones(spark):
    sources = fixtures.fixture_sources(spark, DATA)
    months = monthly_both(marked_lines(sources.shipments, sources.products, CTX)).cache()
    entire = monthly_shipments(shipment_lines(sources.shipments, CTX)).select("segment", "month", "target")
    own = monthly_own_brand(own_brand_lines(sources.shipments, sources.products, CTX))
    for one, two in ((months.select("segment", "month", "target"), entire), (own_months(months), own)):
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not two.isEmpty()
