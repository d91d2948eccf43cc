import random

import pytest

from salesloom.context import AllocationLevel, PlanContext, entire_levels, own_brand_steps
from salesloom.operators.allocation import allocate, branch_status, client_quantiles, client_year, with_retries
from salesloom.operators.own_brand import allocate_own_brand, ratchet_fill
from salesloom.operators.stretch import fill_big_clients, scale_down, stretch_stage
from salesloom.session import stage
from tests import brute

CTX = PlanContext.from_month("2023-10-01")
WALLET = "segment bigint, target double, soz double, sale_loc string, fact_soz double"
PLANS = "sale_loc string, plan_value double"
YEARS = "segment bigint, ordered array<double>"


def make_branches(seed, count, clients=40):
    """Random branches with plans spread over the ladder's paths."""
    rng = random.Random(seed)
    wallet, plans, years = [], [], {}
    segment = 0
    for b in range(count):
        name, rows = f"branch_{b}", []
        top = rng.choice([0.008, 0.04, 0.09, 0.2, 0.3, 0.9])
        for _ in range(clients):
            segment += 1
            kind = rng.random()
            if kind < 0.1:
                rows.append((segment, 0.0, 0.0))
            elif kind < 0.2:
                rows.append((segment, 30000.0, 30000.0))
            else:
                soz = rng.uniform(1e5, 5e7)
                rows.append((segment, round(soz * rng.uniform(0.0001, top), 2), soz))
            if rng.random() < 0.8:
                months = rng.randint(1, 12)
                years[segment] = [float(rng.randint(-100, 6_000_000)) for _ in range(months)]
        total = sum(r[1] for r in rows)
        plan = round(total * rng.choice([0.5, 0.99, 1.0005, 1.01, 1.04, 1.1, 1.3, 2, 3, 4, 6, 9, 15, 60]), 0)
        wallet += [(s, t, z, name, brute.share(t, z)) for s, t, z in rows]
        plans.append((name, plan))
    return wallet, plans, years


def padded(years):
    return [(s, sorted(v + [0.0] * (13 - len(v)))) for s, v in years.items()]


def frames(spark, wallet, plans, years):
    return (
        stage(spark.createDataFrame(wallet, WALLET), "w"),
        stage(spark.createDataFrame(plans, PLANS), "p"),
        stage(spark.createDataFrame(padded(years), YEARS), "y"),
    )


def expected(wallet, plans, years, levels):
    found, stages = {}, {}
    for name, plan in plans:
        rows = [(s, t, z) for s, t, z, loc, _ in wallet if loc == name]
        level, step, targets = brute.allocate_branch(rows, plan, levels, years)
        stages[name] = (level, step)
        found |= {r[0]: x for r, x in zip(rows, targets)}
    return found, stages


def test_ladder_equals_row_by_row_loop(spark):
    wallet, plans, years = make_branches(17, 60)
    want, stages = expected(wallet, plans, years, entire_levels())
    result, decisions = allocate(*frames(spark, wallet, plans, years))
    rows = result.collect()
    assert {r["sale_loc"]: (r["level"], r["stage"]) for r in rows} == stages
    assert len(rows) == len(wallet)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["segment"]], rel=1e-9, abs=1e-5)
    # the random branches reach every kind of outcome
    assert {s for _, s in stages.values()} == {
        *("big_init", "scale", "very_low", "to_5", "to_10", "to_15", "to_25", "bands"),
        *("big_finish", "quantile", "big_last", "failed"),
    }
    assert any(level > 0 for level, step in stages.values() if step != "failed")
    for row in branch_status(result, decisions).collect():
        exact = row["stage"] not in ("failed", "big_finish", "big_last")
        if exact:
            assert row["passed"]
            assert row["total"] == pytest.approx(row["plan"], rel=1e-9)


def one_branch(spark, rows, plan, years=None):
    wallet = [(s, t, z, "b", brute.share(t, z)) for s, t, z in rows]
    return frames(spark, wallet, [("b", plan)], years or {0: [0.0]})


CASES = [
    # a small gap goes to clients above five million
    ("big_init", [(1, 6e6, 1e8), (2, 1e6, 1e8)], 8e6),
    ("very_low", [(1, 1e6, 1e9), (2, 2e6, 1e9)], 3.2e6),
    ("scale", [(1, 1e6, 1e8), (2, 2e6, 1e8)], 1e6),
    ("to_5", [(1, 1e6, 4e7), (2, 0.0, 0.0)], 3e6),
    ("to_10", [(1, 1e6, 1.25e7), (2, 30000.0, 30000.0)], 1.5e6),
    ("to_15", [(1, 1e6, 8e6)], 1.5e6),
    ("to_25", [(1, 1e6, 6e6)], 1.3e6),
    ("bands", [(1, 1e6, 3.8e6)], 1.1e6),
    ("big_finish", [(1, 9e6, 1.6e7)], 1.13e7),
    ("quantile", [(1, 3e6, 1e7)], 6e6),
]


def test_single_branch_stages(spark):
    levels = entire_levels()[:1]
    wallet, plans, years, want = [], [], {}, {}
    for k, (name, rows, plan) in enumerate(CASES):
        rows = [(100 * k + s, t, z) for s, t, z in rows]
        own = {100 * k + 1: [7e6] * 12} if name == "quantile" else {}
        step, targets = brute.one_attempt(rows, plan, levels[0], own)
        assert step == name
        want |= {r[0]: (name, x) for r, x in zip(rows, targets)}
        wallet += [(s, t, z, f"b{k}", brute.share(t, z)) for s, t, z in rows]
        plans.append((f"b{k}", plan))
        years |= own
    result, _ = allocate(*frames(spark, wallet, plans, years), levels=levels)
    found = {r["segment"]: r for r in result.collect()}
    assert found.keys() == want.keys()
    for segment, (name, target) in want.items():
        assert found[segment]["stage"] == name
        assert found[segment]["target"] == pytest.approx(target, rel=1e-12)


def test_clients_without_plan_keep_their_forecast(spark):
    wallet, plans, years = make_branches(3, 3, clients=5)
    wallet += [(900, 5e5, 1e6, None, 0.5), (901, 4e5, 1e6, "unknown", 0.4)]
    result, decisions = allocate(*frames(spark, wallet, plans, years))
    left = {r["segment"]: r for r in result.filter("stage = 'no_plan'").collect()}
    assert {s: r["target"] for s, r in left.items()} == {900: 5e5, 901: 4e5}
    status = {r["sale_loc"]: r for r in branch_status(result, decisions).collect()}
    assert not status["unknown"]["passed"] and status["unknown"]["plan"] is None
    assert None in status


def test_zero_targets_stay_zero(spark):
    wallet, plans, years = make_branches(11, 20)
    result, _ = allocate(*frames(spark, wallet, plans, years))
    zero = {w[0] for w in wallet if w[1] == 0.0}
    assert all(r["target"] == 0.0 for r in result.collect() if r["segment"] in zero)


def test_same_result_for_other_partitionings(spark):
    wallet, plans, years = make_branches(5, 12)

    def run(parts, seed):
        random.Random(seed).shuffle(wallet)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            w, p, y = frames(spark, wallet, plans, years)
            rows = allocate(w.repartition(parts), p, y)[0].collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return {r["segment"]: (r["stage"], r["level"], r["target"]) for r in rows}

    assert run(1, 1) == run(4, 2) == run(50, 3)


def test_single_stage_operators(spark):
    level = AllocationLevel(level=0)
    # exactly on band edges: .01, .05, .1, .15, .2, .25 belong to the upper band
    shares = [0.0, 0.005, 0.01, 0.03, 0.05, 0.08, 0.1, 0.12, 0.15, 0.17, 0.2, 0.22, 0.25, 0.6]
    rows = [(k, s * 1e6, 1e6) for k, s in enumerate(shares)]
    w, _, _ = one_branch(spark, rows, 1.0)
    for step in brute.STEPS:
        raised = [brute.share_after(brute.share(t, z), step, level) * z for _, t, z in rows]
        base = [t for _, t, _ in rows]
        plan = (sum(base) + sum(raised)) / 2
        p = spark.createDataFrame([("b", plan)], PLANS)
        found = {r["segment"]: r for r in stretch_stage(w, p, step, level).collect()}
        want = brute.pull(base, raised, plan)
        assert all(r["passed"] for r in found.values())
        assert [found[k]["target"] for k, _, _ in rows] == pytest.approx(want, rel=1e-12)
        p = spark.createDataFrame([("b", sum(raised) + 1)], PLANS)
        found = {r["segment"]: r for r in stretch_stage(w, p, step, level).collect()}
        assert [found[k]["target"] for k, _, _ in rows] == base and not found[0]["passed"]


def test_own_parameter_of_the_fifth_stage(spark):
    w, p, _ = one_branch(spark, [(1, 1.7e5, 1e6)], 2.4e5)
    assert not stretch_stage(w, p, "to_20").first()["passed"]
    assert stretch_stage(w, p, "to_20", strict_bands=False).first()["target"] == pytest.approx(2.4e5)


def test_big_client_fill_borders(spark):
    rows = [(1, 6e6, 1e8), (2, 5e6, 1e8), (3, 1e6, 1e6)]
    total = 12e6
    for gap, passes in ((0.0, False), (6e6 * 0.23, True), (6e6 * 0.24, False), (-1.0, False)):
        w, p, _ = one_branch(spark, rows, total + gap)
        found = {r["segment"]: r for r in fill_big_clients(w, p).collect()}
        assert found[1]["passed"] is passes
        assert found[1]["target"] == pytest.approx(6e6 + (gap if passes else 0))
        assert found[2]["target"] == 5e6
    w, p, _ = one_branch(spark, [(1, 1e6, 1e7)], 1.1e6)
    assert not fill_big_clients(w, p).first()["passed"]
    # at the finish the gap is measured against the plan; without big clients nothing moves
    found = fill_big_clients(w, p, finish=True).first()
    assert found["passed"] and found["target"] == 1e6
    assert scale_down(w, spark.createDataFrame([("b", 5e5)], PLANS)).first()["target"] == pytest.approx(5e5)


def test_client_year_pads_with_zero_and_matches_percentile(spark):
    rng = random.Random(2)
    rows = []
    for s in range(30):
        for m in rng.sample(range(1, 13), rng.randint(1, 12)):
            rows.append((s, f"{2022 + (m + 8) // 12}-{(m + 8) % 12 + 1:02d}-01", rng.randint(-500, 90000)))
    panel = spark.createDataFrame(rows, "segment bigint, month string, target bigint").selectExpr(
        "segment", "date(month) as month", "target"
    )
    found = {(r["segment"], r["q"]): r["quantile"] for r in client_quantiles(client_year(panel, CTX)).collect()}
    assert len(found) == 30 * 50
    for s in range(30):
        values = [float(t) for k, m, t in rows if k == s and "2022-10-01" <= m <= "2023-10-01"]
        for q in (30, 50, 79):
            assert found[s, q] == pytest.approx(brute.quantile(values, q / 100), rel=1e-12, abs=1e-9)


def make_own(seed, count):
    rng = random.Random(seed)
    rows, plans, segment = [], [], 0
    for b in range(count):
        total = 0.0
        for _ in range(30):
            segment += 1
            t = rng.choice([0.0, 500.0, rng.uniform(1, 400), rng.uniform(501, 90000)])
            rel = rng.choice([0.0, rng.uniform(0, 0.05), rng.uniform(0.03, 0.9), 1.0, 0.0355, 0.07])
            mean = 0.0 if rng.random() < 0.1 else t / rel if rel else rng.uniform(0, 1e6)
            rows.append((segment, t, f"o{b}", mean, rel, 0.0, t * rng.uniform(1, 6)))
            total += t
        plans.append((f"o{b}", round(total * rng.choice([0.8, 1.02, 1.2, 1.5, 2, 3, 5, 8]), 0)))
    return rows, plans


OWN = "segment bigint, target double, sale_loc string, entire_mean double, rel double, least double, greatest double"


def own_dicts(rows, name):
    keys = ("segment", "target", "sale_loc", "entire_mean", "rel", "least", "greatest")
    return [dict(zip(keys, r)) for r in rows if r[2] == name]


def test_own_brand_equals_row_by_row_loop(spark):
    rows, plans = make_own(4, 40)
    result, decisions = allocate_own_brand(
        stage(spark.createDataFrame(rows, OWN), "o"), spark.createDataFrame(plans, PLANS), CTX
    )
    found = {r["segment"]: r for r in result.collect()}
    assert len(found) == len(rows)
    seen = set()
    for name, plan in plans:
        branch = own_dicts(rows, name)
        for level, step in enumerate(own_brand_steps()):
            kind, band, want = brute.own_attempt(branch, plan, step)
            if kind != "failed":
                break
        seen.add(kind)
        for row, target in zip(branch, want):
            r = found[row["segment"]]
            assert (r["stage"], r["level"]) == (kind, level)
            assert r["target"] == pytest.approx(target, rel=1e-9, abs=1e-6)
    assert seen == {"scale", "border", "ratchet", "failed"}


@pytest.mark.parametrize("step", [0.015, 0.04, 0.12])
def test_ratchet_chain_of_moves(spark, step):
    # one client that may move several times, one that never moves, one in the skipped gap
    rows = [(1, 40000.0, "o", 1e6, 0.0355, 0.0, 1e9), (2, 500.0, "o", 5000.0, 0.1, 0.0, 1e9), (3, 900.0, "o", 29700.0, 0.0305, 0.0, 1e9)]
    prepared = spark.createDataFrame(rows, OWN)
    for plan in (4.3e4, 2e5, 6e5, 2e6):
        kind, band, want = brute.own_attempt(own_dicts(rows, "o"), plan, step)
        assert kind in ("ratchet", "failed")
        found = {r["segment"]: r for r in ratchet_fill(prepared, spark.createDataFrame([("o", plan)], PLANS), 0.03, step).collect()}
        assert found[1]["stop_band"] == band
        assert [found[k]["target"] for k in (1, 2, 3)] == pytest.approx(want, rel=1e-12)


def test_retries_see_only_branches_left_open(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "sale_loc string, x int")
    decided = "sale_loc string, level int, stage string"
    first = spark.createDataFrame([("a", 0, "scale"), ("b", 0, "failed"), ("c", 0, "to_5")], decided)
    seen = []

    def retry(left):
        seen.append(sorted(r["x"] for r in left.collect()))
        return spark.createDataFrame([("b", 3, "bands")], decided)

    out = {r["sale_loc"]: (r["level"], r["stage"]) for r in with_retries(rows, first, retry).collect()}
    assert seen == [[2, 3]] and out == {"a": (0, "scale"), "b": (3, "bands"), "c": (0, "to_5")}
    done = first.filter("stage <> 'failed'")
    assert with_retries(rows, done, retry) is done and len(seen) == 1
