import contextlib
import io
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from routepulse import schemas
from routepulse.functions.columns import round_even
from routepulse.operators import checks, facts, kpis, outliers
from routepulse.operators.quantiles import exact_quantiles
from routepulse.operators.running import running
from routepulse.session import tune
from routepulse.plans.views import FleetView, wait_outlier_view

T0 = datetime(2025, 3, 3, 8)


def route(route_id, driver="d1", depot="A", window="early", wait=10.0, km=6.0, **more):
    return {
        "route_id": route_id, "vehicle_id": "v", "vehicle_type": "van", "driver_id": driver,
        "depot": depot, "algorithm": "fifo", "dispatch_window": window, "region": "Center",
        "dispatch_planned": T0, "dispatch_actual": T0, "wait_min": wait, "n_stops": 2,
        "route_km": km, "late_rate": 0.5, **more,
    }


def stop(route_id, delay, seq=1, region="Center", lat=52.52, lon=13.405):
    return {
        "route_id": route_id, "stop_seq": seq, "lat": lat, "lon": lon, "region": region,
        "planned_arrival": T0, "actual_arrival": T0 + timedelta(minutes=delay if delay == delay and delay else 0),
        "delay_min": delay, "is_late": True, "service_min": 3.0,
    }


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f] for f in schema.names) for r in rows], schema)


def routes_of(spark, *rows):
    return frame(spark, rows, schemas.ROUTES)


def stops_of(spark, *rows):
    return frame(spark, rows, schemas.STOPS)


@pytest.fixture(scope="module")
def fleet(spark):
    routes = routes_of(
        spark,
        route("r1", "d1", "A", "morning_peak", 10.0),
        route("r2", "d1", "B", "early", 2.0),
        route("r3", "d2", "A", "midday", None),
        route("r4", "d2", "C", "evening", 1.0),
    )
    stops = stops_of(
        spark,
        stop("r1", 20.0, 1), stop("r1", 30.0, 2), stop("r1", 15.0, 3),
        stop("r2", 16.0, 1), stop("r2", None, 2), stop("r3", 40.0), stop("r9", 50.0),
    )
    return routes, stops


# ----------------------------------------------------------------------------- facts


def test_facts_split_the_delay(fleet):
    rows = {
        (r["route_id"], r["stop_seq"]): r for r in facts.build_stop_facts(*fleet).collect()
    }
    flags = ("is_late", "late_without_wait", "late_due_to_wait", "is_peak")
    assert [rows["r1", 1][c] for c in flags] == [True, False, True, True]
    assert [rows["r1", 2][c] for c in flags] == [True, True, False, True]
    assert [rows["r1", 3][c] for c in flags] == [False, False, False, True]  # strictly above 15
    assert [rows["r2", 1][c] for c in flags] == [True, False, True, False]
    assert [rows["r2", 2][c] for c in flags] == [False, False, False, False]  # no delay known
    # Unknown wait or route: nothing is known to be late without the wait.
    assert [rows["r3", 1][c] for c in flags] == [True, False, True, False]
    assert [rows["r9", 1][c] for c in flags] == [True, False, True, False]
    assert rows["r9", 1]["depot"] is None and rows["r1", 1]["transit_delay_min"] == 10.0
    assert len(rows) == 7


def test_threshold_is_the_callers(fleet):
    assert facts.build_stop_facts(*fleet, threshold=30).where("is_late").count() == 2


def test_repeated_route_is_refused(spark, fleet):
    doubled = fleet[0].unionByName(fleet[0].where("route_id = 'r1'"))
    with pytest.raises(ValueError, match="r1"):
        facts.build_stop_facts(doubled, fleet[1])


def test_filters_and_semi_join(fleet):
    routes, stops = fleet
    chosen = facts.filter_rows(routes, depot="A", driver_id="All", algorithm=None)
    assert {r["route_id"] for r in chosen.collect()} == {"r1", "r3"}
    assert facts.stops_of(stops, chosen).count() == 4
    assert [r[0] for r in facts.filter_options(routes, "depot").collect()] == ["A", "B", "C"]


def test_measures_rebuilt_from_timestamps(spark):
    stops = stops_of(spark, stop("r1", 12.5))
    assert facts.delay_from_timestamps(stops).first()["delay_from_times_min"] == 12.5
    routes = routes_of(spark, route("r1", dispatch_actual=T0 + timedelta(seconds=90)))
    assert facts.wait_from_timestamps(routes).first()["wait_from_times_min"] == 1.5


@pytest.mark.parametrize("block", [1, 2, 256])
def test_legs_follow_the_stop_order_across_blocks(spark, block):
    degree = 1 / 111.0
    rows = [stop("r1", 0.0, i, lat=52.0 + i * i * degree) for i in range(6)]
    rows += [rows[3]] * 3  # copies of a visit add no distance
    legs = facts.leg_distances(stops_of(spark, *rows, stop("r2", 0.0)), block).collect()
    got = {(r["route_id"], r["stop_seq"]): r for r in legs}
    assert got["r1", 0]["leg_km"] is None and got["r2", 1]["leg_km"] is None
    for i in range(1, 6):
        assert got["r1", i]["leg_km"] == pytest.approx(1.3 * (2 * i - 1))
    assert got["r1", 3]["copies"] == 4


def test_route_rollup_and_mismatches(spark, fleet):
    rolled = {r["route_id"]: r for r in facts.route_rollup(fleet[1]).collect()}
    assert (rolled["r1"]["n_stops"], rolled["r1"]["route_km"]) == (3, 0.0)
    assert rolled["r1"]["late_rate"] == pytest.approx(2 / 3)
    found = {r["route_id"] for r in facts.route_mismatches(*fleet).collect()}
    assert found == {"r1", "r3", "r4"}  # r2: two stops, one late, as supplied


# ------------------------------------------------------------------------------ KPIs


def test_delay_attribution(fleet):
    table = {r["depot"]: r for r in kpis.delay_attribution(facts.build_stop_facts(*fleet), "depot").collect()}
    assert set(table) == {"A", "B"}  # the stop without a depot is left out
    a = table["A"]
    assert (a["stops"], a["mean_wait_min"], a["mean_transit_delay_min"]) == (4, 10.0, 11.667)
    assert (a["late_rate"], a["late_rate_without_wait"], a["late_due_to_wait_rate"]) == (0.75, 0.25, 0.5)
    assert table["B"]["late_rate"] == 0.5  # an unknown delay counts as on time


def test_rates_long_and_category_order(fleet):
    table = kpis.delay_attribution(facts.build_stop_facts(*fleet), "dispatch_window")
    ordered = kpis.in_category_order(table, "dispatch_window").collect()
    assert [r["dispatch_window"] for r in ordered] == list(schemas.WINDOW_ORDER)
    assert [r["stops"] for r in ordered] == [2, 3, 1, None, None]
    present = kpis.in_category_order(table, "dispatch_window", keep_absent=False).collect()
    assert [r["dispatch_window"] for r in present] == ["early", "morning_peak", "midday"]
    assert kpis.rates_long(table, "dispatch_window").count() == 9


def test_eta_accuracy(spark, fleet):
    flagged = facts.flag_late(fleet[1])
    row = kpis.eta_accuracy(flagged).first()
    errors = pd.Series([20, 30, 15, 16, 40, 50.0])
    assert row["stops"] == 7
    assert row["bias_min"] == round(errors.mean(), 3)
    assert row["p90_abs_error_min"] == errors.quantile(0.9)
    assert row["on_time_rate"] == round(1 - 5 / 7, 3)
    early = stops_of(spark, stop("r1", -8.0), stop("r1", 4.0))
    row = kpis.eta_accuracy(facts.flag_late(early)).first()
    assert (row["bias_min"], row["mae_min"], row["p90_abs_error_min"]) == (-2.0, 6.0, 7.6)
    by = kpis.eta_accuracy(facts.build_stop_facts(*fleet), "depot").collect()
    assert {r["depot"] for r in by} == {"A", "B"}


def test_route_kpis_two_ways(fleet):
    routes, stops = fleet
    one = kpis.route_kpis(facts.build_stop_facts(routes, stops))
    two = kpis.route_kpis_from_tables(routes, stops)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    got = {r["route_id"]: r for r in two.collect()}
    assert (got["r1"]["n_stops"], got["r1"]["km_per_stop"], got["r1"]["max_delay_min"]) == (3, 2.0, 30.0)
    assert got["r9"]["driver_id"] is None and "r4" not in got
    assert [r["route_id"] for r in kpis.worst_routes(two, 2).collect()] == ["r3", "r9"]


def test_driver_scorecard_minimum_in_both_conditions(spark):
    # (driver, peak): late or not, stop by stop
    seen = {
        ("ada", True): [1, 1, 0, 1], ("ada", False): [0, 1, 0, 0, 0],
        ("bo", True): [0, 0], ("bo", False): [1] * 9,
        ("cy", True): [1, 0, 0], ("cy", False): [1, 1, 1],
    }
    rows = [(driver, bool(late), peak) for (driver, peak), stops in seen.items() for late in stops]
    df = spark.createDataFrame(rows, "driver_id string, is_late boolean, is_peak boolean")
    cards = {r["driver_id"]: r for r in kpis.driver_scorecard(df, 3).collect()}
    assert sorted(cards) == ["ada", "cy"]
    assert (cards["ada"]["stops_peak"], cards["ada"]["stops_offpeak"]) == (4, 5)
    assert cards["ada"]["peak_drop"] == pytest.approx(0.75 - 0.2, abs=1e-3)
    assert cards["cy"]["peak_drop"] == pytest.approx(1 / 3 - 1, abs=1e-3)
    assert kpis.excluded_drivers(df, kpis.driver_scorecard(df, 3)).first()["excluded"] == 1
    with pytest.raises(ValueError, match="1 or more"):
        kpis.driver_scorecard(df, 0)


def test_driver_scorecard_two_ways(spark):
    random.seed(2)
    routes = routes_of(
        spark,
        *[route(f"r{i}", f"d{i % 4}", window=schemas.WINDOW_ORDER[i % 5]) for i in range(40)],
    )
    stops = stops_of(spark, *[stop(f"r{i % 40}", random.uniform(0, 30), i) for i in range(400)])
    one = kpis.driver_scorecard(facts.build_stop_facts(routes, stops), 10)
    two = kpis.driver_scorecard_from_tables(routes, stops, 10)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.count() == 4


def test_views(fleet):
    view = FleetView(*fleet, {"depot": "A", "region": "All"})
    view.check()
    row = view.headline().first()
    assert (row["routes"], row["stops"], row["on_time_rate"], row["average_wait_min"]) == (2, 4, 0.25, 10.0)
    assert {r["depot"] for r in view.depot_attribution().collect()} == {"A"}
    assert view.route_kpis.count() == 2
    means = {r[0]: r[1] for r in FleetView(*fleet, {}).window_late_rates().collect()}
    assert means == pytest.approx({"morning_peak": 2 / 3, "early": 0.5, "midday": 1.0})
    (driver,) = FleetView(*fleet, {}).driver_table(1).collect()
    assert (driver["driver_id"], driver["peak_drop_pp"]) == ("d1", pytest.approx(16.7))
    assert FleetView(*fleet, {}).excluded_drivers(1).first()["excluded"] == 1
    with pytest.raises(ValueError, match="matching"):
        FleetView(*fleet, {"depot": "nowhere"}).check()
    with pytest.raises(ValueError, match="stops matching"):
        FleetView(*fleet, {"depot": "C"}).check()


def test_depot_wait(spark):
    waits = [1.0, 2.0, 4.0, 9.0]
    routes = routes_of(
        spark, *[route(f"r{i}", wait=w) for i, w in enumerate(waits)], route("x", depot="B", wait=50.0)
    )
    rows = kpis.depot_wait(routes).collect()
    assert [r["depot"] for r in rows] == ["B", "A"]
    a = rows[1]
    assert (a["routes"], a["mean_wait_min"], a["median_wait_min"], a["p90_wait_min"]) == (4, 4.0, 3.0, 7.5)
    assert a["p90_above_mean_min"] == 3.5


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = [0.0005, 0.0025, 1.0005, 1.0015, -0.0035, 2.6745, 0.12345]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_even(F.col("v"), 3)).collect()]
    assert got == list(np.round(values, 3))


# ------------------------------------------------------------------ quantiles, running


@pytest.mark.parametrize("accuracy, one_task_rows", [(10_000, 10**6), (100, 10**6), (100, 10)])
def test_exact_quantiles_equal_brute_force(spark, accuracy, one_task_rows):
    rng = np.random.default_rng(1)
    values = {
        "spread": rng.lognormal(2, 1.5, 6000),
        "ties": rng.integers(0, 5, 3000).astype(float),
        "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]),
        "same": np.full(2000, 7.0),
        "hot": np.concatenate([np.full(4000, 2.0), rng.normal(0, 1, 2000)]),
    }
    rows = [(g, float(v)) for g, vs in values.items() for v in vs]
    rows += [("one", None), ("one", float("nan")), (None, 1.0)]
    random.seed(1)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    wanted = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q505": 0.505, "q90": 0.9, "q1": 1.0}
    sizes = {"n": ("count", None)}
    got = exact_quantiles(df, "v", wanted, ["g"], sizes, accuracy, 1, one_task_rows).collect()
    assert {r["g"] for r in got} == set(values)
    for row in got:
        assert row["n"] == len(values[row["g"]]) + 2 * (row["g"] == "one")
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values[row["g"]], p), abs=1e-12)
    every = np.concatenate([*values.values(), [1.0]])
    row = exact_quantiles(df, "v", wanted, accuracy=accuracy, one_task_rows=one_task_rows).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(every, p), abs=1e-12)


@pytest.mark.parametrize("ordered", [False, True])
def test_striped_sketches_give_the_same_quantiles(spark, ordered):
    rng = np.random.default_rng(12)
    values = rng.normal(0, 1, 20_000)
    if ordered:  # every stripe sees a different part of the distribution
        values.sort()
    df = spark.createDataFrame([(float(v),) for v in values], "v double").coalesce(8)
    wanted = {"low": 0.1, "mid": 0.5, "high": 0.95}
    row = exact_quantiles(df, "v", wanted, accuracy=1000, stripes=4).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_hot_route_is_split_in_the_facts_join(spark):
    tune(spark)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        stops = spark.range(0, 120_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 'hot', concat('r', id % 997)) AS route_id",
            "id AS stop_seq", "double(hash(id) % 40) AS delay_min",
        )
        routes = routes_of(spark, route("hot"), *[route(f"r{i}") for i in range(997)])
        df = facts.build_stop_facts(routes, stops)
        attribution = kpis.delay_attribution(df, "depot")
        per_route = kpis.route_kpis(df)
        assert attribution.collect()[0]["stops"] == 120_000
        assert {r["route_id"]: r["n_stops"] for r in per_route.collect()}["hot"] == 40_000
        for table in (attribution, per_route):
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                table.explain()
            assert "skew=true" in out.getvalue()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), (None, 1.0)], "g string, v double")
    n = {"n": ("count", None)}
    assert [tuple(r) for r in exact_quantiles(df, "v", {"m": 0.5}, ["g"], n).collect()] == [("a", 1, None)]
    none = df.where("g = 'a'")
    assert [tuple(r) for r in exact_quantiles(none, "v", {"m": 0.5}, (), n).collect()] == [(1, None)]


def test_quantiles_of_more_groups_than_are_broadcast(spark, monkeypatch):
    from routepulse.operators import quantiles

    monkeypatch.setattr(quantiles, "settle", lambda table: (table, False))
    df = spark.range(1000).selectExpr("id % 20 AS g", "double(id) AS v")
    got = {r["g"]: r["m"] for r in exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {g: 490.0 + g for g in range(20)}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_in_blocks_equals_one_window(spark, by):
    rng = np.random.default_rng(4)
    order = np.unique(np.concatenate([rng.lognormal(0, 3, 3000), rng.uniform(0, 1, 3000)]))
    rows = [(i % 2, float(v), int(rng.integers(1, 9)), float(rng.normal())) for i, v in enumerate(order)]
    df = spark.createDataFrame(rows, "g int, o double, n long, x double")
    wanted = {"total": ("sum", "n"), "top": ("max", "x")}
    plain = running(df, "o", wanted, by).orderBy("o").collect()
    blocks = running(df, "o", wanted, by, one_task_rows=10).orderBy("o")
    assert blocks.columns == [*df.columns, "total", "top"] or set(blocks.columns) == {*df.columns, "total", "top"}
    assert [(r["o"], r["total"], r["top"]) for r in blocks.collect()] == [
        (r["o"], r["total"], r["top"]) for r in plain
    ]


def test_a_row_finds_its_block_by_halving(spark):
    # some thousands of blocks, groups of unlike size, one of them without a key
    rows = [(g, float(v)) for g, n in ((None, 4000), ("a", 900), ("b", 1)) for v in range(n)]
    df = spark.createDataFrame(rows, "g string, o double").withColumn("n", F.lit(1))
    got = running(df, "o", {"total": ("sum", "n")}, ["g"], one_task_rows=2)
    assert [r for r in got.collect() if r["total"] != r["o"] + 1] == []
    assert got.count() == len(rows)
    # no row looks through all cuts of its group
    assert "lambda" not in got._jdf.queryExecution().toString()


# -------------------------------------------------------------------------- outliers


def pandas_iqr(s, k=1.5):
    q1, q3 = s.quantile([0.25, 0.75])
    return (s < q1 - k * (q3 - q1)) | (s > q3 + k * (q3 - q1))


def pandas_z(s, threshold=3.0):
    std = s.std(ddof=0)
    return ((s - s.mean()) / std).abs() > threshold if std > 0 else s != s


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame(
        {
            "id": range(400),
            "g": ["a"] * 300 + ["b"] * 100,
            "v": np.concatenate([rng.lognormal(1, 1, 300), rng.lognormal(3, 0.2, 100)]),
        }
    )
    return data, spark.createDataFrame(data)


def flags(df):
    return [r["is_outlier"] for r in df.orderBy("id").collect()]


def test_global_flags(skewed):
    data, df = skewed
    assert flags(outliers.flag_outliers_iqr(df, "v")) == list(pandas_iqr(data.v))
    assert flags(outliers.flag_outliers_iqr(df, "v", k=0.5)) == list(pandas_iqr(data.v, 0.5))
    assert flags(outliers.flag_outliers_zscore(df, "v", 2.0)) == list(pandas_z(data.v, 2.0))
    low, high = outliers.iqr_bounds(df, "v").first()
    q1, q3 = data.v.quantile([0.25, 0.75])
    assert (low, high) == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))


@pytest.mark.parametrize("method, reference", [("iqr", pandas_iqr), ("zscore", pandas_z)])
def test_group_flags_differ_from_global_ones(skewed, method, reference):
    data, df = skewed
    expected = data.groupby("g").v.transform(reference)
    assert flags(outliers.flag_outliers_by_group(df, "v", "g", method)) == list(expected)


def test_flags_of_constant_missing_and_ungrouped_values(spark):
    rows = [(0, "a", 5.0), (1, "a", 5.0), (2, "a", None), (3, None, 9.0)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    same = df.where("g = 'a'")
    assert flags(outliers.flag_outliers_zscore(same, "v")) == [False] * 3
    assert flags(outliers.flag_outliers_iqr(same, "v")) == [False] * 3
    assert flags(outliers.flag_outliers_by_group(df, "v", "g")) == [False] * 3 + [None]
    assert flags(outliers.flag_outliers_by_group(df, "v", "g", "zscore")) == [False] * 3 + [None]
    with pytest.raises(ValueError, match="method"):
        outliers.flag_outliers_by_group(df, "v", "g", "guess")


def test_wait_outlier_view(spark):
    rng = np.random.default_rng(3)
    waits = np.concatenate([rng.normal(10, 1, 60), [60.0, 61.0], rng.normal(30, 1, 30), [33.9]])
    depots = ["A"] * 62 + ["B"] * 31
    routes = routes_of(
        spark, *[route(f"r{i:03d}", depot=d, wait=float(w)) for i, (d, w) in enumerate(zip(depots, waits))]
    )
    summary, longest = wait_outlier_view(routes, 3)
    data = pd.DataFrame({"depot": depots, "w": waits})
    rows = {r["depot"]: r for r in summary.collect()}
    for depot, own in data.groupby("depot"):
        assert rows[depot]["global_iqr_outliers"] == pandas_iqr(data.w)[own.index].sum()
        assert rows[depot]["global_zscore_outliers"] == pandas_z(data.w)[own.index].sum()
        assert rows[depot]["within_depot_iqr_outliers"] == pandas_iqr(own.w).sum()
        assert rows[depot]["p90_wait_min"] == round(own.w.quantile(0.9), 2)
    assert [r["wait_min"] for r in longest.collect()] == sorted(data.w[pandas_iqr(data.w)], reverse=True)[:3]
    with pytest.raises(ValueError, match="must be known"):
        wait_outlier_view(routes_of(spark, route("r1", wait=None)))


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("j", 5, "c")], "id string, n int, s string")
    got = outliers.first_per_key(df, "id", ["n", "s"])
    assert sorted(map(tuple, got.collect())) == [("j", 5, "c"), ("k", 1, "z")]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "k string, v double")
    with pytest.raises(ValueError, match="more than once"):
        checks.check_unique(df, "k")
    with pytest.raises(ValueError, match="must be known"):
        checks.check_no_missing(df, "v")
    with pytest.raises(ValueError, match=r"\['w', 'x'\]"):
        checks.check_columns(df, ["x", "k", "w"], "this")
    checks.check_unique(df.limit(1), "k")
    checks.check_no_missing(df.limit(0), "v")


# ------------------------------------------------------------- missing values, repeated keys


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_nan_is_a_missing_value_for_outlier_flags(spark, method):
    values = [float(i % 7) for i in range(40)] + [500.0]
    rows = [("g", v) for v in values]
    flagged = {}
    for name, extra in (("clean", []), ("dirty", [("g", float("nan")), ("g", None), (None, 3.0)])):
        df = spark.createDataFrame(rows + extra, "g string, v double")
        alone = outliers.flag_outliers_iqr(df.where("g = 'g'"), "v") if method == "iqr" else outliers.flag_outliers_zscore(df.where("g = 'g'"), "v")
        grouped = outliers.flag_outliers_by_group(df, "v", "g", method)
        for part, out in (("alone", alone), ("grouped", grouped)):
            flagged[name, part] = sorted(str(r["v"]) for r in out.where("is_outlier").collect())
        missing = grouped.where("g IS NULL").collect()
        assert all(r["is_outlier"] is None for r in missing)
    assert set(map(tuple, flagged.values())) == {("500.0",)}


def test_nan_delays_are_neither_late_nor_part_of_means(spark):
    routes = routes_of(spark, route("r1", "d1"), route("r2", "d1"))
    stops = stops_of(spark, stop("r1", 20.0, 1), stop("r1", float("nan"), 2), stop("r1", 10.0, 3), stop("r2", float("nan"), 1))
    by_stop = {(r["route_id"], r["stop_seq"]): r for r in facts.build_stop_facts(routes, stops).collect()}
    assert [by_stop["r1", n]["is_late"] for n in (1, 2, 3)] == [True, False, False]
    assert by_stop["r1", 2]["transit_delay_min"] is None and not by_stop["r1", 2]["late_due_to_wait"]
    for table in (kpis.route_kpis(facts.build_stop_facts(routes, stops)), kpis.route_kpis_from_tables(routes, stops)):
        got = {r["route_id"]: r for r in table.collect()}
        assert (got["r1"]["mean_delay_min"], got["r1"]["max_delay_min"]) == (15.0, 20.0)
        assert got["r2"]["mean_delay_min"] is None
    assert kpis.eta_accuracy(facts.flag_late(stops)).first()["mae_min"] == 15.0


@pytest.mark.parametrize(
    "member",
    ["headline", "depot_attribution", "depot_attribution_long", "window_attribution", "window_late_rates", "worst_routes", "driver_table", "excluded_drivers"],
)
def test_views_refuse_a_repeated_route(spark, member):
    routes = routes_of(spark, route("r1", "d1"), route("r2", "d1"), route("r1", "d2"))
    stops = stops_of(spark, stop("r1", 20.0, 1), stop("r2", 1.0, 1))
    with pytest.raises(ValueError, match="more than once.*r1"):
        getattr(FleetView(routes, stops, {}), member)()


@pytest.mark.parametrize("stripes", [1, 3, 64])
def test_quantiles_and_aggregates_in_stripes(spark, stripes):
    random.seed(stripes)
    values = [(i % 3, random.gauss(50, 9) if i % 11 else None) for i in range(6000)]
    df = spark.createDataFrame(values, "g int, v double").repartition(40)
    wanted = {"n": ("count", None), "mean": ("avg", F.col("v")), "total": ("sum", F.col("v")), "dev": ("std", F.col("v"))}
    rows = exact_quantiles(df, "v", {"q1": 0.25, "p90": 0.9}, ["g"], wanted, accuracy=500, stripes=stripes).collect()
    frame = pd.DataFrame(values, columns=["g", "v"])
    for r in rows:
        own = frame[frame["g"] == r["g"]]["v"]
        assert (r["n"], r["total"]) == (len(own), pytest.approx(own.sum()))
        assert (r["mean"], r["dev"]) == (pytest.approx(own.mean()), pytest.approx(own.std(ddof=0)))
        assert (r["q1"], r["p90"]) == (pytest.approx(own.quantile(0.25)), pytest.approx(own.quantile(0.9)))


def test_a_bracket_that_misses_is_widened(spark):
    df = spark.range(50_000).select(F.col("id").cast("double").alias("v"))
    row = exact_quantiles(df, "v", {"m": 0.5, "p99": 0.99}, accuracy=50, margin=1e-9).first()
    assert (row["m"], row["p99"]) == (24999.5, pytest.approx(49499.01))


def test_legs_of_visits_without_a_sequence_number(spark):
    at = [(52.50, 13.4), (52.51, 13.4), (52.53, 13.4)]
    stops = stops_of(spark, stop("r1", 1.0, None, lat=at[0][0], lon=at[0][1]), stop("r1", 1.0, 1, lat=at[1][0], lon=at[1][1]), stop("r1", 1.0, 300, lat=at[2][0], lon=at[2][1]))
    legs = {r["stop_seq"]: r["leg_km"] for r in facts.leg_distances(stops).collect()}
    assert legs[None] is None
    assert (legs[1], legs[300]) == (pytest.approx(1.3 * 1.11), pytest.approx(1.3 * 2.22))


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_weighted_quantiles_equal_those_of_repeated_rows(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [(rng.choice("abc"), rng.choice([float(rng.randint(0, 300)), None, float("nan")]) if i % 9 == 0 else rng.uniform(0, 50), rng.choice([1, 1, 2, 3, 400])) for i in range(3_000)]
    rows += [("a", 7.0, 0), ("b", 7.0, None), (None, 1.0, 5), ("none", None, 3)]
    df = spark.createDataFrame(rows, "g string, v double, w long").repartition(5)
    wanted = {"q1": 0.25, "p90": 0.9, "last": 1.0}
    got = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, "v", wanted, ["g"], accuracy=accuracy, weight="w").collect()}
    for group in "abc":
        values = [v for g, v, w in rows if g == group and v is not None and not math.isnan(v) for _ in range(w or 0)]
        assert got[group] == pytest.approx(tuple(np.quantile(values, p) for p in wanted.values()), abs=1e-9)
    assert got["none"] == (None, None, None) and set(got) == {"a", "b", "c", "none"}
    whole = exact_quantiles(df.where("g IS NOT NULL"), "v", {"m": 0.5}, accuracy=accuracy, weight="w").first()
    values = [v for g, v, w in rows if g and v is not None and not math.isnan(v) for _ in range(w or 0)]
    assert whole.m == pytest.approx(np.quantile(values, 0.5), abs=1e-9)
    with pytest.raises(ValueError, match="weighted"):
        exact_quantiles(df, "v", wanted, ["g"], {"n": ("count", None)}, weight="w")
