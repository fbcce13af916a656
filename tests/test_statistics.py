import itertools
import math
import random
import time
import tracemalloc
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from routepulse.operators import gee, ranktests
from routepulse.operators.gee import CATEGORIES, MEASURES, driver_clustered_gee
from routepulse.schemas import WINDOW_ORDER

# ------------------------------------------------------------------------ rank tests


def samples(spark, groups):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    random.seed(0)
    random.shuffle(rows)
    rows.append(("ignored", 1.0))
    rows.append((next(iter(groups)), None))
    return spark.createDataFrame(rows, "g string, v double")


def u_statistic(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def asymptotic_p(a, b):
    pooled = pd.Series([*a, *b])
    n1, n2, n = len(a), len(b), len(pooled)
    ties = sum(c**3 - c for c in pooled.value_counts())
    sigma = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    u = u_statistic(a, b)
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma
    return min(1.0, math.erfc(z / math.sqrt(2)))


def kruskal_h(groups):
    pooled = pd.Series(np.concatenate(groups))
    ranks, n, start, total = pooled.rank().to_numpy(), len(pooled), 0, 0.0
    for g in groups:
        total += ranks[start : start + len(g)].sum() ** 2 / len(g)
        start += len(g)
    ties = sum(c**3 - c for c in pooled.value_counts())
    return (12 / (n * (n + 1)) * total - 3 * (n + 1)) / (1 - ties / (n**3 - n))


@pytest.mark.parametrize("one_task_rows", [10**6, 5])
def test_mann_whitney_with_ties(spark, one_task_rows):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 12, 40) / 12, rng.integers(2, 14, 55) / 12
    df = samples(spark, {"fifo": a, "cluster_nn": b})
    row = ranktests.mann_whitney(df, "v", "g", one_task_rows=one_task_rows).first()
    assert row["statistic"] == u_statistic(a, b)
    assert row["p_value"] == pytest.approx(asymptotic_p(a, b), rel=1e-9)
    assert (row["n_first"], row["n_second"], row["method"]) == (40, 55, "asymptotic")
    assert row["mean_difference_second_minus_first"] == pytest.approx(b.mean() - a.mean())


def test_small_samples_without_ties_are_exact(spark):
    a, b = [1.0, 2.5, 7.0], [3.0, 4.0, 5.0, 6.0, 9.0]
    row = ranktests.mann_whitney(samples(spark, {"fifo": a, "cluster_nn": b}), "v", "g").first()
    pooled = sorted(a + b)
    u = u_statistic(a, b)
    far = max(u, 15 - u)
    all_u = [
        u_statistic([pooled[i] for i in pick], [pooled[i] for i in range(8) if i not in pick])
        for pick in itertools.combinations(range(8), 3)
    ]
    assert row["method"] == "exact"
    assert row["p_value"] == pytest.approx(min(1.0, 2 * np.mean([x >= far for x in all_u])))
    assert ranktests.exact_mann_whitney_p(8, 8, 32.0) == 1.0


def test_exact_however_large_the_other_sample(spark):
    few, many = [0.5, 700.25, 90000.75], list(range(60_000))
    row = ranktests.mann_whitney(samples(spark, {"fifo": few, "cluster_nn": [float(x) for x in many]}), "v", "g").first()
    assert row["method"] == "exact"
    assert 0 < row["p_value"] < 1
    small = ranktests.exact_mann_whitney_p(3, 40, 25.0)
    places = list(itertools.combinations(range(43), 3))
    below = sum(sum(p) - 3 <= 25 for p in places)
    assert small == pytest.approx(min(1.0, 2 * below / len(places)))


def test_exact_tail_equals_counted_orders():
    for n1, n2 in [(1, 1), (1, 9), (2, 7), (4, 6), (8, 5), (5, 11), (8, 8)]:
        orders = [sum(p) - n1 * (n1 - 1) // 2 for p in itertools.combinations(range(n1 + n2), n1)]
        for u in range(n1 * n2 + 1):
            far = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= far for x in orders) / len(orders))
            assert ranktests.exact_mann_whitney_p(n1, n2, float(u)) == want


def test_exact_tail_needs_no_room_for_the_larger_sample():
    tracemalloc.start()
    start = time.perf_counter()
    p = [ranktests.exact_mann_whitney_p(8, 10**8, u) for u in (0.0, 1e8, 3.9e8, 4e8)]
    assert time.perf_counter() - start < 1 and tracemalloc.get_traced_memory()[1] < 10**8
    tracemalloc.stop()
    assert 0 < p[0] < 1e-50 and p == sorted(p) and p[3] > 0.999
    # so large samples are close to eight draws from a uniform distribution
    assert p[1] == pytest.approx(2 / math.factorial(8), rel=1e-5)


def test_missing_values_are_left_out_of_rank_tests(spark):
    a, b = [1.0, 2.5, 7.0, 8.0], [3.0, 4.0, 5.0, 6.0, 9.0]
    clean = samples(spark, {"fifo": a, "cluster_nn": b})
    dirty = samples(spark, {"fifo": [*a, math.nan], "cluster_nn": [math.nan, *b]})
    dirty = dirty.unionByName(dirty.limit(3).withColumn("v", F.lit(None).cast("double")))
    for test in (ranktests.mann_whitney, ranktests.pairwise_tests):
        groups = {"groups": ("fifo", "cluster_nn")}
        one, two = (test(df, "v", "g", **groups).collect() for df in (clean, dirty))
        assert one == two
    one, two = (ranktests.kruskal_wallis(df, "v", "g", ("fifo", "cluster_nn")).first() for df in (clean, dirty))
    assert one == two


@pytest.mark.parametrize("one_task_rows", [10**6, 4])
def test_holm_of_rows_without_a_family(spark, one_task_rows):
    ps = [0.01, 0.02, 0.03, 0.04, 0.05, 0.05]
    rows = [(None, i, p) for i, p in enumerate(ps)] + [("x", i, p / 2) for i, p in enumerate(ps)]
    rows += [(None, 90, None), (None, 91, math.nan), ("x", 92, math.nan)]
    df = spark.createDataFrame(rows, "family string, i int, p double")
    got = {(r["family"], r["i"]): r["h"] for r in ranktests.holm_adjust(df, "p", ["family"], "h", one_task_rows).collect()}
    assert len(got) == len(rows)
    for i, h in enumerate(holm(ps)):
        assert got[None, i] == pytest.approx(h)
    for i, h in enumerate(holm([p / 2 for p in ps])):
        assert got["x", i] == pytest.approx(h)
    assert got[None, 90] is got[None, 91] is got["x", 92] is None


def test_equal_values_and_missing_groups(spark):
    row = ranktests.mann_whitney(samples(spark, {"fifo": [1] * 9, "cluster_nn": [1] * 9}), "v", "g").first()
    assert (row["p_value"], row["statistic"]) == (1.0, 40.5)
    with pytest.raises(ValueError, match="only \\['fifo'\\]"):
        ranktests.mann_whitney(samples(spark, {"fifo": [1, 2]}), "v", "g")
    with pytest.raises(ValueError, match="fewer than two groups"):
        ranktests.kruskal_wallis(samples(spark, {"early": [1, 2]}), "v", "g")


@pytest.mark.parametrize("one_task_rows", [10**6, 5])
def test_kruskal_wallis(spark, one_task_rows):
    rng = np.random.default_rng(6)
    groups = {w: rng.integers(0, 9 + i, 20 + 7 * i) / 10 for i, w in enumerate(WINDOW_ORDER)}
    row = ranktests.kruskal_wallis(samples(spark, groups), "v", "g", one_task_rows=one_task_rows).first()
    assert row["statistic"] == pytest.approx(kruskal_h(list(groups.values())))
    assert row["p_value"] == pytest.approx(ranktests.chi_square_tail(row["statistic"], 4))
    fewer = {w: groups[w] for w in WINDOW_ORDER[:3]}
    row = ranktests.kruskal_wallis(samples(spark, fewer), "v", "g").first()
    assert row["statistic"] == pytest.approx(kruskal_h(list(fewer.values())))
    assert row["degrees_of_freedom"] == 2
    tied = ranktests.kruskal_wallis(samples(spark, {"early": [1, 1], "midday": [1]}), "v", "g").first()
    assert tied["statistic"] is None and tied["p_value"] is None


@pytest.mark.parametrize(
    "x, df, p",  # textbook critical values
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05),
     (11.070498, 5, 0.05), (6.634897, 1, 0.01), (16.811894, 6, 0.01), (18.475307, 7, 0.01)],
)
def test_chi_square_tail(x, df, p):
    assert ranktests.chi_square_tail(x, df) == pytest.approx(p, rel=1e-5)
    assert ranktests.chi_square_tail(0.0, df) == 1.0


def holm(ps):
    order, out, top = np.argsort(ps, kind="stable"), np.empty(len(ps)), 0.0
    for i, at in enumerate(order):
        top = max(top, (len(ps) - i) * ps[at])
        out[at] = min(1.0, top)
    return out


@pytest.mark.parametrize("one_task_rows", [10**6, 20])
def test_holm_per_family(spark, one_task_rows):
    rng = np.random.default_rng(9)
    rows, expected = [], {}
    for family, size in (("big", 300), ("small", 3), ("tied", 40)):
        ps = rng.uniform(0, 0.02, size)
        if family == "tied":
            ps = np.round(ps, 3)
        for i, (p, h) in enumerate(zip(ps, holm(ps))):
            rows.append((family, i, float(p)))
            expected[family, i] = h
    rows.append(("small", 99, None))
    df = spark.createDataFrame(rows, "family string, i int, p double")
    got = ranktests.holm_adjust(df, "p", ["family"], "h", one_task_rows).collect()
    assert len(got) == len(rows)
    for row in got:
        if row["p"] is None:
            assert row["h"] is None
        else:
            assert row["h"] == pytest.approx(expected[row["family"], row["i"]], rel=1e-12)
    whole = ranktests.holm_adjust(df.where("family = 'big'"), "p", out="h", one_task_rows=one_task_rows)
    assert {r["i"]: r["h"] for r in whole.collect()} == pytest.approx(
        {i: h for (f, i), h in expected.items() if f == "big"}
    )


def test_pairwise_and_primary(spark):
    rng = np.random.default_rng(11)
    groups = {w: rng.integers(0, 10 + 2 * i, 30 + i) / 20 for i, w in enumerate(WINDOW_ORDER) if w != "midday"}
    table = ranktests.pairwise_tests(samples(spark, groups), "v", "g").collect()
    pairs = list(combinations(groups, 2))
    expected = {f"{a} vs {b}": (groups[a], groups[b]) for a, b in pairs}
    adjusted = dict(zip(expected, holm([asymptotic_p(*ab) for ab in expected.values()])))
    assert {r["comparison"] for r in table} == set(expected)
    for row in table:
        a, b = expected[row["comparison"]]
        assert row["statistic"] == u_statistic(a, b)
        assert row["p_value"] == pytest.approx(asymptotic_p(a, b))
        assert row["p_holm"] == pytest.approx(adjusted[row["comparison"]])
        assert row["mean_difference_first_minus_second"] == pytest.approx(a.mean() - b.mean())
    assert [r["p_holm"] for r in table] == sorted(r["p_holm"] for r in table)

    rows = [("fifo" if i % 2 else "cluster_nn", WINDOW_ORDER[i % 5], (i * 7 % 20) / 20) for i in range(80)]
    kpis = spark.createDataFrame(rows, "algorithm string, dispatch_window string, late_rate double")
    primary = ranktests.primary_tests(kpis).collect()
    assert [r["p_holm"] for r in primary] == pytest.approx(list(holm([r["p_value"] for r in primary])))


@pytest.mark.parametrize("rows_per_task", [7, 60, 10**6])
def test_pair_sums_in_ranges_equal_those_of_all_rows(spark, rows_per_task):
    rng = np.random.default_rng(rows_per_task)
    groups = {f"g{i}": np.round(rng.normal(i / 5, 1, rng.integers(1, 40)), int(rng.integers(0, 4))) for i in range(9)}
    groups["g4"] = np.array([0.0, -0.0, 0.0])
    found = ranktests.pair_sums(samples(spark, groups), "v", "g", [*groups, "absent"], rows_per_task)
    assert set(found) == set(combinations(range(9), 2))
    names = list(groups)
    for (i, j), sums in found.items():
        a, b = groups[names[i]], groups[names[j]]
        times = np.unique(np.concatenate([a, b]) + 0.0, return_counts=True)[1]
        assert (sums.n_first, sums.n_second, sums.u_first, sums.ties) == (len(a), len(b), u_statistic(a, b), (times**3 - times).sum())
        assert (sums.sum_first, sums.sum_second) == (pytest.approx(a.sum()), pytest.approx(b.sum()))


def test_a_thousand_groups(spark):
    rng = np.random.default_rng(12)
    groups = {f"g{i:04}": rng.integers(0, 500, 12) / 10 for i in range(1_000)}
    found = ranktests.pair_sums(samples(spark, groups), "v", "g", list(groups), 5_000)
    assert len(found) == 499_500
    names = list(groups)
    for i, j in [(0, 1), (0, 999), (998, 999), *((int(a), int(a + b)) for a, b in rng.integers(1, 490, (200, 2)))]:
        assert found[i, j].u_first == u_statistic(groups[names[i]], groups[names[j]])


# -------------------------------------------------------------------------------- GEE


def fleet(seed=7, drivers=12, stops=40, effect=0.0):
    """Stops of drivers who differ by ``effect``; lateness follows the algorithm and the load of the road."""
    rng = np.random.default_rng(seed)
    n = drivers * stops
    data = pd.DataFrame(
        {
            "driver_id": [f"d{i % drivers}" for i in range(n)],
            **{
                c: rng.choice(levels, n)
                for c, levels in {
                    "algorithm": ["cluster_nn", "fifo"],
                    "dispatch_window": ["evening", "midday", "morning_peak"],
                    "vehicle_type": ["a", "b"],
                    "region": ["in", "out", "rim"],
                    "depot": ["X", "Y"],
                }.items()
            },
            "wait_min": rng.gamma(2.0, 5.0, n),
            "route_km": rng.normal(20, 4, n),
        }
    )
    drift = rng.normal(0, 1, drivers)[np.arange(n) % drivers] * effect
    odds = drift - 1 + 0.9 * (data["algorithm"] == "fifo") + 0.03 * data["wait_min"]
    data["is_late"] = rng.random(n) < 1 / (1 + np.exp(-odds))
    return data[["driver_id", *CATEGORIES, *MEASURES, "is_late"]]


SCHEMA = (
    "driver_id string, algorithm string, dispatch_window string, vehicle_type string, "
    "region string, depot string, wait_min double, route_km double, is_late boolean"
)


def dense_gee(data, exchangeable=True):
    """The same estimating equations with full per-driver matrices."""
    columns, terms = [np.ones(len(data))], ["Intercept"]
    for c in CATEGORIES:
        for level in sorted(data[c].unique())[1:]:
            columns.append((data[c] == level).to_numpy(float))
            terms.append(f"C({c})[T.{level}]")
    columns += [data[m].to_numpy() for m in MEASURES]
    terms += MEASURES
    x, y = np.column_stack(columns), data["is_late"].to_numpy(float)
    clusters = [np.flatnonzero((data["driver_id"] == d).to_numpy()) for d in data["driver_id"].unique()]
    p, beta, alpha = x.shape[1], np.zeros(x.shape[1]), 0.0

    def pieces():
        mu = 1 / (1 + np.exp(-x @ beta))
        bread, meat, score = np.zeros((p, p)), np.zeros((p, p)), np.zeros(p)
        for c in clusters:
            s = np.sqrt(mu[c] * (1 - mu[c]))
            corr = np.full((len(c), len(c)), alpha) + (1 - alpha) * np.eye(len(c))
            inv = np.linalg.inv(np.outer(s, s) * corr)
            d = x[c] * (s**2)[:, None]
            u = d.T @ inv @ (y[c] - mu[c])
            bread += d.T @ inv @ d
            meat += np.outer(u, u)
            score += u
        return mu, bread, meat, score

    for _ in range(100):
        mu, bread, meat, score = pieces()
        beta = beta + np.linalg.solve(bread, score)
        if exchangeable:
            mu = 1 / (1 + np.exp(-x @ beta))
            e = (y - mu) / np.sqrt(mu * (1 - mu))
            scale = (e**2).sum() / (len(y) - p)
            cross = sum((e[c].sum() ** 2 - (e[c] ** 2).sum()) / 2 for c in clusters)
            pairs = sum(len(c) * (len(c) - 1) / 2 for c in clusters)
            alpha = cross / scale / (pairs - p)
    _, bread, meat, _ = pieces()
    inverse = np.linalg.inv(bread)
    return terms, beta, inverse @ meat @ inverse, alpha


@pytest.mark.parametrize("effect", [0.0, 1.0])
def test_gee_equals_dense_equations(spark, effect):
    data = fleet(effect=effect, stops=48)
    fit = driver_clustered_gee(spark.createDataFrame(data, SCHEMA).repartition(3))
    terms, beta, covariance, alpha = dense_gee(data)
    assert fit.terms == terms and "C(algorithm)[T.fifo]" in fit.terms
    assert fit.params == pytest.approx(beta, abs=1e-6)
    assert fit.covariance == pytest.approx(covariance, abs=1e-6)
    assert fit.correlation == pytest.approx(alpha, abs=1e-6)
    assert fit.conf_int().shape == (len(terms), 2)
    assert (fit.n_drivers, fit.n_stops) == (12, len(data))
    table = fit.table().collect()
    assert [r["term"] for r in table] == terms
    assert all(r["ci_lower"] < r["log_odds"] < r["ci_upper"] and 0 <= r["p_value"] <= 1 for r in table)


def test_gee_with_one_stop_per_driver_is_logistic_regression(spark):
    data = fleet(stops=64)
    data["driver_id"] = [f"d{i}" for i in range(len(data))]
    fit = driver_clustered_gee(spark.createDataFrame(data, SCHEMA))
    assert fit.params == pytest.approx(dense_gee(data, exchangeable=False)[1], abs=1e-6)


def test_gee_collapses_repeated_stops(spark):
    data = fleet(stops=30)
    tripled = pd.concat([data] * 3)
    fit = driver_clustered_gee(spark.createDataFrame(tripled, SCHEMA))
    _, beta, covariance, _ = dense_gee(tripled.reset_index(drop=True))
    assert fit.params == pytest.approx(beta, abs=1e-6)
    assert fit.covariance == pytest.approx(covariance, abs=1e-6)


def test_gee_refuses_unusable_data(spark):
    data = fleet()
    df = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(ValueError, match=r"needs the columns \['depot', 'region'\]"):
        driver_clustered_gee(df.drop("region", "depot"))
    with pytest.raises(ValueError, match="all late or all on time"):
        driver_clustered_gee(df.where("is_late"))
    with pytest.raises(ValueError, match="all late or all on time"):
        driver_clustered_gee(df.limit(0))
    with pytest.raises(ValueError, match="fewer than two drivers"):
        driver_clustered_gee(df.withColumn("driver_id", df.algorithm.substr(1, 0)))
    with pytest.raises(ValueError, match="linearly dependent"):
        driver_clustered_gee(df.withColumn("depot", df.region))
    incomplete = data.copy()
    incomplete.loc[::5, "wait_min"] = None
    fit = driver_clustered_gee(spark.createDataFrame(incomplete, SCHEMA))
    assert fit.n_stops == incomplete["wait_min"].notna().sum()


def test_gee_iterations_need_no_python(spark):
    found = gee.equations(spark.createDataFrame(fleet(), SCHEMA), {"wait_min": 0.3}, 0.1)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
    p = len(dense_gee(fleet())[0])
    assert found.count() == p * (p + 1) // 2 + p


def test_gee_iteration_reads_the_patterns_once(spark):
    found = gee.equations(spark.createDataFrame(fleet(), SCHEMA), {}, 0.1)
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
