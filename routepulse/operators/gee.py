"""Driver-clustered logistic GEE with an exchangeable working correlation.

Stops of one driver and one covariate pattern are interchangeable, so they are first
collapsed to (pattern, stops, late stops) and written once. Every iteration is one
Spark job that reads that table once, built of columns only: patterns are summed per driver (partly
in each task, so that no task holds a driver's rows), a driver's sums become the products that the
estimating equations add up, and the driver program solves a p x p system.

The modelled event is a late stop: positive log-odds mean more lateness.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routepulse.operators.checks import check_columns
from routepulse.session import stage

CATEGORIES = ("algorithm", "dispatch_window", "vehicle_type", "region", "depot")
MEASURES = ("wait_min", "route_km")
REQUIRED = ("is_late", "driver_id", *CATEGORIES, *MEASURES)
MAX_ITERATIONS = 60
TOLERANCE = 1e-8
Z_95 = 1.959963984540054


@dataclass(frozen=True)
class Design:
    """Treatment coding: the first level of a category is its reference."""

    levels: dict[str, list[str]]
    centers: dict[str, float]
    scales: dict[str, float]

    @property
    def terms(self) -> list[str]:
        coded = [f"C({c})[T.{level}]" for c in CATEGORIES for level in self.levels[c][1:]]
        return ["Intercept", *coded, *MEASURES]

    def first_terms(self) -> dict[str, int]:
        """The place of each category's first term (that of its level 1)."""
        places, at = {}, 1
        for c in CATEGORIES:
            places[c] = at
            at += len(self.levels[c]) - 1
        return places

    def unscaling(self) -> np.ndarray:
        """Matrix from coefficients of scaled measures to those of raw ones."""
        terms = self.terms
        back = np.eye(len(terms))
        for m in MEASURES:
            at = terms.index(m)
            back[at, at] = 1 / self.scales[m]
            back[0, at] = -self.centers[m] / self.scales[m]
        return back


@dataclass(frozen=True)
class GeeFit:
    terms: list[str]
    params: np.ndarray
    covariance: np.ndarray
    correlation: float
    scale: float
    n_stops: int
    n_drivers: int
    iterations: int
    spark: SparkSession = field(repr=False)

    def conf_int(self) -> np.ndarray:
        spread = Z_95 * np.sqrt(np.diag(self.covariance))
        return np.column_stack([self.params - spread, self.params + spread])

    def p_values(self) -> np.ndarray:
        z = np.abs(self.params) / np.sqrt(np.diag(self.covariance))
        return np.array([math.erfc(v / math.sqrt(2)) for v in z])

    def table(self) -> DataFrame:
        """term, log_odds, ci_lower, ci_upper, p_value."""
        rows = [
            (term, float(b), float(low), float(high), float(p))
            for term, b, (low, high), p in zip(
                self.terms, self.params, self.conf_int(), self.p_values()
            )
        ]
        return self.spark.createDataFrame(
            rows, "term string, log_odds double, ci_lower double, ci_upper double, p_value double"
        )


def _patterns(facts: DataFrame) -> DataFrame:
    keys = ["driver_id", *CATEGORIES, *MEASURES]
    rows = facts.select(
        F.col("is_late").cast("long").alias("late"),
        F.col("driver_id").cast("string").alias("driver_id"),
        *[F.col(c).cast("string").alias(c) for c in CATEGORIES],
        *[F.col(m).cast("double").alias(m) for m in MEASURES],
    ).dropna()
    collapsed = rows.groupBy(*keys).agg(
        F.count("*").alias("stops"), F.sum("late").alias("late_stops")
    )
    # Drivers lie together in each file, so a batch yields few driver sums.
    return stage(collapsed.sortWithinPartitions("driver_id"), "gee-patterns")


#: Different values of a category that a model can have.
MAX_LEVELS = 500


def _design(patterns: DataFrame) -> tuple[Design, int, int]:
    stops = F.col("stops")
    row = patterns.agg(
        F.sum("stops").alias("stops"),
        F.sum("late_stops").alias("late"),
        F.countDistinct("driver_id").alias("drivers"),
        *[F.approx_count_distinct(c).alias(f"{c}_levels") for c in CATEGORIES],
        *[F.sum(F.col(m) * stops).alias(f"{m}_1") for m in MEASURES],
        *[F.sum(F.col(m) * F.col(m) * stops).alias(f"{m}_2") for m in MEASURES],
    ).first()
    n = row["stops"]
    if not n or row["late"] in (0, n):
        raise ValueError("the stops are all late or all on time: nothing to model")
    if row["drivers"] < 2:
        raise ValueError("fewer than two drivers: no clusters to compare")
    # Their square is solved on the driver program; the count is within a few percent.
    wide = [c for c in CATEGORIES if row[f"{c}_levels"] > MAX_LEVELS]
    if wide:
        raise ValueError(f"too many different values (over {MAX_LEVELS}) in {wide}")
    seen = patterns.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in CATEGORIES]).first()
    centers = {m: row[f"{m}_1"] / n for m in MEASURES}
    scales = {
        m: math.sqrt(max(row[f"{m}_2"] / n - centers[m] ** 2, 0.0)) or 1.0 for m in MEASURES
    }
    return Design(seen.asDict(), centers, scales), n, row["drivers"]


def _coded(patterns: DataFrame, design: Design) -> DataFrame:
    """Categories as numbers (0: the reference), measures standardised."""
    codes = [
        (F.array_position(F.lit(design.levels[c]), F.col(c)) - 1).cast("int").alias(f"{c}_code")
        for c in CATEGORIES
    ]
    scaled = [((F.col(m) - design.centers[m]) / design.scales[m]).alias(m) for m in MEASURES]
    return stage(patterns.select("driver_id", "stops", "late_stops", *scaled, *codes), "gee-coded")


CODES = [f"{c}_code" for c in CATEGORIES]
# The factors of a row's terms: 1 for the intercept and a category's level, else the measure.
FACTORS = ("1", *MEASURES)
SQUARES = [(a, b) for a in range(len(FACTORS)) for b in range(a, len(FACTORS))]


def _sums(coded: DataFrame, design: Design, beta: np.ndarray, alpha: float) -> DataFrame:
    """Sums per driver and equal categories at the given coefficients.

    n stops, their residuals e and squares ee; for each factor f, z_f (weight roots) and r_f
    (residuals), for each two factors the weights w_fg. The coefficients come as one row of a
    table, so that the compiled plan is the same in every iteration.
    """
    terms, first = design.terms, design.first_terms()
    tables = {f"b_{c}": [0.0, *map(float, beta[first[c] : first[c] + len(design.levels[c]) - 1])] for c in CATEGORIES}
    tables["b_other"] = [float(beta[0]), *(float(beta[terms.index(m)]) for m in MEASURES), float(alpha)]
    row = coded.sparkSession.createDataFrame(pa.table({k: pa.array([v], pa.list_(pa.float64())) for k, v in tables.items()}))  # one row
    eta = " + ".join(["b_other[0]", *(f"get(b_{c}, {c}_code)" for c in CATEGORIES), *(f"b_other[{i}] * {m}" for i, m in enumerate(MEASURES, 1))])
    kept = ["driver_id", *CODES, *MEASURES, "stops", "late_stops"]
    rows = coded.crossJoin(F.broadcast(row)).selectExpr(*kept, f"1 / (1 + exp(-({eta}))) AS mu", f"b_other[{len(MEASURES) + 1}] AS alpha")
    rows = rows.selectExpr(*kept, "alpha", "mu", "mu * (1 - mu) AS weight", "late_stops - stops * mu AS residual", "sqrt(mu * (1 - mu)) AS root")
    return rows.groupBy("driver_id", *CODES).agg(
        F.expr("double(sum(stops)) AS n"),
        F.expr("sum(residual / root) AS e"),
        F.expr("sum((late_stops * (1 - mu) * (1 - mu) + (stops - late_stops) * mu * mu) / weight) AS ee"),
        F.expr("first(alpha) AS alpha"),  # the same in all rows
        *[F.expr(f"sum(root * stops * {f}) AS z_{k}") for k, f in enumerate(FACTORS)],
        *[F.expr(f"sum(residual * {f}) AS r_{k}") for k, f in enumerate(FACTORS)],
        *[F.expr(f"sum(weight * stops * {FACTORS[a]} * {FACTORS[b]}) AS w_{a}{b}") for a, b in SQUARES],
    )


def _term_sums(design: Design) -> list[Column]:
    """n, e, ee, alpha, and for every term in order the sums z0, z1, .. and r0, r1, .."""
    of = ["1 = 1", *(f"{c}_code = {i}" for c in CATEGORIES for i in range(1, len(design.levels[c]))), *["1 = 1"] * len(MEASURES)]
    factor = [0] * (len(of) - len(MEASURES)) + [k + 1 for k in range(len(MEASURES))]
    terms = [F.expr(f"sum(IF({when}, {what}_{k}, 0D)) AS {what}{j}") for what in "zr" for j, (when, k) in enumerate(zip(of, factor, strict=True))]
    return [F.expr("sum(n) AS n"), F.expr("sum(e) AS e"), F.expr("sum(ee) AS ee"), F.expr("first(alpha) AS alpha"), *terms]


def _driver_cells(p: int) -> str:
    """What a driver adds: products of terms i and j, (j = -1) the score of i, (i = -1) moments of the residuals."""
    cell = "named_struct('i', {}, 'j', {}, 'bread', {}, 'meat', {})"
    product = cell.format("i", "j", "-z[i] * z[j] * shrink / (1 - alpha)", "u[i] * u[j]")
    products = f"flatten(transform(sequence(0, {p - 1}), i -> transform(sequence(i, {p - 1}), j -> {product})))"
    scores = f"transform(u, (v, i) -> {cell.format('i', '-1', 'v', '0D')})"
    moments = ", ".join(cell.format("-1", str(k), m, "0D") for k, m in enumerate(("ee", "n", "(e * e - ee) / 2", "n * (n - 1) / 2")))
    return f"concat({products}, {scores}, array({moments}))"


def _information_cells(design: Design) -> str:
    """What equal categories add to the information of the independence model."""
    # the terms that are not 0 in a row, and the factor of each
    places = [("0", 0), *((f"IF({c}_code > 0, {c}_code + {at - 1}, NULL)", 0) for c, at in design.first_terms().items())]
    places += [(str(len(design.terms) - len(MEASURES) + k), k + 1) for k in range(len(MEASURES))]
    cells = [
        f"named_struct('i', {i}, 'j', {j}, 'bread', w_{min(a, b)}{max(a, b)} / (1 - alpha), 'meat', 0D)"
        for x, (i, a) in enumerate(places)
        for j, b in places[x:]
    ]
    return f"array({', '.join(cells)})"


def _cells(sums: DataFrame, design: Design) -> DataFrame:
    """What the equations add up: at most a row for each pair of terms, each term and each moment.

    Drivers and equal categories come from one grouping, so that the patterns are read and summed once.
    """
    p, weights = len(design.terms), [f"w_{a}{b}" for a, b in SQUARES]
    found = sums.groupingSets([["driver_id"], CODES], "driver_id", *CODES)
    found = found.agg(F.grouping("driver_id").alias("pooled"), *_term_sums(design), *[F.expr(f"sum({w}) AS {w}") for w in weights])
    z, r = (", ".join(f"{what}{j}" for j in range(p)) for what in "zr")
    kept = ["pooled", *CODES, *weights, "n", "e", "ee", "alpha"]
    found = found.selectExpr(*kept, f"array({z}) AS z", f"array({r}) AS r", "alpha / (1 + (n - 1) * alpha) AS shrink")
    found = found.selectExpr(*kept, "z", "shrink", "zip_with(r, z, (a, b) -> (a - b * shrink * e) / (1 - alpha)) AS u")
    found = found.selectExpr(f"explode(IF(pooled = 0, {_driver_cells(p)}, {_information_cells(design)})) AS cell").select("cell.*")
    found = found.where("i IS NOT NULL AND j IS NOT NULL")
    return found.groupBy("i", "j").agg(F.expr("sum(bread) AS bread"), F.expr("sum(meat) AS meat"))


def _equations(sums: DataFrame, design: Design) -> dict[str, np.ndarray]:
    """The bread, score, meat and residual moments over all drivers."""
    p = len(design.terms)
    out = {"bread": np.zeros((p, p)), "meat": np.zeros((p, p)), "score": np.zeros(p), "moments": np.zeros(4)}
    for r in _cells(sums, design).collect():
        if r.i < 0:
            out["moments"][r.j] = r.bread
        elif r.j < 0:
            out["score"][r.i] = r.bread
        else:
            for what in ("bread", "meat"):
                out[what][r.i, r.j] = out[what][r.j, r.i] = r[what]
    return out


def equations(facts: DataFrame, coefficients: dict[str, float], correlation: float) -> DataFrame:
    """The estimating equations at the given coefficients (others 0; measures standardised), per stop.

    One row for each pair of terms, in the order of the model: term, other, bread and meat (of
    the sandwich), and one for each term: other NULL, its score as bread and no meat.
    """
    check_columns(facts, REQUIRED, "driver-clustered analysis")
    patterns = _patterns(facts)
    design, n_stops, _ = _design(patterns)
    beta = np.array([coefficients.get(term, 0.0) for term in design.terms])
    cells = _cells(_sums(_coded(patterns, design), design, beta, correlation), design).where("i >= 0")
    names = F.lit(design.terms)
    return cells.select(
        F.get(names, F.col("i")).alias("term"),
        F.when(F.col("j") >= 0, F.get(names, F.when(F.col("j") >= 0, F.col("j")))).alias("other"),
        (F.col("bread") / n_stops).alias("bread"),
        F.when(F.col("j") >= 0, F.col("meat") / n_stops).alias("meat"),
    )


def driver_sums(facts: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Per driver at the given coefficients (others 0; measures standardised): what an iteration adds up.

    driver_id, n (stops), e and ee (sums of the residuals and their squares), z (sum of the
    weights' roots) and z_wait_min (the same times the standardised wait).
    """
    check_columns(facts, REQUIRED, "driver-clustered analysis")
    patterns = _patterns(facts)
    design, _, _ = _design(patterns)
    beta = np.array([coefficients.get(term, 0.0) for term in design.terms])
    sums = _sums(_coded(patterns, design), design, beta, 0.0).groupBy("driver_id").agg(*_term_sums(design))
    wait = design.terms.index("wait_min")
    return sums.select("driver_id", F.col("n").cast("long"), "e", "ee", F.col("z0").alias("z"), F.col(f"z{wait}").alias("z_wait_min"))


def _check_rank(information: np.ndarray, terms: list[str]) -> None:
    scale = np.sqrt(np.diag(information))
    if (scale == 0).any():
        raise ValueError(f"{terms[int(np.argmin(scale))]} does not vary; drop it")
    values, vectors = np.linalg.eigh(information / np.outer(scale, scale))
    if values[0] < 1e-10:
        involved = [t for t, w in zip(terms, vectors[:, 0]) if abs(w) > 0.1]
        raise ValueError(f"terms are linearly dependent: {involved}")


def driver_clustered_gee(
    facts: DataFrame, max_iterations: int = MAX_ITERATIONS, tolerance: float = TOLERANCE
) -> GeeFit:
    """Fit is_late ~ algorithm + window + vehicle + region + depot + wait + km.

    Clusters are drivers; rows with a missing value are left out; standard errors
    are the robust (sandwich) ones.
    """
    check_columns(facts, REQUIRED, "driver-clustered analysis")
    patterns = _patterns(facts)
    design, n_stops, n_drivers = _design(patterns)
    coded = _coded(patterns, design)
    terms = design.terms
    p = len(terms)
    beta, alpha, settled = np.zeros(p), 0.0, False
    for iteration in range(1, max_iterations + 1):
        sums = _equations(_sums(coded, design, beta, alpha), design)
        if iteration == 1:
            _check_rank(sums["bread"], terms)
        residual, stops, cross, pairs = sums["moments"][:4]
        scale = residual / (stops - p)
        if settled:
            break
        step = np.linalg.solve(sums["bread"], sums["score"])
        # The plain logistic start ignores dependence until it is near its optimum.
        new_alpha = cross / scale / (pairs - p) if iteration > 3 and pairs > p else 0.0
        if not np.isfinite(step).all() or not -1 < new_alpha < 1:
            raise ValueError(f"GEE diverged after {iteration} iterations")
        settled = (
            np.abs(step).max() <= tolerance * max(1.0, np.abs(beta).max())
            and abs(new_alpha - alpha) <= tolerance
            and iteration > 4
        )
        beta, alpha = beta + step, new_alpha
    else:
        raise ValueError(f"GEE did not converge in {max_iterations} iterations")
    inverse = np.linalg.inv(sums["bread"])
    back = design.unscaling()
    return GeeFit(
        terms=terms,
        params=back @ beta,
        covariance=back @ (inverse @ sums["meat"] @ inverse) @ back.T,
        correlation=alpha,
        scale=float(scale),
        n_stops=n_stops,
        n_drivers=n_drivers,
        iterations=iteration,
        spark=facts.sparkSession,
    )
