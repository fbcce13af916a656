"""Outlier flags: global and within-group IQR fences and z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.functions.columns import flag, known, round_even
from routepulse.operators.checks import check_no_missing
from routepulse.operators.quantiles import exact_quantiles
from routepulse.session import join_small, stage

QUARTILES = {"_q1": 0.25, "_q3": 0.75}
SHOWN_QUANTILES = {"median_wait_min": 0.5, "p90_wait_min": 0.9}
MOMENTS = ("_mean", "_std")


def _moments(value: str) -> dict[str, Column]:
    number = known(F.col(value))
    return {"_mean": F.avg(number), "_std": F.stddev_pop(number)}


def _fences(k: float) -> tuple[Column, Column]:
    spread = F.col("_q3") - F.col("_q1")
    return F.col("_q1") - k * spread, F.col("_q3") + k * spread


def iqr_bounds(df: DataFrame, value: str, k: float = 1.5, by: list[str] | None = None) -> DataFrame:
    """(low, high) fences q1 - k*iqr and q3 + k*iqr; one row, or one per group."""
    keys = by or []
    low, high = _fences(k)
    quartiles = exact_quantiles(df, value, QUARTILES, keys)
    return quartiles.select(*keys, low.alias("low"), high.alias("high"))


def _outside(value: Column, k: float) -> Column:
    low, high = _fences(k)
    return flag((value < low) | (value > high))


def _far(value: Column, threshold: float) -> Column:
    usable = F.col("_std") > 0
    score = F.when(usable, F.abs((value - F.col("_mean")) / F.col("_std")))
    return flag(score > threshold)


def _with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    # One scalar subquery: the statistic becomes a constant in the scan of df.
    packed = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumns({c: packed[c] for c in one_row.columns})


def flag_outliers_iqr(
    df: DataFrame, value: str, k: float = 1.5, out: str = "is_outlier"
) -> DataFrame:
    """Flag values outside the global fences; a missing value is not flagged."""
    fenced = _with_scalars(df, exact_quantiles(df, value, QUARTILES))
    return fenced.withColumn(out, _outside(known(F.col(value)), k)).drop(*QUARTILES)


def flag_outliers_zscore(
    df: DataFrame, value: str, threshold: float = 3.0, out: str = "is_outlier"
) -> DataFrame:
    """Flag values more than ``threshold`` population deviations from the mean."""
    moments = df.agg(*[c.alias(name) for name, c in _moments(value).items()])
    scaled = _with_scalars(df, moments)
    return scaled.withColumn(out, _far(known(F.col(value)), threshold)).drop(*MOMENTS)


def flag_outliers_by_group(
    df: DataFrame,
    value: str,
    group: str,
    method: str = "iqr",
    out: str = "is_outlier",
    k: float = 1.5,
    threshold: float = 3.0,
) -> DataFrame:
    """Flag a value against its own group; a row without a group gets no flag."""
    if method == "iqr":
        statistics = exact_quantiles(df, value, QUARTILES, [group])
        test = _outside(known(F.col(value)), k)
    elif method == "zscore":
        grouped = df.where(F.col(group).isNotNull()).groupBy(group)
        statistics = grouped.agg(*[c.alias(name) for name, c in _moments(value).items()])
        test = _far(known(F.col(value)), threshold)
    else:
        raise ValueError(f"method must be 'iqr' or 'zscore', not {method!r}")
    helpers = [c for c in statistics.columns if c != group]
    joined = join_small(df, statistics, [group], "left")
    return joined.withColumn(out, F.when(F.col(group).isNotNull(), test)).drop(*helpers)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``, combined on the map side.

    ``order`` must name every column that may differ within a key.
    """
    rest = [c for c in order if c != key] + [c for c in df.columns if c not in (*order, key)]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def route_waits(routes: DataFrame) -> DataFrame:
    """One wait per route with all three outlier flags and its depot's median and p90.

    The waits are staged: the fences and moments read them several times.
    """
    columns = ["route_id", "depot", "dispatch_window", "algorithm", "wait_min"]
    waits = stage(first_per_key(routes.select(*columns), "route_id", columns[1:]), "waits")
    check_no_missing(waits, "wait_min")
    wait = F.col("wait_min")
    # The moments come with the sketch of the global quartiles.
    moments = {"_mean": ("avg", wait), "_std": ("std", wait)}
    overall = exact_quantiles(waits, "wait_min", QUARTILES, aggregates=moments)
    flagged = _with_scalars(waits, overall).select(
        *columns,
        _outside(wait, 1.5).alias("iqr_outlier_global"),
        _far(wait, 3.0).alias("zscore_outlier_global"),
    )
    # All quantiles of a depot come from one call; the summary finds its own with the rows.
    depots = exact_quantiles(flagged, "wait_min", QUARTILES | SHOWN_QUANTILES, ["depot"])
    low, high = _fences(1.5)
    joined = join_small(flagged, depots, ["depot"], "left")
    test = flag((wait < low) | (wait > high))
    within = F.when(F.col("depot").isNotNull(), test)
    return joined.withColumn("iqr_outlier_within_depot", within).drop(*QUARTILES)


def wait_outlier_summary(waits: DataFrame, digits: int | None = 2) -> DataFrame:
    """Waits and flag counts per depot, longest mean wait first; ``waits`` from ``route_waits``."""
    flags = {
        "global_iqr_outliers": "iqr_outlier_global",
        "global_zscore_outliers": "zscore_outlier_global",
        "within_depot_iqr_outliers": "iqr_outlier_within_depot",
    }
    minutes = ["mean_wait_min", *SHOWN_QUANTILES]
    table = (
        waits.where(F.col("depot").isNotNull())
        .groupBy("depot")
        .agg(
            F.count("*").alias("routes"),
            F.avg("wait_min").alias("mean_wait_min"),
            *[F.max(name).alias(name) for name in SHOWN_QUANTILES],
            *[F.sum(F.col(c).cast("long")).alias(name) for name, c in flags.items()],
        )
    )
    return table.orderBy(F.desc_nulls_last("mean_wait_min"), "depot").select(
        "depot", "routes", *[round_even(F.col(c), digits).alias(c) for c in minutes], *flags
    )


def longest_outlier_waits(waits: DataFrame, n: int = 20) -> DataFrame:
    found = waits.where("iqr_outlier_global").drop(*SHOWN_QUANTILES)
    return found.orderBy(F.desc("wait_min"), "route_id").limit(n)
