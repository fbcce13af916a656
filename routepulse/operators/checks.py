"""Data-quality checks.

The ``check_`` functions run one small job each and raise ValueError. The spatial job runs
none of them: it observes the same while its tables are written, and the ``refuse_``
functions judge what was seen before anything is published.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXAMPLES = 5


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def unknown_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` absent from ``known``; a missing key is unknown.

    Distinct comes first: it combines on the map side, so neither a hot key nor the
    row count of ``df`` reaches the join.
    """
    return df.select(key).distinct().join(known.select(key), key, "left_anti")


def routes_once(routes: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, dict[str, Column]]:
    """One row per route id with its attributes, and what to observe of it: whether an id repeats."""
    rows = routes.groupBy("route_id").agg(*[F.min(c).alias(c) for c in columns], F.count("*").alias("_rows"))
    repeated = F.col("_rows") > 1
    return rows, {"repeated": F.count_if(repeated), "first": F.min(F.when(repeated, F.col("route_id"))), "last": F.max(F.when(repeated, F.col("route_id")))}


def ping_metrics(known: Column, place: Column) -> dict[str, Column]:
    """What to observe of pings that were joined with their routes and located."""
    lost, homeless, route = known.isNull(), place.isNull(), F.col("route_id")
    return {
        "pings": F.count("*"),
        "unknown": F.count_if(lost),
        "unknown_first": F.min(F.when(lost, route)),
        "unknown_last": F.max(F.when(lost, route)),
        "homeless": F.count_if(homeless),
        "homeless_first": F.min(F.when(homeless, route)),
        "homeless_last": F.max(F.when(homeless, route)),
    }


def refuse_repeated(seen: dict, what: str = "Route IDs") -> None:
    if seen["repeated"]:
        raise ValueError(f"{what} occur more than once: {_ends(seen['first'], seen['last'])}")


def refuse_pings(seen: dict) -> None:
    if not seen["pings"]:
        raise ValueError("No GPS pings found")
    if seen["unknown"]:
        raise ValueError(f"pings of routes that are not in the routes table: {_ends(seen['unknown_first'], seen['unknown_last'])}")
    if seen["homeless"]:
        raise ValueError(f"GPS pings have unusable coordinates on routes {_ends(seen['homeless_first'], seen['homeless_last'])}")


def _ends(first, last) -> list:
    """The first and the last example."""
    return [first] if first == last else [first, last]


def ping_problems(pings: DataFrame, routes: DataFrame) -> DataFrame:
    """Per route the pings that a spatial job refuses: ``problem`` and how many ``pings`` have it.

    Pings are counted per route (partly in each task) before routes are joined.
    """
    placed = F.coalesce((F.abs("lat") <= 90) & (F.abs("lon") <= 360), F.lit(False))
    counted = pings.groupBy("route_id", placed.alias("_placed")).agg(F.count("*").alias("pings"))
    joined = counted.join(routes.select("route_id", F.lit(True).alias("_known")).distinct(), "route_id", "left")
    problems = F.array_compact(
        F.array(
            F.when(F.col("_known").isNull(), F.lit("unknown route")),
            F.when(~F.col("_placed"), F.lit("unusable coordinates")),
        )
    )
    found = joined.select("route_id", F.explode(problems).alias("problem"), "pings")
    return found.groupBy("route_id", "problem").agg(F.sum("pings").alias("pings"))


def check_unique(df: DataFrame, key: str, what: str = "Route IDs") -> None:
    found = duplicate_keys(df, key).limit(EXAMPLES).collect()
    if found:
        raise ValueError(f"{what} occur more than once: {[row[0] for row in found]}")


def check_references(df: DataFrame, known: DataFrame, key: str = "route_id") -> None:
    found = unknown_keys(df, known, key).limit(EXAMPLES).collect()
    if found:
        raise ValueError(f"pings of routes that are not in the routes table: {[row[0] for row in found]}")


def check_not_empty(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"No {what} found")


def check_columns(df: DataFrame, required: Iterable[str], purpose: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{purpose} needs the columns {missing}")


def check_no_missing(df: DataFrame, column: str) -> None:
    value = F.col(column)
    absent = value.isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        absent = absent | F.isnan(value)
    if not df.where(absent).isEmpty():
        raise ValueError(f"{column} must be known in every row for outliers to be found")
