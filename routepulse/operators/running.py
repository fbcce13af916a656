"""Running totals over an ordered table that may be too long for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.session import settle

# Longest ordered group that one task sorts and scans.
ONE_TASK_ROWS = 2_000_000
_COMBINE = {"sum": F.sum, "max": F.max}


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys of which a missing one is a group of its own, as in a window."""
    renamed = right.withColumnsRenamed({k: f"_{k}_group" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}_group")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_{k}_group" for k in keys])


def longest_group(df: DataFrame, by: Sequence[str]) -> int:
    if not by:
        return df.count()
    top = df.groupBy(*by).count().agg(F.max("count")).first()[0]
    return top or 0


def running(
    df: DataFrame,
    order: str,
    columns: Mapping[str, tuple[str, str]],
    by: Sequence[str] = (),
    longest: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add inclusive running values ``{new column: ("sum" | "max", column)}``.

    ``order`` must be distinct within a group (collapse ties first) and not NULL.
    Groups up to ``one_task_rows`` use one plain window. Longer ones are cut into
    blocks at sketched quantiles of ``order``, twice as many as tasks are needed for the
    longest; each block is scanned on its own and the blocks' totals are carried over.
    Rows with a missing key in ``by`` are a group like any other.
    """
    by = list(by)
    return scan(in_blocks(df, order, by, longest, one_task_rows), order, columns, by).drop("_block")


def in_blocks(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    longest: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add ``_block``, a row's block within its group, where one task cannot scan the longest group; else add nothing.

    A row finds its block among the cuts by halving, so its cost follows the logarithm of their number.
    """
    by = list(by)
    if longest is None:
        longest = longest_group(df, by)
    if longest <= one_task_rows:
        return df
    blocks = 2 * -(-longest // one_task_rows)
    points = [i / blocks for i in range(1, blocks)]
    cuts = df.groupBy(*by).agg(F.percentile_approx(order, points, 4 * blocks).alias("_cuts"))
    table, is_small = settle(cuts)
    table = F.broadcast(table) if is_small else table
    # without groups there is one row of cuts
    placed = (join_groups(df, table, by, "inner") if by else df.crossJoin(table)).withColumn("_block", F.lit(0))
    for power in reversed(range((blocks - 1).bit_length())):
        # beyond the last cut ``get`` is NULL
        below = F.get("_cuts", F.col("_block") + ((1 << power) - 1)) < F.col(order)
        placed = placed.withColumn("_block", F.col("_block") + F.when(below, 1 << power).otherwise(0))
    return placed.drop("_cuts")


def scan(
    df: DataFrame, order: str, columns: Mapping[str, tuple[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """``running`` over a table of ``in_blocks``; its ``_block`` stays for further scans."""
    by = list(by)
    group = by or [F.lit(0)]

    def over(*keys):
        return (
            Window.partitionBy(*keys)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    if "_block" not in df.columns:
        window = over(*group)
        return df.withColumns(
            {new: _COMBINE[kind](c).over(window) for new, (kind, c) in columns.items()}
        )

    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        df.groupBy(*by, "_block")
        .agg(*[_COMBINE[kind](c).alias(f"_total_{new}") for new, (kind, c) in columns.items()])
        .select(
            *by,
            "_block",
            *[
                _COMBINE[kind](f"_total_{new}").over(before).alias(f"_carry_{new}")
                for new, (kind, _) in columns.items()
            ],
        )
    )
    inner = over(*by, "_block")
    scanned = df.withColumns(
        {new: _COMBINE[kind](c).over(inner) for new, (kind, c) in columns.items()}
    )
    scanned = join_groups(scanned, carried, [*by, "_block"], "inner")
    joined = {}
    for new, (kind, _) in columns.items():
        own, carry = F.col(new), F.col(f"_carry_{new}")
        joined[new] = own + F.coalesce(carry, F.lit(0)) if kind == "sum" else F.greatest(own, carry)
    return scanned.withColumns(joined).drop(*[f"_carry_{new}" for new in columns])
