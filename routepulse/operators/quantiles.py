"""Exact interpolated quantiles without holding a group's values in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here a bounded
sketch (combined on the map side) first brackets each wanted rank; a second pass
merges all values outside the brackets into counts, also on the map side, so only
about 0.1 % of a group's distinct values per quantile is ever sorted, in blocks where
even that is too much for one task. The sketch only decides where to look: the result
comes from exact counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.functions.columns import known
from routepulse.operators.running import ONE_TASK_ROWS, longest_group, running
from routepulse.session import settle, stage

ACCURACY = 10_000
# Sketches that one task merges, and the input of a scan task.
SKETCHES_PER_STRIPE = 512
# How often a sketch sees a row of some weight at most; it only decides where to look.
SKETCH_COPIES = 32
SCAN_TASK_BYTES = 128 * 1024 * 1024


def _greatest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def stripes_for(df: DataFrame) -> int:
    """Tasks that merge the sketches of a scan of ``df``, from the planner's size of it.

    Before a join that size may be a product: there are never more stripes than scan tasks anyway.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return min(max(1, int(str(size)) // (SKETCHES_PER_STRIPE * SCAN_TASK_BYTES)), 1 << 20)


def _parts(kind: str, name: str, column: Column | None) -> list[Column]:
    """What a stripe keeps of an aggregate."""
    if kind == "count":
        return [F.count("*").alias(f"_part_{name}")]
    value = known(column.cast("double"))
    if kind == "sum":
        return [F.sum(column).alias(f"_part_{name}")]
    if kind == "avg":
        return [F.sum(value).alias(f"_part_{name}"), F.count(value).alias(f"_part_{name}_n")]
    if kind == "std":
        return [F.struct(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var")).alias(f"_part_{name}")]
    raise ValueError(f"unknown aggregate {kind!r}")


def _merged(kind: str, name: str) -> Column:
    """The aggregate of all stripes."""
    if kind == "count":
        return F.coalesce(F.sum(f"_part_{name}"), F.lit(0))
    if kind == "sum":
        return F.sum(f"_part_{name}")
    if kind == "avg":
        return F.try_divide(F.sum(f"_part_{name}"), F.sum(f"_part_{name}_n"))
    parts = F.filter(F.collect_list(f"_part_{name}"), lambda x: x["n"] > 0)

    def total(of) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda t, x: t + x["n"] * of(x))

    n = F.aggregate(parts, F.lit(0).cast("long"), lambda t, x: t + x["n"])
    mean = total(lambda x: x["mean"]) / n
    spread = total(lambda x: x["var"] + (x["mean"] - mean) * (x["mean"] - mean))
    return F.when(n > 0, F.sqrt(spread / n))


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    aggregates: Mapping[str, tuple[str, Column | None]] | None = None,
    accuracy: int = ACCURACY,
    stripes: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
    margin: float | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with ``{name: probability}`` quantiles.

    Linear interpolation between order statistics; missing values are skipped and
    rows with a missing group key are left out. A group without any value has missing
    quantiles; without ``by`` there is exactly one row.

    ``aggregates`` ({name: (kind, column)}, kind "count", "sum", "avg" or "std", the
    population deviation) are computed over all rows of a group in the sketch's pass and
    put in front of the quantiles, which saves reading ``df`` a third time.

    A group's sketches are merged by ``stripes`` tasks, by default as many as the size
    of ``df`` asks for, and their results by one. A quantile of the whole lies between
    the smallest and the largest of the stripes' quantiles, so the bracket stays safe.
    Should a rank still lie outside its bracket, the second pass is repeated with
    a wider one; ``margin`` is the bracket's half width as a share of the ranks.

    ``weight`` names a column of whole numbers: a row then stands for so many equal ones (none
    below 1). The ranks are those of the rows it stands for; ``aggregates`` don't go with it.
    """
    if weight and aggregates:
        raise ValueError("aggregates of weighted rows are not supported")
    by, aggregates = list(by), dict(aggregates or {})
    if stripes is None:
        stripes = stripes_for(df)
    column = F.col(value) if isinstance(value, str) else value
    rows = df
    for key in by:
        rows = rows.where(F.col(key).isNotNull())

    # Rank error of the sketch is at most n/accuracy; five times that is a safe bracket
    # as long as it spans a few ranks. Groups of up to ``accuracy`` values are kept whole.
    margin = margin or 5.0 / accuracy
    points = [
        edge
        for p in probabilities.values()
        for edge in (max(p - margin, 0.0), min(p + margin, 1.0))
    ]
    cuts = [f"_cut{i}" for i in range(len(points))]
    numeric = known(column.cast("double"))
    count = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    if weight:
        rows = rows.where(count >= 1)
    sketch = [
        F.count(numeric).alias("_n"),
        F.percentile_approx(numeric, points, accuracy).alias("_cut"),
    ]
    for name, (kind, of) in aggregates.items():
        sketch += _parts(kind, name, of)
    ends = [F.get("_cut", F.lit(i)) for i in range(len(points))]
    seen = rows
    if weight:
        # the sketch counts rows: a heavy one is shown to it several times
        seen = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least(count, F.lit(SKETCH_COPIES)).cast("int"))))
        sketch[0] = F.coalesce(F.sum(F.when(numeric.isNotNull() & (F.col("_copy") == 1), count)), F.lit(0)).alias("_n")
    sketched = (
        seen.withColumn("_stripe", F.spark_partition_id() % stripes)
        .groupBy(*by, "_stripe")
        .agg(*sketch)
        .groupBy(*by)
        .agg(
            *[_merged(kind, name).alias(name) for name, (kind, _) in aggregates.items()],
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
            F.array(*[F.max(e) if i % 2 else F.min(e) for i, e in enumerate(ends)]).alias("_cut"),
        )
    )
    whole = [F.lit(float("inf") if i % 2 else float("-inf")) for i in range(len(points))]
    first = sketched.select(
        *by,
        *aggregates,
        "_n",
        *[
            F.when(F.col("_n") <= accuracy, whole[i]).otherwise(F.get("_cut", F.lit(i))).alias(c)
            for i, c in enumerate(cuts)
        ],
    )
    first, is_small = settle(first)
    if not is_small:
        first = stage(first, "quantile-groups")

    data = rows.select(*by, numeric.alias("_v"), count.alias("_w")).where("_v IS NOT NULL")
    edges = first.select(*by, "_n", *cuts)
    if by:
        data = data.join(F.broadcast(edges) if is_small else edges, by)
    else:
        kinds, row = dict(edges.dtypes), edges.first()
        data = data.withColumns({c: F.lit(row[c]).cast(kinds[c]) for c in edges.columns})
    histogram = _histogram(data, by, len(probabilities))
    # Rows inside brackets: the margins and the sketch's error on both sides.
    largest = edges.agg(F.max("_n")).first()[0] or 0
    kept = largest * (2 * margin + 2 / accuracy) * len(probabilities) if largest > accuracy else largest
    longest = int(kept)
    if kept > one_task_rows or stripes > 1:
        histogram = stage(histogram, "histogram")
        longest = longest_group(histogram, by)
    ranked = running(
        histogram, "_at", {"_all": ("sum", "_rows")}, by, longest, one_task_rows
    ).withColumn("_before", F.col("_all") - F.col("_rows"))
    results = _pick(ranked, by, probabilities)
    results, _ = settle(results) if is_small else (stage(results, "quantiles"), False)
    if margin < 1 and not results.where("_missed").isEmpty():
        return exact_quantiles(
            df, value, probabilities, by, aggregates, accuracy, stripes, one_task_rows, margin * 8, weight
        )
    shown, results = first.select(*by, *aggregates), results.drop("_missed")
    if by:
        table = shown.join(results, by, "left")
    else:
        packed = results.select(F.struct(*probabilities)).scalar()
        table = shown.withColumns({name: packed[name] for name in probabilities})
    # Callers often use a small result several times: evaluate it once.
    return settle(table)[0] if is_small else table


def _histogram(data: DataFrame, by: list[str], brackets: int) -> DataFrame:
    """Counts per value inside a bracket, with the values of the gap that follows it."""
    ends = [(F.col(f"_cut{2 * i}"), F.col(f"_cut{2 * i + 1}")) for i in range(brackets)]
    inside = reduce(lambda a, b: a | b, [F.col("_v").between(low, high) for low, high in ends])
    # A value in a gap counts with the nearest bracket end below it, if there is one.
    behind = _greatest([F.when(high < F.col("_v"), high) for _, high in ends])
    behind = F.coalesce(behind, F.lit(float("-inf")))
    return (
        data.withColumn("_inside", inside)
        .withColumn("_at", F.when(F.col("_inside"), F.col("_v")).otherwise(behind))
        .groupBy(*by, "_n", "_at")
        .agg(
            F.sum("_w").alias("_rows"),
            F.sum(F.when(F.col("_inside"), F.col("_w")).otherwise(0)).alias("_exact"),
        )
    )


def _pick(ranked: DataFrame, by: list[str], probabilities: Mapping[str, float]) -> DataFrame:
    """Interpolate between the two order statistics around each probability."""

    def at_rank(rank: Column) -> Column:
        hit = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_exact"))
        return F.max(F.when(hit, F.col("_at")))

    picks, results, missed = [], {}, F.lit(False)
    for i, (name, p) in enumerate(probabilities.items()):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        rank = F.floor(position)
        picks += [at_rank(rank).alias(f"_low{i}"), at_rank(rank + 1).alias(f"_high{i}")]
        weight = position - rank
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        bracketed = low.isNotNull() & ((weight == 0) | high.isNotNull())
        interpolated = F.when(weight == 0, low).otherwise(low + (high - low) * weight)
        results[name] = F.when(bracketed, interpolated)
        missed = missed | ~bracketed
    return (
        ranked.groupBy(*by, "_n")
        .agg(*picks)
        .select(*by, *[c.alias(name) for name, c in results.items()], missed.alias("_missed"))
    )
