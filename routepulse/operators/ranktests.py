"""Rank tests on routes: Mann-Whitney U, Kruskal-Wallis, Holm, pairwise post-hoc.

Samples are collapsed to one row per distinct value with a count per group; ranks
come from running counts over that table. Only sums (one row) reach the driver
program, where the p-values are worked out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import cache, lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routepulse.functions.columns import known
from routepulse.operators.running import ONE_TASK_ROWS, in_blocks, join_groups, longest_group, running, scan
from routepulse.schemas import ALGORITHMS, WINDOW_ORDER
from routepulse.session import stage

EXACT_SMALL_SAMPLE = 8

TEST_SCHEMA = "comparison string, test string, statistic double, p_value double, method string"


@dataclass(frozen=True)
class RankSums:
    """Sums behind one two-sample comparison."""

    n_first: int
    n_second: int
    u_first: float
    ties: float
    sum_first: float
    sum_second: float


def value_counts(
    df: DataFrame,
    value: str,
    group: str,
    groups: Sequence[str],
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Distinct values with each group's count ``n0, n1, ...`` and running count ``c0, ...``."""
    number = known(F.col(value).cast("double"))
    rows = df.where(number.isNotNull() & F.col(group).isin(*groups))
    counts = rows.groupBy(number.alias("value")).agg(
        *[F.count(F.when(F.col(group) == g, 1)).alias(f"n{i}") for i, g in enumerate(groups)]
    )
    counts = stage(counts, "value-counts")
    return running(
        counts,
        "value",
        {f"c{i}": ("sum", f"n{i}") for i in range(len(groups))},
        longest=longest_group(counts, []),
        one_task_rows=one_task_rows,
    )


def _ties(count: Column) -> Column:
    t = count.cast("double")
    return t * t * t - t


def _rank_sums(counts: DataFrame, pairs: Sequence[tuple[int, int]]) -> list[RankSums]:
    sums: list[Column] = []
    for i, j in pairs:
        first, second = F.col(f"n{i}").cast("double"), F.col(f"n{j}").cast("double")
        # Second-sample values below this value, plus half of those equal to it.
        below = F.col(f"c{j}") - second + second / 2
        sums += [
            F.sum(f"n{i}"),
            F.sum(f"n{j}"),
            F.sum(first * below),
            F.sum(_ties(F.col(f"n{i}") + F.col(f"n{j}"))),
            F.sum(first * F.col("value")),
            F.sum(second * F.col("value")),
        ]
    row = counts.agg(*[c.alias(f"s{k}") for k, c in enumerate(sums)]).first()
    return [RankSums(*[v or 0 for v in row[6 * k : 6 * k + 6]]) for k in range(len(pairs))]


@cache
def _partition_series(parts: int) -> tuple[int, list[int]]:
    """Period L and numerator N of 1 / ((1 - q) (1 - q^2) .. (1 - q^parts) (1 - q)) = N / (1 - q^L)^(parts + 1)."""
    period = math.lcm(*range(1, parts + 1))
    numerator = [1]
    for i in (1, *range(1, parts + 1)):
        # times 1 + q^i + q^2i + .. + q^(L - i)
        longer = numerator + [0] * (period - i)
        for k in range(i, len(longer)):
            longer[k] += longer[k - i]
        numerator = [x - (longer[k - period] if k >= period else 0) for k, x in enumerate(longer)]
    return period, numerator


def partitions_up_to(total: int, parts: int) -> int:
    """How many ways there are to write 0, 1, .. or ``total`` as a sum of at most ``parts`` whole numbers."""
    period, numerator = _partition_series(parts)
    return sum(numerator[k] * math.comb((total - k) // period + parts, parts) for k in range(total % period, min(total, len(numerator) - 1) + 1, period))


@lru_cache(maxsize=1 << 16)
def exact_mann_whitney_p(n1: int, n2: int, u: float) -> float:
    """Two-sided p-value from the exact null distribution of U (no ties).

    The orders with each U are counted by the coefficients of a Gaussian binomial, a product
    of (1 - q^(large + i)) / (1 - q^i) over the smaller sample: partitions into as many parts
    as that has, of which none may be larger than the other sample. Those with too large parts are taken off
    by inclusion and exclusion over the numerator's terms, so the cost follows the smaller sample alone.
    """
    small, large = sorted((n1, n2))
    tail = n1 * n2 - math.ceil(max(u, n1 * n2 - u))
    ways = {0: 1}  # the numerator, as far as the tail reaches
    for i in range(1, small + 1):
        for total, sign in list(ways.items()):
            if total + large + i <= tail:
                ways[total + large + i] = ways.get(total + large + i, 0) - sign
    orders = sum(sign * partitions_up_to(tail - total, small) for total, sign in ways.items())
    # the quotient of whole numbers is rounded once, however long they are
    return min(1.0, float(Fraction(2 * orders, math.comb(n1 + n2, small))))


def mann_whitney_p(sums: RankSums) -> tuple[float, str]:
    """Two-sided p-value and the method used (exact or asymptotic)."""
    n1, n2 = sums.n_first, sums.n_second
    pairs = n1 * n2
    if min(n1, n2) <= EXACT_SMALL_SAMPLE and sums.ties == 0:
        return exact_mann_whitney_p(n1, n2, sums.u_first), "exact"
    n = float(n1 + n2)
    variance = pairs / 12 * (n + 1 - sums.ties / (n * (n - 1)))
    if variance <= 0:
        return 1.0, "asymptotic"
    far = max(sums.u_first, pairs - sums.u_first)
    z = (far - pairs / 2 - 0.5) / math.sqrt(variance)
    return min(1.0, math.erfc(z / math.sqrt(2))), "asymptotic"


def chi_square_tail(x: float, df: int) -> float:
    """P(chi-square with ``df`` degrees of freedom > x), closed form."""
    if x <= 0:
        return 1.0
    half = x / 2
    if df % 2 == 0:
        tail, term, start = 0.0, math.exp(-half), 1
    else:
        tail = math.erfc(math.sqrt(half))
        term, start = math.exp(-half) * math.sqrt(half) / math.gamma(1.5), 1.5
    steps = df // 2
    for k in range(steps):
        tail += term
        term *= half / (start + k)
    return min(1.0, tail)


def _groups_present(counts: DataFrame, groups: Sequence[str]) -> list[int]:
    row = counts.agg(*[F.sum(f"n{i}").alias(f"s{i}") for i in range(len(groups))]).first()
    return [i for i, n in enumerate(row) if n]


def mann_whitney(
    df: DataFrame,
    value: str = "late_rate",
    group: str = "algorithm",
    groups: tuple[str, str] = ALGORITHMS,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Two-sided Mann-Whitney U of the first against the second group (one row)."""
    counts = value_counts(df, value, group, groups, one_task_rows)
    present = _groups_present(counts, groups)
    if len(present) < 2:
        raise ValueError(
            f"{group}: values are needed in both of {sorted(groups)}, only {sorted(groups[i] for i in present)} have any"
        )
    (sums,) = _rank_sums(counts, [(0, 1)])
    p, method = mann_whitney_p(sums)
    first_mean, second_mean = sums.sum_first / sums.n_first, sums.sum_second / sums.n_second
    return df.sparkSession.createDataFrame(
        [
            (
                f"{groups[1]} vs {groups[0]}",
                "Mann-Whitney U",
                float(sums.u_first),
                p,
                method,
                int(sums.n_first),
                int(sums.n_second),
                second_mean - first_mean,
            )
        ],
        TEST_SCHEMA + ", n_first long, n_second long, mean_difference_second_minus_first double",
    )


def kruskal_wallis(
    df: DataFrame,
    value: str = "late_rate",
    group: str = "dispatch_window",
    groups: Sequence[str] = WINDOW_ORDER,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Kruskal-Wallis H over the groups that have values (one row)."""
    counts = value_counts(df, value, group, groups, one_task_rows)
    total = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(groups))])
    upto = reduce(lambda a, b: a + b, [F.col(f"c{i}") for i in range(len(groups))])
    rank = upto - total + (total + 1) / 2
    row = counts.agg(
        F.sum(_ties(total)),
        *[F.sum(f"n{i}") for i in range(len(groups))],
        *[F.sum(F.col(f"n{i}") * rank) for i in range(len(groups))],
    ).first()
    sizes, ranks = row[1 : 1 + len(groups)], row[1 + len(groups) :]
    used = [(n, r) for n, r in zip(sizes, ranks) if n]
    if len(used) < 2:
        raise ValueError(f"{group}: fewer than two groups have values to compare")
    n = float(sum(size for size, _ in used))
    tie_factor = 1 - row[0] / (n**3 - n)
    if tie_factor > 0:
        h = 12 / (n * (n + 1)) * sum(r * r / size for size, r in used) - 3 * (n + 1)
        h /= tie_factor
        p = chi_square_tail(h, len(used) - 1)
    else:
        h = p = None
    return df.sparkSession.createDataFrame(
        [(f"all {group} groups", "Kruskal-Wallis", h, p, "chi-square", len(used) - 1)],
        TEST_SCHEMA + ", degrees_of_freedom int",
    )


def holm_adjust(
    df: DataFrame,
    p: str = "p_value",
    family: Sequence[str] = (),
    out: str = "p_holm",
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Holm step-down adjusted p-values within each family.

    A missing p-value (NULL or NaN) is no test and stays missing. Rows without a family
    are a family of their own.
    """
    family = list(family)
    tested = df.where(known(F.col(p)).isNotNull())
    if longest_group(tested, family) <= one_task_rows:
        partition = family or [F.lit(0)]
        whole = Window.partitionBy(*partition)
        ordered = whole.orderBy(known(F.col(p)).asc_nulls_last())
        step = (F.count(known(F.col(p))).over(whole) - F.row_number().over(ordered) + 1) * known(F.col(p))
        stepped = df.withColumn("_step", step)
        # Ties share the largest adjusted value: range frame.
        so_far = F.max("_step").over(
            ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return stepped.withColumn(
            out, F.when(known(F.col(p)).isNotNull(), F.least(F.lit(1.0), so_far))
        ).drop("_step")

    # Equal p-values share one adjusted value, so distinct ones are enough.
    distinct = tested.groupBy(*family, p).agg(F.count("*").alias("_rows"))
    sizes = tested.groupBy(*family).agg(F.count("*").alias("_tests"))
    distinct = stage(distinct, "holm")
    # Both scans run in the same blocks.
    placed = in_blocks(distinct, p, family, one_task_rows=one_task_rows)
    upto = scan(placed, p, {"_upto": ("sum", "_rows")}, family)
    if family:
        upto = join_groups(upto, sizes, family, "inner")
    else:
        upto = upto.withColumn("_tests", sizes.scalar())
    step = (F.col("_tests") - (F.col("_upto") - F.col("_rows"))) * F.col(p)
    steps = stage(upto.withColumn("_step", step).drop("_tests", "_upto", "_rows"), "holm-steps")
    stepped = scan(steps, p, {"_so_far": ("max", "_step")}, family)
    adjusted = stepped.select(*family, p, F.least(F.lit(1.0), F.col("_so_far")).alias(out))
    return join_groups(df, adjusted, [*family, p]).select(*df.columns, out)


def primary_tests(kpis: DataFrame) -> DataFrame:
    """Algorithm and window test on the routes' late rates, Holm family of two."""
    columns = ["comparison", "test", "statistic", "p_value", "method"]
    kpis = stage(kpis.select("algorithm", "dispatch_window", "late_rate"), "late-rates")
    both = (
        mann_whitney(kpis)
        .select(*columns)
        .unionByName(kruskal_wallis(kpis).select(*columns))
    )
    return holm_adjust(both)


def _pair_adder(n_groups: int) -> Callable:
    """A function that adds up, over a task's sorted (value, place, n) rows, what pairs of groups need.

    It yields a row for each pair (first < second: u, and the sums of n * n of the one times n
    of the other) and one for each group (second NULL: its count, cubes and sum of values).
    It travels to the workers, which need numpy and pyarrow but not this package.
    """
    most = max(1, (1 << 22) // max(n_groups, 1))  # values of a dense block

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        u, squares = np.zeros((n_groups, n_groups)), np.zeros((n_groups, n_groups))
        below, cubes, total = np.zeros(n_groups), np.zeros(n_groups), np.zeros(n_groups)
        held = [np.zeros(0), np.zeros(0, np.int64), np.zeros(0)]

        def block(value, place, n):
            at = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
            for low in range(0, int(at[-1]) + 1, most):
                here = (at >= low) & (at < low + most)
                dense = np.zeros((int(at[here].max()) - low + 1, n_groups))
                dense[at[here] - low, place[here]] = n[here]
                upto = np.cumsum(dense, axis=0)
                u[:] += dense.T @ (below + upto - dense / 2)
                squares[:] += (dense * dense).T @ dense
                cubes[:] += (dense**3).sum(axis=0)
                below[:] += upto[-1]
            np.add.at(total, place, value * n)

        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("value", "place", "n")]
            rows = [np.concatenate(x) for x in zip(held, new, strict=True)]
            # the last value may go on in the next batch
            whole = int(np.searchsorted(rows[0], rows[0][-1], "left")) if len(rows[0]) else 0
            if whole:
                block(*(x[:whole] for x in rows))
            held = [x[whole:] for x in rows]
        if len(held[0]):
            block(*held)
        if not below.any():
            return
        first, second = np.triu_indices(n_groups, 1)
        part = TaskContext.get().partitionId()
        both = [
            (first, second, u[first, second], squares[first, second], squares[second, first]),
            (np.arange(n_groups), np.full(n_groups, -1), below, cubes, total),
        ]
        for i, j, *numbers in both:
            columns = [np.full(len(i), part), i, j, *numbers]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.float64()] * 3, strict=True)], ["part", "first", "second", "a", "b", "c"])

    return add


def pair_sums(
    df: DataFrame, value: str, group: str, groups: Sequence[str], rows_per_task: int = ONE_TASK_ROWS
) -> dict[tuple[int, int], RankSums]:
    """The sums behind all comparisons of two groups that have values, by their places in ``groups``.

    Rows become one for each value and group. They are sorted in ranges of values of
    ``rows_per_task`` rows; a range adds up all pairs among its own rows in dense blocks, and the
    values of lower ranges come in as counts. What leaves the tasks is a row for each pair
    and range, summed by Spark: one for each pair arrives here, so the number of groups may be some thousands.
    """
    spark, n_groups = df.sparkSession, len(groups)
    number = known(F.col(value).cast("double"))
    # 0.0 and -0.0 are one value
    places = spark.createDataFrame([(g, i) for i, g in enumerate(groups)], f"`{group}` string, place long")
    rows = df.select(F.col(group).cast("string").alias(group), (number + 0.0).alias("value")).where("value IS NOT NULL")
    counts = rows.join(F.broadcast(places), group).groupBy("value", "place").agg(F.count("*").cast("double").alias("n"))
    counts = stage(counts, "value-counts")
    tasks = max(1, -(-counts.count() // rows_per_task))
    ordered = counts.repartitionByRange(tasks, "value").sortWithinPartitions("value")
    found = stage(ordered.mapInArrow(_pair_adder(n_groups), "part long, first long, second long, a double, b double, c double"), "pair-sums")
    # a row for each range and group: ranges have very many rows each
    own = found.where("second < 0").select("part", "first", "a", "b", "c").toPandas()
    parts, at = np.unique(own["part"].to_numpy(), return_inverse=True)
    n, cubes, total = np.zeros((len(parts), n_groups)), np.zeros(n_groups), np.zeros(n_groups)
    n[at, own["first"]] = own["a"]
    np.add.at(cubes, own["first"], own["b"])
    np.add.at(total, own["first"], own["c"])
    lower = np.cumsum(n, axis=0) - n
    across, size = n.T @ lower, n.sum(axis=0)
    pairs = found.where("second >= 0").groupBy("first", "second").agg(F.sum("a").alias("u"), F.sum("b").alias("s"), F.sum("c").alias("t")).toPandas()
    out = {}
    for i, j, u, s, t in pairs.itertuples(index=False):
        if size[i] and size[j]:
            ties = cubes[i] + cubes[j] + 3 * (s + t) - size[i] - size[j]
            out[int(i), int(j)] = RankSums(int(size[i]), int(size[j]), *map(float, (u + across[i, j], ties, total[i], total[j])))
    return dict(sorted(out.items()))


def pairwise_tests(
    df: DataFrame,
    value: str = "late_rate",
    group: str = "dispatch_window",
    groups: Sequence[str] = WINDOW_ORDER,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Mann-Whitney U for every pair of groups in order, Holm-adjusted, by p_holm.

    All pairs come from one pass over the sorted values; no rows are paired.
    """
    rows = []
    for (i, j), sums in pair_sums(df, value, group, groups, one_task_rows).items():
        p, method = mann_whitney_p(sums)
        means = sums.sum_first / sums.n_first, sums.sum_second / sums.n_second
        rows.append(
            (f"{groups[i]} vs {groups[j]}", *means, means[0] - means[1],
             float(sums.u_first), p, method)
        )
    table = df.sparkSession.createDataFrame(
        rows,
        "comparison string, mean_rate_first double, mean_rate_second double, "
        "mean_difference_first_minus_second double, statistic double, p_value double, "
        "method string",
    )
    return holm_adjust(table).orderBy("p_holm", "comparison")
