"""Running totals, average ranks and exact quantiles over distributed sorted data.

The shared shape: collapse equal values first (map-side combine), range-partition the distinct
values, write that layout out with its partition numbers, then add each partition's starting
offset to a running sum inside the partition. No window spans more than one partition, however
large a group or a run of equal values is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.runtime import freeze

PART = "__part"


def range_layout(table: DataFrame, *keys: str) -> DataFrame:
    """``table`` laid out by ``keys`` in range partitions whose number is stored in the rows."""
    laid_out = table.repartitionByRange(*keys).withColumn(PART, F.spark_partition_id())
    return freeze(laid_out)


def running_total(
    table: DataFrame, order: str, weight: str, group: Sequence[str] = (), output: str = "before"
) -> DataFrame:
    """Add ``output``: the sum of ``weight`` over the group's rows with a smaller ``order``.

    ``table`` must hold each (group, order) once. Also adds ``<output>_total``, the group's sum.
    Group columns must not be null.
    """
    group = list(group)
    layout = range_layout(table, *group, order)
    sums = layout.groupBy(PART, *group).agg(F.sum(weight).alias("__sum"))
    # At most one row per partition in each group here, so these windows stay small.
    parts = Window.partitionBy(*group) if group else Window.partitionBy()
    offsets = sums.select(
        PART,
        *group,
        F.coalesce(
            F.sum("__sum").over(parts.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__offset"),
        F.sum("__sum").over(parts).alias(f"{output}_total"),
    )
    inside = Window.partitionBy(PART, *group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = layout.withColumn("__local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    joined = local.join(offsets, [PART, *group])
    return joined.withColumn(output, F.col("__local") + F.col("__offset")).drop(PART, "__local", "__offset")


def value_counts(df: DataFrame, value: str, extra: Mapping[str, object] | None = None) -> DataFrame:
    """Distinct non-null values with their row count ``n``, and further aggregates in ``extra``."""
    aggregates = [expression.alias(name) for name, expression in (extra or {}).items()]
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"), *aggregates)


def with_average_rank(counts: DataFrame, value: str, output: str = "rank") -> DataFrame:
    """Average rank (1-based, ties share their mean) of each distinct value of ``value_counts``."""
    ranked = running_total(counts, value, "n")
    return ranked.withColumn(output, F.col("before") + (F.col("n") + 1) / 2)


def rank_pairs(
    pairs: DataFrame, value: str, other: str, output: str, group: Sequence[str] = ()
) -> DataFrame:
    """Average rank of ``value`` within its group for rows (group…, value, other, n).

    Each (group, value, other) is present once. A value that is very frequent may come with very
    many partners, so it is allowed to span several range partitions; only the values at the edges
    of a partition's groups need a correction, which is a broadcast of at most two rows per
    partition and group. Also adds ``rows``, the sum of all ``n`` of the group.
    """
    group = list(group)
    keys = [PART, *group]
    layout = range_layout(pairs, *group, value, other)
    sums = layout.groupBy(*keys).agg(
        F.min(value).alias("__first"), F.max(value).alias("__last"), F.sum("n").alias("__sum")
    )
    # One row per partition and group: this window runs over partitions, not over data.
    ordered = Window.partitionBy(*group).orderBy(PART)
    edges = F.broadcast(
        sums.withColumns(
            {
                "__offset": F.coalesce(
                    F.sum("__sum").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "rows": F.sum("__sum").over(
                    ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                ),
            }
        )
    )
    at_edge = layout.join(edges, keys).filter((F.col(value) == F.col("__first")) | (F.col(value) == F.col("__last")))
    before_edge = F.col("__offset") + F.when(F.col(value) == F.col("__first"), 0).otherwise(
        F.col("__sum") - F.col("__ties")
    )
    spans = (
        at_edge.groupBy(*keys, value, "__first", "__offset", "__sum")
        .agg(F.sum("n").alias("__ties"))
        .groupBy(*group, value)
        .agg(F.min(before_edge).alias("__span_before"), F.sum("__ties").alias("__span_ties"))
    )
    upto = Window.partitionBy(*keys).orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = layout.select(
        *keys,
        value,
        other,
        "n",
        F.sum("n").over(upto).alias("__upto"),
        F.sum("n").over(Window.partitionBy(*keys, value)).alias("__ties"),
    )
    placed = local.join(edges, keys).join(F.broadcast(spans), [*group, value], "left")
    before = F.coalesce("__span_before", F.col("__offset") + F.col("__upto") - F.col("__ties"))
    ties = F.coalesce("__span_ties", "__ties")
    return placed.select(*group, value, other, "n", "rows", (before + (ties + 1) / 2).alias(output))


def tie_sums(counts: DataFrame) -> DataFrame:
    """One row over ``value_counts`` with the tie terms of the rank tests' variances.

    The number of tied pairs is exact (decimal); the cubic terms only feed a variance, as doubles.
    """
    exact = F.col("n").cast("decimal(18,0)")
    t = F.col("n").cast("double")

    def total(term):
        return F.coalesce(F.sum(term), F.lit(0))

    return counts.agg(
        total(F.col("n")).alias("rows"),
        (total(exact * (exact - 1)) / 2).cast("decimal(38,0)").alias("tied_pairs"),
        total(t * t * t - t).alias("cubes"),
        total(t * (t - 1) * (t - 2)).alias("triples"),
        total(t * (t - 1) * (2 * t + 5)).alias("spread"),
    )


def exact_quantiles(
    df: DataFrame, value: str, quantiles: Mapping[str, float], group: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, per group or (one row) over all rows.

    With ``weight``, a column of whole numbers, a row stands for that many equal ones.

    Unlike ``percentile`` no task holds a group's distinct values: each wanted position is found
    among the running counts of the range-partitioned distinct values.
    """
    group = list(group)
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    for name in group:
        rows = rows.filter(F.col(name).isNotNull())
    counts = rows.groupBy(*group, F.col(value).cast("double").alias("__v")).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"))
    placed = running_total(counts, "__v", "n", group)

    def at(position):
        covers = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(covers, F.col("__v")))

    picked = []
    for name, q in quantiles.items():
        exact = F.lit(float(q)) * (F.col("before_total") - 1)
        picked += [
            at(F.floor(exact)).alias(f"__lo_{name}"),
            at(F.ceil(exact)).alias(f"__hi_{name}"),
            F.max(exact - F.floor(exact)).alias(f"__w_{name}"),
        ]
    found = placed.groupBy(*group).agg(*picked)
    return found.select(
        *group,
        *(
            (F.col(f"__lo_{name}") + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * F.col(f"__w_{name}")).alias(name)
            for name in quantiles
        ),
    )
