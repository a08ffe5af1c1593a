"""Tests that compare groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.functions.filters import source_contains, source_is
from townsquare.functions.tails import chi2_tail, f_tail, mann_whitney_p, t_two_sided
from townsquare.operators.normality import as_number, check_normality
from townsquare.operators.ranks import exact_quantiles, running_total, value_counts

LEVEL = 0.05
MIN_GROUP_ROWS = 5
SENTIMENTS = ("positive", "neutral", "negative")
REPORT_SCHEMA = (
    "name string, statistic double, p_value double, test_used string, levene_p_value double, significant boolean"
)


def grouped_values(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """Rows (g, v) of the named groups with a value."""
    return df.select(F.col(group).alias("g"), as_number(value).alias("v")).filter(
        F.col("g").isin(list(groups)) & F.col("v").isNotNull()
    )


def _f_ratio(values: DataFrame) -> DataFrame:
    per_group = values.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("variance")
    )
    # A row per named group, so the list is short; with it the values are read only once.
    sums = per_group.agg(
        F.count(F.lit(1)).alias("k"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("variance")).alias("within"),
        F.collect_list(F.struct("n", "mean")).alias("groups"),
    )
    spread = F.aggregate("groups", F.lit(0.0), lambda acc, g: acc + g["n"] * F.pow(g["mean"] - F.col("grand"), 2))
    sums = sums.withColumn("between", spread)
    ratio = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))
    )
    separated = (F.col("within") == 0) & (F.col("between") > 0) & (F.col("k") > 1)
    return sums.select("k", "n", F.when(separated, float("inf")).otherwise(ratio).alias("statistic"))


def anova(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """one row (k, n, statistic) with the one-way F, from per-group moments."""
    return _f_ratio(grouped_values(df, group, value, groups))


def levene(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """ANOVA on the distances from the group medians; one row (k, n, statistic)."""
    values = grouped_values(df, group, value, groups)
    medians = exact_quantiles(values, "v", {"median": 0.5}, ["g"])
    # At most one row per name in ``groups``.
    distances = values.join(F.broadcast(medians), "g").select("g", F.abs(F.col("v") - F.col("median")).alias("v"))
    return _f_ratio(distances)


def _rank_sums(values: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row: per group i its size ``n_i`` and rank sum ``r_i``; total ``n`` and ``ties`` Σ(t³-t)."""
    sizes = {f"n_{i}": F.count_if(F.col("g") == name) for i, name in enumerate(groups)}
    counts = running_total(value_counts(values, "v", sizes), "v", "n")
    rank = F.col("before") + (F.col("n") + 1) / 2
    t = F.col("n").cast("double")
    return counts.agg(
        *(F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(groups))),
        *(F.coalesce(F.sum(F.col(f"n_{i}") * rank), F.lit(0.0)).alias(f"r_{i}") for i in range(len(groups))),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(t * t * t - t), F.lit(0.0)).alias("ties"),
    )


def kruskal(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """one row (k, n, statistic) with the tie-corrected H.

    Group sizes are counted per distinct value, so ranks and rank sums come from one table.
    """
    sums = _rank_sums(grouped_values(df, group, value, groups), groups)
    n = F.col("n").cast("double")
    centre = (n + 1) / 2
    spread = sum(
        (
            F.coalesce(
                F.try_divide(
                    F.pow(F.col(f"r_{i}") - F.col(f"n_{i}") * centre, 2), F.col(f"n_{i}").cast("double")
                ),
                F.lit(0.0),
            )
            for i in range(len(groups))
        ),
        F.lit(0.0),
    )
    present = sum(((F.col(f"n_{i}") > 0).cast("int") for i in range(len(groups))), F.lit(0))
    h = F.try_divide(12 * spread, n * (n + 1))
    correction = F.lit(1.0) - F.try_divide(F.col("ties"), n * n * n - n)
    return sums.select(present.alias("k"), "n", F.try_divide(h, correction).alias("statistic"))


def mann_whitney(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """one row with U of the first group, both sizes and the tie term."""
    sums = _rank_sums(grouped_values(df, group, value, groups), groups)
    n1 = F.col("n_0").cast("double")
    return sums.select(
        F.col("n_0").alias("n1"),
        F.col("n_1").alias("n2"),
        (F.col("r_0") - n1 * (n1 + 1) / 2).alias("statistic"),
        "ties",
    )


def welch(df: DataFrame, group: str, value: str, groups: Sequence[str]) -> DataFrame:
    """one row (n1, n2, statistic, df) of the unequal-variance t, from one aggregate."""
    values = grouped_values(df, group, value, groups)
    stats = values.agg(
        *(
            measure(F.when(F.col("g") == name, F.col("v"))).alias(f"{label}{i}")
            for i, name in enumerate(groups, start=1)
            for label, measure in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
        )
    )
    e1, e2 = (F.try_divide(F.col(f"v{i}"), F.col(f"n{i}")) for i in (1, 2))
    freedom = F.try_divide(
        F.pow(e1 + e2, 2),
        F.try_divide(e1 * e1, F.col("n1") - 1) + F.try_divide(e2 * e2, F.col("n2") - 1),
    )
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(e1 + e2))
    return stats.select("n1", "n2", t.alias("statistic"), freedom.alias("df"))


def _f_test(row) -> tuple[float | None, float | None]:
    statistic, k, n = row["statistic"], row["k"], row["n"]
    return statistic, None if statistic is None else f_tail(statistic, k - 1, n - k)


def compare_sentiments(
    df: DataFrame,
    group: str = "sentiment_label",
    value: str = "total_engagement",
    groups: Sequence[str] = SENTIMENTS,
) -> tuple | None:
    """groups with more than five rows; unequal variances → Kruskal-Wallis, else ANOVA."""
    sizes = grouped_values(df, group, value, groups).groupBy("g").count().collect()  # a row per named group
    kept = [g for g in groups if any(row["g"] == g and row["count"] > MIN_GROUP_ROWS for row in sizes)]
    if len(kept) < 2:
        return None
    _, levene_p = _f_test(levene(df, group, value, kept).first())
    if levene_p is not None and levene_p < LEVEL:
        row = kruskal(df, group, value, kept).first()
        statistic, test = row["statistic"], "Kruskal-Wallis (Heteroscedastic)"
        p = None if statistic is None else chi2_tail(statistic, row["k"] - 1)
    else:
        (statistic, p), test = _f_test(anova(df, group, value, kept).first()), "ANOVA (Fisher)"
    return "sentiment_engagement_comparison", statistic, p, test, levene_p, p is not None and p < LEVEL


def _two_platforms(df: DataFrame, value: str) -> DataFrame:
    side = F.when(source_is("twitter"), "twitter").when(source_contains("reddit"), "reddit")
    return df.select(side.alias("side"), as_number(value).alias("v"))


def compare_platforms(df: DataFrame, value: str = "engagement_rate") -> tuple | None:
    """Twitter-like against Reddit-like rows; both normal → Welch, else Mann-Whitney."""
    sides, names = _two_platforms(df, value), ("twitter", "reddit")
    per_side = sides.filter("side is not null and v is not null").groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis")
    )
    known = {row["side"]: row.asDict() for row in per_side.collect()}  # two rows at most
    if any(known.get(s, {"n": 0})["n"] <= MIN_GROUP_ROWS for s in names):
        return None
    normal = all(check_normality(sides.filter(F.col("side") == s), "v", known[s])["is_normal"] for s in names)
    if normal:
        row, test = welch(sides, "side", "v", names).first(), "Welch's T-test"
        p = None if row["statistic"] is None else t_two_sided(row["statistic"], row["df"])
    else:
        row, test = mann_whitney(sides, "side", "v", names).first(), "Mann-Whitney U"
        p = mann_whitney_p(row["statistic"], row["n1"], row["n2"], row["ties"])
    return "platform_engagement_comparison", row["statistic"], p, test, None, p is not None and p < LEVEL


def statistical_tests(df: DataFrame, anova: bool = True, ttest: bool = True) -> DataFrame:
    """F12 and F15 as report rows; a comparison that lacks columns or rows has none."""
    columns = set(df.columns)
    rows = []
    if anova and {"sentiment_label", "total_engagement"} <= columns:
        rows.append(compare_sentiments(df))
    if ttest and {"data_source", "engagement_rate"} <= columns:
        rows.append(compare_platforms(df))
    return df.sparkSession.createDataFrame([row for row in rows if row], REPORT_SCHEMA)
