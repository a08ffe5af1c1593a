"""Correlations: Pearson, Spearman, Kendall and the distribution-aware choice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.functions.filters import complete_pairs, source_contains
from townsquare.functions.tails import correlation_p, kendall_p
from townsquare.operators.normality import as_number, check_normality
from townsquare.operators.ranks import rank_pairs, running_total, tie_sums

METHODS = ("pearson", "spearman", "kendall")
LEVEL = 0.05
REPORT_SCHEMA = "name string, n long, correlation double, p_value double, method_used string, significant boolean"


def _ratio(covariance, x_spread, y_spread):
    """Null instead of a division by zero when a side does not vary."""
    r = F.try_divide(covariance, F.sqrt(x_spread) * F.sqrt(y_spread))
    # least and greatest skip nulls, so an undefined value has to be kept apart.
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """one row (n, correlation) over complete pairs, from one partial aggregate."""
    return (
        complete_pairs(df, x, y)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.covar_pop("x", "y").alias("c"),
            F.var_pop("x").alias("vx"),
            F.var_pop("y").alias("vy"),
        )
        .select("n", _ratio(F.col("c"), F.col("vx"), F.col("vy")).alias("correlation"))
    )


def _pair_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    return complete_pairs(df, x, y).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def _long_pairs(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows (name, x, y): every named pair's complete cases."""
    sides = [
        F.struct(F.lit(name).alias("name"), as_number(x).alias("x"), as_number(y).alias("y"))
        for name, (x, y) in pairs.items()
    ]
    return df.select(F.inline(F.array(*sides))).dropna(subset=["x", "y"])


def spearman_all(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """F5 for all named pairs at once: rows (name, n, correlation), Pearson over average ranks.

    Equal pairs collapse first. x is ranked over (name, x, y) range partitions; the rank sums are
    then combined per y, which leaves one row per distinct y to rank. No join on a data value is
    made, and the number of jobs does not grow with the number of pairs.
    """
    counts = _long_pairs(df, pairs).groupBy("name", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    by_x = rank_pairs(counts, "x", "y", "rank_x", ["name"])
    off_x = F.col("rank_x") - (F.col("rows") + 1) / 2
    per_y = by_x.groupBy("name", "y").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * off_x).alias("s"),
        F.sum(F.col("n") * off_x * off_x).alias("q"),
    )
    by_y = running_total(per_y, "y", "n", ["name"])
    off_y = F.col("before") + (F.col("n") + 1) / 2 - (F.col("before_total") + 1) / 2
    return by_y.groupBy("name").agg(
        F.sum("n").alias("n"),
        _ratio(F.sum(F.col("s") * off_y), F.sum("q"), F.sum(F.col("n") * off_y * off_y)).alias("correlation"),
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """F5 for one pair: one row (n, correlation), or none without complete pairs."""
    return spearman_all(df, {"pair": (x, y)}).select("n", "correlation")


def kendall(df: DataFrame, x: str, y: str) -> DataFrame:
    """one row with n, concordant and discordant pairs, tie terms and τ-b.

    Pairs of rows are never formed. y's rank is written in binary; two rows with different y first
    differ at one bit, so per bit the rows sharing the higher bits are sorted by x and each row
    with a 1 counts the rows with a 0 and a smaller x by a running total. That is one sort of
    (distinct pairs × bits of the row count).
    """
    pairs = _pair_counts(df, x, y)
    ranked = rank_pairs(pairs, "y", "x", "rank_y").withColumn("code", (F.col("rank_y") * 2).cast("long"))
    # Twice the largest rank is below 2 · rows + 1, hence this many bits.
    bits = F.ceil(F.log2(2 * F.col("rows") + 2)).cast("int")
    levels = ranked.withColumn("level", F.explode(F.sequence(F.lit(0), bits - 1)))
    prefix = F.call_function("shiftright", F.call_function("shiftright", F.col("code"), F.col("level")), F.lit(1))
    one = F.call_function("shiftright", F.col("code"), F.col("level")).bitwiseAND(F.lit(1)) == 1
    sides = (
        levels.select("level", prefix.alias("prefix"), "x", "n", one.alias("one"))
        .groupBy("level", "prefix", "x")
        .agg(
            F.sum(F.when(~F.col("one"), F.col("n")).otherwise(0)).alias("zeros"),
            F.sum(F.when(F.col("one"), F.col("n")).otherwise(0)).alias("ones"),
        )
    )
    below = running_total(sides, "x", "zeros", ["level", "prefix"])
    exact = "decimal(18,0)"
    concordant = below.agg(
        F.coalesce(F.sum(F.col("ones").cast(exact) * F.col("before").cast(exact)), F.lit(0))
        .cast("decimal(38,0)")
        .alias("concordant")
    )
    per_x = tie_sums(pairs.groupBy("x").agg(F.sum("n").alias("n")))
    per_y = tie_sums(pairs.groupBy("y").agg(F.sum("n").alias("n")))
    both = tie_sums(pairs)
    names = ("tied_pairs", "triples", "spread")
    row = both.select(
        F.col("rows").alias("n"),
        F.col("tied_pairs").alias("both_tied_pairs"),
        *(per_x.select(c).scalar().alias(f"x_{c}") for c in names),
        *(per_y.select(c).scalar().alias(f"y_{c}") for c in names),
        concordant.scalar().alias("concordant"),
    )
    total = (F.col("n").cast(exact) * (F.col("n").cast(exact) - 1) / 2).cast("decimal(38,0)")
    untied = row.withColumn("pairs", total).withColumn(
        "discordant",
        (
            F.col("pairs")
            - F.col("x_tied_pairs")
            - F.col("y_tied_pairs")
            + F.col("both_tied_pairs")
            - F.col("concordant")
        ).cast("decimal(38,0)"),
    )
    free = [(F.col("pairs") - F.col(f"{side}_tied_pairs")).cast("double") for side in ("x", "y")]
    return untied.withColumn(
        "correlation",
        _ratio(F.col("concordant").cast("double") - F.col("discordant").cast("double"), *free),
    )


def _pair_moments(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> dict[str, dict]:
    """Counts, variances, shape and covariance of every pair's complete cases, in one scan.

    One grouped aggregate in long form: a column per pair and measure would outgrow what the JVM
    is willing to compile.
    """
    facts = (
        _long_pairs(df, pairs)
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.covar_pop("x", "y").alias("covariance"),
            *(
                measure(side).alias(f"{side}_{measure.__name__}")
                for side in ("x", "y")
                for measure in (F.var_pop, F.skewness, F.kurtosis)
            ),
        )
    )
    found = {row["name"]: row.asDict() for row in facts.collect()}  # a row per named pair
    return {name: found.get(name, {"n": 0}) for name in pairs}


def _choose_method(df: DataFrame, x: str, y: str, stats: dict) -> str:
    pair = complete_pairs(df, x, y)
    for side in ("x", "y"):
        known = {"n": stats["n"], "skewness": stats[f"{side}_skewness"], "kurtosis": stats[f"{side}_kurtosis"]}
        if not check_normality(pair, side, known)["is_normal"]:
            return "spearman"
    return "pearson"


def _pearson_from(stats: dict) -> float | None:
    spread = (stats["x_var_pop"] * stats["y_var_pop"]) ** 0.5
    return max(-1.0, min(1.0, stats["covariance"] / spread)) if spread > 0 else None


def _kendall_with_p(df: DataFrame, x: str, y: str, n: int) -> tuple[float | None, float | None]:
    row = kendall(df, x, y).first()
    if row["correlation"] is None:
        return None, None
    ties = [tuple(float(row[f"{s}_{c}"]) for c in ("tied_pairs", "triples", "spread")) for s in ("x", "y")]
    return row["correlation"], kendall_p(int(row["concordant"]), int(row["discordant"]), n, *ties)


def correlation_report(df: DataFrame, pairs: Mapping[str, tuple[str, str]], method: str | None = None) -> DataFrame:
    """F7 for every named pair: Pearson if both sides look normal, else Spearman, unless overridden.

    One scan yields the moments of all pairs (and so every Pearson); the pairs that need ranks are
    ranked together. Later steps scan ``df`` again, so pass a stored table, not a costly plan. A
    pair with fewer than two complete cases has no row.
    """
    stats = _pair_moments(df, pairs) if pairs else {}
    usable = {name: pair for name, pair in pairs.items() if stats[name]["n"] >= 2}
    methods = {name: method or _choose_method(df, *pair, stats[name]) for name, pair in usable.items()}
    ranked = {name: usable[name] for name in usable if methods[name] == "spearman"}
    # One row per named pair.
    rho = {row["name"]: row["correlation"] for row in spearman_all(df, ranked).collect()} if ranked else {}
    rows = []
    for name, (x, y) in usable.items():
        n, used = stats[name]["n"], methods[name]
        if used == "pearson":
            r = _pearson_from(stats[name])
            p = correlation_p(r, n)
        elif used == "spearman":
            r = rho[name]
            p = correlation_p(r, n) if n > 2 else None
        elif used == "kendall":
            r, p = _kendall_with_p(df, x, y, n)
        else:
            continue
        rows.append((name, n, r, p, used, p is not None and p < LEVEL))
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def optimal_correlation(df: DataFrame, x: str, y: str, method: str | None = None, name: str | None = None) -> DataFrame:
    """F7 for one pair."""
    return correlation_report(df, {name or f"{x}_vs_{y}": (x, y)}, method)


def named_pairs(
    df: DataFrame,
    volume_vs_engagement: bool = True,
    influencer_activity_vs_virality: bool = True,
    sentiment_vs_commercial_metrics: bool = False,
) -> dict[str, tuple[str, str]]:
    """F8: the switchable set of pairs, limited to columns the table has."""
    pairs = {}
    columns = set(df.columns)
    if volume_vs_engagement and {"word_count", "reddit_engagement"} <= columns:
        pairs["volume_vs_engagement"] = ("word_count", "reddit_engagement")
    if influencer_activity_vs_virality and {"user_followers_count", "total_engagement"} <= columns:
        pairs["influencer_virality"] = ("user_followers_count", "total_engagement")
    if sentiment_vs_commercial_metrics:
        numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        for sentiment in (c for c in numeric if "sentiment" in c or "vader_compound" in c):
            for engagement in (c for c in numeric if "engagement" in c.lower()):
                pairs[f"{sentiment}_vs_{engagement}"] = (sentiment, engagement)
    return pairs


def compute_correlations(df: DataFrame, **switches: bool) -> DataFrame:
    """F8: the named correlation set."""
    return correlation_report(df, named_pairs(df, **switches))


def reddit_volume_correlation(df: DataFrame, min_rows: int = 5) -> DataFrame:
    """word count against engagement over the Reddit-like rows, if there are more than five."""
    rows = df.filter(source_contains("reddit", ignore_case=False))
    if len(rows.limit(min_rows + 1).collect()) <= min_rows:
        return correlation_report(df, {})
    return optimal_correlation(rows, "word_count", "reddit_engagement", name="volume_vs_engagement")


def cross_platform_correlation(pivoted: DataFrame, platforms: Iterable[str]) -> DataFrame:
    """correlation of the first two platforms (alphabetically) of a platform pivot."""
    first_two = sorted(platforms)[:2]
    if len(first_two) < 2:
        return correlation_report(pivoted, {})
    return optimal_correlation(pivoted, *first_two, name="_vs_".join(first_two))
