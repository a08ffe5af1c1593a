"""Normality tests and the gate that picks one by sample size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.functions.tails import shapiro_p, shapiro_weights, skew_kurtosis_z

# Sample sizes and level of the gate.
MIN_ROWS = 3
LARGE_SAMPLE = 5000
LEVEL = 0.05


def as_number(column: str | Column) -> Column:
    """The column as a double, NaN as null."""
    number = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def moments(df: DataFrame, value: str) -> DataFrame:
    """One row: count, mean, variance, skewness and excess kurtosis of the non-null values."""
    v = as_number(value)
    return df.agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.var_pop(v).alias("variance"),
        F.skewness(v).alias("skewness"),
        F.kurtosis(v).alias("kurtosis"),
    )


def omnibus_from_moments(n: int, skewness: float | None, kurtosis: float | None) -> tuple[float | None, float | None]:
    """D'Agostino's K² and its p; ``None`` where the values do not vary."""
    if skewness is None or kurtosis is None or n < 8:
        return None, None
    z_skew, z_kurt = skew_kurtosis_z(n, skewness, kurtosis)
    k2 = z_skew**2 + z_kurt**2
    return k2, math.exp(-k2 / 2)


def shapiro(df: DataFrame, value: str, max_rows: int = LARGE_SAMPLE) -> tuple[float, float] | None:
    """Shapiro-Wilk W and p, for 3 to ``max_rows`` - 1 values.

    The size is checked before anything is sorted, so the un-partitioned window below and the
    weight table are bounded by ``max_rows``.
    """
    values = df.select(as_number(value).alias("v")).filter(F.col("v").isNotNull())
    size = values.agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var")).first()
    n = size["n"]
    if not MIN_ROWS <= n < max_rows:
        raise ValueError(f"Shapiro-Wilk needs {MIN_ROWS} to {max_rows - 1} values, got {n}")
    if size["var"] == 0:
        return 1.0, 1.0
    weights = df.sparkSession.createDataFrame(list(enumerate(shapiro_weights(n), start=1)), "place int, a double")
    ordered = values.withColumn("place", F.row_number().over(Window.orderBy("v")))
    slope = ordered.join(F.broadcast(weights), "place").agg(F.sum(F.col("a") * (F.col("v") - F.lit(size["mean"]))))
    w = min(1.0, slope.first()[0] ** 2 / (n * size["var"]))
    return w, shapiro_p(w, n)


def check_normality(df: DataFrame, value: str, known: dict | None = None) -> dict:
    """too few values → not normal; else Shapiro-Wilk or K² by size, normal iff p > 0.05.

    ``known`` may carry moments (n, skewness, kurtosis) that a caller already has.
    """
    stats = known or moments(df, value).first().asDict()
    n = stats["n"]
    if n < MIN_ROWS:
        return {"n": n, "test": None, "statistic": None, "p_value": 0.0, "is_normal": False}
    if n < LARGE_SAMPLE:
        test, (statistic, p) = "shapiro", shapiro(df, value)
    else:
        test, (statistic, p) = "normaltest", omnibus_from_moments(n, stats["skewness"], stats["kurtosis"])
    return {"n": n, "test": test, "statistic": statistic, "p_value": p, "is_normal": p is not None and p > LEVEL}


NORMALITY_SCHEMA = "name string, n long, test string, statistic double, p_value double, is_normal boolean"


def normality_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """F3 for several columns, one row each."""
    rows = [{"name": c, **check_normality(df, c)} for c in columns]
    order = [part.split()[0] for part in NORMALITY_SCHEMA.split(", ")]
    return df.sparkSession.createDataFrame([tuple(r[k] for k in order) for r in rows], NORMALITY_SCHEMA)
