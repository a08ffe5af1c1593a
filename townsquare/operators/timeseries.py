"""Time-series checks over a daily table.

A daily table has one row per calendar day, so it stays small whatever the number of posts;
windows over it may run un-partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.functions.tails import unit_root_p
from townsquare.runtime import freeze

MIN_DAYS = 7
MIN_DECOMPOSITION_DAYS = 14
LEVEL = 0.05
ADF_SCHEMA = "column string, test_statistic double, p_value double, lags int, n int, is_stationary boolean"


def _gram_matrices(daily: DataFrame, lags: dict[str, int]) -> dict[str, tuple[np.ndarray, int]]:
    """Per column the sums of products X'X and the row count, for regression rows with all lags.

    X holds today's change, 1, yesterday's level and the earlier changes. The products are summed
    in long form, so the plan does not grow with the number of lags.
    """
    by_day = Window.orderBy("day")
    changes, lagged = {}, {}
    for name, depth in lags.items():
        changes[f"{name}_level"] = F.lag(name).over(by_day)
        changes[f"{name}_change"] = F.col(name) - F.lag(name).over(by_day)
        for i in range(1, depth + 1):
            lagged[f"{name}_change{i}"] = F.lag(f"{name}_change", i).over(by_day)
    table = daily.withColumns(changes)
    table = table.withColumns(lagged) if lagged else table
    vectors = []
    for name, depth in lags.items():
        parts = [F.col(f"{name}_change"), F.lit(1.0), F.col(f"{name}_level")]
        parts += [F.col(f"{name}_change{i}") for i in range(1, depth + 1)]
        vectors.append(F.struct(F.lit(name).alias("name"), F.array(*parts).alias("row")))
    rows = table.select(F.inline(F.array(*vectors))).filter(~F.exists("row", lambda v: v.isNull()))
    left = rows.select("name", "row", F.posexplode("row").alias("i", "a"))
    products = left.select("name", "i", "a", F.posexplode("row").alias("j", "b")).filter("j >= i")
    sums = products.groupBy("name", "i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("s"))
    grams = {name: np.zeros((depth + 3, depth + 3)) for name, depth in lags.items()}
    for r in sums.collect():  # (lags + 3)² / 2 rows per column
        grams[r["name"]][r["i"], r["j"]] = grams[r["name"]][r["j"], r["i"]] = r["s"]
    return {name: (gram, round(gram[1, 1])) for name, gram in grams.items()}


def _least_squares(gram: np.ndarray, terms: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients, residual sum of squares and (X'X)⁻¹ for the first ``terms`` regressors."""
    xx, xy = gram[1 : terms + 1, 1 : terms + 1], gram[1 : terms + 1, 0]
    inverse = np.linalg.pinv(xx)
    beta = inverse @ xy
    return beta, max(float(gram[0, 0] - beta @ xy), 0.0), inverse


def dickey_fuller(daily: DataFrame, columns: Sequence[str], max_lag: int | None = None) -> dict[str, dict]:
    """F16: augmented Dickey-Fuller with a constant, lag order by AIC, for several daily columns.

    ``max_lag`` bounds the orders tried; 0 is the plain test.
    """
    daily = freeze(daily.select("day", *(F.col(c).cast("double") for c in columns)))
    facts = daily.agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(c) for c in columns)).first()
    n = facts["n"]
    usual = math.ceil(12 * (n / 100) ** 0.25) if max_lag is None else max_lag
    max_lag = min(n // 2 - 2, usual)
    if max_lag < 0:
        raise ValueError("too few days")
    # Sums of products keep more digits around the mean; the constant absorbs the shift.
    centred = daily.select("day", *((F.col(c) - F.lit(facts[c])).alias(c) for c in columns))
    lags = {}
    for name, (gram, rows) in _gram_matrices(centred, dict.fromkeys(columns, max_lag)).items():
        # Every candidate is a leading block of the same matrix, over the same days.
        lags[name] = min(
            range(max_lag + 1),
            key=lambda k: rows * math.log(max(_least_squares(gram, k + 2)[1], 1e-300) / rows) + 2 * (k + 2),
        )
    results = {}
    for name, (gram, rows) in _gram_matrices(centred, lags).items():
        terms = lags[name] + 2
        beta, residual, inverse = _least_squares(gram, terms)
        variance = residual / (rows - terms) * inverse[1, 1] if rows > terms else 0.0
        t = float(beta[1] / math.sqrt(variance)) if variance > 0 else float("nan")
        p = None if math.isnan(t) else unit_root_p(t)
        results[name] = {"statistic": t, "p_value": p, "lags": lags[name], "n": rows}
    return results


def stationarity(daily: DataFrame, max_lag: int | None = None) -> DataFrame:
    """F16: one row per daily column that varies; needs a week of days."""
    names = [c for c in daily.columns if c != "day"]
    facts = daily.agg(F.count(F.lit(1)).alias("n"), *(F.stddev_samp(c).alias(c) for c in names)).first()
    varying = [c for c in names if facts[c] and facts[c] > 0] if facts["n"] >= MIN_DAYS else []
    results = dickey_fuller(daily, varying, max_lag) if varying else {}
    rows = [
        (name, r["statistic"], r["p_value"], r["lags"], r["n"], r["p_value"] is not None and r["p_value"] < LEVEL)
        for name, r in results.items()
    ]
    return daily.sparkSession.createDataFrame(rows, ADF_SCHEMA)


def decompose(daily: DataFrame, column: str, model: str = "additive", period: int = 7) -> DataFrame:
    """(day, observed, trend, seasonal, resid) by centred moving average; odd ``period``.

    Positions are row numbers of the daily table as given. The trend is null near both ends.
    Fewer than two periods of days give no rows.
    """
    half = period // 2
    by_day = Window.orderBy("day")
    around = by_day.rowsBetween(-half, half)
    v = F.col(column).cast("double")
    days = daily.select(
        "day",
        v.alias("observed"),
        F.when(F.count(v).over(around) == period, F.avg(v).over(around)).alias("trend"),
        ((F.row_number().over(by_day) - 1) % period).alias("phase"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("days"),
    ).filter(F.col("days") >= 2 * period)
    multiplicative = model.startswith("m")
    detrended = F.try_divide("observed", "trend") if multiplicative else F.col("observed") - F.col("trend")
    phases = days.groupBy("phase").agg(F.avg(detrended).alias("mean"))
    centre = F.avg("mean").over(Window.partitionBy())
    seasonal = F.try_divide(F.col("mean"), centre) if multiplicative else F.col("mean") - centre
    # ``period`` rows.
    cycle = F.broadcast(phases.select("phase", seasonal.alias("seasonal")))
    rest = (
        F.try_divide(F.try_divide("observed", "seasonal"), F.col("trend"))
        if multiplicative
        else F.col("observed") - F.col("trend") - F.col("seasonal")
    )
    return days.join(cycle, "phase").select("day", "observed", "trend", "seasonal", rest.alias("resid"))
