"""Regression metrics and residuals, each from a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: list[str] | None = None
) -> DataFrame:
    """MAE, MSE, RMSE, R2, MSLE and RMSLE.

    The spread around the mean in R2 comes from ``var_pop``, whose partial
    results merge without subtracting large sums. The logarithmic errors are
    null when any value is -1 or below.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = df.filter(y.isNotNull() & p.isNotNull())
    error = y - p
    log_ok = (y > -1) & (p > -1)
    log_error = F.when(log_ok, F.log1p(y) - F.log1p(p))
    squared, spread = F.sum(error * error), F.var_pop(y) * F.count("*")
    msle = F.when(F.every(log_ok), F.avg(log_error * log_error))
    r2 = (
        F.when(spread > 0, 1 - squared / spread).when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return both.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r2.alias("r2"),
        msle.alias("msle"),
        F.sqrt(msle).alias("rmsle"),
    )


def with_residual(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.withColumn("residual", F.col(label) - F.col(prediction))


def residual_bin(residual: Column, low: float, high: float, bins: int) -> Column:
    return F.width_bucket(residual, F.lit(float(low)), F.lit(float(high)), F.lit(bins))


def residual_histogram(
    df: DataFrame, label: str, prediction: str, low: float, high: float, bins: int = 20
) -> DataFrame:
    """Counts per residual bin; bins 0 and bins+1 hold what lies outside the range."""
    binned = with_residual(df, label, prediction).select(
        residual_bin(F.col("residual"), low, high, bins).alias("bin"), "residual"
    )
    return binned.groupBy("bin").agg(
        F.count("*").alias("n"), F.min("residual").alias("lowest"), F.max("residual").alias("highest")
    )
