"""Row counts, label statistics, fold statistics and request-log summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.operators.align import join_per_key
from modelyard.operators.cumulative import exact_quantiles


def label_summary(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("n_rows"),
        F.min(label).alias("label_min"),
        F.max(label).alias("label_max"),
        F.avg(label).alias("label_mean"),
    )


def score_spread(scores: DataFrame, score: str) -> DataFrame:
    """Mean and population standard deviation."""
    return scores.agg(
        F.count("*").alias("n"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std")
    )


def request_rate(log: DataFrame, ts: str, unit: str = "hour") -> DataFrame:
    """Requests per time unit, for units that had any."""
    return log.groupBy(F.date_trunc(unit, F.col(ts)).alias("at")).agg(F.count("*").alias("requests"))


def request_summary(
    log: DataFrame, ts: str, latency: str, by: list[str], shares: list[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Requests, requests per second, mean latency and exact latency percentiles per group."""
    seconds = F.timestamp_diff("SECOND", F.date_trunc("second", F.min(ts)), F.date_trunc("second", F.max(ts)))
    totals = log.groupBy(*by).agg(
        F.count("*").alias("requests"),
        F.avg(latency).alias("time_per_request"),
        F.nullif(seconds, F.lit(0)).alias("_seconds"),
    )
    percentiles = exact_quantiles(log, latency, list(shares), by).drop("n")
    return join_per_key(totals, percentiles, by, "left").select(
        *by, "requests", (F.col("requests") / F.col("_seconds")).alias("requests_per_second"),
        "time_per_request", *[c for c in percentiles.columns if c not in by],
    )


def approximate_percentiles(
    log: DataFrame, latency: str, by: list[str], shares: list[float] = (0.5, 0.95, 0.99), accuracy: int = 10_000
) -> DataFrame:
    """One-pass estimate for when exact percentiles are not worth a second shuffle."""
    return log.groupBy(*by).agg(F.percentile_approx(latency, list(shares), accuracy).alias("percentiles"))
