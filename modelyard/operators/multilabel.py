"""Metrics on label sets and on rankings, computed from arrays inside each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.functions.scalars import bind


def _overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def label_set_metrics(df: DataFrame, truth: str, predicted: str, n_labels: int) -> DataFrame:
    """Subset accuracy, Hamming loss and mean Jaccard score."""
    y, p = F.array_distinct(truth), F.array_distinct(predicted)
    both, either = _overlap(y, p), F.size(F.array_union(y, p))
    return df.agg(
        F.count("*").alias("n"),
        F.avg((both == either).cast("double")).alias("subset_accuracy"),
        F.avg((either - both) / F.lit(n_labels)).alias("hamming_loss"),
        F.avg(F.when(either > 0, both / F.nullif(either, F.lit(0))).otherwise(1.0)).alias("jaccard"),
    )


def label_confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """tp, fp, fn, tn of every label that occurs in either set."""
    y, p = F.array_distinct(truth), F.array_distinct(predicted)
    one, none = F.lit(1), F.lit(0)
    marks = F.transform(
        F.array_union(y, p),
        lambda c: F.struct(
            c.alias("label"),
            F.when(F.array_contains(y, c), one).otherwise(none).alias("in_truth"),
            F.when(F.array_contains(p, c), one).otherwise(none).alias("in_predicted"),
        ),
    )
    rows = df.agg(F.count("*").alias("n"))
    sums = df.select(F.inline(marks)).groupBy("label").agg(
        F.sum(F.col("in_truth") * F.col("in_predicted")).alias("tp"),
        F.sum((1 - F.col("in_truth")) * F.col("in_predicted")).alias("fp"),
        F.sum(F.col("in_truth") * (1 - F.col("in_predicted"))).alias("fn"),
    )
    return sums.withColumn("tn", rows.scalar() - F.col("tp") - F.col("fp") - F.col("fn"))


def binarized(df: DataFrame, labels: str, classes: list[str]) -> DataFrame:
    """One 0/1 column per class."""
    return df.withColumns({c: F.array_contains(labels, c).cast("int") for c in classes})


def precision_at(ranked: Column, relevant: Column, k: int) -> Column:
    return _overlap(F.slice(ranked, 1, k), relevant) / F.lit(float(k))


def average_precision(ranked: Column, relevant: Column) -> Column:
    """Mean over the relevant items of the precision where each one is found; 0 without any."""
    hits = F.transform(ranked, lambda x: F.array_contains(relevant, x).cast("int"))
    walked = F.aggregate(
        hits,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("found"), F.lit(0.0).alias("total")),
        lambda s, h: F.struct(
            (s["at"] + 1).alias("at"),
            (s["found"] + h).alias("found"),
            (s["total"] + F.when(h == 1, (s["found"] + 1) / (s["at"] + 1)).otherwise(0.0)).alias("total"),
        ),
    )
    n = F.size(F.array_distinct(relevant))
    return F.when(n > 0, walked["total"] / F.nullif(n, F.lit(0))).otherwise(0.0)


def ndcg_at(ranked: Column, relevant: Column, k: int) -> Column:
    """Discounted gain of the first k items over the best possible, items being relevant or not."""

    def gain(n: Column, weight) -> Column:
        steps = F.sequence(F.lit(1), n)
        return F.aggregate(steps, F.lit(0.0), lambda s, i: s + weight(i) / F.log2(i + 1))

    found = lambda i: F.array_contains(relevant, F.get(ranked, i - 1)).cast("double")
    best = F.least(F.size(F.array_distinct(relevant)), F.lit(k))
    reached = F.least(F.size(ranked), F.lit(k))
    return F.when(
        (best > 0) & (reached > 0), gain(reached, found) / gain(best, lambda i: F.lit(1.0))
    ).otherwise(0.0)


def ranking_metrics(df: DataFrame, ranked: str, relevant: str, k: int) -> DataFrame:
    """Precision at k, mean average precision and NDCG at k over all rows."""

    def measured(pair: Column) -> Column:
        r, t = pair["ranked"], pair["relevant"]
        return F.struct(
            precision_at(r, t, k).alias("precision"),
            average_precision(r, t).alias("average"),
            ndcg_at(r, t, k).alias("ndcg"),
        )

    # Both lists are evaluated once per row, however often the metrics look at them.
    pair = F.struct(F.col(ranked).alias("ranked"), F.col(relevant).alias("relevant"))
    return df.select(bind(pair, measured).alias("m")).agg(
        F.count("*").alias("n"),
        F.avg("m.precision").alias("precision_at_k"),
        F.avg("m.average").alias("map"),
        F.avg("m.ndcg").alias("ndcg_at_k"),
    )
