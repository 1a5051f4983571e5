"""Classification metrics.

All label metrics start from the (label, prediction) counts, which shrink any
number of rows to at most classes squared; rows are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.operators.cumulative import running_totals

# Fixed value: how close to 0 or 1 a probability may come in the log loss
# (the spacing of double precision numbers at 1).
PROBABILITY_EPSILON = 2.220446049250313e-16


def ratio(top: Column, bottom: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def accuracy(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def binary_metrics(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 of the positive class, in one pass."""
    y, p = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    counted = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) for the pairs that occur."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row per class that occurs as a label or as a prediction."""
    pairs = confusion_counts(df, label, prediction)
    n, hit = F.col("n"), F.col("label") == F.col("prediction")
    none = F.lit(0).cast("bigint")
    as_label = F.struct(
        F.col("label").alias("class"), F.when(hit, n).otherwise(none).alias("tp"),
        n.alias("support"), none.alias("predicted"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), none.alias("tp"), none.alias("support"), n.alias("predicted")
    )
    sums = (
        pairs.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.withColumns(
        {
            "precision": ratio(tp, predicted),
            "recall": ratio(tp, support),
            "f1": ratio(2 * tp, support + predicted),
        }
    )


def averaged_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy with macro, micro and weighted precision, recall and F1, in one row."""
    tp, support, predicted = F.sum("tp"), F.sum("support"), F.sum("predicted")
    columns = [support.alias("n"), ratio(tp, support).alias("accuracy")]
    for name in ("precision", "recall", "f1"):
        columns.append(F.avg(name).alias(f"macro_{name}"))
        columns.append(ratio(F.sum(F.col(name) * F.col("support")), support).alias(f"weighted_{name}"))
    columns += [
        ratio(tp, predicted).alias("micro_precision"),
        ratio(tp, support).alias("micro_recall"),
        ratio(2 * tp, support + predicted).alias("micro_f1"),
    ]
    return class_metrics(df, label, prediction).agg(*columns)


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Class rows, then the accuracy, macro and weighted rows, as (entry, precision, recall, f1, support)."""
    per_class = class_metrics(df, label, prediction)
    classes = per_class.select(
        F.col("class").cast("string").alias("entry"), "precision", "recall", "f1", "support"
    )
    blank = F.lit(None).cast("double")
    overall = averaged_metrics(df, label, prediction).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("entry"), blank.alias("precision"), blank.alias("recall"),
                    F.col("accuracy").alias("f1"), F.col("n").alias("support"),
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("entry"),
                        F.col(f"{kind}_precision").alias("precision"),
                        F.col(f"{kind}_recall").alias("recall"),
                        F.col(f"{kind}_f1").alias("f1"),
                        F.col("n").alias("support"),
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.unionByName(overall)


def confusion_wide(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """One row per label, one count column per listed class, and ``other``, the
    predictions of any class not listed (null ones included)."""
    counts = confusion_counts(df, label, prediction)
    listed = F.coalesce(F.col("prediction").isin(classes), F.lit(False))
    columns = [F.coalesce(F.sum(F.when(F.col("prediction") == F.lit(c), F.col("n"))), F.lit(0)).alias(str(c)) for c in classes]
    return counts.groupBy("label").agg(*columns, F.coalesce(F.sum(F.when(~listed, F.col("n"))), F.lit(0)).alias("other"))


def confusion_json(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The dense matrix as one JSON text, rows and columns in class order.

    The text has a cell for each pair of classes, which is its size whatever the
    rows; ``confusion_counts`` has the same numbers as a table.
    """
    pairs = confusion_counts(df, label, prediction)
    names = pairs.select(F.explode(F.array("label", "prediction")).alias("class")).distinct()
    classes = sorted(r["class"] for r in names.collect())
    by_label = pairs.groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("counts")
    )
    rows = by_label.agg(F.map_from_entries(F.collect_list(F.struct("label", "counts"))).alias("rows"))
    order = F.array(*[F.lit(c) for c in classes])
    cell = lambda y, p: F.coalesce(F.try_element_at(F.try_element_at(F.col("rows"), y), p), F.lit(0))
    matrix = F.transform(order, lambda y: F.transform(order, lambda p: cell(y, p)))
    return rows.select(F.to_json(matrix).alias("matrix"))


def log_loss(df: DataFrame, label: str, probability: str) -> DataFrame:
    eps = PROBABILITY_EPSILON
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def _score_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label).cast("bigint")
    scored = df.select(F.col(score).alias("score"), y.alias("pos"), (1 - y).alias("neg"))
    return running_totals(scored, "score", ["pos", "neg"])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half.

    Null when either class is absent.
    """
    totals = _score_totals(df, label, score)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = F.sum(pos * (F.col("neg_upto").cast("double") - neg / 2))
    return totals.agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), won.alias("_won")
    ).select(
        "n_pos", "n_neg",
        (F.col("_won") / F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))).alias("roc_auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tpr, fpr) for every distinct score: what "score >= threshold" reaches."""
    totals = _score_totals(df, label, score)
    sizes = df.filter(F.col(score).isNotNull()).agg(
        F.struct(
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
        ).alias("sizes")
    )
    at_or_above = {
        m: F.col("sizes")[m] - F.col(f"{m}_upto") + F.col(m) for m in ("pos", "neg")
    }
    return totals.withColumn("sizes", sizes.scalar()).select(
        F.col("score").alias("threshold"),
        ratio(at_or_above["pos"], F.col("sizes")["pos"]).alias("tpr"),
        ratio(at_or_above["neg"], F.col("sizes")["neg"]).alias("fpr"),
    )


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the precision-recall steps: the precision at each distinct
    score, weighted by the share of positives that score adds. Null without positives."""
    totals = _score_totals(df, label, score)
    sizes = df.filter(F.col(score).isNotNull()).agg(
        F.struct(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n")).alias("sizes")
    )
    found = F.col("sizes.pos") - F.col("pos_upto") + F.col("pos")
    taken = F.col("sizes.n") - F.col("pos_upto") - F.col("neg_upto") + F.col("pos") + F.col("neg")
    share = F.col("pos") / F.nullif("sizes.pos", F.lit(0))
    return totals.withColumn("sizes", sizes.scalar()).agg(
        F.sum(share * ratio(found, taken)).alias("average_precision")
    )
