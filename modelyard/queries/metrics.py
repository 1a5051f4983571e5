"""Summaries and metrics."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.functions.keys import fold_number
from modelyard.functions.scalars import argmax
from modelyard.operators.classification import (
    accuracy,
    average_precision,
    averaged_metrics,
    binary_metrics,
    class_metrics,
    classification_report,
    confusion_counts,
    confusion_json,
    confusion_wide,
    log_loss,
    roc_auc,
    roc_curve,
)
from modelyard.operators.cumulative import exact_quantiles, running_totals
from modelyard.operators.multilabel import binarized, label_confusion, label_set_metrics, ranking_metrics
from modelyard.operators.registry import leaderboard
from modelyard.operators.regression import regression_metrics, residual_histogram, with_residual
from modelyard.operators.report import markdown_table
from modelyard.operators.splits import with_hash_split
from modelyard.operators.summary import approximate_percentiles, label_summary, request_rate, request_summary, score_spread
from modelyard.queries import query, rounded, table

# --- inputs shared by several queries ----------------------------------------

BINARY = """b AS (SELECT doc_id, quality AS y, (n_chars > 2000)::INTEGER AS p, n_chars / (n_chars + 2000.0::DOUBLE) AS s
                  FROM documents JOIN labels USING (doc_id))"""
MULTI = """m AS (SELECT label AS y, (list_position(embedding, list_max(embedding)) - 1) % 10 AS p FROM embeddings)"""
PAIRS = """c AS (SELECT y, p, count(*) AS n FROM m GROUP BY 1, 2),
    k AS (SELECT y AS class FROM c UNION SELECT p FROM c),
    s AS (SELECT class,
            coalesce((SELECT sum(n) FROM c WHERE y = class AND p = class), 0)::BIGINT AS tp,
            coalesce((SELECT sum(n) FROM c WHERE y = class), 0)::BIGINT AS support,
            coalesce((SELECT sum(n) FROM c WHERE p = class), 0)::BIGINT AS predicted FROM k),
    r AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
            CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
            CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1 FROM s)"""


def binary_scores(spark, folder) -> DataFrame:
    n = F.col("n_chars")
    documents = table(spark, folder, "documents").select(
        "doc_id", (n > 2000).cast("int").alias("p"), (n / (n + F.lit(2000.0))).alias("s")
    )
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    return documents.join(labels, "doc_id")


def class_predictions(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("label").alias("y"), (argmax(F.col("embedding")) % 10).alias("p")
    )


def priced_lines(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("prediction", F.col("l_quantity") * 1500)


# --- counts and statistics -----------------------------------------------------


@query(
    "split_statistics",
    "A1 A2",
    """SELECT CASE WHEN substr(md5(concat_ws(':', '42', o_orderkey::VARCHAR)), 1, 8) < '33333333'
                   THEN 'test' ELSE 'train' END AS split,
              count(*) AS n_rows, min(o_totalprice) AS label_min, max(o_totalprice) AS label_max,
              round(avg(o_totalprice), 4) AS label_mean FROM orders GROUP BY 1""",
)
def split_statistics(spark, folder):
    marked = with_hash_split(table(spark, folder, "orders"), ["o_orderkey"])
    return rounded(label_summary(marked, "o_totalprice", ["split"]), 4)


FOLDS = """f AS (SELECT (('0x' || substr(md5(concat_ws(':', '42', doc_id::VARCHAR)), 1, 15))::BIGINT % 5)::INTEGER AS fold, y, p FROM b)"""


@query(
    "fold_accuracy",
    "M19 A4",
    f"WITH {BINARY}, {FOLDS} SELECT fold, count(*) AS n, round(avg((y = p)::INTEGER), 6) AS accuracy FROM f GROUP BY fold",
)
def fold_accuracy(spark, folder):
    folded = binary_scores(spark, folder).withColumn("fold", fold_number(42, 5, "doc_id"))
    return rounded(accuracy(folded, "y", "p", ["fold"]))


@query(
    "fold_accuracy_spread",
    "A3 M19",
    f"""WITH {BINARY}, {FOLDS}, a AS (SELECT fold, avg((y = p)::INTEGER) AS accuracy FROM f GROUP BY fold)
        SELECT count(*) AS n, round(avg(accuracy), 6) AS mean, round(stddev_pop(accuracy), 6) AS std FROM a""",
)
def fold_accuracy_spread(spark, folder):
    folded = binary_scores(spark, folder).withColumn("fold", fold_number(42, 5, "doc_id"))
    return rounded(score_spread(accuracy(folded, "y", "p", ["fold"]), "accuracy"))


# --- binary ----------------------------------------------------------------------


@query(
    "binary_metrics",
    "A4 A5",
    f"""WITH {BINARY}, c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND p = 1) AS fp,
                count(*) FILTER (WHERE y = 1 AND p <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND p <> 1) AS tn FROM b)
        SELECT tp, fp, fn, tn, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
               round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
               round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
               round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM c""",
)
def binary(spark, folder):
    return rounded(binary_metrics(binary_scores(spark, folder), "y", "p"))


@query(
    "log_loss",
    "A11",
    f"""WITH {BINARY}, q AS (SELECT y, least(greatest(s, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS s FROM b)
        SELECT round(-avg(y * ln(s) + (1 - y) * ln(1 - s)), 6) AS log_loss FROM q""",
)
def log_loss_(spark, folder):
    return rounded(log_loss(binary_scores(spark, folder), "y", "s"))


@query(
    "roc_auc",
    "A12 W4",
    f"""WITH {BINARY}, d AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY s),
             t AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg AS below FROM d)
        SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
               round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos) * sum(neg)), 6) AS roc_auc FROM t""",
)
def roc_auc_(spark, folder):
    return rounded(roc_auc(binary_scores(spark, folder), "y", "s"))


@query(
    "roc_curve",
    "A13 W4",
    f"""WITH {BINARY}, d AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY s)
        SELECT round(s, 6) AS threshold,
               round(sum(pos) OVER (ORDER BY s DESC) / sum(pos) OVER (), 6) AS tpr,
               round(sum(neg) OVER (ORDER BY s DESC) / sum(neg) OVER (), 6) AS fpr FROM d""",
)
def roc_curve_(spark, folder):
    return rounded(roc_curve(binary_scores(spark, folder), "y", "s"))


@query(
    "average_precision",
    "K2 W4",
    f"""WITH {BINARY}, d AS (SELECT s, sum(y) AS pos, count(*) AS n FROM b GROUP BY s),
             t AS (SELECT pos, sum(pos) OVER w AS found, sum(n) OVER w AS taken, sum(pos) OVER () AS total
                   FROM d WINDOW w AS (ORDER BY s DESC))
        SELECT round(sum(pos / total * found / taken), 6) AS average_precision FROM t""",
)
def average_precision_(spark, folder):
    return rounded(average_precision(binary_scores(spark, folder), "y", "s"))


# --- multi-class -------------------------------------------------------------------


@query("accuracy", "A4", f"WITH {MULTI} SELECT count(*) AS n, round(avg((y = p)::INTEGER), 6) AS accuracy FROM m")
def accuracy_(spark, folder):
    return rounded(accuracy(class_predictions(spark, folder), "y", "p"))


@query("confusion_counts", "A10", f"WITH {MULTI} SELECT y AS label, p AS prediction, count(*) AS n FROM m GROUP BY 1, 2")
def confusion(spark, folder):
    return confusion_counts(class_predictions(spark, folder), "y", "p")


@query(
    "confusion_wide",
    "A10",
    f"WITH {MULTI} SELECT y AS label, "
    + ", ".join(f"count(*) FILTER (WHERE p = {c}) AS \"{c}\"" for c in range(10))
    + ", count(*) FILTER (WHERE coalesce(p NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9), true)) AS other FROM m GROUP BY 1",
)
def confusion_wide_(spark, folder):
    return confusion_wide(class_predictions(spark, folder), "y", "p", list(range(10)))


@query(
    "confusion_json",
    "A10",
    f"""WITH {MULTI}, {PAIRS},
        cell AS (SELECT a.class AS y, b.class AS p, coalesce(c.n, 0) AS n
                 FROM k a CROSS JOIN k b LEFT JOIN c ON c.y = a.class AND c.p = b.class),
        line AS (SELECT y, '[' || string_agg(n::VARCHAR, ',' ORDER BY p) || ']' AS line FROM cell GROUP BY y)
        SELECT '[' || string_agg(line, ',' ORDER BY y) || ']' AS matrix FROM line""",
)
def confusion_json_(spark, folder):
    return confusion_json(class_predictions(spark, folder), "y", "p")


@query(
    "class_metrics",
    "A6 A9",
    f"""WITH {MULTI}, {PAIRS}
        SELECT class, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM r""",
)
def class_metrics_(spark, folder):
    return rounded(class_metrics(class_predictions(spark, folder), "y", "p"))


AVERAGES = """SELECT sum(support)::BIGINT AS n, round(sum(tp) / sum(support), 6) AS accuracy,
   round(avg(precision), 6) AS macro_precision, round(sum(precision * support) / sum(support), 6) AS weighted_precision,
   round(avg(recall), 6) AS macro_recall, round(sum(recall * support) / sum(support), 6) AS weighted_recall,
   round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
   round(sum(tp) / sum(predicted), 6) AS micro_precision, round(sum(tp) / sum(support), 6) AS micro_recall,
   round(2 * sum(tp) / (sum(support) + sum(predicted)), 6) AS micro_f1 FROM r"""


@query("averaged_metrics", "A6 A7 A8", f"WITH {MULTI}, {PAIRS} {AVERAGES}")
def averaged_metrics_(spark, folder):
    return rounded(averaged_metrics(class_predictions(spark, folder), "y", "p"))


@query(
    "classification_report",
    "A9",
    f"""WITH {MULTI}, {PAIRS}, a AS ({AVERAGES})
        SELECT class::VARCHAR AS entry, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r
        UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, n FROM a
        UNION ALL SELECT 'macro avg', macro_precision, macro_recall, macro_f1, n FROM a
        UNION ALL SELECT 'weighted avg', weighted_precision, weighted_recall, weighted_f1, n FROM a""",
)
def classification_report_(spark, folder):
    return rounded(classification_report(class_predictions(spark, folder), "y", "p"))


# --- regression ----------------------------------------------------------------------

LINES = "l AS (SELECT *, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)"


@query(
    "regression_metrics",
    "A14 A15 A16 A17 M20",
    f"""WITH {LINES}, m AS (SELECT l_returnflag AS flag, avg(y) AS ybar FROM l GROUP BY 1)
        SELECT l_returnflag, count(*) AS n, round(avg(abs(y - p)), 4) AS mae,
               round(avg(power((y - p) / 1000, 2)), 4) AS mse_thousands,
               round(sqrt(avg(power(y - p, 2))), 4) AS rmse,
               round(1 - sum(power(y - p, 2)) / sum(power(y - ybar, 2)), 6) AS r2,
               round(avg(power(ln(1 + y) - ln(1 + p), 2)), 6) AS msle,
               round(sqrt(avg(power(ln(1 + y) - ln(1 + p), 2))), 6) AS rmsle
        FROM l JOIN m ON flag = l_returnflag GROUP BY l_returnflag""",
)
def regression(spark, folder):
    metrics = regression_metrics(priced_lines(spark, folder), "l_extendedprice", "prediction", ["l_returnflag"])
    return metrics.select(
        "l_returnflag", "n", F.round("mae", 4).alias("mae"), F.round(F.col("mse") / 1e6, 4).alias("mse_thousands"),
        F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("msle", 6).alias("msle"),
        F.round("rmsle", 6).alias("rmsle"),
    )


@query(
    "residuals",
    "M24",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_quantity * 1500, 4) AS residual FROM lineitem",
)
def residuals(spark, folder):
    scored = with_residual(priced_lines(spark, folder), "l_extendedprice", "prediction")
    return rounded(scored.select("l_orderkey", "l_linenumber", "residual"), 4)


@query(
    "residual_histogram",
    "M24",
    """WITH r AS (SELECT l_extendedprice - l_quantity * 1500 AS residual FROM lineitem),
            b AS (SELECT residual, CASE WHEN residual < -40000 THEN 0 WHEN residual >= 40000 THEN 21
                    ELSE floor((residual + 40000) / 4000) + 1 END::BIGINT AS bin FROM r)
       SELECT bin, count(*) AS n, round(min(residual), 4) AS lowest, round(max(residual), 4) AS highest FROM b GROUP BY bin""",
)
def residual_histogram_(spark, folder):
    return rounded(residual_histogram(priced_lines(spark, folder), "l_extendedprice", "prediction", -40000, 40000, 20), 4)


RULES = {"flat_1500": (0.0, 1500.0), "flat_1450": (0.0, 1450.0), "based_1400": (900.0, 1400.0)}
RULE_SCORES = " UNION ALL ".join(
    f"""SELECT '{name}' AS model, sqrt(avg(power(y - ({a}::DOUBLE + l_quantity * {b}::DOUBLE), 2))) AS rmse,
        avg(abs(y - ({a}::DOUBLE + l_quantity * {b}::DOUBLE))) AS mae,
        1 - sum(power(y - ({a}::DOUBLE + l_quantity * {b}::DOUBLE), 2)) / sum(power(y - ybar, 2)) AS r2 FROM l, a"""
    for name, (a, b) in RULES.items()
)
BOARD = f"""WITH {LINES}, a AS (SELECT avg(y) AS ybar FROM l), s AS ({RULE_SCORES}),
   board AS (SELECT row_number() OVER (ORDER BY rmse, model)::INTEGER AS rank, model, round(rmse, 4) AS rmse,
             round(mae, 4) AS mae, round(r2, 6) AS r2 FROM s)"""


def rule_board(spark, folder) -> DataFrame:
    """Every rule is scored in the same pass: one row per (line, rule), summed up by rule."""
    lines = table(spark, folder, "lineitem")
    guesses = [
        F.struct(F.lit(name).alias("model"), (F.lit(a) + F.col("l_quantity") * F.lit(b)).alias("p"))
        for name, (a, b) in RULES.items()
    ]
    guessed = lines.select(F.col("l_extendedprice").alias("y"), F.inline(F.array(*guesses)))
    scores = regression_metrics(guessed, "y", "p", ["model"]).select("model", "rmse", "mae", "r2")
    board = leaderboard(scores)
    return board.select(
        "rank", "model", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2")
    )


@query("rule_leaderboard", "T2 W2 M20", f"{BOARD} SELECT * FROM board")
def rule_leaderboard(spark, folder):
    return rule_board(spark, folder)


@query("best_rule", "T2", f"{BOARD} SELECT * FROM board WHERE rank = 1")
def best_rule(spark, folder):
    return rule_board(spark, folder).orderBy("rank").limit(1)


@query(
    "leaderboard_markdown",
    "F10 F2",
    f"""{BOARD} SELECT concat('| model | rmse | mae | r2 |', chr(10), '|---|---:|---:|---:|', chr(10),
          string_agg(concat('| ', model, ' | ', printf('%.4f', rmse), ' | ', printf('%.4f', mae), ' | ', printf('%.4f', r2), ' |'),
                     chr(10) ORDER BY rank)) AS markdown FROM board""",
)
def leaderboard_markdown(spark, folder):
    return markdown_table(rule_board(spark, folder), ["model", "rmse", "mae", "r2"])


@query(
    "ranked_associations",
    "T3 F8 W2",
    """WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS q, abs(corr(l_discount, l_extendedprice)) AS d,
                         abs(corr(l_tax, l_extendedprice)) AS t FROM lineitem),
            f AS (SELECT 'l_quantity' AS feature, q AS importance FROM c UNION ALL SELECT 'l_discount', d FROM c
                  UNION ALL SELECT 'l_tax', t FROM c)
       SELECT feature, round(importance, 6) AS importance,
              row_number() OVER (ORDER BY importance DESC, feature)::INTEGER AS rank FROM f""",
)
def ranked_associations(spark, folder):
    names = ["l_quantity", "l_discount", "l_tax"]
    found = table(spark, folder, "lineitem").agg(*[F.abs(F.corr(n, "l_extendedprice")).alias(n) for n in names])
    rows = [F.struct(F.lit(n).alias("feature"), F.col(n).alias("importance")) for n in names]
    ranked = leaderboard(found.select(F.inline(F.array(*rows))), "importance", "feature", descending=True)
    return rounded(ranked)


# --- distributions and request log -----------------------------------------------------


@query(
    "price_distribution",
    "W3",
    """WITH d AS (SELECT l_returnflag, l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1, 2)
       SELECT l_returnflag, l_extendedprice, n,
              sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice)::BIGINT AS n_upto FROM d""",
)
def price_distribution(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice", F.lit(1).cast("bigint").alias("n"))
    return running_totals(lines, "l_extendedprice", ["n"], ["l_returnflag"])


@query(
    "request_summary",
    "A21 X4",
    """WITH s AS (SELECT event_type, count(*) AS requests, avg(value) AS time_per_request,
                    date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds,
                    quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99
                  FROM events GROUP BY 1)
       SELECT event_type, requests, round(requests / seconds, 6) AS requests_per_second,
              round(time_per_request, 6) AS time_per_request, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99
       FROM s""",
)
def request_summary_(spark, folder):
    return rounded(request_summary(table(spark, folder, "events"), "ts", "value", ["event_type"]))


@query(
    "request_rate",
    "A21",
    "SELECT date_trunc('hour', ts) AS at, count(*) AS requests FROM events GROUP BY 1",
)
def request_rate_(spark, folder):
    events = table(spark, folder, "events")
    return request_rate(events, "ts", "hour").withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("approximate_latency", "A21")
def approximate_latency(spark, folder):
    return approximate_percentiles(table(spark, folder, "events"), "value", ["event_type"])


@query(
    "price_quantiles",
    "A21 W3",
    """SELECT count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
              round(quantile_cont(l_extendedprice, 0.995), 4) AS p99_5 FROM lineitem""",
)
def price_quantiles(spark, folder):
    return rounded(exact_quantiles(table(spark, folder, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.995]), 4)


# --- label sets and rankings ---------------------------------------------------------------

SETS = """s AS (SELECT o_orderkey, list_distinct(list_filter([o_orderstatus, CASE WHEN o_totalprice > 250000 THEN 'high' END,
                         CASE WHEN o_custkey % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS truth,
                list_distinct(list_filter([CASE WHEN o_custkey % 3 = 0 THEN 'F' ELSE o_orderstatus END,
                         CASE WHEN o_totalprice > 300000 THEN 'high' END,
                         CASE WHEN o_orderkey % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS predicted
                FROM orders)"""


def label_sets(spark, folder) -> DataFrame:
    def present(*items):
        return F.array_compact(F.array(*items))

    high = lambda bar: F.when(F.col("o_totalprice") > bar, F.lit("high"))
    even = lambda key: F.when(F.col(key) % 2 == 0, F.lit("even"))
    guess = F.when(F.col("o_custkey") % 3 == 0, F.lit("F")).otherwise(F.col("o_orderstatus"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        present(F.col("o_orderstatus"), high(250000), even("o_custkey")).alias("truth"),
        present(guess, high(300000), even("o_orderkey")).alias("predicted"),
    )


@query(
    "label_set_metrics",
    "K1 K3",
    f"""WITH {SETS}, o AS (SELECT len(list_intersect(truth, predicted)) AS b,
                   len(list_distinct(list_concat(truth, predicted))) AS e FROM s)
        SELECT count(*) AS n, round(avg((b = e)::INTEGER), 6) AS subset_accuracy, round(avg((e - b) / 5), 6) AS hamming_loss,
               round(avg(CASE WHEN e > 0 THEN b / e ELSE 1 END), 6) AS jaccard FROM o""",
)
def label_set_metrics_(spark, folder):
    return rounded(label_set_metrics(label_sets(spark, folder), "truth", "predicted", 5))


@query(
    "label_confusion",
    "K3",
    f"""WITH {SETS}, n AS (SELECT count(*) AS n FROM s),
        u AS (SELECT unnest(list_distinct(list_concat(truth, predicted))) AS label, truth, predicted FROM s),
        c AS (SELECT label, count(*) FILTER (WHERE list_contains(truth, label) AND list_contains(predicted, label)) AS tp,
                count(*) FILTER (WHERE NOT list_contains(truth, label)) AS fp,
                count(*) FILTER (WHERE NOT list_contains(predicted, label)) AS fn FROM u GROUP BY label)
        SELECT label, tp, fp, fn, n - tp - fp - fn AS tn FROM c, n""",
)
def label_confusion_(spark, folder):
    return label_confusion(label_sets(spark, folder), "truth", "predicted")


@query(
    "binarized_labels",
    "K3",
    f"""WITH {SETS} SELECT o_orderkey, list_contains(truth, 'F')::INTEGER AS "F", list_contains(truth, 'high')::INTEGER AS high,
                           list_contains(truth, 'even')::INTEGER AS even FROM s""",
)
def binarized_labels(spark, folder):
    return binarized(label_sets(spark, folder), "truth", ["F", "high", "even"]).drop("truth", "predicted")


RANKED = ["high", "F", "even", "O", "P"]


@query(
    "ranking_metrics",
    "K2",
    f"""WITH {SETS}, i AS (SELECT o_orderkey, t.pos, list_contains(truth, {RANKED}[t.pos])::INTEGER AS hit, len(truth) AS n_rel
             FROM s, unnest(range(1, 6)) AS t(pos)),
       c AS (SELECT *, sum(hit) OVER (PARTITION BY o_orderkey ORDER BY pos) AS found FROM i),
       p AS (SELECT o_orderkey, sum(hit) FILTER (WHERE pos <= 3) / 3 AS pk,
               sum(CASE WHEN hit = 1 THEN found / pos ELSE 0 END) / max(n_rel) AS ap,
               sum(hit / log2(pos + 1)) FILTER (WHERE pos <= 3) / sum(1 / log2(pos + 1)) FILTER (WHERE pos <= least(n_rel, 3)) AS ndcg
             FROM c GROUP BY o_orderkey)
       SELECT count(*) AS n, round(avg(pk), 6) AS precision_at_k, round(avg(ap), 6) AS map, round(avg(ndcg), 6) AS ndcg_at_k FROM p""",
)
def ranking_metrics_(spark, folder):
    ranked = label_sets(spark, folder).withColumn("ranked", F.array(*[F.lit(i) for i in RANKED]))
    return rounded(ranking_metrics(ranked, "ranked", "truth", 3))
