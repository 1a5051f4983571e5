"""Two-sample Kolmogorov-Smirnov drift test, one row per feature."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.functions.scalars import bind, utc_stamp
from modelyard.operators.contract import ContractError
from modelyard.operators.cumulative import running_totals
from modelyard.operators.registry import latest_version

P_VALUE = 0.05
WINDOW_ROWS = 20
SERIES_TERMS = 100
# Below this lambda the true probability is 1 to more digits than a double has,
# while a cut-off alternating series is not.
SMALLEST_LAMBDA = 0.2
FINITE_ROWS = 140
# Size of the quantile sketches, and rows of a feature's bounded profile.
SKETCH_SIZE = 4096
PROFILE_POINTS = 2048
# Sketches of the tasks are merged in this many groups before they meet in one row.
MERGE_GROUPS = 256


def long_features(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) rows without nulls."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull())


def feature_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, n) with n = 1: a profile whose equal values are not merged yet."""
    return long_features(df, features).withColumn("n", F.lit(1).cast("bigint"))


def reference_profile(df: DataFrame, features: list[str]) -> DataFrame:
    """What the test needs of the training rows: how often each value occurs."""
    return long_features(df, features).groupBy("feature", "value").agg(F.count("*").alias("n"))


def bounded_profile(
    df: DataFrame, features: list[str], points: int = PROFILE_POINTS, sketch_size: int = SKETCH_SIZE
) -> DataFrame:
    """(feature, value, n) like ``reference_profile``, with at most ``points`` rows for each
    feature however many rows or distinct values there are.

    Each feature becomes one mergeable quantile sketch, and its rows are quantiles, each
    standing for the rows since the one before; the ``n`` of a feature add up to its rows.
    Its distribution is off by at most 1 / ``points`` beside the sketch's own rank error
    (``sketch_rank_error``, exceeded once in a hundred times), and so is ``ks_distance``.
    It is the exact profile of features with up to ``points`` (a power of two) and
    ``sketch_size`` rows.
    Nulls and NaN do not count; a feature without values has no rows.
    """
    sketches = [F.kll_sketch_agg_double(F.col(f).cast("double"), sketch_size).alias(f) for f in features]
    partial = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_group")).agg(*sketches)
    merged = partial.agg(*[F.kll_merge_agg_double(f, sketch_size).alias(f) for f in features])
    each = merged.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("sketch")) for f in features])))
    counted = each.withColumn("rows", F.kll_sketch_get_n_double("sketch")).filter(F.col("rows") > 0)
    # The value at the end of part j is that of row ceil(j * rows / points), in order.
    ranks = F.array(*[F.lit(j / points) for j in range(1, points + 1)])
    ends = counted.select("feature", "rows", F.posexplode(F.kll_sketch_get_quantile_double("sketch", ranks)).alias("part", "value"))
    upto = [F.expr(f"(rows * (part + {more}) + {points - 1}) div {points}") for more in (0, 1)]
    return ends.select("feature", "value", (upto[1] - upto[0]).alias("n")).filter(F.col("n") > 0).groupBy(
        "feature", "value"
    ).agg(F.sum("n").alias("n"))


def sketch_rank_error(sketch_size: int = SKETCH_SIZE) -> float:
    """Share of rows by which a rank read from a sketch of this size is off, at most, 99 times in 100."""
    return 2.296 / sketch_size**0.9021


def ks_distance(reference: DataFrame, current: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(feature, n_ref, n_cur, distance) from two (feature, value, n) frames.

    ``sizes`` (feature, n_ref, n_cur, n_ref + n_cur as rows, one row per feature) is
    counted here unless the caller has it.
    """
    zero = F.lit(0).cast("bigint")
    both = reference.select("feature", "value", F.col("n").alias("ref"), zero.alias("cur")).unionAll(
        current.select("feature", "value", zero.alias("ref"), F.col("n").alias("cur"))
    )
    if sizes is None:
        measured = both.groupBy("feature").agg(
            F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.count("*").alias("rows")
        )
        # As many rows as the caller named features.
        sizes = both.sparkSession.createDataFrame(measured.collect(), measured.schema)
    largest = sizes.agg(F.max("rows")).first()[0] or 0
    totals = running_totals(both, "value", ["ref", "cur"], ["feature"], largest=largest)
    gap = F.abs(
        F.col("ref_upto") / F.nullif("n_ref", F.lit(0)) - F.col("cur_upto") / F.nullif("n_cur", F.lit(0))
    )
    return (
        totals.join(F.broadcast(sizes.drop("rows")), "feature")
        .groupBy("feature", "n_ref", "n_cur")
        .agg(F.max(gap).alias("distance"))
    )


def feature_sizes(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, n_ref, n_cur, rows): values that count of each feature, from the rows as they stand."""
    counts = [df.agg(*[F.count(F.col(f).cast("double")).alias(f) for f in features]).first() for df in (reference, current)]
    rows = [(f, counts[0][f], counts[1][f], counts[0][f] + counts[1][f]) for f in features]
    known = [r for r in rows if r[3]]
    return reference.sparkSession.createDataFrame(known, "feature string, n_ref bigint, n_cur bigint, rows bigint")


def effective_rows(n_ref: Column, n_cur: Column) -> Column:
    a, b = n_ref.cast("double"), n_cur.cast("double")
    return a * b / (a + b)


def limit_p_value(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Kolmogorov's limit distribution at a point moved for the sample size (Vrbik
    2018): beyond FINITE_ROWS within 0.5 percent of the finite-sample probability
    around 0.01, within 2 percent down to 0.001."""
    root = F.sqrt(effective_rows(n_ref, n_cur))
    plain = root * distance
    lam = plain + 1 / (6 * root) + (plain - 1) / (4 * root * root)

    def term(k: Column) -> Column:
        sign = F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        return sign * F.exp(F.lit(-2.0) * k * k * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), lambda s, k: s + term(k))
    return F.when(lam < SMALLEST_LAMBDA, F.lit(1.0)).otherwise(
        F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    )


def finite_p_value(n: int, distance: float) -> float:
    """P(D_n >= distance) for n rows against a fixed distribution, by the matrix
    form of the finite-sample distribution (Marsaglia, Tsang and Wang 2003); one
    value in plain numbers, ``finite_p_values`` is its column form."""
    if distance <= 0:
        return 1.0
    if distance >= 1:
        return 0.0
    k = int(n * distance) + 1
    size = 2 * k - 1
    h = k - n * distance
    rows, cols = np.indices((size, size))
    matrix = np.where(rows - cols + 1 >= 0, 1.0, 0.0)
    powers = h ** np.arange(1, size + 1)
    matrix[:, 0] -= powers
    matrix[-1, :] -= powers[::-1]
    matrix[-1, 0] += max(2 * h - 1, 0.0) ** size
    inverse_factorials = np.exp([-math.lgamma(i + 1) for i in range(size + 1)])
    matrix *= inverse_factorials[np.clip(rows - cols + 1, 0, size)]
    inside = np.linalg.matrix_power(matrix, n)[k - 1, k - 1]
    for i in range(1, n + 1):
        inside *= i / n
    return float(min(max(1.0 - inside, 0.0), 1.0))


def finite_p_values(rows: Column, distance: Column) -> Column:
    """P(D_n >= distance) for n = ``rows`` (at most FINITE_ROWS) against a fixed
    distribution, by the matrix form of the finite-sample distribution (Marsaglia,
    Tsang and Wang 2003): a unit vector is multiplied n times by one small matrix."""
    product = rows * distance
    middle = F.floor(product).cast("int") + 1
    size, h = 2 * middle - 1, middle - product
    places = F.sequence(F.lit(0), size - 1)
    inverse_factorials = F.lit([math.exp(-math.lgamma(i + 1)) for i in range(2 * FINITE_ROWS + 4)])

    def entry(given: Column, i: Column, j: Column) -> Column:
        size, h = given["size"], given["h"]
        value = F.when(i - j + 1 >= 0, 1.0).otherwise(0.0)
        value -= F.when(j == 0, F.pow(h, i + 1)).otherwise(0.0) + F.when(i == size - 1, F.pow(h, size - j)).otherwise(0.0)
        value += F.when((j == 0) & (i == size - 1), F.pow(F.greatest(2 * h - 1, F.lit(0.0)), size)).otherwise(0.0)
        return value * F.get(inverse_factorials, F.greatest(i - j + 1, F.lit(0)))

    def walked(given: Column) -> Column:
        def step(vector: Column, turn: Column) -> Column:
            return F.transform(
                given["columns"],
                lambda c: F.aggregate(F.zip_with(vector, c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) * turn / given["n"],
            )

        unit = F.transform(given["places"], lambda i: F.when(i == given["middle"] - 1, 1.0).otherwise(0.0))
        return F.get(F.aggregate(F.sequence(F.lit(1), given["n"]), unit, step), given["middle"] - 1)

    def with_columns(given: Column) -> Column:
        columns = F.transform(given["places"], lambda j: F.transform(given["places"], lambda i: entry(given, i, j)))
        return F.struct(*[given[c].alias(c) for c in ("n", "middle", "places")], columns.alias("columns"))

    given = F.struct(rows.cast("int").alias("n"), middle.alias("middle"), size.alias("size"), h.alias("h"), places.alias("places"))
    inside = bind(given, lambda g: bind(with_columns(g), walked))
    chance = F.least(F.greatest(1 - inside, F.lit(0.0)), F.lit(1.0))
    return F.when(distance <= 0, 1.0).when(distance >= 1, 0.0).otherwise(chance)


def with_p_value(distances: DataFrame) -> DataFrame:
    """``p_value`` of the rounded effective sample size: the finite-sample
    distribution itself (one small matrix per feature) up to FINITE_ROWS, and the
    limit corrected for the size beyond, which nearly meets it there (see
    ``limit_p_value``)."""
    n_ref, n_cur = F.col("n_ref"), F.col("n_cur")
    limit = limit_p_value(F.col("distance"), n_ref, n_cur)
    rows = F.rint(effective_rows(n_ref, n_cur)).cast("int")
    return distances.withColumn("p_value", F.when(rows <= FINITE_ROWS, finite_p_values(rows, F.col("distance"))).otherwise(limit))


def with_decision(tested: DataFrame, n_features: int, alpha: float = P_VALUE) -> DataFrame:
    """Bonferroni: a feature drifts when its p-value is below alpha over the number of features."""
    threshold = alpha / n_features
    return tested.withColumn("threshold", F.lit(threshold)).withColumn(
        "drifted", F.col("p_value") < F.lit(threshold)
    )


def drift_test(
    reference: DataFrame, current: DataFrame, features: list[str], alpha: float = P_VALUE
) -> DataFrame:
    """Test rows for two frames of raw features."""
    sizes = feature_sizes(reference, current, features)
    distances = ks_distance(feature_rows(reference, features), feature_rows(current, features), sizes)
    return with_decision(with_p_value(distances), len(features), alpha)


def any_drift(tested: DataFrame) -> DataFrame:
    return tested.agg(
        F.count("*").alias("n_features"),
        F.min("p_value").alias("lowest_p"),
        F.max(F.col("drifted").cast("int")).alias("is_drift"),
    )


def drift_report(tested: DataFrame, version: DataFrame, at: Column, window_size: int) -> DataFrame:
    """One nested row; ``version`` is the one-row (name, version, run_id) frame."""
    results = tested.agg(
        F.struct(
            F.max(F.col("drifted").cast("int")).alias("is_drift"),
            F.max("threshold").alias("threshold"),
            F.array_sort(
                F.collect_list(F.struct("feature", "distance", "p_value", "drifted"))
            ).alias("data"),
        ).alias("preds")
    )
    return version.select(
        utc_stamp(at).alias("timestamp_utc"),
        F.col("name").alias("model_name"),
        F.col("version").alias("model_version"),
        F.col("run_id").alias("model_run_id"),
        F.lit(window_size).alias("window_size"),
        results.scalar().alias("preds"),
    )


def version_with_reference(versions: DataFrame, references: DataFrame, name: str) -> DataFrame:
    """The latest version of a model, joined with its stored reference.

    An error when the model has no versions, or its latest one no reference.
    """
    latest = latest_version(versions.filter(F.col("name") == name))
    row = latest.first()
    if row is None:
        raise ContractError(f"no registered version of {name}")
    if not references.filter(F.col("run_id") == row["run_id"]).head(1):
        raise ContractError(f"version {row['version']} of {name} (run {row['run_id']}) has no reference sample")
    return latest
