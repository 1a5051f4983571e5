"""Column contracts, quality gates and row rules."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StructType,
)

# Fixed value: the pattern an e-mail address has to match.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"


class ContractError(ValueError):
    """The data breaks a declared rule."""


# --- projections -----------------------------------------------------------


def all_but(df: DataFrame, *labels: str) -> list[str]:
    return [c for c in df.columns if c not in labels]


def columns_by_type(df: DataFrame, label: str | None = None, include_ints: bool = False):
    """(string columns, numeric columns). Only doubles count as numeric unless
    ``include_ints``; the label is in neither list."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"} if include_ints else {"double"}
    strings = [c for c, t in df.dtypes if t == "string" and c != label]
    return strings, [c for c, t in df.dtypes if t in numeric and c != label]


# --- null handling ---------------------------------------------------------


def is_missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if isinstance(kind, (DoubleType, FloatType)) else missing


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows in which no cell is null or NaN.

    One condition per column: the null checks reach the scan, and a wide frame
    is planned in time that grows with its columns, not with their combinations.
    """
    return df.filter(reduce(lambda a, b: a & b, [~is_missing(df, c) for c in df.columns]))


def missing_cells(df: DataFrame) -> DataFrame:
    """One row: the number of null or NaN cells over all columns."""
    per_row = reduce(lambda a, b: a + b, [is_missing(df, c).cast("bigint") for c in df.columns])
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("missing_cells"))


# --- contracts -------------------------------------------------------------


# Kinds of violations, in the order in which they are told.
ABSENT, UNEXPECTED, EMPTY, NOT_A_NUMBER, OUTSIDE = "absent", "unexpected", "empty", "not_a_number", "outside"


def column_violations(df: DataFrame, expected: list[str]) -> list[tuple[str, str]]:
    """(kind, column) of each expected column that is absent and each present one that is unexpected."""
    here, wanted = dict.fromkeys(df.columns), dict.fromkeys(expected)
    return [(ABSENT, c) for c in wanted if c not in here] + [(UNEXPECTED, c) for c in here if c not in wanted]


def require_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    found = column_violations(df, expected)
    if found:
        raise ContractError("; ".join(f"column {name} is {kind}" for kind, name in found))
    return df


def contract_violations(df: DataFrame, expected: list[str], label: str, low: float, high: float) -> DataFrame:
    """kind, column, n_rows: one row for each way in which the table breaks its contract.

    n_rows counts the rows with an empty cell or a label outside the range, in one
    pass over the table; it is null for violations of the columns themselves.
    """
    found = [(kind, name, None) for kind, name in column_violations(df, expected)]
    numeric = label in df.columns and is_numeric(df, label)
    if label in df.columns and not numeric:
        found.append((NOT_A_NUMBER, label, None))
    named = df.sparkSession.createDataFrame(found, "kind string, column string, n_rows bigint")
    counts = {(EMPTY, c): F.count_if(is_missing(df, c)) for c in df.columns}
    if numeric:
        counts[OUTSIDE, label] = F.count_if(~in_range(F.col(label), low, high))
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("column"), n.alias("n_rows")) for (kind, name), n in counts.items()
    ]
    return named.unionByName(df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).filter("n_rows > 0"))


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)


def in_range(value: Column, low: float, high: float) -> Column:
    """Inclusive; a null or NaN value is outside."""
    return F.coalesce(value.between(low, high), F.lit(False))


def contract_report(
    df: DataFrame, expected: list[str], label: str, low: float, high: float, split: str | None = None
) -> DataFrame:
    """Gate results as rows, one per split, from a single pass.

    ``status`` is ``passed`` only when the column set matches, no cell is
    missing, the label is numeric and every label lies inside the range.
    """
    columns = column_violations(df.drop(split) if split else df, expected)
    columns_ok = not columns
    numeric = label in df.columns and is_numeric(df, label)
    cells = reduce(lambda a, b: a + b, [is_missing(df, c).cast("bigint") for c in df.columns])
    value = F.col(label) if numeric else F.lit(None).cast("double")
    grouped = df.groupBy(split) if split else df.groupBy()
    measured = grouped.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.every(in_range(value, low, high)), F.lit(True)).alias("label_in_range"),
        F.min(value).alias("label_min"),
        F.max(value).alias("label_max"),
        F.avg(value).alias("label_mean"),
    )
    passed = F.lit(columns_ok and numeric) & (F.col("missing_cells") == 0) & F.col("label_in_range")
    return measured.withColumns(
        {
            "columns_checked": F.lit(len(expected)),
            "columns_ok": F.lit(columns_ok),
            "broken_columns": F.lit(", ".join(f"{name} {kind}" for kind, name in columns)),
            "label_numeric": F.lit(numeric),
            "status": F.when(passed, "passed").otherwise("failed"),
        }
    )


def enforce_contract(report: DataFrame) -> None:
    """Raise on the first failed row of a gate report."""
    failed = report.filter("status <> 'passed'").head(1)
    if failed:
        told = failed[0].asDict()
        raise ContractError(f"the table breaks its contract ({told.pop('broken_columns') or 'its columns are right'}): {told}")


# --- signatures ------------------------------------------------------------

_WIDENING = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]


def _casts_safely(source, target) -> bool:
    if source == target:
        return True
    ranks = {kind: rank for rank, kind in enumerate(_WIDENING)}
    if type(source) in ranks and type(target) in ranks:
        lossy = isinstance(source, LongType) and isinstance(target, (FloatType, DoubleType))
        lossy = lossy or (isinstance(source, IntegerType) and isinstance(target, FloatType))
        return ranks[type(source)] <= ranks[type(target)] and not lossy
    return isinstance(source, BooleanType) and type(target) in (IntegerType, LongType) or (
        isinstance(source, DecimalType) and isinstance(target, DecimalType)
        and source.scale <= target.scale
        and source.precision - source.scale <= target.precision - target.scale
    )


def enforce_schema(df: DataFrame, signature: StructType) -> DataFrame:
    """Columns of the signature in its order. A missing column or a cast that
    could lose information is an error; columns outside the signature go."""
    problems, chosen = [], []
    for field in signature.fields:
        if field.name not in df.columns:
            problems.append(f"{field.name} is missing")
        elif not _casts_safely(df.schema[field.name].dataType, field.dataType):
            found = df.schema[field.name].dataType.simpleString()
            problems.append(f"{field.name} is {found}, expected {field.dataType.simpleString()}")
        else:
            chosen.append(F.col(field.name).cast(field.dataType).alias(field.name))
    if problems:
        raise ContractError("schema mismatch: " + "; ".join(problems))
    return df.select(chosen)


def infer_signature(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and whether it held a value in
    every row (only then may callers be required to send it)."""
    counts = df.agg(*[F.sum(is_missing(df, c).cast("bigint")).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("name"),
            F.lit(t).alias("type"),
            (F.coalesce(F.col(c), F.lit(0)) == 0).alias("required"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- row rules -------------------------------------------------------------


def positive_rule(column: str) -> Column:
    """Message when the value is absent or not above zero, else null."""
    value = F.col(column)
    return (
        F.when(value.isNull() | F.isnan(value.cast("double")), f"{column} is required")
        .when(value <= 0, f"{column} must be positive")
        .otherwise(F.lit(None).cast("string"))
    )


def optional_email_rule(column: str) -> Column:
    value = F.col(column)
    return F.when(value.isNotNull() & ~value.rlike(EMAIL), f"{column} is not an e-mail address")


def check_rows(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Every row with its ``errors`` (possibly empty) and an ``accepted`` flag."""
    messages = F.filter(F.array(*rules), lambda m: m.isNotNull())
    return df.withColumn("errors", messages).withColumn("accepted", F.size("errors") == 0)


def accepted_and_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = checked.filter("accepted").drop("errors", "accepted")
    return good, checked.filter("NOT accepted").drop("accepted")


# --- gates on one-row results ----------------------------------------------


def band_gate(metrics: DataFrame, metric: str, low: float, high: float) -> DataFrame:
    """``status`` is ``passed`` strictly inside the band."""
    inside = (F.col(metric) > low) & (F.col(metric) < high)
    return metrics.withColumn("status", F.when(F.coalesce(inside, F.lit(False)), "passed").otherwise("failed"))


def require_band(gated: DataFrame, metric: str) -> None:
    row = gated.select("status", metric).first()
    if row is None or row["status"] != "passed":
        raise ContractError(f"{metric} out of the expected band: {None if row is None else row[metric]}")


def minimum_rows(df: DataFrame, least: int = 20) -> DataFrame:
    """One row naming the branch to take."""
    enough = F.col("n_rows") >= least
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "branch", F.when(enough, "monitoring_done").otherwise("skip_monitoring")
    )


def require_rows(df: DataFrame, least: int) -> None:
    if len(df.head(least)) < least:
        raise PySparkValueError(f"at least {least} rows are needed")
