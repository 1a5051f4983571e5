"""Sinks: tables, CSV, JSON documents with a moving pointer, cached counts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.sources.commits import put_file
from modelyard.sources.readers import TEXT_FORMATS

# Blanks around a value belong to it; a quote inside one is doubled.
CSV_WRITE = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
SINGLE_FILE_ROWS = 1_000_000


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Parquet table in the catalog; with a path, the table is external."""
    writer = df.write.format("parquet").mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header=True, **CSV_WRITE, **TEXT_FORMATS).csv(path)


def write_single_csv(df: DataFrame, path: str, max_rows: int = SINGLE_FILE_ROWS) -> int:
    """One CSV file when the result is small enough for one task, else several.

    Returns the number of rows. Every row is written either way.
    """
    rows = df.count()
    write_csv(df.coalesce(1) if rows <= max_rows else df, path)
    return rows


def write_document(df: DataFrame, path: str, latest: str | None = None) -> None:
    """JSON document at ``path``; ``latest`` is a second copy, in one file that a new one replaces at once.

    Whoever reads ``latest`` meanwhile, or after a failure, finds the old document.
    """
    df.write.mode("overwrite").options(**TEXT_FORMATS).json(path)
    if latest:
        written = df.sparkSession.read.options(**TEXT_FORMATS).schema(df.schema).json(path)
        put_file(written, latest, "document.json", lambda one, at: one.write.options(**TEXT_FORMATS).json(at))


def rows_as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON text per row, nulls kept as explicit fields."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", **TEXT_FORMATS}).alias(name))


def rows_from_json(df: DataFrame, schema, name: str = "json") -> DataFrame:
    return df.select(F.from_json(name, schema, TEXT_FORMATS).alias("row")).select("row.*")


def persist_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
