"""Markdown tables and reports from small result frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_line(columns: list[str], digits: int = 4, types: dict[str, str] | None = None) -> Column:
    """One Markdown row; doubles with a fixed number of decimals."""
    types = types or {}
    cells = [
        F.format_string(f"%.{digits}f", F.col(c)) if types.get(c) in ("double", "float") else F.col(c).cast("string")
        for c in columns
    ]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def markdown_table(board: DataFrame, columns: list[str], order: str = "rank", digits: int = 4) -> DataFrame:
    """One row, one text: header, alignment line and a line per row in order."""
    types = dict(board.dtypes)
    right = {"double", "float", "int", "bigint"}
    header = "| " + " | ".join(columns) + " |"
    ruler = "|" + "|".join("---:" if types[c] in right else "---" for c in columns) + "|"
    lines = board.select(F.col(order).alias("at"), table_line(columns, digits, types).alias("line"))
    body = F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda r: r["line"])
    return lines.agg(
        F.array_join(F.concat(F.array(F.lit(header), F.lit(ruler)), body), "\n").alias("markdown")
    )


def bullet(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"- {name}: `"), value.cast("string"), F.lit("`"))


def section(title: str, lines: list[Column]) -> Column:
    return F.concat_ws("\n", F.lit(f"## {title}"), F.lit(""), *lines)
