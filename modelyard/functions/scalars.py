"""Scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two timestamp layouts, as Spark patterns.
UTC_STAMP = "yyyyMMdd'T'HHmmss'Z'"
RUN_STAMP = "yyyyMMdd_HHmmss"


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, UTC_STAMP)


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, RUN_STAMP)


def fixed(value: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", value)


def has_name(listed: Column, name: str) -> Column:
    """Is ``name`` one of the comma-separated entries?"""
    return F.array_contains(F.split(listed, ","), name)


def is_true(text: Column) -> Column:
    return F.lower(text) == "true"


def value_or(mapping: Column, key: str, default) -> Column:
    return F.coalesce(F.try_element_at(mapping, F.lit(key)), F.lit(default))


def run_uri(run_id: Column, artifact: str = "model") -> Column:
    return F.concat(F.lit("runs:/"), run_id, F.lit(f"/{artifact}"))


def version_uri(name: Column, version: Column) -> Column:
    return F.concat(F.lit("models:/"), name, F.lit("/"), version)


def argmax(values: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Null when either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it as a lambda variable in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
