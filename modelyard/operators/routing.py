"""Who may send a message and which handler takes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOWED, DENIED = "allowed", "denied"


def gate_by_list(df: DataFrame, user: str, allowed: list) -> DataFrame:
    member = F.coalesce(F.col(user).isin(allowed), F.lit(False))
    return df.withColumn("access", F.when(member, ALLOWED).otherwise(DENIED))


def allowed_rows(df: DataFrame, allowed: DataFrame, user: str) -> DataFrame:
    """Rows of the users on the list; Spark sends the list to every task if its bytes allow."""
    return df.join(allowed.select(user), user, "left_semi")


def denied_rows(df: DataFrame, allowed: DataFrame, user: str) -> DataFrame:
    return df.join(allowed.select(user), user, "left_anti")


def route(content_type: Column, text: Column) -> Column:
    """Handler name: a command wins over the kind of content."""
    command = F.regexp_extract(F.coalesce(text, F.lit("")), r"^/([a-z]+)", 1)
    return (
        F.when(command.isin("start", "help"), F.lit("welcome"))
        .when(content_type == "photo", F.lit("describe_image"))
        .when(content_type == "voice", F.lit("transcribe"))
        .when(content_type == "text", F.lit("converse"))
        .otherwise(F.lit("ignore"))
    )


def route_by(value: Column, routes: dict[str, list], otherwise: str) -> Column:
    """Handler whose list holds the value, first match first."""
    chosen = F.lit(otherwise)
    for handler, accepted in reversed(routes.items()):
        chosen = F.when(value.isin(accepted), F.lit(handler)).otherwise(chosen)
    return chosen
