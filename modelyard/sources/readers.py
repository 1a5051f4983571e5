"""Scans: CSV, tables, JSON artifacts, file listings, binary files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# File extension -> MIME type, and the type used when none matches.
MIME_BY_EXTENSION = {
    "bmp": "image/bmp",
    "gif": "image/gif",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "png": "image/png",
    "svg": "image/svg+xml",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "webp": "image/webp",
}
DEFAULT_MIME = "image/png"
# Text files keep timestamps to the microsecond; the default layouts cut them short.
TEXT_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """CSV scan. Without a schema Spark reads the whole file once more to infer one.

    A bare empty field is null, a quoted one an empty text. ``multi_line`` allows
    line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.options(header=header, sep=sep, escape='"', nullValue=r"\N", multiLine=multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.options(**TEXT_FORMATS).schema(schema).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_source(
    spark: SparkSession, kind: str, source: str, schema: StructType | str | None = None
) -> DataFrame:
    """``"delta"`` names a catalog table; every other kind is a CSV path."""
    if kind == "delta":
        return read_table(spark, source)
    return read_csv(spark, source, schema)


def quoted_name(name: str) -> str:
    """Catalog name with each part quoted, safe to place in a statement."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def select_all(spark: SparkSession, source: str) -> DataFrame:
    """``SELECT *`` over a named table or view."""
    return spark.sql(f"SELECT * FROM {quoted_name(source)}")


def read_artifacts(
    spark: SparkSession, paths: dict[str, str], schemas: dict[str, StructType | str]
) -> dict[str, DataFrame]:
    """Load several JSON artifacts; the error lists every one that is missing."""
    found, missing = {}, []
    for name, path in paths.items():
        try:
            found[name] = spark.read.options(**TEXT_FORMATS).schema(schemas[name]).json(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(f"{name} ({path})")
    if missing:
        raise FileNotFoundError("missing artifacts: " + ", ".join(missing))
    return found


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and modification time of files; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modification_time"),
        )
    )


def read_binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    )


def mime_type(path: Column) -> Column:
    extension = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    chosen = F.lit(DEFAULT_MIME)
    for known, mime in MIME_BY_EXTENSION.items():
        chosen = F.when(extension == known, mime).otherwise(chosen)
    return chosen


def data_url(path: Column, content: Column) -> Column:
    one_line = F.translate(F.base64(content), "\r\n", "")
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), one_line)
