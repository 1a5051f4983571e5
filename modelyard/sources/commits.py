"""Small files that appear whole or not at all: numbered commits and pointers.

A file is written under a name of its own and then renamed. The rename fails if
the name is taken (a commit), or takes its place at once (a pointer); Spark's own
streaming logs rely on the same two renames of the file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TAKEN = "FileAlreadyExistsException"


def _renamed(spark: SparkSession, files, own, target, replace: bool) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark._jvm.java.lang.reflect.Array.newInstance(hadoop.Options.Rename._java_lang_class, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE if replace else hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(own, target, options)
    except Py4JJavaError as error:
        if TAKEN in error.java_exception.getClass().getName() and not replace:
            return False
        raise
    return True


def put(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a file of a few lines at once; False if it is there already and not to be replaced."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    own = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = files.create(own, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        return _renamed(spark, files, own, target, replace)
    finally:
        files.delete(own, False)


def put_file(df: DataFrame, folder: str, name: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write a frame of one document with ``write`` and let its only file take the place of ``folder``/``name`` at once."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    write(df.coalesce(1), staged)
    target = hadoop.Path(folder, name)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    parts = [f.getPath() for f in files.globStatus(hadoop.Path(staged, "part-*"))]
    if parts:
        _renamed(spark, files, parts[0], target, True)
    else:
        put(spark, str(target), "", replace=True)
    files.delete(hadoop.Path(staged), True)


class CommitLog:
    """Numbered entries, each a JSON file that only one writer can have made."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def read(self) -> DataFrame:
        """All entries with their ``number``; empty before the first."""
        try:
            rows = self.spark.read.schema(self.schema).json(f"{self.path}/*.json")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema).withColumn("number", F.lit(0).cast("bigint"))
        number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("bigint")
        return rows.withColumn("number", number)

    def last(self) -> int:
        """Highest number, 0 before the first entry."""
        return self.read().agg(F.max("number")).first()[0] or 0

    def append(self, entry: Callable[[int], dict]) -> int:
        """Add ``entry(number)`` under the next free number, which is returned; another writer's number is never reused."""
        number = self.last() + 1
        while not put(self.spark, f"{self.path}/{number:012d}.json", json.dumps(entry(number))):
            number += 1
        return number


def point(spark: SparkSession, path: str, target: str) -> None:
    """Let the pointer at ``path`` name ``target``; readers see the old or the new name, never neither."""
    put(spark, path, target, replace=True)


def pointed(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]
