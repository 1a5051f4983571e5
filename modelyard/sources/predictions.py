"""The growing table of predictions.

Each batch of new rows is its own ``batch=<id>`` folder, in buckets of the rows'
digests. Beside it stand the batch's digests, in the same buckets, and a manifest
file with its size. A new batch meets the digests of earlier ones, and rows are
compared only where a digest was found; the last rows are read from the
newest batches that hold enough. A batch is compared with the batches before it,
and replaces its own folders, so running it again after a failure leaves the same
table.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from modelyard.operators.scoring import distinct_rows, last_rows, not_yet_in
from modelyard.session import scratch_path
from modelyard.sources.commits import put

BATCH, BUCKET, DIGEST = "batch", "_bucket", "_digest"
BUCKETS = 8


class PredictionTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, sequence: list[str]):
        self.spark, self.path, self.schema, self.sequence = spark, path, schema, sequence
        self.compared = [f.name for f in schema.fields if f.name not in sequence]

    def _table(self, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", path).format(kind).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _rows(self) -> DataFrame:
        return self._table(f"{self.path}/rows", StructType([*self.schema.fields]).add(BATCH, LongType()).add(BUCKET, IntegerType()))

    def _digests(self) -> DataFrame:
        return self._table(f"{self.path}/digests", StructType().add(DIGEST, LongType()).add(BATCH, LongType()).add(BUCKET, IntegerType()))

    def _sizes(self) -> DataFrame:
        return self._table(f"{self.path}/sizes", StructType().add("n_rows", LongType()).add(BATCH, LongType()), "json")

    def read(self) -> DataFrame:
        """All rows with their batch; empty before the first append."""
        return self._rows().drop(BUCKET)

    def earlier(self, fresh: DataFrame, batch: int) -> DataFrame:
        """Rows of earlier batches that may equal one of ``fresh`` (with digest and bucket).

        Of earlier batches only the digests are read, and rows only of those batches
        and buckets in which a digest of ``fresh`` was found.
        """
        known = self._digests().filter(F.col(BATCH) < batch)
        found = known.join(fresh.select(DIGEST), DIGEST, "left_semi").select(BATCH, BUCKET).distinct().collect()
        hit = F.lit(False)
        for at in sorted({r[BATCH] for r in found}):
            hit = hit | ((F.col(BATCH) == at) & F.col(BUCKET).isin(sorted(r[BUCKET] for r in found if r[BATCH] == at)))
        return self._rows().filter(hit)

    def append(self, scored: DataFrame, batch: int) -> None:
        """Add the rows the table does not hold yet, one of each."""
        names = [f.name for f in self.schema.fields]
        digest = F.xxhash64(*self.compared)
        marked = distinct_rows(scored.select(names), self.sequence).withColumn(DIGEST, digest)
        staged = scratch_path(self.spark, "new-rows")
        marked.withColumn(BUCKET, F.pmod(DIGEST, F.lit(BUCKETS)).cast("int")).write.parquet(staged)
        fresh = self.spark.read.parquet(staged)
        new = not_yet_in(self.earlier(fresh, batch), fresh, self.compared)
        folder = f"{BATCH}={batch}"
        # Files by bucket: as many as there are buckets, however many tasks wrote them.
        new.select(*names, BUCKET).repartition(BUCKETS, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/rows/{folder}")
        own = self._rows().filter(F.col(BATCH) == batch)
        own.select(digest.alias(DIGEST), BUCKET).repartition(BUCKETS, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/digests/{folder}")
        put(self.spark, f"{self.path}/sizes/{folder}/size.json", json.dumps({"n_rows": own.count()}), replace=True)

    def newest(self, n: int) -> list[int]:
        """The newest batches that together hold ``n`` rows, or all that hold any: at most ``n``."""
        taken, rows = [], 0
        for row in self._sizes().filter("n_rows > 0").orderBy(F.desc(BATCH)).limit(n).collect():
            if rows >= n:
                break
            taken.append(row[BATCH])
            rows += row["n_rows"]
        return taken

    def last(self, n: int) -> DataFrame:
        """The last ``n`` rows; older batches than these need are not read."""
        return last_rows(self.read().filter(F.col(BATCH).isin(self.newest(n))), [BATCH, *self.sequence], n)
