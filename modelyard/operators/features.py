"""Feature columns: category indexes, scaling, indicators, term weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import IDF, HashingTF, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.functions.scalars import cosine
from modelyard.functions.text import terms
from modelyard.operators.cumulative import running_totals
from modelyard.session import scratch_path


RANKS = "name string, category string, at double"
# Text that one task counts the terms of.
PART_BYTES = 1 << 24


def index_stages(strings: list[str], numbers: list[str], output: str = "features") -> list:
    """Indexer (frequent categories first, rows with an unseen or null category
    skipped) and assembler."""
    indexed = [f"{c}Index" for c in strings]
    stages = [TableIndexer(strings, indexed)] if strings else []
    return [*stages, VectorAssembler(inputCols=indexed + numbers, outputCol=output)]


def category_counts(train: DataFrame, columns: list[str]) -> DataFrame:
    """(name, category, n): rows of each category of each column, as text, without nulls."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("category")) for c in columns])
    found = train.select(F.inline(pairs)).filter(F.col("category").isNotNull())
    return found.groupBy("name", "category").agg(F.count("*").alias("n"))


def category_ranks(counts: DataFrame) -> DataFrame:
    """(name, category, at): 0 for a column's most frequent category, ties by name.

    Categories are counted and ranked as tables, so there may be any number of
    them: ranks are counts of the categories that come before, range by range.
    """
    order = F.struct((-F.col("n")).alias("n"), "category").alias("_order")
    ranked = running_totals(counts.select("name", order, F.lit(1).cast("bigint").alias("n")), "_order", ["n"], ["name"])
    return ranked.select("name", F.col("_order.category").alias("category"), (F.col("n_upto") - 1).cast("double").alias("at"))


def with_indexes(df: DataFrame, ranks: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Each column's rank under a new name, for rows whose categories all have one.

    The ranks are joined: Spark sends them to the tasks if they are small, and
    otherwise brings rows and ranks together, splitting categories that many rows have.
    """
    for name, output in columns.items():
        key = f"_category_of_{output}"
        own = ranks.filter(F.col("name") == name).select(F.col("category").alias(key), F.col("at").alias(output))
        df = df.withColumn(key, F.col(name).cast("string")).join(own, key).drop(key)
    return df


def index_categories(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>Index`` (frequent categories first, ties by name) for rows whose
    categories all occur in the training rows."""
    return with_indexes(df, category_ranks(category_counts(train, columns)), {c: f"{c}Index" for c in columns})


class TableIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage of ``category_ranks``: the ranks are a table, never on the driver.

    Rows with a null or unseen category are skipped. Output columns are marked as
    nominal, so trees split them as categories.
    """

    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None) -> None:
        super().__init__()
        self._set(inputCols=inputCols, outputCols=outputCols)

    def _fit(self, df: DataFrame) -> TableIndexerModel:
        path = scratch_path(df.sparkSession, "categories")
        counts = category_counts(df, self.getInputCols())
        counts.write.parquet(f"{path}/counts")
        counts = df.sparkSession.read.schema(counts.schema).parquet(f"{path}/counts")
        category_ranks(counts).write.partitionBy("name").parquet(f"{path}/ranks")
        sizes = dict(counts.groupBy("name").count().collect())  # one row for each column
        model = TableIndexerModel(f"{path}/ranks", [sizes.get(c, 0) for c in self.getInputCols()])
        return self._copyValues(model)


class TableIndexerModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """Ranks of categories at ``path``, and how many each column has; saved with the pipeline it is part of."""

    def __init__(self, path: str = "", sizes: list[int] | None = None) -> None:
        super().__init__()
        self.path, self.sizes = path, sizes or []

    def ranks(self, spark) -> DataFrame:
        return spark.read.schema(RANKS).parquet(self.path)

    def _transform(self, df: DataFrame) -> DataFrame:
        outputs = dict(zip(self.getInputCols(), self.getOutputCols()))
        indexed = with_indexes(df, self.ranks(df.sparkSession), outputs)
        for output, size in zip(self.getOutputCols(), self.sizes):
            nominal = {"ml_attr": {"type": "nominal", "name": output, "num_vals": size}}
            indexed = indexed.withMetadata(output, nominal)
        return indexed

    def write(self) -> MLWriter:
        return _RanksWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RanksReader()


class _RanksWriter(MLWriter):
    def __init__(self, model: TableIndexerModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes})
        self.model.ranks(self.sparkSession).write.partitionBy("name").parquet(f"{path}/ranks")


class _RanksReader(MLReader):
    def load(self, path: str) -> TableIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableIndexerModel(f"{path}/ranks", metadata["sizes"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


@dataclass
class Scaling:
    """Mean and population deviation per column, learnt once, applied row by row."""

    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Scaling:
        measured = [F.avg(c).alias(f"mean_{c}") for c in columns]
        measured += [F.stddev_pop(c).alias(f"dev_{c}") for c in columns]
        row = df.agg(*measured).first()
        return cls(
            {c: row[f"mean_{c}"] for c in columns},
            # A constant column is only centred.
            {c: row[f"dev_{c}"] or 1.0 for c in columns},
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(self.mean[c])) / F.lit(self.deviation[c]) for c in self.mean}
        )


def indicators(df: DataFrame, columns: list[str], drop_first: bool = True) -> DataFrame:
    """One 0/1 column ``<column>_<category>`` per category in sorted order, the
    first one left out; the source columns go.

    The categories become column names, so the driver holds as many as the result has columns.
    """
    added = {}
    for name in columns:
        found = df.select(name).filter(F.col(name).isNotNull()).distinct().collect()
        for category in sorted(r[0] for r in found)[1 if drop_first else 0:]:
            hit = F.coalesce(F.col(name) == F.lit(category), F.lit(False))
            added[f"{name}_{category}"] = hit.cast("int")
    return df.withColumns(added).drop(*columns)


def hashed_term_weights(df: DataFrame, text: str, buckets: int = 1 << 18, output: str = "tfidf") -> DataFrame:
    """Term weights as sparse vectors for MLlib, terms hashed to buckets: no shuffle
    of terms, but two terms may share a bucket."""
    tokenized = df.withColumn("_tokens", terms(F.col(text)))
    stages = [
        HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=buckets),
        IDF(inputCol="_counts", outputCol=output),
    ]
    return Pipeline(stages=stages).fit(tokenized).transform(tokenized).drop("_tokens", "_counts")


def term_weights(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, weight): term count times ln((1 + n) / (1 + documents with the
    term)) + 1, scaled so that each document's weights have length 1.

    Texts are dealt by key, so that a document is counted where it lies. What travels
    to the terms' frequencies and back is one row for each term of a dealt part, with
    the documents of that part that have it, not one row for each document and term. A
    document's terms come together in one row, which its text already was.
    """
    documents, size = df.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    parts = max(1, -(-(size or 0) // PART_BYTES))
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("_part")
    dealt = df.select(part, key, F.col(text).alias("_text")).repartitionById(parts, "_part")
    counted = dealt.select("_part", key, F.explode(terms(F.col("_text"))).alias("term")).groupBy("_part", key, "term").agg(
        F.count("*").alias("_n")
    )
    found = counted.groupBy("_part", "term").agg(F.collect_list(F.struct(F.col(key).alias("_key"), "_n")).alias("_found"))
    rarity = counted.groupBy("_part", "term").agg(F.count("*").alias("_in")).groupBy("term").agg(F.sum("_in").alias("_in"))
    rarity = rarity.select("term", (F.ln((1 + documents) / (1 + F.col("_in"))) + 1).alias("_idf"))
    back = found.join(rarity, "term").select("_part", "term", "_idf", "_found").repartitionById(parts, "_part")
    weighted = back.select("_part", "term", "_idf", F.inline("_found")).select(
        "_part", F.col("_key").alias(key), "term", (F.col("_n") * F.col("_idf")).alias("weight")
    )
    gathered = weighted.groupBy("_part", key).agg(
        F.collect_list(F.struct("term", "weight")).alias("_terms"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_length"),
    )
    return gathered.select(key, "_length", F.inline("_terms")).select(
        key, "term", (F.col("weight") / F.col("_length")).alias("weight")
    )


def class_centers(df: DataFrame, vector: str, key: str) -> DataFrame:
    """Mean vector per class, columns (key, center).

    Summed by (class, dimension), so a large class is spread over its dimensions.
    """
    spread = df.select(key, F.posexplode(vector).alias("_at", "_x"))
    means = spread.groupBy(key, "_at").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "_x")))
    return means.groupBy(key).agg(F.transform(ordered, lambda s: s["_x"]).alias("center"))


def cosine_to(df: DataFrame, vector: str, centers: DataFrame, key: str, center: str = "center") -> DataFrame:
    """Cosine of each row's vector with the center of its own class.

    One center per class; Spark sends them to every task if their size allows.
    """
    return df.join(centers, key).withColumn("cosine", cosine(F.col(vector), F.col(center)))
