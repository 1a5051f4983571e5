"""Mixing sources to target weights along a low-discrepancy schedule, without Python in the tasks.

Golden-ratio points, one per slot, fall into the cumulative weights of the
sources; the slots of a source are ranked, and rank r takes block r (modulo the
blocks) of the source's documents, which stand in shuffled order and are cut
into blocks of equal numbers of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WORD, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 64
SEED = 17
# Documents of a source that one task puts in order, and slots that one task ranks.
BUCKET_DOCS = 4096
CHUNK = 1 << 16
# Points are multiples of the golden ratio modulo 1, in units of 2^-31.
POINTS = 1 << 31
GOLDEN = 1327217885


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: a later failure starts from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def source_targets(sized: DataFrame) -> DataFrame:
    """sid, source, source_size, n_docs, n_blocks, target, lo, hi: one row per source.

    Weights repeat along the sources in code point order, null last. Targets are
    shares of SHARE times all words by weight, at most MOST times the source's
    words; what lies above is shared again by weight: with the sources ordered by
    the weight unit at which they are full, the full ones are a prefix. lo and hi
    bound the source's part of the points 0 to 1, by the blocks it needs.
    The windows see one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    numbered = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(MOST))
    by_fill = Window.orderBy(F.col("brim") / F.col("weight"), "sid")
    before, all_rows = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(all_rows) * F.lit(SHARE) - F.coalesce(F.sum("brim").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    marked = numbered.withColumns({"weight": weight, "brim": full}).withColumn("capped", F.col("brim") * weights_left <= left * F.col("weight"))
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("brim"))).over(all_rows), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_rows)
    shared = (F.sum("source_size").over(all_rows) * F.lit(SHARE) - taken) * F.col("weight") / open_weight
    blocks = F.ceil(F.col("source_size") / BLOCK)
    needed = F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("target", F.round(F.when(F.col("capped"), F.col("brim")).otherwise(shared), 6))
        .withColumn("n_blocks", blocks)
        .withColumn("needed", needed)
        .withColumn("hi", F.sum("needed").over(upto))
        .select("sid", "source", "source_size", "n_docs", "n_blocks", "target", (F.col("hi") - F.col("needed")).alias("lo"), "hi")
    )


def dealt(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows with their source's columns, the digest that they are ordered by and its bucket.

    A source is spread over buckets of the documents' digests, so that no task
    orders more than about BUCKET_DOCS documents of it.
    """
    sources = targets.select(F.col("source").alias("of"), "sid", "source_size", "target", F.ceil(F.col("n_docs") / BUCKET_DOCS).alias("n_buckets"))
    digest = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("doc_id").cast("string")))
    spread = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = sized.withColumn("digest", digest).join(sources, F.col("source").eqNullSafe(F.col("of")))
    return rows.withColumn("bucket", F.floor(spread * F.col("n_buckets") / (1 << 32)))


def bucket_offsets(rows: DataFrame, words: Column) -> DataFrame:
    """sid, bucket, offset: the words in a source's earlier buckets, which come before this one."""
    sums = rows.groupBy("sid", "bucket").agg(F.sum(words).alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))


def placed(sized: DataFrame, targets: DataFrame, *keep: str) -> DataFrame:
    """sid, bucket, place, start, size and ``keep``: each document's first word in its source's shuffled order."""
    rows = dealt(sized, targets)
    offsets = bucket_offsets(rows, F.col("size"))
    order = Window.partitionBy("sid", "bucket").orderBy("digest", "doc_id", "size")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"place": F.row_number().over(order), "inside": inside}).join(offsets, ["sid", "bucket"])
    return rows.select("sid", "bucket", "place", (F.col("offset") + F.col("inside")).alias("start"), "size", "source_size", "target", *keep)


def placed_sizes(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """As ``placed``, with doc_id, for rows of nothing but doc_id, source and size.

    Rows that agree in these are interchangeable: they are ordered as one row with
    their number, and numbered behind one another afterwards. So any number of
    rows with one id, or none, leaves a bucket with a row for each of their sizes.
    """
    merged = sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    rows = dealt(merged, targets)
    words = F.col("size") * F.col("copies")
    offsets = bucket_offsets(rows, words)
    before = Window.partitionBy("sid", "bucket").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = {name: F.coalesce(F.sum(of).over(before), F.lit(0)) for name, of in (("place", F.col("copies")), ("inside", words))}
    # Copies are written out in parts that may stand in any task.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BUCKET_DOCS)))
    parts = rows.withColumns(first).join(offsets, ["sid", "bucket"]).withColumn("part", part).repartition("sid", "bucket", "part")
    from_copy, to_copy = F.col("part") * BUCKET_DOCS, F.least(F.col("copies"), (F.col("part") + 1) * BUCKET_DOCS) - 1
    each = parts.withColumn("copy", F.explode(F.sequence(from_copy, to_copy)))
    return each.select(
        "sid", "bucket", (F.col("place") + F.col("copy") + 1).alias("place"),
        (F.col("offset") + F.col("inside") + F.col("copy") * F.col("size")).alias("start"), "size", "source_size", "target", "doc_id",
    )


def schedule(targets: DataFrame) -> DataFrame:
    """slot, sid, rank, epoch, block: which block of which source stands at each slot of the mix.

    Slots find their source by an equal join on cells of the unit interval, four
    per source, and are ranked in chunks whose counts are added up. Ranks beyond
    MOST rounds of a source's blocks are left out.
    """
    spark = targets.sparkSession
    size = targets.agg(F.max("hi"), F.count(F.lit(1))).first()
    slots, cells = -int(-(size[0] or 0.0) // 1), 4 * size[1]
    span = size[0] or 1.0
    point = F.col("slot") % POINTS * GOLDEN % POINTS / F.lit(float(POINTS)) * F.lit(span)
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point)
    points = points.withColumn("cell", F.floor(F.col("point") / F.lit(span) * cells))
    first, last = (F.floor(F.col(c) / F.lit(span) * cells) for c in ("lo", "hi"))
    parts = targets.filter("hi > lo").select("sid", "lo", "hi", "n_blocks", F.explode(F.sequence(first, last)).alias("cell"))
    hit = points.join(parts, "cell").filter("point >= lo AND point < hi").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = hit.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = hit.withColumn("inside", inside).join(offsets, ["sid", "chunk"]).withColumn("rank", F.col("offset") + F.col("inside"))
    epoch, block = F.floor(F.col("rank") / F.col("n_blocks")), F.col("rank") % F.col("n_blocks")
    return ranked.filter(F.col("rank") < MOST * F.col("n_blocks")).select("slot", "sid", "rank", epoch.alias("epoch"), block.alias("block"))


def takes(rows: DataFrame, slots: DataFrame, *more: str) -> DataFrame:
    """sid, bucket, place, taken and ``more`` of every placed document; ``words`` has the words taken in each round.

    Blocks meet slots on (source, block); a document's blocks come together
    again by its place. A document without words takes none.
    """
    times = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    first, last = F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    pieces = rows.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    ends = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    words = F.when(F.col("block") >= 0, ends - F.greatest(F.col("start"), F.col("block") * BLOCK)).otherwise(0)
    met = pieces.withColumn("words", words).join(times, ["sid", "block"], "left")
    rounds = [F.coalesce(F.sum(F.when(F.col("times") > e, F.col("words"))), F.lit(0)) for e in range(MOST)]
    keys = ["sid", "bucket", "place"]
    found = met.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in more], F.array(*rounds).alias("words"))
    return found.withColumn("taken", F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix as documents: each row once for each round that takes words of it, in the columns of ``docs``.

    A round that takes a document's first words only (the last block of the mix)
    cuts the text behind them; n_chars, where there is such a column, follows.
    Rows without words go, null sources count as one source, repeated rows are
    rows of their own; an empty table gives no rows. Other columns stay.
    """
    columns = docs.columns
    sized = docs.select(F.struct(*columns).alias("row"), "doc_id", "source", n_words(F.col("text")).alias("size"))
    targets = stored(source_targets(sized), "targets")
    rows = stored(placed(sized, targets, "row"), "placed")
    found = takes(rows.drop("row"), schedule(targets))
    copies = found.select("sid", "bucket", "place", F.explode("words").alias("words")).filter("words > 0")
    whole = rows.join(copies, ["sid", "bucket", "place"])
    ends = F.split(F.col("row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(ends, 1, F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("row.text"))
    out = whole.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns])
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def word_takes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row; see op7_golden_mix."""
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    targets = stored(source_targets(sized), "targets")
    rows = stored(placed_sizes(sized, targets), "placed")
    columns = ("doc_id", "size", "source_size", "target")
    return takes(rows, schedule(targets), *columns).select(*columns, "taken")


def op7_golden_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of each document, with its source's size and target."""
    return word_takes(table(spark, folder, "documents"))


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5('{SEED}' || coalesce(':' || doc_id, '')) AS digest
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source
), w AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][(sid - 1) % {len(WEIGHTS)} + 1] AS weight, {MOST}.0::DOUBLE * source_size AS brim FROM s
), c AS (
  SELECT *, brim * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))
    <= ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(brim) OVER b, 0)) * weight AS capped
  FROM w WINDOW b AS (ORDER BY brim / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, round(CASE WHEN capped THEN brim ELSE ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(brim) FILTER (capped) OVER (), 0))
    * weight / (sum(weight) FILTER (NOT capped) OVER ()) END, 6) AS target, ceil(source_size / {BLOCK})::BIGINT AS n_blocks
  FROM c
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN target * n_blocks / source_size ELSE 0 END AS needed FROM t
), h AS (
  SELECT *, sum(needed) OVER (ORDER BY sid) AS hi FROM n
), p AS (
  SELECT i, i % {POINTS} * {GOLDEN} % {POINTS} / {float(POINTS)}::DOUBLE * span AS point
  FROM (SELECT max(hi) AS span, unnest(range(ceil(max(hi))::BIGINT)) AS i FROM h)
), r AS (
  SELECT sid, n_blocks, row_number() OVER (PARTITION BY sid ORDER BY i) - 1 AS rank
  FROM p JOIN h ON point >= hi - needed AND point < hi
), k AS (
  SELECT sid, rank % n_blocks AS block, count(*) AS times FROM r WHERE rank < {MOST} * n_blocks GROUP BY ALL
), o AS (
  SELECT d.*, sid, source_size, target, row_number() OVER () AS id,
    coalesce(sum(size) OVER (PARTITION BY sid ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source
), x AS (
  SELECT id, sid, start, size, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM o WHERE size > 0
), y AS (
  SELECT id, sum(times * (least(start + size, (block + 1) * {BLOCK}) - greatest(start, block * {BLOCK}))) AS taken
  FROM x JOIN k USING (sid, block) GROUP BY id
)
SELECT doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM o LEFT JOIN y USING (id)
"""
