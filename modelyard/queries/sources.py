"""Scans and sinks: each query writes and reads back, or reads, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.operators.align import with_single
from modelyard.operators.report import bullet, section
from modelyard.operators.splits import with_hash_split
from modelyard.operators.summary import label_summary
from modelyard.queries import query, rounded, table
from modelyard.session import scratch_path
from modelyard.sources.readers import (
    data_url,
    list_files,
    mime_type,
    read_artifacts,
    read_binary,
    read_csv,
    read_source,
    select_all,
)
from modelyard.sources.sinks import (
    persist_and_count,
    rows_as_json,
    rows_from_json,
    save_table,
    write_csv,
    write_document,
    write_single_csv,
)


@query("csv_round_trip", "S1 S2 S8", "SELECT * FROM customer")
def csv_round_trip(spark, folder):
    customer = table(spark, folder, "customer")
    path = scratch_path(spark, "customer-csv")
    write_csv(customer, path)
    return read_csv(spark, path, customer.schema)


@query("csv_inferred_types", "S1", "SELECT * FROM orders")
def csv_inferred_types(spark, folder):
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "orders-csv")
    write_csv(orders, path)
    found = read_csv(spark, path)
    return found.withColumns(
        {
            "o_orderkey": F.col("o_orderkey").cast("bigint"),
            "o_custkey": F.col("o_custkey").cast("bigint"),
            "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
        }
    )


@query("table_round_trip", "S3 S4 S6", "SELECT * FROM part")
def table_round_trip(spark, folder):
    save_table(table(spark, folder, "part"), "yard_part", scratch_path(spark, "part-table"))
    return select_all(spark, "yard_part")


@query(
    "source_by_kind",
    "S5 U1",
    """SELECT 'delta' AS kind, * FROM supplier UNION ALL SELECT 'local' AS kind, * FROM supplier""",
)
def source_by_kind(spark, folder):
    supplier = table(spark, folder, "supplier")
    path = scratch_path(spark, "supplier-csv")
    save_table(supplier, "yard_supplier", scratch_path(spark, "supplier-table"))
    write_csv(supplier, path)
    by_table = read_source(spark, "delta", "yard_supplier").withColumn("kind", F.lit("delta"))
    by_path = read_source(spark, "local", path, supplier.schema).withColumn("kind", F.lit("local"))
    return by_table.unionByName(by_path)


@query(
    "single_file_summary",
    "S7 S8",
    """SELECT o_orderpriority, count(*) AS n_rows, min(o_totalprice) AS label_min,
              max(o_totalprice) AS label_max, round(avg(o_totalprice), 4) AS label_mean
       FROM orders GROUP BY 1""",
)
def single_file_summary(spark, folder):
    summary = rounded(label_summary(table(spark, folder, "orders"), "o_totalprice", ["o_orderpriority"]), 4)
    path = scratch_path(spark, "summary-csv")
    write_single_csv(summary, path)
    return read_csv(spark, path, summary.schema)


@query(
    "document_with_latest_copy",
    "S9",
    """SELECT 'lineitem' AS dataset, count(*) AS n_rows, min(l_extendedprice) AS label_min,
              max(l_extendedprice) AS label_max, round(avg(l_extendedprice), 4) AS label_mean
       FROM lineitem""",
)
def document_with_latest_copy(spark, folder):
    summary = label_summary(table(spark, folder, "lineitem"), "l_extendedprice")
    document = rounded(summary, 4).withColumn("dataset", F.lit("lineitem"))
    path, latest = scratch_path(spark, "document"), scratch_path(spark, "latest")
    write_document(document, path, latest)
    return read_artifacts(spark, {"summary": latest}, {"summary": document.schema})["summary"]


@query(
    "artifact_report",
    "S9 S10 F10",
    """WITH s AS (SELECT count(*) AS n, avg(o_totalprice) AS m FROM orders),
            v AS (SELECT count(*) FILTER (WHERE substr(md5(concat_ws(':', '42', o_orderkey::VARCHAR)), 1, 8) >= '33333333') AS train,
                         count(*) FILTER (WHERE substr(md5(concat_ws(':', '42', o_orderkey::VARCHAR)), 1, 8) < '33333333') AS test
                  FROM orders)
       SELECT concat('## Orders at a glance', chr(10), chr(10),
                     '- rows: `', s.n, '`', chr(10),
                     '- rows learnt from: `', v.train, '`', chr(10),
                     '- rows held out: `', v.test, '`', chr(10),
                     '- mean price: `', printf('%.2f', s.m), '`') AS report
       FROM s, v""",
)
def artifact_report(spark, folder):
    orders = table(spark, folder, "orders")
    summary = label_summary(orders, "o_totalprice")
    sides = with_hash_split(orders, ["o_orderkey"]).agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test")
    )
    paths = {"summary": scratch_path(spark, "summary"), "validation": scratch_path(spark, "validation")}
    write_document(summary, paths["summary"])
    write_document(sides, paths["validation"])
    loaded = read_artifacts(spark, paths, {"summary": summary.schema, "validation": sides.schema})
    rows = loaded["summary"].select("n_rows", "label_mean")
    rows = with_single(with_single(rows, loaded["validation"], "train"), loaded["validation"], "test")
    return rows.select(
        section(
            "Orders at a glance",
            [
                bullet("rows", F.col("n_rows")),
                bullet("rows learnt from", F.col("train")),
                bullet("rows held out", F.col("test")),
                bullet("mean price", F.format_string("%.2f", "label_mean")),
            ],
        ).alias("report")
    )


@query("file_listing", "S11")
def file_listing(spark, folder):
    return list_files(spark, folder, "*.parquet").select("name", "size")


@query("json_between_tasks", "S12", "SELECT * FROM events")
def json_between_tasks(spark, folder):
    events = table(spark, folder, "events")
    return rows_from_json(rows_as_json(events), events.schema)


@query(
    "image_payloads",
    "S13 J7",
    """WITH files AS (
         SELECT page_id, concat('page_', page_id,
                  CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.gif' ELSE '' END) AS path,
                encode(html) AS content FROM pages)
       SELECT page_id,
              CASE page_id % 4 WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/gif' ELSE 'image/png' END AS mime,
              concat('data:', CASE page_id % 4 WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/gif' ELSE 'image/png' END,
                     ';base64,', base64(content)) AS url
       FROM files""",
)
def image_payloads(spark, folder):
    extension = (
        F.when(F.col("page_id") % 4 == 0, ".png")
        .when(F.col("page_id") % 4 == 1, ".JPG")
        .when(F.col("page_id") % 4 == 2, ".gif")
        .otherwise("")
    )
    files = table(spark, folder, "pages").select(
        "page_id",
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), extension).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    return files.select(
        "page_id",
        mime_type(F.col("path")).alias("mime"),
        data_url(F.col("path"), F.col("content")).alias("url"),
    )


@query(
    "binary_files",
    "S11 S13",
    """WITH files AS (SELECT c_custkey // 1000 AS block, encode(string_agg(coalesce(c_name, '') || chr(10), '' ORDER BY c_custkey, c_name)) AS content
                      FROM customer GROUP BY 1)
       SELECT block, octet_length(content)::BIGINT AS size, concat('data:image/png;base64,', base64(content)) AS url FROM files""",
)
def binary_files(spark, folder):
    """Files of a thousand customers' names each, listed and read back as bytes."""
    path = scratch_path(spark, "binary")
    names = table(spark, folder, "customer").select(
        F.floor(F.col("c_custkey") / 1000).alias("block"), "c_custkey", F.coalesce("c_name", F.lit("")).alias("value")
    )
    parted = names.repartition("block").sortWithinPartitions("block", "c_custkey", "value").select("block", "value")
    parted.write.partitionBy("block").text(path)
    files = read_binary(spark, path, "part-*").select("path", data_url(F.col("path"), F.col("content")).alias("url"))
    block = F.regexp_extract("path", r"/block=(\d+)/", 1).cast("bigint").alias("block")
    return list_files(spark, path, "part-*").join(files, "path").select(block, "size", "url")


@query(
    "prompts_against_one_image",
    "J7",
    """SELECT conv_id, turn, text AS prompt, (SELECT max(url) FROM pages) AS image
       FROM conversations WHERE role = 'user'""",
)
def prompts_against_one_image(spark, folder):
    image = table(spark, folder, "pages").agg(F.max("url").alias("image"))
    prompts = table(spark, folder, "conversations").filter("role = 'user'")
    return with_single(prompts, image, "image").select("conv_id", "turn", F.col("text").alias("prompt"), "image")


@query("cached_count", "S14", "SELECT count(*) AS n_rows FROM lineitem")
def cached_count(spark, folder):
    kept, n = persist_and_count(table(spark, folder, "lineitem"))
    kept.unpersist()
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n_rows"))
