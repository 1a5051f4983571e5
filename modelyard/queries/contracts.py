"""Projections, validation and gates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from modelyard.operators.contract import (
    all_but,
    band_gate,
    check_rows,
    columns_by_type,
    contract_report,
    contract_violations,
    drop_missing,
    enforce_schema,
    infer_signature,
    minimum_rows,
    missing_cells,
    optional_email_rule,
    positive_rule,
)
from modelyard.operators.regression import regression_metrics
from modelyard.operators.routing import allowed_rows, denied_rows, gate_by_list, route, route_by
from modelyard.operators.splits import with_hash_split
from modelyard.queries import query, rounded, table
from modelyard.sources.readers import select_all

NAN = float("nan")

WITH_GAPS = """gaps AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_quantity = 7 THEN NULL WHEN l_quantity = 8 THEN 'nan'::DOUBLE ELSE l_quantity END AS quantity,
         nullif(l_returnflag, 'R') AS returnflag, l_extendedprice
  FROM lineitem)"""


def with_gaps(spark, folder):
    quantity = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(quantity == 7, F.lit(None)).when(quantity == 8, F.lit(NAN)).otherwise(quantity).alias("quantity"),
        F.nullif("l_returnflag", F.lit("R")).alias("returnflag"),
        "l_extendedprice",
    )


@query("select_columns", "P1", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_columns(spark, folder):
    table(spark, folder, "lineitem").createOrReplaceTempView("yard_lineitem")
    return select_all(spark, "yard_lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("all_but_label", "P2", "SELECT * EXCLUDE (o_totalprice) FROM orders")
def all_but_label(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select(all_but(orders, "o_totalprice"))


@query(
    "columns_by_type",
    "P3",
    "SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM lineitem",
)
def by_type(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    strings, numbers = columns_by_type(lineitem, "l_extendedprice")
    return lineitem.select(*strings, *numbers)


@query("drop_column", "P4", "SELECT l_quantity, l_discount, l_tax FROM lineitem")
def drop_column(spark, folder):
    scored = table(spark, folder, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", (F.col("l_quantity") * 1500).alias("prediction")
    )
    return scored.drop("prediction")


@query(
    "complete_rows",
    "P5",
    f"""WITH {WITH_GAPS} SELECT * FROM gaps
        WHERE quantity IS NOT NULL AND NOT isnan(quantity) AND returnflag IS NOT NULL""",
)
def complete_rows(spark, folder):
    return drop_missing(with_gaps(spark, folder))


@query(
    "missing_cell_count",
    "P7",
    f"""WITH {WITH_GAPS} SELECT count(*) FILTER (WHERE quantity IS NULL OR isnan(quantity))
        + count(*) FILTER (WHERE returnflag IS NULL) AS missing_cells FROM gaps""",
)
def missing_cell_count(spark, folder):
    return missing_cells(with_gaps(spark, folder))


ORDER_COLUMNS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]


@query(
    "data_contract",
    "P6 P7 P8 P9 U4 A1 A2",
    """WITH s AS (SELECT *, CASE WHEN substr(md5(concat_ws(':', '42', o_orderkey::VARCHAR)), 1, 8) < '33333333'
                            THEN 'test' ELSE 'train' END AS split FROM orders)
       SELECT split, count(*) AS n_rows, 0::BIGINT AS missing_cells,
              bool_and(o_totalprice BETWEEN 0 AND 500000) AS label_in_range,
              min(o_totalprice) AS label_min, max(o_totalprice) AS label_max,
              round(avg(o_totalprice), 4) AS label_mean, 6 AS columns_checked, true AS columns_ok,
              '' AS broken_columns, true AS label_numeric,
              CASE WHEN bool_and(o_totalprice BETWEEN 0 AND 500000) THEN 'passed' ELSE 'failed' END AS status
       FROM s GROUP BY split""",
)
def data_contract(spark, folder):
    marked = with_hash_split(table(spark, folder, "orders"), ["o_orderkey"])
    return rounded(contract_report(marked, ORDER_COLUMNS, "o_totalprice", 0, 500000, "split"), 4)


@query(
    "broken_contract",
    "P6 P7 P8 P9 U4",
    f"""WITH {WITH_GAPS}
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE quantity IS NULL OR isnan(quantity))
                 + count(*) FILTER (WHERE returnflag IS NULL) AS missing_cells,
               bool_and(coalesce(quantity BETWEEN 1 AND 40, false)) AS label_in_range,
               4 AS columns_checked, false AS columns_ok, true AS label_numeric, 'failed' AS status,
               'l_tax absent, l_linenumber unexpected, l_extendedprice unexpected' AS broken_columns
        FROM gaps""",
)
def broken_contract(spark, folder):
    expected = ["l_orderkey", "quantity", "returnflag", "l_tax"]
    report = contract_report(with_gaps(spark, folder), expected, "quantity", 1, 40)
    return report.drop("label_min", "label_max", "label_mean")


@query(
    "contract_violations",
    "P6 P8 P9 U4",
    f"""WITH {WITH_GAPS}, n AS (SELECT count(*) FILTER (WHERE quantity IS NULL OR isnan(quantity)) AS q,
            count(*) FILTER (WHERE returnflag IS NULL) AS r,
            count(*) FILTER (WHERE NOT coalesce(quantity BETWEEN 1 AND 40, false)) AS o FROM gaps)
        SELECT * FROM (SELECT 'absent' AS kind, 'l_tax' AS column, NULL::BIGINT AS n_rows
            UNION ALL SELECT 'unexpected', 'l_linenumber', NULL UNION ALL SELECT 'unexpected', 'l_extendedprice', NULL UNION ALL SELECT 'empty', 'quantity', q FROM n
            UNION ALL SELECT 'empty', 'returnflag', r FROM n UNION ALL SELECT 'outside', 'quantity', o FROM n)
        WHERE n_rows IS NULL OR n_rows > 0""",
)
def contract_violations_(spark, folder):
    expected = ["l_orderkey", "quantity", "returnflag", "l_tax"]
    return contract_violations(with_gaps(spark, folder), expected, "quantity", 1, 40)


@query(
    "row_rules",
    "P10",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS balance,
                         c_nationkey - 3 AS shifted FROM customer),
            e AS (SELECT c_custkey,
                    CASE WHEN balance IS NULL THEN 'balance is required'
                         WHEN balance <= 0 THEN 'balance must be positive' END AS a,
                    CASE WHEN shifted <= 0 THEN 'shifted must be positive' END AS b FROM c)
       SELECT c_custkey, concat_ws('; ', a, b) AS errors, a IS NULL AND b IS NULL AS accepted FROM e""",
)
def row_rules(spark, folder):
    requests = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("balance"),
        (F.col("c_nationkey") - 3).alias("shifted"),
    )
    checked = check_rows(requests, [positive_rule("balance"), positive_rule("shifted")])
    return checked.select("c_custkey", F.array_join("errors", "; ").alias("errors"), "accepted")


@query(
    "optional_email",
    "P11",
    """WITH m AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN NULL
                     WHEN c_nationkey < 10 THEN c_name
                     ELSE concat(replace(lower(c_name), '#', '.'), '@example.com') END AS email FROM customer)
       SELECT c_custkey, email, email IS NULL OR regexp_matches(email,
              '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}$') AS accepted
       FROM m""",
)
def optional_email(spark, folder):
    name = F.col("c_name")
    email = F.when(F.col("c_nationkey") >= 10, F.concat(F.replace(F.lower(name), F.lit("#"), F.lit(".")), F.lit("@example.com")))
    email = F.when(F.col("c_nationkey") < 5, F.lit(None)).when(F.col("c_nationkey") < 10, name).otherwise(email)
    members = table(spark, folder, "customer").select("c_custkey", email.alias("email"))
    return check_rows(members, [optional_email_rule("email")]).drop("errors")


@query(
    "schema_enforced",
    "P12",
    """SELECT l_extendedprice, l_linenumber::BIGINT AS l_linenumber, l_returnflag,
              l_quantity FROM lineitem""",
)
def schema_enforced(spark, folder):
    signature = (
        StructType()
        .add("l_extendedprice", DoubleType())
        .add("l_linenumber", LongType())
        .add("l_returnflag", StringType())
        .add("l_quantity", DoubleType())
    )
    return enforce_schema(table(spark, folder, "lineitem"), signature)


@query(
    "inferred_signature",
    "P13",
    f"""WITH {WITH_GAPS},
        c AS (SELECT count(*) FILTER (WHERE quantity IS NULL OR isnan(quantity)) AS q,
                     count(*) FILTER (WHERE returnflag IS NULL) AS f,
                     count(*) FILTER (WHERE l_orderkey IS NULL) AS k,
                     count(*) FILTER (WHERE l_linenumber IS NULL) AS l,
                     count(*) FILTER (WHERE l_extendedprice IS NULL) AS p FROM gaps)
        SELECT 0 AS position, 'l_orderkey' AS name, 'bigint' AS type, k = 0 AS required FROM c
        UNION ALL SELECT 1, 'l_linenumber', 'int', l = 0 FROM c
        UNION ALL SELECT 2, 'quantity', 'double', q = 0 FROM c
        UNION ALL SELECT 3, 'returnflag', 'string', f = 0 FROM c
        UNION ALL SELECT 4, 'l_extendedprice', 'double', p = 0 FROM c""",
)
def inferred_signature(spark, folder):
    return infer_signature(with_gaps(spark, folder))


@query(
    "listed_users",
    "P14 J6",
    """SELECT event_id, user_id, CASE WHEN user_id IN (3, 5, 8, 13, 21, 34) THEN 'allowed' ELSE 'denied' END AS access
       FROM events""",
)
def listed_users(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    return gate_by_list(events, "user_id", [3, 5, 8, 13, 21, 34])


@query(
    "allowed_orders",
    "P14 J6",
    """SELECT o_orderkey, o_custkey, 'allowed' AS access FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
       UNION ALL
       SELECT o_orderkey, o_custkey, 'denied' AS access FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def allowed_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    members = (
        table(spark, folder, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    )
    inside = allowed_rows(orders, members, "o_custkey").withColumn("access", F.lit("allowed"))
    return inside.unionByName(
        denied_rows(orders, members, "o_custkey").withColumn("access", F.lit("denied"))
    )


@query(
    "routed_events",
    "P15",
    """SELECT event_id, CASE WHEN event_type IN ('signup') THEN 'welcome'
                             WHEN event_type IN ('view', 'click') THEN 'converse'
                             WHEN event_type IN ('purchase') THEN 'describe_image' ELSE 'ignore' END AS handler
       FROM events""",
)
def routed_events(spark, folder):
    routes = {"welcome": ["signup"], "converse": ["view", "click"], "describe_image": ["purchase"]}
    return table(spark, folder, "events").select(
        "event_id", route_by(F.col("event_type"), routes, "ignore").alias("handler")
    )


@query(
    "routed_messages",
    "P15",
    """WITH m AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN concat('/start ', text) ELSE text END AS text,
                    CASE WHEN turn % 3 = 0 THEN 'text' WHEN turn % 3 = 1 THEN 'voice' ELSE 'photo' END AS kind
                  FROM conversations)
       SELECT conv_id, turn, CASE WHEN regexp_extract(text, '^/([a-z]+)', 1) IN ('start', 'help') THEN 'welcome'
                WHEN kind = 'photo' THEN 'describe_image' WHEN kind = 'voice' THEN 'transcribe'
                ELSE 'converse' END AS handler
       FROM m""",
)
def routed_messages(spark, folder):
    kind = F.when(F.col("turn") % 3 == 0, "text").when(F.col("turn") % 3 == 1, "voice").otherwise("photo")
    text = F.when(F.col("role") == "system", F.concat(F.lit("/start "), F.col("text"))).otherwise(F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", route(kind, text).alias("handler"))


@query(
    "error_band_gate",
    "P19",
    """WITH m AS (SELECT l_returnflag, round(sqrt(avg(power(l_extendedprice - l_quantity * 1500, 2))), 4) AS rmse
                  FROM lineitem GROUP BY 1)
       SELECT *, CASE WHEN rmse > 0 AND rmse < 20000 THEN 'passed' ELSE 'failed' END AS status FROM m""",
)
def error_band_gate(spark, folder):
    scored = table(spark, folder, "lineitem").withColumn("prediction", F.col("l_quantity") * 1500)
    metrics = regression_metrics(scored, "l_extendedprice", "prediction", ["l_returnflag"])
    return band_gate(rounded(metrics.select("l_returnflag", "rmse"), 4), "rmse", 0.0, 20000.0)


@query(
    "enough_rows_branch",
    "P20",
    """SELECT count(*) AS n_rows, CASE WHEN count(*) >= 20 THEN 'monitoring_done' ELSE 'skip_monitoring' END AS branch
       FROM lineitem""",
)
def enough_rows_branch(spark, folder):
    return minimum_rows(table(spark, folder, "lineitem"), 20)
