"""IO1-IO8."""

from pyspark.sql import functions as F

from tabforge.queries.registry import query
from tabforge.runtime import new_path
from tabforge.sources import io


@query(
    "src_csv_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def src_csv_roundtrip(t):
    path = new_path(t.spark, "customer-csv")
    t.customer.write.csv(path, header=True)
    return io.read_csv(t.spark, path, t.customer.schema, on_bad="fail")


@query(
    "src_csv_typed",
    """SELECT event_id, CAST(user_id AS INTEGER) AS user_id,
              CASE WHEN event_type <> 'error' THEN value END AS value,
              event_type = 'error' AS is_bad
       FROM events""",
)
def src_csv_typed(t):
    path = new_path(t.spark, "events-csv")
    value = F.when(F.col("event_type") == "error", "not a number").otherwise(F.col("value").cast("string"))
    t.events.select("event_id", "user_id", value.alias("value")).write.csv(path, header=True)
    schema = "event_id long, user_id int, value double"
    df = io.read_csv(t.spark, path, schema, on_bad="null")
    return df.select("event_id", "user_id", "value", F.col(io.BAD_ROW).isNotNull().alias("is_bad"))


@query(
    "require_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def require_key(t):
    return io.key_report(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "parse_ts_format",
    """SELECT event_id,
              CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
       FROM events""",
)
def parse_ts_format(t):
    text = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd")).otherwise(
        F.date_format("ts", "yyyy MM dd HH:mm:ss")
    )
    parsed = io.parse_ts(text, ["yyyy MM dd HH:mm:ss"])
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "parse_ts_multi",
    """SELECT event_id,
              CASE event_type WHEN 'error' THEN NULL
                   WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:00')
                   WHEN 'view' THEN strftime(ts, '%Y-%m-%d 00:00:00')
                   ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
       FROM events""",
)
def parse_ts_multi(t):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("no time"))
        .when(kind == "click", F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .when(kind == "view", F.date_format("ts", "yyyyMMdd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    parsed = io.parse_ts(text, ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyyMMdd"])
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "cache_parquet",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY o_orderpriority""",
)
def cache_parquet(t):
    path = new_path(t.spark, "cache")
    mark = io.inputs_fingerprint(t.spark, [f"{t.folder}/orders.parquet"], "v1")
    kept = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    io.cached(t.spark, path, lambda: t.orders.select(kept), mark)

    def never():
        raise AssertionError("the cached table must be used")

    return (
        io.cached(t.spark, path, never, mark)
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("sink_predictions", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prediction FROM orders")
def sink_predictions(t):
    path = new_path(t.spark, "predictions")
    scored = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("double").alias("prediction"))
    io.write_predictions(scored, path, "o_orderkey", "prediction")
    return io.read_csv(t.spark, path, "o_orderkey long, prediction int", on_bad="fail")
