"""J1-J6 and the literal table."""

from pyspark.sql import functions as F

from tabforge.functions import rowmath as M
from tabforge.operators import joins as J
from tabforge.queries.registry import LINE_ID, query, r6
from tabforge.sources.io import literal_table

PRICE_RANGES = [
    ("low", 0.0, 100000.0),
    ("middle", 50000.0, 250000.0),
    ("touching", 250000.0, 400000.0),
    ("high", 300000.0, 500000.0),
]
_RANGES_SQL = "(VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in PRICE_RANGES) + ") AS r(name, lo, hi)"

TYPE_CODES = [("ECONOMY", 1, "cheap"), ("SMALL", 2, "cheap"), ("LARGE", 3, "dear"), ("PROMO", 4, "dear")]


@query(
    "join_left_dim",
    f"""SELECT {LINE_ID} AS line_id, p_type, p_size FROM lineitem
        LEFT JOIN part p ON l_partkey = p_partkey + 50""",
)
def join_left_dim(t):
    """The dimension's keys are shifted, so that some rows find no partner."""
    dim = t.part.select((F.col("p_partkey") + 50).alias("l_partkey"), "p_type", "p_size")
    fact = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), "l_partkey")
    return J.enrich(fact, dim, "l_partkey").drop("l_partkey")


@query(
    "join_left_salted",
    f"""SELECT {LINE_ID} AS line_id, s_acctbal FROM lineitem
        LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def join_left_salted(t):
    dim = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    fact = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), "l_suppkey")
    return J.enrich(fact, dim, "l_suppkey", salts=4).drop("l_suppkey")


@query(
    "join_left_hot",
    f"""SELECT {LINE_ID} AS line_id, s_acctbal FROM lineitem
        LEFT JOIN supplier ON CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 50 <> 1 THEN l_suppkey END = s_suppkey""",
)
def join_left_hot(t):
    """One supplier has a third of the lines, some lines have none."""
    dim = t.supplier.select(F.col("s_suppkey").alias("key"), "s_acctbal")
    key = F.when(F.col("l_orderkey") % 3 == 0, 7).when(F.col("l_orderkey") % 50 != 1, F.col("l_suppkey"))
    fact = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), key.cast("long").alias("key"))
    return J.enrich_hot(fact, dim, "key", share=0.05).drop("key")


@query(
    "join_left_composite",
    """WITH w AS (
         SELECT nullif(event_type, 'error') AS event_type, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour,
                count(*) AS n_hour, round(avg(value), 6) AS mean_value
         FROM events GROUP BY ALL)
       SELECT e.event_id, w.n_hour, w.mean_value FROM events e
       LEFT JOIN w ON nullif(e.event_type, 'error') IS NOT DISTINCT FROM w.event_type
                  AND date_trunc('hour', e.ts) = w.hour""",
)
def join_left_composite(t):
    """Second dimension by two keys: what the hour before looked like. One key can be missing on both sides."""
    e = t.events.select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.date_trunc("hour", "ts").alias("hour"),
        "value",
    )
    hourly = e.groupBy("event_type", "hour").agg(
        F.count(F.lit(1)).alias("n_hour"), r6(F.avg("value")).alias("mean_value")
    )
    dim = hourly.withColumn("hour", F.col("hour") + F.expr("INTERVAL 1 HOUR"))
    joined = J.enrich(e, dim, ["event_type", "hour"], null_keys_match=True)
    return joined.select("event_id", "n_hour", "mean_value")


@query(
    "join_lookup",
    "SELECT p_partkey, code, kind FROM part LEFT JOIN (VALUES "
    + ", ".join(f"('{a}', {b}, '{c}')" for a, b, c in TYPE_CODES)
    + ") AS v(p_type, code, kind) USING (p_type)",
)
def join_lookup(t):
    table = literal_table(t.spark, TYPE_CODES, "p_type string, code int, kind string")
    return J.lookup_join(t.part.select("p_partkey", "p_type"), table, "p_type").drop("p_type")


@query(
    "range_flags",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN o_totalprice >= {a} AND o_totalprice < {b} THEN 1 ELSE 0 END AS {n}" for n, a, b in PRICE_RANGES
    )
    + " FROM orders",
)
def range_flags(t):
    flags = M.range_flags("o_totalprice", {n: (a, b) for n, a, b in PRICE_RANGES})
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in flags.items()])


@query(
    "range_join",
    f"""SELECT o_orderkey, name FROM orders
        JOIN {_RANGES_SQL} ON o_totalprice >= lo AND o_totalprice < hi""",
)
def range_join(t):
    ranges = literal_table(t.spark, PRICE_RANGES, "name string, lo double, hi double")
    return J.range_join(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ranges).select("o_orderkey", "name")


@query(
    "join_by_key",
    """SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, year(o_orderdate) AS order_year FROM orders""",
)
def join_by_key(t):
    a = t.orders.select("o_orderkey", r6(F.ln("o_totalprice")).alias("log_price"))
    b = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"))
    return J.glue([a, b], "o_orderkey")


@query(
    "row_shares",
    f"""SELECT {LINE_ID} AS line_id,
              round(l_discount / nullif(l_discount + l_tax, 0), 6) AS l_discount,
              round(l_tax / nullif(l_discount + l_tax, 0), 6) AS l_tax
       FROM lineitem""",
)
def row_shares(t):
    shares = M.row_shares(["l_discount", "l_tax"])
    return t.lineitem.select(F.expr(LINE_ID).alias("line_id"), *[r6(c).alias(n) for n, c in shares.items()])
