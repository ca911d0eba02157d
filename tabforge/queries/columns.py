"""P1-P18."""

from pyspark.sql import functions as F

from tabforge.operators import cols as C
from tabforge.queries.registry import LINE_ID, query, r6


@query("drop_cols", "SELECT p_partkey, p_type, p_size, p_retailprice FROM part")
def drop_cols(t):
    return t.part.drop("p_name", "p_brand")


@query("select_pos", "SELECT o_custkey, o_orderstatus, o_totalprice FROM orders")
def select_pos(t):
    return t.orders.select(C.cols_pos(t.orders, 1, -2))


@query("select_range", "SELECT p_brand, p_type, p_size FROM part")
def select_range(t):
    return t.part.select(C.cols_range(t.part, "p_brand", "p_size"))


@query("select_suffix", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def select_suffix(t):
    return t.orders.select(*C.cols_like(t.orders, suffix="key"), *C.cols_like(t.orders, contains="date"))


@query("reorder_cols", "SELECT s_acctbal, s_suppkey, s_nationkey, s_name FROM supplier")
def reorder_cols(t):
    return C.reorder(t.supplier, [["s_acctbal"], ["s_suppkey", "s_nationkey"], ["s_name"]])


@query("align_cols", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def align_cols(t):
    train = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return C.align(t.customer.select("c_mktsegment", "c_name", "c_acctbal", "c_custkey"), train)


@query("filter_eq", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'")
def filter_eq(t):
    return t.events.where(F.col("event_type") == "click").select("event_id", "user_id", "value")


@query(
    "row_lookup",
    """SELECT 'key' AS how, o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 42
       UNION ALL
       SELECT 'position', o_orderkey, o_totalprice FROM
         (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 19""",
)
def row_lookup(t):
    cols = ["o_orderkey", "o_totalprice"]
    by_key = C.lookup(t.orders, "o_orderkey", 42).select(F.lit("key").alias("how"), *cols)
    nth = C.lookup_position(t.orders.select(cols), "o_orderkey", 18).select(F.lit("position").alias("how"), *cols)
    return by_key.unionAll(nth)


@query(
    "semi_join_keys",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_join_keys(t):
    keys = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return C.semi_join_keys(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey")


_NARROW = """CASE WHEN min({c}) >= -128 AND max({c}) < 128 THEN 'tinyint'
                  WHEN min({c}) >= -32768 AND max({c}) < 32768 THEN 'smallint'
                  WHEN min({c}) >= -2147483648 AND max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END"""


@query(
    "downcast_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col, {_NARROW.format(c=c)} AS type, CAST(sum({c}) AS BIGINT) AS total FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    ),
)
def downcast_numeric(t):
    ints = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    small = C.downcast(t.lineitem.select(ints), ints)
    types = dict(small.dtypes)
    cells = [
        F.struct(F.lit(c).alias("col"), F.lit(types[c]).alias("type"), F.sum(c).cast("long").alias("total")) for c in ints
    ]
    return small.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query("label_shift", "SELECT vec_id, CAST(label - 1 AS INTEGER) AS label FROM embeddings")
def label_shift(t):
    return C.shift_label(t.embeddings.select("vec_id", "label"), "label", -1)


@query("drop_all_null", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, nullif(s_nationkey, 0) AS partly FROM supplier")
def drop_all_null(t):
    wide = t.supplier.withColumns(
        {"empty": F.nullif("s_name", "s_name"), "partly": F.nullif(F.col("s_nationkey"), F.lit(0))}
    )
    return C.drop_all_null(wide)


@query("drop_near_constant", f"SELECT {LINE_ID} AS line_id, l_quantity, l_tax, l_returnflag FROM lineitem")
def drop_near_constant(t):
    wide = t.lineitem.select(
        F.expr(LINE_ID).alias("line_id"),
        "l_quantity",
        "l_tax",
        "l_returnflag",
        (F.col("l_quantity") > 0).cast("int").alias("always_one"),
        (F.col("l_orderkey") == F.col("l_partkey")).cast("int").alias("rarely_one"),
        F.when(F.col("l_orderkey") == F.col("l_suppkey"), "odd").otherwise("usual").alias("rare_word"),
    )
    checked = [c for c in wide.columns if c != "line_id"]
    return C.drop_near_constant(wide, 99.0, checked)


@query("drop_low_variance", f"SELECT {LINE_ID} AS line_id, l_quantity, l_extendedprice, l_linenumber FROM lineitem")
def drop_low_variance(t):
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return C.drop_low_variance(t.lineitem.select(F.expr(LINE_ID).alias("line_id"), *numbers), numbers, 1.5)


@query(
    "impute_mean",
    f"""SELECT {LINE_ID} AS line_id,
              round(coalesce(nullif(l_tax, 0.0), (SELECT avg(nullif(l_tax, 0.0)) FROM lineitem)), 6) AS l_tax,
              round(coalesce(nullif(l_discount, 0.0), (SELECT avg(nullif(l_discount, 0.0)) FROM lineitem)), 6)
                AS l_discount
       FROM lineitem""",
)
def impute_mean(t):
    gaps = t.lineitem.select(
        F.expr(LINE_ID).alias("line_id"), *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in ("l_tax", "l_discount")]
    )
    full = C.impute(gaps, ["l_tax", "l_discount"])
    return full.select("line_id", r6("l_tax").alias("l_tax"), r6("l_discount").alias("l_discount"))


@query(
    "replace_inf",
    f"""SELECT {LINE_ID} AS line_id,
              round(CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity / l_discount END, 6) AS ratio
       FROM lineitem""",
)
def replace_inf(t):
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide("l_quantity", "l_discount")
    )
    rows = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), ratio.alias("ratio"))
    return C.finite_or(rows, ["ratio"]).withColumn("ratio", r6("ratio"))
