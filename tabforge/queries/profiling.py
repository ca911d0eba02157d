"""G1-G11, C1-C11."""

import math

from pyspark.sql import functions as F

from tabforge.operators import profile as P
from tabforge.operators import sketches
from tabforge.queries.registry import LINE_FEATURES, query, r6

NUMBERS = [*LINE_FEATURES, "l_linenumber"]


@query(
    "table_shape",
    """SELECT col, type, (SELECT count(*) FROM customer) AS n_rows FROM (VALUES
       ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
       ('c_mktsegment', 'string')) AS v(col, type)""",
)
def table_shape(t):
    return P.table_shape(t.customer)


@query("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def preview(t):
    return P.preview(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 5, last=True)


@query(
    "nunique_by_group",
    """SELECT event_type, count(DISTINCT user_id) AS n FROM
         (SELECT nullif(event_type, 'error') AS event_type, user_id FROM events)
       WHERE event_type IS NOT NULL GROUP BY event_type""",
)
def nunique_by_group(t):
    rows = t.events.select(F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "user_id")
    return P.nunique_by(rows, "event_type", "user_id")


@query("value_counts", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1")
def value_counts(t):
    return P.value_counts(t.customer, "c_mktsegment")


@query("group_min_max", "SELECT p_type, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1")
def group_min_max(t):
    return P.group_min_max(t.part, "p_type", "p_retailprice")


@query("group_count", "SELECT l_returnflag, count(nullif(l_tax, 0)) AS n FROM lineitem GROUP BY 1")
def group_count(t):
    rows = t.lineitem.select("l_returnflag", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"))
    return P.group_count(rows, "l_returnflag", "l_tax")


@query("distinct_classes", "SELECT DISTINCT label FROM embeddings")
def distinct_classes(t):
    return P.distinct_classes(t.embeddings, "label")


@query(
    "null_counts",
    """SELECT 'l_tax' AS col, count(*) FILTER (l_tax = 0) AS n_null FROM lineitem
       UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount = 0) FROM lineitem
       UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity = 0) FROM lineitem""",
)
def null_counts(t):
    cols = ["l_tax", "l_discount", "l_quantity"]
    return P.null_counts(t.lineitem.select(*[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in cols]))


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS col, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                   CAST(min({c}) AS DOUBLE) AS lo, round(quantile_cont({c}, 0.25), 6) AS q25,
                   round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
                   CAST(max({c}) AS DOUBLE) AS hi
            FROM (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0.0) AS l_discount FROM lineitem)"""
        for c in LINE_FEATURES[:3]
    ),
)
def describe_numeric(t):
    rows = t.lineitem.select(
        "l_quantity", "l_extendedprice", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount")
    )
    d = P.describe(rows, LINE_FEATURES[:3])
    return d.withColumns({c: r6(c) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "cols_with_negative",
    """SELECT 'c_custkey' AS col, bool_or(c_custkey < 0) AS has_negative FROM customer
       UNION ALL SELECT 'c_nationkey', bool_or(c_nationkey < 0) FROM customer
       UNION ALL SELECT 'c_acctbal', bool_or(c_acctbal < 0) FROM customer""",
)
def cols_with_negative(t):
    return P.cols_with_negative(t.customer)


MODE_COLS = ["l_returnflag", "l_linenumber", "l_discount", "l_tax"]


@query(
    "mode_frequency",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS col, round(100.0 * max(n) / (SELECT count(*) FROM lineitem), 6) AS mode_pct
            FROM (SELECT {v}, count(*) AS n FROM lineitem WHERE {v} IS NOT NULL GROUP BY {v})"""
        for c, v in [(c, "nullif(l_tax, 0.0)" if c == "l_tax" else c) for c in MODE_COLS]
    ),
)
def mode_frequency(t):
    rows = t.lineitem.select(*MODE_COLS).withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))
    return P.mode_frequency(rows).withColumn("mode_pct", r6("mode_pct")).orderBy("mode_pct", "col")


@query(
    "zero_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER ({c} = 0) AS n_zero FROM lineitem" for c in NUMBERS),
)
def zero_counts(t):
    return P.zero_counts(t.lineitem, NUMBERS)


# Four numbers and three made from them, so that strong correlations exist.
DERIVED = {
    "net": "l_extendedprice * (1 - l_discount)",
    "gross": "l_extendedprice * (1 + l_tax)",
    "boxes": "floor(l_quantity / 2)",
}
CORR_COLS = [*LINE_FEATURES, *DERIVED]
_WIDE = "SELECT " + ", ".join(LINE_FEATURES) + ", " + ", ".join(f"{e} AS {n}" for n, e in DERIVED.items()) + " FROM lineitem"


def _wide(t):
    return t.lineitem.select(*LINE_FEATURES, *[F.expr(e).cast("double").alias(n) for n, e in DERIVED.items()])


def _corr_sql(keep, columns="a, b, round(r, 6) AS r"):
    cells = [
        f"SELECT '{a}' AS a, '{b}' AS b, {1.0 if a == b else f'corr({a}, {b})'} AS r FROM wide"
        + (" GROUP BY 1, 2" if a == b else "")
        for i, a in enumerate(CORR_COLS)
        for j, b in enumerate(CORR_COLS)
        if keep(i, j)
    ]
    return f"WITH wide AS ({_WIDE}) SELECT {columns} FROM (" + " UNION ALL ".join(cells) + ")"


@query("corr_matrix", _corr_sql(lambda i, j: True, "a, b, CAST(round(r, 6) AS DOUBLE) AS r"))
def corr_matrix(t):
    return P.corr_long(_wide(t), CORR_COLS).withColumn("r", r6("r"))


@query("corr_lower_triangle", _corr_sql(lambda i, j: i > j))
def corr_lower_triangle(t):
    return P.corr_lower_triangle(_wide(t), CORR_COLS).withColumn("r", r6("r"))


@query("top_corr_pairs", _corr_sql(lambda i, j: i < j, "a, b, round(abs(r), 6) AS abs_r") + " WHERE abs(r) > 0.95")
def top_corr_pairs(t):
    return P.top_corr_pairs(_wide(t), CORR_COLS).withColumn("abs_r", r6("abs_r"))


EMB = [f"e{i}" for i in range(64)]


def embedding_cols(t):
    """The 64 numbers of each vector as columns."""
    return t.embeddings.select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(EMB)]
    )


@query(
    "corr_matrix_wide",
    """WITH cells AS (SELECT vec_id, i - 1 AS i, CAST(embedding[i] AS DOUBLE) AS x
                      FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))
       SELECT 'e' || p.i AS a, 'e' || q.i AS b, round(corr(p.x, q.x), 6) AS r
       FROM cells p JOIN cells q USING (vec_id) GROUP BY p.i, q.i""",
)
def corr_matrix_wide(t):
    """Many columns, so the Gram matrix path."""
    return P.corr_long(embedding_cols(t), EMB).withColumn("r", r6("r"))


FEATURES = {
    "mean": {"balance": "c_acctbal", "nation": "c_nationkey"},
    "worst": {"balance": "c_abs", "nation": "c_square"},
}


def _people(t):
    return t.customer.select(
        "c_custkey",
        "c_mktsegment",
        "c_acctbal",
        "c_nationkey",
        F.abs("c_acctbal").alias("c_abs"),
        (F.col("c_nationkey") * F.col("c_nationkey")).alias("c_square"),
    )


_PEOPLE = "SELECT *, abs(c_acctbal) AS c_abs, c_nationkey * c_nationkey AS c_square FROM customer"


@query(
    "entity_profile",
    f"WITH p AS ({_PEOPLE}), g AS (SELECT * FROM p WHERE c_mktsegment = 'BUILDING') "
    + " UNION ALL ".join(
        f"""SELECT '{block}' AS block, '{f}' AS feature,
              round((avg(g.{c}) - min(g.{c})) / (max(g.{c}) - min(g.{c})), 6) AS group_mean,
              round(((SELECT {c} FROM p WHERE c_custkey = 18) - min(g.{c})) / (max(g.{c}) - min(g.{c})), 6) AS entity
            FROM g"""
        for block, named in FEATURES.items()
        for f, c in named.items()
    ),
)
def entity_profile(t):
    p = P.entity_profile(_people(t), "c_custkey", 18, "c_mktsegment", "BUILDING", FEATURES)
    return p.withColumns({"group_mean": r6("group_mean"), "entity": r6("entity")})


@query(
    "above_group_mean",
    f"WITH p AS ({_PEOPLE}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST((SELECT {c} FROM p WHERE c_custkey = 18) AS DOUBLE) AS entity,
              round(avg({c}), 6) AS group_mean, (SELECT {c} FROM p WHERE c_custkey = 18) > avg({c}) AS above
            FROM p WHERE c_mktsegment = 'MACHINERY'"""
        for c in ("c_acctbal", "c_nationkey", "c_square")
    ),
)
def above_group_mean(t):
    cols = ["c_acctbal", "c_nationkey", "c_square"]
    rows = P.above_group_mean(_people(t), "c_custkey", 18, "c_mktsegment", "MACHINERY", cols)
    return rows.withColumn("group_mean", r6("group_mean"))


def _hist_sql(table, col, bins, by=None):
    keys = f"{by}, bin" if by else "bin"
    grid = f"(SELECT DISTINCT {by} FROM {table}), " if by else ""
    return f"""
      WITH e AS (SELECT min({col}) AS lo, max({col}) AS hi, (max({col}) - min({col})) / {bins} AS w FROM {table}),
      c AS (SELECT {keys}, count(*) AS n FROM (
              SELECT {by + ',' if by else ''} CAST(least(floor(({col} - lo) / w), {bins - 1}) AS INTEGER) AS bin
              FROM {table}, e) GROUP BY ALL)
      SELECT {keys}, coalesce(n, 0) AS n, round(lo + bin * w, 6) AS bin_lo
      FROM (SELECT * FROM {grid}(SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin))
      LEFT JOIN c USING ({keys}), e"""


@query("histogram", _hist_sql("orders", "o_totalprice", 32))
def histogram(t):
    return P.histogram(t.orders, "o_totalprice", 32).withColumn("bin_lo", r6("bin_lo"))


@query("histogram_by_class", _hist_sql("events", "value", 50, "event_type"))
def histogram_by_class(t):
    return P.histogram(t.events, "value", 50, by="event_type").withColumn("bin_lo", r6("bin_lo"))


GRID = [float(x) for x in range(0, 500, 25)]


@query(
    "kde_by_group",
    f"""WITH s AS (SELECT event_type, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h
                   FROM events GROUP BY 1)
        SELECT event_type, x,
               round(sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * {math.sqrt(2 * math.pi)}), 8)
                 AS density
        FROM events JOIN s USING (event_type), (SELECT CAST(unnest(range(0, 500, 25)) AS DOUBLE) AS x)
        GROUP BY event_type, x""",
)
def kde_by_group(t):
    d = P.kde(t.events, "value", "event_type", GRID)
    return d.withColumn("density", F.round("density", 8))


@query(
    "cov_ellipse",
    """WITH m AS (SELECT l_returnflag, avg(l_quantity) AS centre_x, avg(l_linenumber) AS centre_y,
                         var_samp(l_quantity) AS a, covar_samp(l_quantity, l_linenumber) AS b,
                         var_samp(l_linenumber) AS c FROM lineitem GROUP BY 1)
       SELECT l_returnflag, round(centre_x, 6) AS centre_x, round(centre_y, 6) AS centre_y,
              round(6 * sqrt((a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b)), 6) AS width,
              round(6 * sqrt((a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b)), 6) AS height,
              round(degrees(0.5 * atan2(2 * b, a - c)), 6) AS angle
       FROM m""",
)
def cov_ellipse(t):
    e = P.cov_ellipse(t.lineitem, "l_quantity", "l_linenumber", "l_returnflag", 3)
    return e.withColumns({c: r6(c) for c in e.columns if c != "l_returnflag"})


@query(
    "range_scale_by",
    """SELECT event_id, round(value / (max(value) OVER (PARTITION BY event_type)
                                       - min(value) OVER (PARTITION BY event_type)), 6) AS value
       FROM events""",
)
def range_scale_by(t):
    rows = t.events.select("event_id", "event_type", "value")
    return P.range_scale_by(rows, ["value"], "event_type").select("event_id", r6("value").alias("value"))


_FEW = 100
_MERGED = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _merged_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls, round(avg({c}), 5) AS mean,
        round(stddev_samp({c}), 5) AS std, CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS largest,
        CASE WHEN count(DISTINCT {c}) <= {_FEW} THEN count(DISTINCT {c}) END AS few_values,
        CASE WHEN count(DISTINCT {c}) <= {_FEW} THEN (SELECT max(k) FROM (SELECT count({c}) AS k FROM rows_ GROUP BY {c})) END AS top_count
        FROM rows_"""


@query(
    "profile_merged",
    f"WITH rows_ AS (SELECT nullif(l_quantity, 7) AS l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem) "
    + " UNION ALL ".join(_merged_sql(c) for c in _MERGED),
)
def profile_merged(t):
    """Profiles of twelve parts, merged by return flag, then all; distinct values and the top count while they are few."""
    rows = t.lineitem.withColumn("l_quantity", F.nullif("l_quantity", F.lit(7)))
    parts = sketches.profile_parts(rows, _MERGED, F.concat_ws("/", "l_returnflag", F.pmod("l_orderkey", F.lit(4))))
    merged = sketches.merge_profiles(sketches.merge_profiles(parts, F.substring_index("part", "/", 1)))
    few = F.col("distinct") <= _FEW
    return sketches.read_profile(merged).select(
        "column", "n", "nulls", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "least", "largest",
        F.when(few, F.col("distinct")).alias("few_values"), F.when(few, F.col("top")[0]["count"]).alias("top_count"),
    )
