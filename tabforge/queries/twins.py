"""More SQL twins: components by power iteration, importances, one bagged tree, kept weights, family ranges, renamed columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.fixed import FAMILY_ELEVATION
from tabforge.models import reduce as R
from tabforge.models.forest import ForestClassifier
from tabforge.operators import joins as J
from tabforge.queries.registry import LINE_FEATURES, LINES_SQL, lines, query, r6
from tabforge.queries.trees import _LEAVES, _TABLES, FEW, _level_sql, few_valued
from tabforge.runtime import new_path
from tabforge.sources import io

STEPS = 100
MONEY = ["l_extendedprice", "net", "tax", "l_quantity"]  # the first three rise and fall together

_CORR = "[" + ", ".join("[" + ", ".join(f"corr({a}, {b})" for b in MONEY) + "]" for a in MONEY) + "]"
#: First component of the correlations: multiply, bring to length 1, repeat; the largest weight is made positive.
_POWER = f"""WITH RECURSIVE money AS (SELECT l_extendedprice, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * l_tax AS tax, l_quantity FROM lineitem),
      m AS (SELECT {_CORR} AS m FROM money),
      it AS (SELECT 0 AS i, [0.6, 0.5, 0.4, 0.3]::DOUBLE[] AS v
             UNION ALL
             SELECT i + 1, [x / sqrt(list_dot_product(u, u)) FOR x IN u]
             FROM (SELECT i, [list_dot_product(row, v) FOR row IN m] AS u FROM it, m WHERE i < {STEPS})),
      last AS (SELECT v FROM it WHERE i = {STEPS}),
      w AS (SELECT unnest({MONEY!r}) AS feature, unnest(v) AS x FROM last),
      signed AS (SELECT feature, x * sign((SELECT arg_max(x, abs(x)) FROM w)) AS loading FROM w)"""


def money(t):
    net, tax = F.col("l_extendedprice") * (1 - F.col("l_discount")), F.col("l_extendedprice") * F.col("l_tax")
    return t.lineitem.select("l_extendedprice", net.alias("net"), tax.alias("tax"), "l_quantity")


@query("pca_first_loadings", f"{_POWER} SELECT feature, CAST(1 AS INTEGER) AS component, round(loading, 5) AS loading FROM signed")
def pca_first_loadings(t):
    """Weights of four columns in the first component."""
    found = R.Pca(MONEY).fit(money(t)).loadings(t.spark)
    return found.where("component = 1").withColumn("loading", F.round("loading", 5))


@query("top_loadings", f"{_POWER} SELECT feature, round(loading, 5) AS loading FROM signed ORDER BY abs(loading) DESC, feature LIMIT 2")
def top_loadings(t):
    """The two columns that weigh most in the first component."""
    found = R.Pca(MONEY).fit(money(t)).top_loadings(t.spark, 1, 2)
    return found.select("feature", F.round("loading", 5).alias("loading"))


@query(
    "tree_importances",
    f"WITH {_TABLES}, {_level_sql(0)}, {_level_sql(1)}, g AS (SELECT f, score - whole AS gain FROM b0 UNION ALL SELECT f, score - whole FROM b1), "
    f"names AS (SELECT unnest(range({len(FEW)})) AS f, unnest({FEW!r}) AS feature) "
    "SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM g), 6) AS importance FROM names LEFT JOIN g USING (f) GROUP BY feature",
)
def tree_importances(t):
    """Share of each column in the impurity that a tree of two levels takes away."""
    train, _ = few_valued(t)
    found = ForestClassifier(FEW, maxDepth=2).fit(train).importances()
    return t.spark.createDataFrame(list(found.items()), "feature string, importance double").withColumn("importance", r6("importance"))


@query("clf_bagging_one", f"WITH {_TABLES}, {_level_sql(0)}, {_level_sql(1)}, {_LEAVES}")
def clf_bagging_one(t):
    """A bag of one tree that sees every row once and all columns is that tree."""
    train, test = few_valued(t)
    model = ForestClassifier(FEW, keyCol="line_id", trees=1, maxDepth=2, maxFeatures=len(FEW)).fit(train)
    return model.transform(test).select("line_id", "label", "prediction")


@query(
    "weights_cached",
    f"WITH {LINES_SQL} SELECT line_id, round("
    + " + ".join(f"{c} / (SELECT max({c}) - min({c}) FROM lines)" for c in LINE_FEATURES)
    + ", 6) AS total FROM lines",
)
def weights_cached(t):
    """Weights of four columns, kept as a one-row table and read back."""
    rows, path = lines(t), new_path(t.spark, "weights")
    mark = io.inputs_fingerprint(t.spark, [f"{t.folder}/lineitem.parquet"], "1/range")

    def build():
        ends = rows.agg(*[(1 / (F.max(c) - F.min(c))).alias(c) for c in LINE_FEATURES]).first()
        return ends.asDict()

    def never():
        raise AssertionError("the kept weights must be used")

    io.cached_weights(t.spark, path, build, mark)
    weights = io.cached_weights(t.spark, path, never, mark)
    total = sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(0.0))
    return rows.select("line_id", r6(total).alias("total"))


_FAMILIES = ", ".join(f"('{name}', {lo}, {hi})" for name, lo, hi in FAMILY_ELEVATION)


@query(
    "family_elevation",
    f"""SELECT o_orderkey, family FROM orders JOIN (VALUES {_FAMILIES}) AS r(family, lo, hi)
        ON o_totalprice / 100 >= lo AND o_totalprice / 100 < hi""",
)
def family_elevation(t):
    """Families whose range holds a value; ranges overlap, so a row may have many."""
    ranges = io.literal_table(t.spark, FAMILY_ELEVATION, "family string, lo int, hi int")
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") / 100).alias("height"))
    return J.range_join(rows, "height", ranges).select("o_orderkey", "family")


@query("rename_column", "SELECT o_orderkey AS key, o_totalprice AS price FROM orders")
def rename_column(t):
    return t.orders.select("o_orderkey", "o_totalprice").withColumnRenamed("o_orderkey", "key").withColumnRenamed("o_totalprice", "price")
