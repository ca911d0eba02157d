"""Trees, forests and boosting from the level-wise grower, with SQL twins on columns of few values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.models.forest import ForestClassifier, ForestRegressor, bagged_forest, extra_forest
from tabforge.models.softmax import SoftmaxBoosted, rounds_by_cv
from tabforge.operators.split import train_test
from tabforge.plans import tune
from tabforge.queries.modelling import SEED, TEST_SHARE, TRAIN_TEST_SQL, parts
from tabforge.queries.registry import LINE_FEATURES, lines, query, r6

FEW = ["l_quantity", "l_discount", "price_step", "l_tax"]
_TABLES = f"""{TRAIN_TEST_SQL},
      tr0 AS (SELECT line_id, label, 1 AS node, floor(l_extendedprice / 5000) AS price_step, l_quantity, l_discount, l_tax FROM train),
      te0 AS (SELECT line_id, label, 1 AS node, floor(l_extendedprice / 5000) AS price_step, l_quantity, l_discount, l_tax FROM test)"""


def few_valued(t):
    """Train and test line items with the price in steps, so that every column has few values."""
    rows = lines(t).withColumn("price_step", F.floor(F.col("l_extendedprice") / 5000).cast("double"))
    return train_test(rows, "line_id", TEST_SHARE, SEED)


def _squares(prefix: str, less: str = "") -> str:
    return " + ".join(f"pow({prefix}{k}{f' - {less}{k}' if less else ''}, 2)" for k in range(3))


def _level_sql(i: int, pick: str = "") -> str:
    """Split every node of ``tr<i>`` by the cut with the least Gini impurity; ``pick`` keeps some of the splits only."""
    long_ = " UNION ALL ".join(f"SELECT node, {j} AS f, {c} AS x, label FROM tr{i}" for j, c in enumerate(FEW))
    value = "CASE b.f " + " ".join(f"WHEN {j} THEN r.{c}" for j, c in enumerate(FEW)) + " END"
    moved = f"SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.node ELSE 2 * r.node + CAST({value} > b.cut AS INT) END AS node)"
    each = ", ".join(f"count(*) FILTER (label = {k}) AS n{k}" for k in range(3))
    sums = ", ".join(f"sum(n{k}) OVER w AS c{k}, sum(n{k}) OVER (PARTITION BY node, f) AS t{k}" for k in range(3))
    return f"""h{i} AS (SELECT node, f, x, {each} FROM ({long_}) GROUP BY node, f, x),
      c{i} AS (SELECT node, f, x, lead(x) OVER (PARTITION BY node, f ORDER BY x) AS hi, {sums} FROM h{i}
               WINDOW w AS (PARTITION BY node, f ORDER BY x ROWS UNBOUNDED PRECEDING)),
      s{i} AS (SELECT node, f, (x + hi) / 2 AS cut,
                 ({_squares('c')}) / (c0 + c1 + c2) + ({_squares('t', 'c')}) / (t0 + t1 + t2 - c0 - c1 - c2) AS score,
                 ({_squares('t')}) / (t0 + t1 + t2) AS whole
               FROM c{i} WHERE hi IS NOT NULL AND greatest(t0, t1, t2) < t0 + t1 + t2),
      a{i} AS (SELECT * FROM s{i} QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, f, cut) = 1),
      b{i} AS (SELECT * FROM a{i} {pick}),
      tr{i + 1} AS ({moved} FROM tr{i} r LEFT JOIN b{i} b USING (node)),
      te{i + 1} AS ({moved} FROM te{i} r LEFT JOIN b{i} b USING (node))"""


_LEAVES = """best AS (SELECT node, label AS cls FROM tr2 GROUP BY node, label
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) = 1)
      SELECT line_id, label, cls AS prediction FROM te2 JOIN best USING (node)"""


def _predicted(est, t):
    train, test = few_valued(t)
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


@query("clf_tree_depth2", f"WITH {_TABLES}, {_level_sql(0)}, {_level_sql(1)}, {_LEAVES}")
def clf_tree_depth2(t):
    """Two levels of splits over four columns."""
    return _predicted(ForestClassifier(FEW, maxDepth=2), t)


@query(
    "clf_tree_best_first",
    f"WITH {_TABLES}, {_level_sql(0)}, {_level_sql(1, 'QUALIFY row_number() OVER (ORDER BY score - whole DESC, node) = 1')}, {_LEAVES}",
)
def clf_tree_best_first(t):
    """Three leaves: after the first split, the side that gains more is split."""
    return _predicted(ForestClassifier(FEW, maxLeaves=3), t)


_P, _H = 1 / 3, 2 * (1 / 3) * (1 - 1 / 3)


def _round_sql() -> str:
    """First round of three stumps: for each class the cut of the largest gain, and both leaves' steps."""
    long_ = " UNION ALL ".join(f"SELECT {j} AS f, {c} AS x, label FROM tr0" for j, c in enumerate(FEW))
    value = "CASE f " + " ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(FEW)) + " END"
    return f"""h AS (SELECT k, f, x, count(*) AS n, count(*) FILTER (label = k) AS hit
            FROM ({long_}), (SELECT unnest(range(3)) AS k) GROUP BY ALL),
      c AS (SELECT k, f, x, lead(x) OVER (PARTITION BY k, f ORDER BY x) AS hi,
              sum(n) OVER w * {_P}::DOUBLE - sum(hit) OVER w AS g1, sum(n) OVER w * {_H}::DOUBLE AS h1,
              sum(n) OVER v * {_P}::DOUBLE - sum(hit) OVER v AS g, sum(n) OVER v * {_H}::DOUBLE AS hh
            FROM h WINDOW w AS (PARTITION BY k, f ORDER BY x ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY k, f)),
      b AS (SELECT k, f, (x + hi) / 2 AS cut, -0.1 * g1 / (h1 + 1) AS low, -0.1 * (g - g1) / (hh - h1 + 1) AS high FROM c
            WHERE hi IS NOT NULL AND h1 >= 1 AND hh - h1 >= 1
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY g1 * g1 / (h1 + 1) + (g - g1) * (g - g1) / (hh - h1 + 1) DESC, f, x) = 1),
      m AS (SELECT line_id, label, k, CASE WHEN {value} <= cut THEN low ELSE high END AS m FROM te0, b),
      p AS (SELECT line_id, label, {', '.join(f'exp(max(m) FILTER (k = {k})) / sum(exp(m)) AS p{k}' for k in range(3))}
            FROM m GROUP BY line_id, label)
      SELECT line_id, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS prediction,
             {', '.join(f'round(p{k}, 6) AS p{k}' for k in range(3))} FROM p"""


@query("clf_boost_round1", f"WITH {_TABLES}, {_round_sql()}")
def clf_boost_round1(t):
    """One round of softmax boosting with stumps: three trees, one for each class."""
    train, test = few_valued(t)
    model = SoftmaxBoosted(FEW, keyCol="line_id", rounds=1, maxDepth=1).fit(train)
    shares = [r6(F.get("probability", k)).alias(f"p{k}") for k in range(3)]
    return model.transform(test).select("line_id", "prediction", *shares)


@query("clf_forest_grown")
def clf_forest_grown(t):
    """Bootstrap trees of any depth, two of the four columns tried at each node."""
    train, test = parts(t, scaled=False)
    model = bagged_forest(LINE_FEATURES, key="line_id", trees=20, minLeaf=2).fit(train)
    return model.transform(test).select("line_id", "label", "prediction")


@query("clf_extra_grown")
def clf_extra_grown(t):
    """Extremely randomised trees with cuts drawn inside each node."""
    train, test = parts(t, scaled=False)
    return extra_forest(LINE_FEATURES, trees=20).fit(train).transform(test).select("line_id", "label", "prediction")


def _boosted(**kw) -> SoftmaxBoosted:
    """With the row and column shares of the worked problems."""
    return SoftmaxBoosted(LINE_FEATURES, keyCol="line_id", subsample=0.7, colsample=0.7, **kw)


@query("clf_boost_softmax")
def clf_boost_softmax(t):
    """Three classes in one model; a held-out share of the rows says when to stop."""
    train, test = parts(t, scaled=False)
    model = _boosted(rounds=40, rate=0.3, maxDepth=4, validation=0.2, patience=5).fit(train)
    return model.transform(test).select("line_id", "label", "prediction")


@query("boost_rounds_cv")
def boost_rounds_cv(t):
    """Held-out log loss after each round of five folds that advance in step, and the round to stop at."""
    train, _ = parts(t, scaled=False)
    history, best = rounds_by_cv(_boosted(rounds=12, rate=0.5, maxDepth=4, patience=3), train, "line_id", k=5, seed=1)
    return history.withColumn("best", F.col("round") == best)


@query("reg_forest_mae")
def reg_forest_mae(t):
    """Mean absolute error of a forest of many trees on five folds of all line items."""
    rows = lines(t).select("line_id", "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    est = ForestRegressor(["l_quantity", "l_discount", "l_tax"], keyCol="line_id", trees=10, maxFeatures="onethird", bootstrap=True, minLeaf=5)
    return tune.cross_val(est, rows, "line_id", "label", 5, metric="mae", stratified=False)
