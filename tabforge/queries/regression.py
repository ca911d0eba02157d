"""Regression trees behind an imputer, on a column with few values, so that SQL can say the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.models import regress
from tabforge.operators.split import train_test
from tabforge.plans import tune
from tabforge.queries.modelling import SEED, TEST_SHARE, TRAIN_TEST_SQL
from tabforge.queries.registry import LINES_SQL, lines, query


def priced(t):
    """Line items with a column of a few values, some missing, and the price to predict."""
    bin_ = F.floor(F.col("l_quantity") / 5)
    q = F.when(F.col("l_quantity") % 10 != 3, bin_).cast("double")
    return lines(t).select("line_id", q.alias("q"), F.col("l_extendedprice").cast("double").alias("label"))


_Q = "CASE WHEN l_quantity % 10 <> 3 THEN CAST(floor(l_quantity / 5) AS DOUBLE) END"


def _stump_sql(train: str, test: str, by=()) -> str:
    """CTEs that end in ``judged``: the cut with the least squared error, and the mean of either side."""
    g = "".join(f"{b}, " for b in by)
    using = f"USING ({', '.join(by)})" if by else "ON true"
    group = f"GROUP BY {', '.join(by)}" if by else ""
    over = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""fill AS (SELECT {g} avg(q) AS fill FROM {train} {group}),
      tr_ AS (SELECT {g} coalesce(q, fill) AS x, label FROM {train} JOIN fill {using}),
      te_ AS (SELECT {g} line_id, coalesce(q, fill) AS x, label FROM {test} JOIN fill {using}),
      h AS (SELECT {g} x, count(*) AS n, sum(label) AS s FROM tr_ GROUP BY {g} x),
      c AS (SELECT {g} x AS lo, lead(x) OVER ({over} ORDER BY x) AS hi, sum(n) OVER w AS n1, sum(s) OVER w AS s1,
                   sum(n) OVER ({over}) AS n_all, sum(s) OVER ({over}) AS s_all
            FROM h WINDOW w AS ({over} ORDER BY x ROWS UNBOUNDED PRECEDING)),
      b AS (SELECT * FROM c WHERE hi IS NOT NULL
            QUALIFY row_number() OVER ({over} ORDER BY s1 * s1 / n1 + (s_all - s1) * (s_all - s1) / (n_all - n1) DESC) = 1),
      judged AS (SELECT {g} line_id, label, CASE WHEN x <= (lo + hi) / 2 THEN s1 / n1 ELSE (s_all - s1) / (n_all - n1) END AS prediction
                 FROM te_ JOIN b {using})"""


_TRAIN_TEST = TRAIN_TEST_SQL + f""",
      tr AS (SELECT line_id, {_Q} AS q, CAST(l_extendedprice AS DOUBLE) AS label FROM train),
      te AS (SELECT line_id, {_Q} AS q, CAST(l_extendedprice AS DOUBLE) AS label FROM test)"""
_ROUNDED = "line_id, round(prediction, 4) AS prediction"


@query("reg_tree_stump", f"WITH {_TRAIN_TEST}, {_stump_sql('tr', 'te')} SELECT {_ROUNDED} FROM judged")
def reg_tree_stump(t):
    """Gaps filled with the training mean, then one split."""
    train, test = train_test(priced(t), "line_id", TEST_SHARE, SEED)
    model = regress.tree_regression(["q"], max_depth=1).fit(train)
    return model.transform(test).select("line_id", F.round("prediction", 4).alias("prediction"))


@query("reg_forest_stump", f"WITH {_TRAIN_TEST}, {_stump_sql('tr', 'te')} SELECT {_ROUNDED} FROM judged")
def reg_forest_stump(t):
    """A forest of one tree with all rows is that tree."""
    train, test = train_test(priced(t), "line_id", TEST_SHARE, SEED)
    model = regress.forest_regression(["q"], trees=1, max_depth=1, max_features="all", bootstrap=False).fit(train)
    return model.transform(test).select("line_id", F.round("prediction", 4).alias("prediction"))


@query(
    "reg_tree_mae",
    f"""WITH {LINES_SQL}, rows_ AS (SELECT line_id, {_Q} AS q, CAST(l_extendedprice AS DOUBLE) AS label,
           CAST('0x' || substr(md5(concat_ws(':', line_id, '0')), 1, 8) AS BIGINT) % 5 AS fold FROM lines),
      held AS (SELECT unnest(range(5)) AS held),
      tr AS (SELECT * FROM rows_, held WHERE fold <> held), te AS (SELECT * FROM rows_, held WHERE fold = held),
      {_stump_sql('tr', 'te', ['held'])}
      SELECT CAST(held AS INTEGER) AS fold, round(avg(abs(label - prediction)), 4) AS score FROM judged GROUP BY held""",
)
def reg_tree_mae(t):
    """Mean absolute error on five folds; the imputer learns from the training folds only."""
    scores = tune.cross_val(regress.tree_regression(["q"], max_depth=1), priced(t), "line_id", "label", 5, metric="mae", stratified=False)
    return scores.withColumn("score", F.round("score", 4))
