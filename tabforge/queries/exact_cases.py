"""Estimators on inputs for which the answer has a closed form, so that SQL can say it."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tabforge.models import knn as K
from tabforge.models import learner as L
from tabforge.models import reduce as R
from tabforge.models.boost import AdaBoost
from tabforge.operators.split import train_test
from tabforge.queries.modelling import _Z, SEED, TEST_SHARE, TRAIN_TEST_SQL, TWO
from tabforge.queries.profiling import embedding_cols
from tabforge.queries.registry import LINES_SQL, lines, query, r6


def binned(t):
    """Train and test line items with a column of a few values that tells much about the class."""
    rows = lines(t).withColumn("q", F.floor(F.col("l_quantity") / 5).cast("double"))
    return train_test(rows.select("line_id", "q", "label"), "line_id", TEST_SHARE, SEED)


# The cut with the least Gini impurity, and the most frequent class on either side.
_STUMP = f"""WITH {TRAIN_TEST_SQL},
  h AS (SELECT floor(l_quantity / 5) AS q, label, count(*) AS n FROM train GROUP BY ALL),
  c AS (SELECT DISTINCT q AS cut FROM h WHERE q < (SELECT max(q) FROM h)),
  s AS (SELECT cut, q <= cut AS low, label, sum(n) AS n FROM h, c GROUP BY ALL),
  g AS (SELECT cut, low, sum(n) - sum(n * n) / sum(n) AS mixed FROM s GROUP BY ALL),
  b AS (SELECT cut FROM g GROUP BY cut ORDER BY sum(mixed), cut LIMIT 1),
  m AS (SELECT low, label AS prediction FROM s JOIN b USING (cut)
        QUALIFY row_number() OVER (PARTITION BY low ORDER BY n DESC, label) = 1)
  SELECT line_id, label, prediction FROM test JOIN b ON true JOIN m ON m.low = (floor(l_quantity / 5) <= b.cut)"""


def _judged(est, t):
    train, test = binned(t)
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


@query("clf_tree_stump", _STUMP)
def clf_tree_stump(t):
    """A tree of one split on a column with few values."""
    return _judged(L.decision_tree(["q"], max_depth=1, keyCol="line_id"), t)


@query("clf_forest_stump", _STUMP)
def clf_forest_stump(t):
    """A forest of one tree with all rows and all columns is that tree."""
    return _judged(L.random_forest(["q"], trees=1, max_depth=1, max_features="all", bootstrap=False, keyCol="line_id"), t)


@query("clf_adaboost_stump", _STUMP)
def clf_adaboost_stump(t):
    """The first round of boosting is a tree on equal weights."""
    return _judged(AdaBoost(["q"], rounds=1, maxDepth=1), t)


@query(
    "clf_logistic_cells",
    f"""WITH {TRAIN_TEST_SQL},
      h AS (SELECT floor(l_quantity / 5) AS q, label, count(*) AS n FROM train GROUP BY ALL),
      m AS (SELECT q, label AS prediction FROM h QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, label) = 1)
      SELECT line_id, label, prediction FROM test JOIN m ON m.q = floor(l_quantity / 5)""",
)
def clf_logistic_cells(t):
    """With one flag for each value a nearly unpenalised model gives each value its most frequent class."""
    flags = [f"q{i}" for i in range(11)]
    cells = [(F.col("q") == i).cast("double").alias(c) for i, c in enumerate(flags)]
    train, test = (d.select("line_id", "label", *cells) for d in binned(t))
    return L.logistic(flags, C=1e6, keyCol="line_id").fit(train).transform(test).select("line_id", "label", "prediction")


@query(
    "pca_components_2d",
    f"""WITH {LINES_SQL}, {_Z} SELECT CAST(CASE WHEN (1 + abs(r)) / 2 >= 0.85 THEN 1 ELSE 2 END AS INTEGER) AS n_components FROM z""",
)
def pca_components_2d(t):
    """Components of two columns that hold 85 % of the variance."""
    return R.components_for(lines(t), TWO)


_FOUR = [f"e{i}" for i in range(4)]


def _weight_step_sql(seed: int, rate: float) -> str:
    """The first step: the drawn column, and the leave-one-out score under each of four factors."""
    rng = random.Random(seed)
    r = rate * rng.random()
    column = rng.randrange(len(_FOUR))
    factors = ", ".join(f"({i}, {f!r})" for i, f in enumerate((1 - r, 1.0, 1 + r, 1 + 2 * r)))
    cell = "(CAST(a.embedding[{0}] AS DOUBLE) - CAST(b.embedding[{0}] AS DOUBLE))"
    parts = " + ".join(
        f"pow({cell.format(i + 1)}{' * CAST(factor AS DOUBLE)' if i == column else ''}, 2)" for i in range(len(_FOUR))
    )
    return f"""WITH t(trial, factor) AS (VALUES {factors}),
      n AS (SELECT trial, factor, a.vec_id, a.label AS own, b.label FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id, t
            QUALIFY row_number() OVER (PARTITION BY trial, a.vec_id ORDER BY sqrt({parts}), b.vec_id) = 1),
      s AS (SELECT trial, factor, avg(CAST(own = label AS INTEGER)) AS score FROM n GROUP BY ALL)
      SELECT CAST(0 AS INTEGER) AS step, 'e{column}' AS col, CAST(1 AS DOUBLE) AS old,
             round(CAST(factor AS DOUBLE), 6) AS tried, round(score, 6) AS score
      FROM s ORDER BY s.score DESC, trial LIMIT 1"""


@query("knn_weight_step", _weight_step_sql(3, 0.5))
def knn_weight_step(t):
    """One step of the weight search on four columns."""
    steps, _ = K.weight_search(embedding_cols(t), _FOUR, "vec_id", "label", steps=1, rate=0.5, seed=3)
    return steps.withColumns({c: r6(c) for c in ("tried", "score")})
