"""Estimators of L, K, B, D, NN, R, U and C9."""

import math

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabforge.models import knn as K
from tabforge.models import learner as L
from tabforge.models import reduce as R
from tabforge.models.bayes import GaussianNB
from tabforge.models.boost import AdaBoost, Boosted
from tabforge.models.discriminant import Lda, Qda
from tabforge.models.features import extra_trees, rbf_svm
from tabforge.models.scale import Standardize
from tabforge.operators.split import train_test
from tabforge.queries.profiling import EMB, embedding_cols
from tabforge.queries.registry import LINE_FEATURES, LINES_SQL, lines, part_sql, query, r6

SEED, TEST_SHARE, TEST_HEX = 21, 0.2, "33333333"
TEST = part_sql("line_id", SEED, TEST_HEX)
TRAIN_TEST_SQL = f"""{LINES_SQL},
  train AS (SELECT * FROM lines WHERE NOT ({TEST})),
  test AS (SELECT * FROM lines WHERE {TEST})"""


def parts(t, scaled=True):
    """Train and test line items; numbers scaled by what the train rows show."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    if not scaled:
        return train, test
    scale = Standardize(LINE_FEATURES).fit(train)
    return scale.transform(train), scale.transform(test)


def predicted(est, t, scaled=True):
    train, test = parts(t, scaled)
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


# ---------------------------------------------------------------- SQL-checkable classifiers


def nb_sql(train: str, test: str, cols, by=(), key: str = "line_id") -> str:
    """CTEs ``stats``, ``whole``, ``judged`` of Gaussian naive Bayes, one model per value of ``by``."""
    g = "".join(f"{b}, " for b in by)
    on = f"JOIN stats USING ({', '.join(by)}) JOIN whole USING ({', '.join(by)})" if by else "CROSS JOIN stats CROSS JOIN whole"
    means = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in cols)
    widest = ", ".join(f"var_pop({c})" for c in cols)
    terms = " + ".join(
        f"ln({2 * math.pi} * (v_{c} + eps)) + ({c} - m_{c}) * ({c} - m_{c}) / (v_{c} + eps)" for c in cols
    )
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""
      stats AS (SELECT {g} label AS cls, count(*) AS n, {means} FROM {train} GROUP BY {g} label),
      whole AS (SELECT {g} count(*) AS n_all, 1e-9 * greatest({widest}) AS eps FROM {train} {group}),
      scored AS (SELECT {g} {key}, label, cls, ln(n / n_all) - 0.5 * ({terms}) AS s FROM {test} {on}),
      judged AS (SELECT {g} {key}, label, cls AS prediction FROM
                 (SELECT *, row_number() OVER (PARTITION BY {g} {key} ORDER BY s DESC, cls) AS rn FROM scored)
                 WHERE rn = 1)"""


@query(
    "clf_gaussian_nb",
    f"WITH {TRAIN_TEST_SQL}, {nb_sql('train', 'test', LINE_FEATURES)} SELECT line_id, label, prediction FROM judged",
)
def clf_gaussian_nb(t):
    return predicted(GaussianNB(LINE_FEATURES), t, scaled=False)


TWO = ["l_quantity", "l_extendedprice"]
_MOMENTS = """m AS (SELECT label AS cls, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
      var_pop(l_quantity) AS a, covar_pop(l_quantity, l_extendedprice) AS b, var_pop(l_extendedprice) AS c
    FROM train GROUP BY label)"""


@query(
    "clf_lda_2d",
    f"""WITH {TRAIN_TEST_SQL}, {_MOMENTS},
      w AS (SELECT sum(n) AS n_all, sum(n * a) / (sum(n) - count(*)) AS a, sum(n * b) / (sum(n) - count(*)) AS b,
                   sum(n * c) / (sum(n) - count(*)) AS c FROM m),
      s AS (SELECT line_id, label, cls,
              ln(m.n / w.n_all) - 0.5 * (w.c * pow(l_quantity - mx, 2)
                - 2 * w.b * (l_quantity - mx) * (l_extendedprice - my) + w.a * pow(l_extendedprice - my, 2))
                / (w.a * w.c - w.b * w.b) AS s
            FROM test, m, w)
      SELECT line_id, label, cls AS prediction FROM s
      QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY s DESC, cls) = 1""",
)
def clf_lda_2d(t):
    return predicted(Lda(TWO), t, scaled=False)


@query(
    "clf_qda_2d",
    f"""WITH {TRAIN_TEST_SQL}, {_MOMENTS},
      k AS (SELECT cls, n, sum(n) OVER () AS n_all, mx, my, a * n / (n - 1) AS a, b * n / (n - 1) AS b,
                   c * n / (n - 1) AS c FROM m),
      s AS (SELECT line_id, label, cls,
              ln(n / n_all) - 0.5 * ln(a * c - b * b) - 0.5 * (c * pow(l_quantity - mx, 2)
                - 2 * b * (l_quantity - mx) * (l_extendedprice - my) + a * pow(l_extendedprice - my, 2))
                / (a * c - b * b) AS s
            FROM test, k)
      SELECT line_id, label, cls AS prediction FROM s
      QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY s DESC, cls) = 1""",
)
def clf_qda_2d(t):
    return predicted(Qda(TWO), t, scaled=False)


@query("clf_lda")
def clf_lda(t):
    """All 64 numbers of the vectors, so the cross-product pass is used."""
    train, test = train_test(embedding_cols(t), "vec_id", TEST_SHARE, SEED)
    return Lda(EMB).fit(train).transform(test).select("vec_id", "label", "prediction")


@query("clf_qda")
def clf_qda(t):
    train, test = train_test(embedding_cols(t), "vec_id", TEST_SHARE, SEED)
    return Qda(EMB).fit(train).transform(test).select("vec_id", "label", "prediction")


# ---------------------------------------------------------------- nearest neighbours


def vectors(t):
    return embedding_cols(t)


_V = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
_VTEST = part_sql("vec_id", SEED, TEST_HEX)
_L1 = "list_sum([abs(q.e[i] - s.e[i]) for i in range(1, 65)])"


@query(
    "knn_neighbors",
    f"""WITH {_V} SELECT q.vec_id AS qkey, s.vec_id AS tkey, round(list_distance(q.e, s.e), 6) AS dist, s.label,
          CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, s.e), s.vec_id) AS INTEGER) AS rank
        FROM v q JOIN v s ON q.vec_id <> s.vec_id QUALIFY rank <= 3""",
)
def knn_neighbors(t):
    v = vectors(t)
    return K.neighbors(v, v, EMB, "vec_id", "label", 3, skip="vec_id").withColumn("dist", r6("dist"))


def _knn_sql(dist, k, votes):
    return f"""WITH {_V},
      d AS (SELECT q.vec_id, q.label AS own, s.vec_id AS tkey, s.label, {dist} AS dist
            FROM v q JOIN v s ON ({_VTEST.replace('vec_id', 'q.vec_id')}) AND NOT ({_VTEST.replace('vec_id', 's.vec_id')})),
      n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, tkey) <= {k}),
      b AS (SELECT vec_id, own, label, {votes} AS w FROM n GROUP BY ALL)
      SELECT vec_id, own AS label, label AS prediction FROM b
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, label) = 1"""


@query("knn_classify", _knn_sql("list_distance(q.e, s.e)", 5, "count(*)"))
def knn_classify(t):
    train, test = train_test(vectors(t), "vec_id", TEST_SHARE, SEED)
    est = K.KnnClassifier(inputCols=EMB, keyCol="vec_id", k=5)
    return est.fit(train).transform(test).select("vec_id", "label", "prediction")


@query("knn_classify_weighted", _knn_sql(_L1, 3, "sum(1 / dist)"))
def knn_classify_weighted(t):
    """City-block distance and votes by 1/distance."""
    train, test = train_test(vectors(t), "vec_id", TEST_SHARE, SEED)
    est = K.KnnClassifier(inputCols=EMB, keyCol="vec_id", k=3, p=1, weights="distance")
    return est.fit(train).transform(test).select("vec_id", "label", "prediction")


@query(
    "knn_loo_accuracy",
    f"""WITH {_V}, n AS (SELECT q.label AS own, s.label FROM v q JOIN v s ON q.vec_id <> s.vec_id
          QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, s.e), s.vec_id) = 1)
        SELECT round(avg(CAST(own = label AS INTEGER)), 6) AS accuracy FROM n""",
)
def knn_loo_accuracy(t):
    return K.loo_accuracy(vectors(t), EMB, "vec_id", "label").select(r6("accuracy").alias("accuracy"))


KS = list(range(1, 50, 2))


@query(
    "tune_knn",
    f"""WITH f AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
               CAST('0x' || substr(md5(concat_ws(':', vec_id, '0')), 1, 8) AS BIGINT) % 10 AS fold FROM embeddings),
      n AS (SELECT q.vec_id, q.fold, q.label AS own, s.label,
              row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, s.e), s.vec_id) AS rank
            FROM f q JOIN f s ON q.fold <> s.fold QUALIFY rank <= 49),
      v AS (SELECT k, vec_id, fold, own, label, count(*) AS c FROM n, (SELECT unnest(range(1, 50, 2)) AS k)
            WHERE rank <= k GROUP BY ALL),
      p AS (SELECT k, fold, own, label FROM v QUALIFY row_number() OVER (PARTITION BY k, vec_id ORDER BY c DESC, label) = 1),
      e AS (SELECT k, fold, avg(CAST(own <> label AS INTEGER)) AS err FROM p GROUP BY k, fold),
      m AS (SELECT CAST(k AS INTEGER) AS k, round(avg(err), 9) AS error FROM e GROUP BY k)
      SELECT k, error, k = first_value(k) OVER (ORDER BY error, k) AS best FROM m""",
)
def tune_knn(t):
    return K.tune_k(vectors(t), EMB, "vec_id", "label", KS, 10)


@query("knn_weight_search")
def knn_weight_search(t):
    steps, _ = K.weight_search(vectors(t), EMB, "vec_id", "label", steps=2, seed=1)
    return steps


# ---------------------------------------------------------------- MLlib classifiers


@query("clf_logistic")
def clf_logistic(t):
    return predicted(L.logistic(LINE_FEATURES, C=100.0, max_iter=30), t)


@query("clf_logistic_ovr")
def clf_logistic_ovr(t):
    return predicted(L.logistic(LINE_FEATURES, C=5.0, one_vs_rest=True, max_iter=20), t)


@query("clf_linear_svm")
def clf_linear_svm(t):
    return predicted(L.linear_svm(LINE_FEATURES, max_iter=20), t)


@query("clf_rbf_svm")
def clf_rbf_svm(t):
    return predicted(rbf_svm(LINE_FEATURES, C=2.8, gamma=0.1, size=64, max_iter=15), t)


@query("clf_tree")
def clf_tree(t):
    return predicted(L.decision_tree(LINE_FEATURES, max_depth=8), t)


@query("clf_forest")
def clf_forest(t):
    return predicted(L.random_forest(LINE_FEATURES, trees=10, max_depth=6, keyCol="line_id"), t)


@query("clf_bagging")
def clf_bagging(t):
    return predicted(L.bagging(LINE_FEATURES, trees=10, max_depth=6, keyCol="line_id"), t)


@query("clf_extra_trees")
def clf_extra_trees(t):
    return predicted(extra_trees(LINE_FEATURES, trees=10, max_depth=8), t)


@query("clf_gbt")
def clf_gbt(t):
    return predicted(Boosted(LINE_FEATURES, rounds=5, maxDepth=3), t)


@query("gbt_early_stop")
def gbt_early_stop(t):
    est = Boosted(LINE_FEATURES, keyCol="line_id", rounds=8, maxDepth=3, validation=0.2, tolerance=0.05, balanced=True)
    return predicted(est, t)


@query("clf_adaboost")
def clf_adaboost(t):
    return predicted(AdaBoost(LINE_FEATURES, rounds=6, maxDepth=2), t)


@query("clf_mlp")
def clf_mlp(t):
    return predicted(L.perceptron(LINE_FEATURES, hidden=[10], max_iter=20), t)


@query("scale_logit_stages")
def scale_logit_stages(t):
    """Scaling and classifier as the stages of one MLlib estimator."""
    both = Pipeline(stages=[Standardize(LINE_FEATURES), L.logistic(LINE_FEATURES, C=100.0, max_iter=20)])
    return predicted(both, t, scaled=False)


@query("feature_importances")
def feature_importances(t):
    train, _ = parts(t)
    model = L.random_forest(LINE_FEATURES, trees=10, max_depth=5, keyCol="line_id").fit(train)
    return L.importances(model, LINE_FEATURES, t.spark)


# ---------------------------------------------------------------- components, clusters, curves

_Z = """z AS (SELECT corr(l_quantity, l_extendedprice) AS r, avg(l_quantity) AS mx, stddev_pop(l_quantity) AS sx,
                     avg(l_extendedprice) AS my, stddev_pop(l_extendedprice) AS sy FROM lines)"""


@query(
    "pca_variance_2d",
    f"""WITH {LINES_SQL}, {_Z}
        SELECT CAST(1 AS INTEGER) AS component, round((1 + abs(r)) / 2, 6) AS ratio,
               round((1 + abs(r)) / 2, 6) AS cumulative FROM z
        UNION ALL SELECT 2, round((1 - abs(r)) / 2, 6), 1.0 FROM z""",
)
def pca_variance_2d(t):
    v = R.Pca(TWO).fit(lines(t)).variance(t.spark)
    return v.withColumns({"ratio": r6("ratio"), "cumulative": r6("cumulative")})


@query(
    "pca_scores_2d",
    f"""WITH {LINES_SQL}, {_Z},
        s AS (SELECT line_id, (l_quantity - mx) / sx AS a, (l_extendedprice - my) / sy AS b, r FROM lines, z)
        SELECT line_id, round((a + CASE WHEN r > 0 THEN b ELSE -b END) / sqrt(2), 6) AS pc1,
               round((a - CASE WHEN r > 0 THEN b ELSE -b END) / sqrt(2), 6) AS pc2 FROM s""",
)
def pca_scores_2d(t):
    """Two standardised columns: the components are their sum and difference."""
    rows = lines(t)
    model = R.Pca(TWO).fit(rows)
    # both weights of a component are equal here; the first one is made positive
    signs = [1.0 if load[0] >= 0 else -1.0 for load in model.fitted()["loadings"]]
    out = model.transform(rows)
    return out.select("line_id", *[r6(F.col(f"pc{i}") * s).alias(f"pc{i}") for i, s in enumerate(signs, 1)])


@query("pca_variance")
def pca_variance(t):
    return R.Pca(LINE_FEATURES).fit(lines(t)).variance(t.spark)


@query("pca_loadings")
def pca_loadings(t):
    return R.Pca(LINE_FEATURES).fit(lines(t)).loadings(t.spark)


@query("pca_scores")
def pca_scores(t):
    rows = lines(t)
    return R.Pca(LINE_FEATURES, k=2).fit(rows).transform(rows).select("line_id", "pc1", "pc2")


@query("pca_components_for")
def pca_components_for(t):
    return R.components_for(embedding_cols(t), EMB, 0.85)


@query("kmeans_groups")
def kmeans_groups(t):
    """Groups of the rows by their first two components, with the size of each group."""
    rows = lines(t)
    pcs = R.Pca(LINE_FEATURES, k=2).fit(rows).transform(rows).select("line_id", "pc1", "pc2")
    grouped, centres = R.cluster(pcs, ["pc1", "pc2"], "line_id", 3, seed=1)
    sizes = grouped.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"))
    return centres.join(sizes, "cluster")


@query(
    "elbow_k1",
    f"""WITH {LINES_SQL} SELECT CAST(1 AS INTEGER) AS k,
          round(count(*) * (var_pop(l_quantity) + var_pop(l_discount)), 4) AS sse FROM lines""",
)
def elbow_k1(t):
    e = R.elbow(lines(t), ["l_quantity", "l_discount"], "line_id", [1])
    return e.withColumn("sse", F.round("sse", 4))


@query("elbow")
def elbow(t):
    return R.elbow(lines(t), ["l_quantity", "l_discount"], "line_id", [1, 2, 3, 4])


@query("rbm_features")
def rbm_features(t):
    """Hidden-unit probabilities, then logistic regression on them."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    rbm = R.RbmFeatures(LINE_FEATURES, units=8, epochs=3, rate=0.5, seed=1).fit(train)
    units = [f"h{i}" for i in range(8)]

    def widened(df):
        return rbm.transform(df).select("line_id", "label", *[F.col("rbm")[i].alias(u) for i, u in enumerate(units)])

    fitted = L.logistic(units, C=1000.0, max_iter=20).fit(widened(train))
    return fitted.transform(widened(test)).select("line_id", "label", "prediction")


@query(
    "polyfit_deg1",
    """WITH z AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS x,
                         l_extendedprice AS y FROM lineitem)
       SELECT CAST(0 AS INTEGER) AS power, round(regr_intercept(y, x), 4) AS coefficient FROM z
       UNION ALL SELECT 1, round(regr_slope(y, x), 4) FROM z""",
)
def polyfit_deg1(t):
    p = R.polyfit(t.lineitem, "l_quantity", "l_extendedprice", 1)
    return p.select("power", F.round("coefficient", 4).alias("coefficient"))


@query("polyfit_deg5")
def polyfit_deg5(t):
    return R.polyfit(t.lineitem, "l_quantity", "l_extendedprice", 5)
