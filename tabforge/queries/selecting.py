"""H1-H4, H8, Z1-Z6, W1 and the flagship."""

from pyspark.sql import functions as F

from tabforge.functions.rowmath import bin_floor
from tabforge.models import learner as L
from tabforge.models.bayes import GaussianNB
from tabforge.models.discriminant import Lda, Qda
from tabforge.operators import joins as J
from tabforge.operators import metrics as V
from tabforge.operators.split import train_test
from tabforge.plans import board, ensemble, tune
from tabforge.queries.modelling import SEED, TEST_SHARE, TRAIN_TEST_SQL, TWO, nb_sql, parts
from tabforge.queries.registry import LINE_FEATURES, LINE_ID, LINES_SQL, lines, part_sql, query, r6


@query(
    "flagship",
    """WITH e AS (SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS quantity_bin, p_type, l_partkey, l_extendedprice
                  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
       SELECT p_type, quantity_bin, count(DISTINCT l_partkey) AS n_parts, min(l_extendedprice) AS lo,
              max(l_extendedprice) AS hi FROM e GROUP BY ALL""",
)
def flagship(t):
    """Readings joined to their dimension, binned, profiled per group."""
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    fact = t.lineitem.select("l_partkey", "l_extendedprice", bin_floor("l_quantity", 5).alias("quantity_bin"))
    wide = J.enrich(fact, dim, "l_partkey")
    return wide.groupBy("p_type", "quantity_bin").agg(
        F.count_distinct("l_partkey").alias("n_parts"),
        F.min("l_extendedprice").alias("lo"),
        F.max("l_extendedprice").alias("hi"),
    )


@query(
    "classify_and_score",
    f"""WITH {TRAIN_TEST_SQL},
        m AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}' for c in LINE_FEATURES)} FROM train),
        tr AS (SELECT line_id, label, {', '.join(f'({c} - a_{c}) / s_{c} AS {c}' for c in LINE_FEATURES)} FROM train, m),
        te AS (SELECT line_id, label, {', '.join(f'({c} - a_{c}) / s_{c} AS {c}' for c in LINE_FEATURES)} FROM test, m),
        {nb_sql('tr', 'te', LINE_FEATURES)},
        k AS (SELECT unnest([0, 1, 2]) AS cls)
        SELECT CAST(a.cls AS INTEGER) AS label, CAST(b.cls AS INTEGER) AS prediction, count(line_id) AS n
        FROM k a CROSS JOIN k b LEFT JOIN judged j ON j.label = a.cls AND j.prediction = b.cls GROUP BY ALL""",
)
def classify_and_score(t):
    """Split, scale on the train rows, Gaussian naive Bayes, confusion matrix."""
    train, test = parts(t)
    return V.confusion(GaussianNB(LINE_FEATURES).fit(train).transform(test))


def _folds_sql(rows: str, k: int, seed: int) -> str:
    return f"""SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', line_id, '{seed}'))) - 1) % {k}
               AS fold FROM {rows}"""


@query(
    "cv_scores_nb",
    f"""WITH {LINES_SQL}, folds AS ({_folds_sql('lines', 3, 5)}), g AS (SELECT unnest([0, 1, 2]) AS held),
        tr AS (SELECT * FROM folds, g WHERE fold <> held), te AS (SELECT * FROM folds, g WHERE fold = held),
        {nb_sql('tr', 'te', LINE_FEATURES, ['held'])}
        SELECT CAST(held AS INTEGER) AS fold, round(avg(CAST(label = prediction AS INTEGER)), 6) AS score
        FROM judged GROUP BY held""",
)
def cv_scores_nb(t):
    scores = tune.cross_val(GaussianNB(LINE_FEATURES), lines(t), "line_id", "label", 3, seed=5)
    return scores.withColumn("score", r6("score"))


@query("cv_scores")
def cv_scores(t):
    tree = L.decision_tree(LINE_FEATURES, max_depth=5)
    return tune.cross_val(tree, lines(t), "line_id", "label", 3, metric="mae")


@query("grid_search")
def grid_search(t):
    est = L.random_forest(LINE_FEATURES, trees=5, keyCol="line_id")
    grid = tune.param_grid({est.base.maxDepth: [2, 4], est.base.impurity: ["gini", "entropy"]})
    return tune.grid_search(est, grid, lines(t), "line_id", "label", 2).table


@query("random_search")
def random_search(t):
    est = L.decision_tree(LINE_FEATURES)
    space = {est.base.maxDepth: [2, 4, 6, 8], est.base.minInstancesPerNode: [1, 5, 20], est.base.impurity: ["gini", "entropy"]}
    return tune.random_search(est, space, 3, lines(t), "line_id", "label", 2, seed=4).table


@query("param_sweep")
def param_sweep(t):
    est = L.decision_tree(LINE_FEATURES)
    train, test = parts(t)
    return tune.sweep(est, {est.base.maxDepth: [2, 6], est.base.minInstancesPerNode: [1, 50]}, train, test)


@query("grid_search_stack")
def grid_search_stack(t):
    """Parameters of one base and of the meta model, searched through the stack."""
    tree = L.decision_tree(LINE_FEATURES)
    meta = L.logistic([], C=100.0, max_iter=10)
    stack = ensemble.Stack([tree, GaussianNB(LINE_FEATURES)], meta, "line_id", k=2)
    grid = [{tree.base.maxDepth: 3, meta.base.maxIter: 5}, {tree.base.maxDepth: 6, meta.base.maxIter: 10}]
    return tune.grid_search(stack, grid, lines(t), "line_id", "label", 2).table


def _rules(t):
    rows = lines(t)
    return [
        rows.select("line_id", F.least(F.floor(F.col("l_quantity") / 17), F.lit(2)).cast("int").alias("prediction")),
        rows.select("line_id", F.least(F.floor(F.col("l_extendedprice") / 35000), F.lit(2)).cast("int").alias("prediction")),
        rows.select("line_id", F.lit(1).alias("prediction")),
    ]


_RULES = f"""{LINES_SQL}, votes AS (
   SELECT line_id, CAST(least(floor(l_quantity / 17), 2) AS INTEGER) AS p, 1.0 AS w FROM lines
   UNION ALL SELECT line_id, CAST(least(floor(l_extendedprice / 35000), 2) AS INTEGER), 1.5 FROM lines
   UNION ALL SELECT line_id, 1, 1.0 FROM lines)"""


@query(
    "vote_majority",
    f"""WITH {_RULES}, s AS (SELECT line_id, p, sum(w) AS w FROM votes GROUP BY ALL)
        SELECT line_id, p AS prediction FROM s
        QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY w DESC, p) = 1""",
)
def vote_majority(t):
    return ensemble.vote(_rules(t), "line_id", weights=[1.0, 1.5, 1.0])


@query("vote_models")
def vote_models(t):
    """Three fitted models on the same row; their votes need no join."""
    train, test = parts(t)
    bases = [GaussianNB(LINE_FEATURES), Lda(LINE_FEATURES), L.decision_tree(LINE_FEATURES)]
    return ensemble.Voting(bases, weights=[1, 1, 2]).fit(train).transform(test).select("line_id", "label", "prediction")


@query("blend")
def blend(t):
    train, test = parts(t)
    bases = [GaussianNB(LINE_FEATURES), L.decision_tree(LINE_FEATURES), Qda(LINE_FEATURES)]
    est = ensemble.Blend(bases, L.logistic([], C=100.0, max_iter=10), "line_id", use_proba=True)
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


@query("stack_oof")
def stack_oof(t):
    train, test = parts(t)
    est = ensemble.Stack(
        [GaussianNB(LINE_FEATURES), L.decision_tree(LINE_FEATURES)], L.logistic([], C=100.0, max_iter=10), "line_id", k=3
    )
    return est.fit(train).transform(test).select("line_id", "label", "prediction")


@query("oof_coverage", f"WITH {LINES_SQL} SELECT line_id, CAST(2 AS INTEGER) AS n_outputs FROM lines")
def oof_coverage(t):
    """Every row gets one output per base model, from models that never saw it."""
    data = tune.folded(lines(t), "line_id", "label", 3)
    bases = [GaussianNB(LINE_FEATURES), Lda(LINE_FEATURES)]
    wide, names, _ = ensemble.oof_table(bases, data, "label", 3, [0, 1, 2])
    filled = sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in names), F.lit(0))
    return wide.select("line_id", filled.alias("n_outputs"))


@query(
    "oof_nb",
    f"""WITH {TRAIN_TEST_SQL}, folds AS ({_folds_sql('train', 3, 6)}), g AS (SELECT unnest([0, 1, 2]) AS held),
        tr AS (SELECT * FROM folds, g WHERE fold <> held),
        te AS (SELECT line_id, label, held, 'train' AS part, {', '.join(LINE_FEATURES)} FROM folds, g WHERE fold = held
               UNION ALL
               SELECT line_id, label, held, 'test' AS part, {', '.join(LINE_FEATURES)} FROM test, g),
        {nb_sql('tr', 'te', LINE_FEATURES, ['held'])}
        SELECT line_id, round(avg(prediction), 6) AS output FROM judged GROUP BY line_id""",
)
def oof_nb(t):
    """Out-of-fold class for train rows, mean class number of the three models for test rows."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    inner, outer = ensemble.oof(GaussianNB(LINE_FEATURES), train, test, "line_id", "label", 3, seed=6)
    both = inner.select("line_id", "_b0").unionAll(outer.select("line_id", "_b0"))
    return both.select("line_id", r6("_b0").alias("output"))


_FLAGGED = f"""flagged AS (SELECT {LINE_ID} AS line_id, l_returnflag FROM lineitem)"""


@query(
    "per_group_nb",
    f"""WITH {TRAIN_TEST_SQL}, {_FLAGGED},
        tr AS (SELECT * FROM train JOIN flagged USING (line_id)), te AS (SELECT * FROM test JOIN flagged USING (line_id)),
        {nb_sql('tr', 'te', TWO, ['l_returnflag'])}
        SELECT line_id, l_returnflag, label, prediction FROM judged""",
)
def per_group_nb(t):
    """One model per return flag, on the columns whose variance in the group exceeds 1.5."""
    train, test = train_test(_flagged(t), "line_id", TEST_SHARE, SEED)
    model = ensemble.per_group_fit(GaussianNB, train, "l_returnflag", LINE_FEATURES, min_variance=1.5)
    return model.transform(test).select("line_id", "l_returnflag", "label", "prediction")


def _flagged(t):
    flag = t.lineitem.select(F.expr(LINE_ID).alias("line_id"), "l_returnflag", *LINE_FEATURES)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return flag.withColumn("label", F.when(net < 30000, 0).when(net < 65000, 1).otherwise(2))


@query(
    "per_group_qda",
    f"""WITH {TRAIN_TEST_SQL}, {_FLAGGED},
      m AS (SELECT l_returnflag, label AS cls, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
              var_samp(l_quantity) AS a, covar_samp(l_quantity, l_extendedprice) AS b, var_samp(l_extendedprice) AS c
            FROM train JOIN flagged USING (line_id) GROUP BY ALL),
      k AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag) AS n_all FROM m),
      s AS (SELECT line_id, l_returnflag, label, cls,
              ln(n / n_all) - 0.5 * ln(a * c - b * b) - 0.5 * (c * pow(l_quantity - mx, 2)
                - 2 * b * (l_quantity - mx) * (l_extendedprice - my) + a * pow(l_extendedprice - my, 2))
                / (a * c - b * b) AS s
            FROM test JOIN flagged USING (line_id) JOIN k USING (l_returnflag))
      SELECT line_id, l_returnflag, label, cls AS prediction FROM s
      QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY s DESC, cls) = 1""",
)
def per_group_qda(t):
    train, test = train_test(_flagged(t), "line_id", TEST_SHARE, SEED)
    model = ensemble.per_group_fit(Qda, train, "l_returnflag", LINE_FEATURES, min_variance=1.5)
    return model.transform(test).select("line_id", "l_returnflag", "label", "prediction")


@query(
    "per_group_oof",
    f"""WITH {TRAIN_TEST_SQL}, {_FLAGGED},
        tr0 AS (SELECT * FROM train JOIN flagged USING (line_id)), te0 AS (SELECT * FROM test JOIN flagged USING (line_id)),
        folds AS (SELECT *, (row_number() OVER (PARTITION BY l_returnflag, label
                    ORDER BY md5(concat_ws(':', line_id, '9'))) - 1) % 3 AS fold FROM tr0),
        g AS (SELECT unnest([0, 1, 2]) AS held),
        tr AS (SELECT * FROM folds, g WHERE fold <> held), te AS (SELECT * FROM te0, g),
        {nb_sql('tr', 'te', TWO, ['l_returnflag', 'held'])},
        p AS (SELECT line_id, held, cls, exp(s - max(s) OVER w) / sum(exp(s - mx)) OVER w AS p
              FROM (SELECT *, max(s) OVER (PARTITION BY line_id, held) AS mx FROM scored)
              WINDOW w AS (PARTITION BY line_id, held))
        SELECT line_id, {', '.join(f"round(sum(p) FILTER (cls = {c}) / 3, 6) AS p_{c}" for c in (0, 1, 2))}
        FROM p GROUP BY line_id""",
)
def per_group_oof(t):
    """Per return flag: mean class probabilities of three models, each fitted without one fold."""
    train, test = train_test(_flagged(t), "line_id", TEST_SHARE, SEED)
    _, mean = ensemble.per_group_oof(
        GaussianNB, train, test, "l_returnflag", "line_id", "label", LINE_FEATURES, 3, min_variance=1.5, seed=9
    )
    return mean.select("line_id", *[r6(f"p_{c}").alias(f"p_{c}") for c in (0, 1, 2)])


@query("pseudo_label")
def pseudo_label(t):
    train, rest = train_test(lines(t), "line_id", 0.6, SEED)
    holdout, test = train_test(rest, "line_id", 0.5, SEED + 1)
    _, history = ensemble.pseudo_label(
        GaussianNB(LINE_FEATURES), train, holdout, test, "line_id", start=0.2, step=0.2, target=0.99, max_rounds=2
    )
    return history


@query(
    "pseudo_union",
    f"""WITH {TRAIN_TEST_SQL}
        SELECT line_id, label, false AS is_pseudo FROM train
        UNION ALL SELECT line_id, CAST(least(floor(l_extendedprice / 35000), 2) AS INTEGER), true
        FROM test WHERE {part_sql('line_id', 31, '40000000')}""",
)
def pseudo_union(t):
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    guess = F.least(F.floor(F.col("l_extendedprice") / 35000), F.lit(2)).cast("int")
    both = ensemble.pseudo_union(train, test.withColumn("prediction", guess), "line_id", 0.25, seed=31)
    return both.select("line_id", "label", "is_pseudo")


@query("compare_models")
def compare_models(t):
    train, test = parts(t)
    models = {
        "naive Bayes": GaussianNB(LINE_FEATURES),
        "linear discriminant": Lda(LINE_FEATURES),
        "quadratic discriminant": Qda(LINE_FEATURES),
        "logistic": L.logistic(LINE_FEATURES, C=100.0, max_iter=10),
        "tree": L.decision_tree(LINE_FEATURES),
    }
    return board.compare(models, train, test)
