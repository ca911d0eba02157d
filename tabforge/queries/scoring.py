"""V1-V9 and the leaderboard tables H7, W2, W3."""

from pyspark.sql import functions as F

from tabforge.operators import metrics as V
from tabforge.plans import board
from tabforge.queries.registry import query, r6

# True class 1..7 and a rule that is right now and then.
PRED = "least(1 + CAST(floor(l_quantity / 8) AS INTEGER), 7)"
SCORED = f"scored AS (SELECT l_linenumber AS label, CAST({PRED} AS INTEGER) AS prediction FROM lineitem)"


def scored(t):
    return t.lineitem.select(F.col("l_linenumber").alias("label"), F.expr(PRED).cast("int").alias("prediction"))


@query(
    "metric_accuracy",
    f"""WITH {SCORED} SELECT round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy,
          round(1 - avg(CAST(label = prediction AS INTEGER)), 6) AS error FROM scored""",
)
def metric_accuracy(t):
    return V.accuracy(scored(t)).select(r6("accuracy").alias("accuracy"), r6("error").alias("error"))


@query(
    "metric_confusion",
    f"""WITH {SCORED}, moved AS (SELECT CASE WHEN label = 3 THEN 4 ELSE label END AS label, prediction FROM scored),
             c AS (SELECT label AS k FROM moved UNION SELECT prediction FROM moved),
             n AS (SELECT label, prediction, count(*) AS n FROM moved GROUP BY ALL)
        SELECT a.k AS label, b.k AS prediction, coalesce(n, 0) AS n
        FROM c a CROSS JOIN c b LEFT JOIN n ON n.label = a.k AND n.prediction = b.k""",
)
def metric_confusion(t):
    """Class 3 is predicted but never true here, so its row of the matrix is empty."""
    moved = F.when(F.col("label") == 3, 4).otherwise(F.col("label"))
    return V.confusion(scored(t).withColumn("label", moved))


_REPORT = f"""{SCORED},
  k AS (SELECT unnest(range(1, 8)) AS cls),
  p AS (SELECT cls, count(*) FILTER (label = cls) AS support, count(*) FILTER (prediction = cls) AS predicted,
               count(*) FILTER (label = cls AND prediction = cls) AS hits
        FROM scored, k GROUP BY cls)"""


@query(
    "metric_class_report",
    f"""WITH {_REPORT}, r AS (SELECT CAST(cls AS VARCHAR) AS cls, coalesce(hits / nullif(predicted, 0), 0) AS precision,
               coalesce(hits / nullif(support, 0), 0) AS recall,
               coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1, support FROM p)
        SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
               CAST(sum(support) AS BIGINT) FROM r
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
               CAST(sum(support) AS BIGINT) FROM r""",
)
def metric_class_report(t):
    return V.class_report(scored(t)).withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("metric_mae", f"WITH {SCORED} SELECT round(avg(abs(label - prediction)), 6) AS mae FROM scored")
def metric_mae(t):
    return V.mae(scored(t)).select(r6("mae").alias("mae"))


@query(
    "metric_mape_accuracy",
    f"""WITH {SCORED} SELECT
          round(100 - 100 * avg(abs(((label - 1) - prediction) / CAST(nullif(label - 1, 0) AS DOUBLE))), 6)
            AS mape_accuracy,
          count(*) FILTER (label = 1) AS n_zero FROM scored""",
)
def metric_mape_accuracy(t):
    shifted = scored(t).withColumn("label", F.col("label") - 1)
    return V.mape_accuracy(shifted).withColumn("mape_accuracy", r6("mape_accuracy"))


@query(
    "metric_auc_macro",
    f"""WITH {_REPORT}, n AS (SELECT count(*) AS n FROM scored)
        SELECT round(avg((hits / support + 1 - (predicted - hits) / (n - support)) / 2), 6) AS auc FROM p, n""",
)
def metric_auc_macro(t):
    return V.auc_hard(scored(t), "macro").select(r6("auc").alias("auc"))


@query(
    "metric_auc_micro",
    f"""WITH {SCORED}, a AS (SELECT avg(CAST(label = prediction AS INTEGER)) AS acc FROM scored)
        SELECT round((acc + 1 - (1 - acc) / 6) / 2, 6) AS auc FROM a""",
)
def metric_auc_micro(t):
    return V.auc_hard(scored(t), "micro").select(r6("auc").alias("auc"))


@query(
    "metric_log_loss",
    """WITH p AS (SELECT l_returnflag, l_quantity + 1 AS a, l_discount * 100 AS n, l_tax * 100 + 1 AS r FROM lineitem)
       SELECT round(-avg(ln(greatest(CASE l_returnflag WHEN 'A' THEN a WHEN 'N' THEN n ELSE r END / (a + n + r), 1e-15))),
                    6) AS log_loss FROM p""",
)
def metric_log_loss(t):
    """Three made probabilities per row; the one of N can be 0."""
    a, n, r = F.col("l_quantity") + 1, F.col("l_discount") * 100, F.col("l_tax") * 100 + 1
    probs = t.lineitem.select("l_returnflag", *[(x / (a + n + r)).alias(k) for k, x in zip("ANR", (a, n, r))])
    loss = V.log_loss(probs, {"A": "A", "N": "N", "R": "R"}, label="l_returnflag")
    return loss.select(r6("log_loss").alias("log_loss"))


_FOLDS = f"""f AS (SELECT l_returnflag AS model, l_suppkey % 5 AS fold,
                     avg(CAST(l_linenumber = {PRED} AS INTEGER)) AS score FROM lineitem GROUP BY ALL)"""


def _fold_scores(t):
    """Accuracy of the rule per model and fold."""
    hit = (F.col("l_linenumber") == F.expr(PRED)).cast("double")
    fold = (F.col("l_suppkey") % 5).alias("fold")
    return t.lineitem.groupBy(F.col("l_returnflag").alias("model"), fold).agg(F.avg(hit).alias("score"))


@query(
    "cv_summary",
    f"""WITH {_FOLDS} SELECT model, round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score
        FROM f GROUP BY model""",
)
def cv_summary(t):
    s = V.cv_summary(_fold_scores(t), by=["model"])
    return s.withColumns({c: r6(c) for c in ("mean_score", "std_score")})


@query(
    "leaderboard_top",
    f"""WITH {_FOLDS} SELECT model, fold, round(score, 6) AS score FROM f ORDER BY f.score DESC, model, fold LIMIT 3""",
)
def leaderboard_top(t):
    return board.top_n(_fold_scores(t), "score", 3, ties=["model", "fold"]).withColumn("score", r6("score"))


@query(
    "leaderboard_flags",
    f"""WITH {_FOLDS}, m AS (SELECT model || fold AS classifier, score AS accuracy, 10 * score AS training_time,
               40 * score AS testing_time FROM f)
        SELECT classifier, round(accuracy, 6) AS accuracy, accuracy = max(accuracy) OVER () AS best_accuracy,
               training_time = min(training_time) OVER () AS best_training_time,
               testing_time = min(testing_time) OVER () AS best_testing_time,
               accuracy < 0.13 AS low_accuracy, testing_time > 5 AS slow
        FROM m""",
)
def leaderboard_flags(t):
    s = F.col("score")
    table = _fold_scores(t).select(
        F.concat("model", F.col("fold").cast("string")).alias("classifier"),
        s.alias("accuracy"),
        (10 * s).alias("training_time"),
        (40 * s).alias("testing_time"),
    )
    flags = board.leaderboard_flags(table, min_accuracy=0.13, max_seconds=5.0)
    return flags.drop("training_time", "testing_time").withColumn("accuracy", r6("accuracy"))


@query(
    "score_predictions_wide",
    f"""WITH {SCORED} SELECT 'rule' AS model, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy FROM scored
        UNION ALL SELECT 'always_4', round(avg(CAST(label = 4 AS INTEGER)), 6) FROM scored
        UNION ALL SELECT 'shifted', round(avg(CAST(label = prediction + 1 AS INTEGER)), 6) FROM scored""",
)
def score_predictions_wide(t):
    wide = scored(t).select(
        "label",
        F.col("prediction").alias("rule"),
        F.lit(4).alias("always_4"),
        (F.col("prediction") + 1).alias("shifted"),
    )
    return board.score_wide(wide, ["rule", "always_4", "shifted"]).withColumn("accuracy", r6("accuracy"))
