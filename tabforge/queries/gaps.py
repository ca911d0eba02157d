"""Missing cells, unseen groups and malformed files: one rule for each, whatever the width or size."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.models import knn as K
from tabforge.models.bayes import GaussianNB
from tabforge.models.discriminant import Lda
from tabforge.operators import cols as C
from tabforge.operators import metrics as V
from tabforge.operators import profile as P
from tabforge.operators.split import train_test
from tabforge.plans import board, ensemble
from tabforge.queries.modelling import _MOMENTS, SEED, TEST_SHARE, TRAIN_TEST_SQL, TWO, nb_sql
from tabforge.queries.profiling import EMB, embedding_cols
from tabforge.queries.registry import LINE_FEATURES, lines, query, r6
from tabforge.queries.scoring import SCORED, scored
from tabforge.queries.selecting import _FLAGGED, _flagged
from tabforge.runtime import new_path
from tabforge.sources import io

GAPPY = EMB[:20]
_HOLES = ", ".join(
    f"CASE WHEN (vec_id + {i}) % 7 <> 0 THEN CAST(embedding[{i + 1}] AS DOUBLE) END AS {c}" for i, c in enumerate(GAPPY)
)


def gappy_vectors(t):
    """Twenty numbers of each vector; about one cell in seven is missing, in every row another one."""
    holes = [F.when((F.col("vec_id") + i) % 7 != 0, F.col(c)).alias(c) for i, c in enumerate(GAPPY)]
    return embedding_cols(t).select("vec_id", "label", *holes)


@query(
    "corr_matrix_gaps",
    f"WITH g AS (SELECT vec_id, {_HOLES} FROM embeddings) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, CAST(round(corr({a}, {b}), 6) AS DOUBLE) AS r FROM g" for a in GAPPY for b in GAPPY
    ),
)
def corr_matrix_gaps(t):
    """Each pair over the rows where both are present, also for many columns."""
    return P.corr_long(gappy_vectors(t), GAPPY).withColumn("r", r6("r"))


@query(
    "clf_lda_gaps",
    f"""WITH {TRAIN_TEST_SQL.replace("train AS (SELECT * FROM lines WHERE NOT", "train AS (SELECT * FROM lines WHERE l_quantity % 5 <> 0 AND NOT")},
      {_MOMENTS},
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
def clf_lda_gaps(t):
    """Training rows with a missing cell take no part in the fit."""
    train, test = train_test(lines(t), "line_id", TEST_SHARE, SEED)
    holed = train.withColumn("l_quantity", F.when(F.col("l_quantity") % 5 != 0, F.col("l_quantity")))
    return Lda(TWO).fit(holed).transform(test).select("line_id", "label", "prediction")


@query(
    "knn_gaps",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 9 <> 4)
       SELECT q.vec_id AS qkey, s.vec_id AS tkey, round(list_distance(q.e, s.e), 6) AS dist, s.label,
              CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, s.e), s.vec_id) AS INTEGER) AS rank
       FROM v q JOIN v s ON q.vec_id <> s.vec_id QUALIFY rank <= 2""",
)
def knn_gaps(t):
    """One missing number takes a vector out of the search and leaves all others as they are."""
    v = embedding_cols(t).withColumn("e7", F.when(F.col("vec_id") % 9 != 4, F.col("e7")))
    return K.neighbors(v, v, EMB, "vec_id", "label", 2, skip="vec_id").withColumn("dist", r6("dist"))


@query(
    "per_group_unseen",
    f"""WITH {TRAIN_TEST_SQL},
        {_FLAGGED},
        tr AS (SELECT * FROM train JOIN flagged USING (line_id) WHERE l_returnflag <> 'A'),
        te AS (SELECT * FROM test JOIN flagged USING (line_id)),
        {nb_sql('tr', 'te', TWO, ['l_returnflag'])}
        SELECT line_id, l_returnflag, label, prediction FROM judged
        UNION ALL SELECT line_id, l_returnflag, label, NULL FROM te WHERE l_returnflag = 'A'""",
)
def per_group_unseen(t):
    """Rows of a group that was not in the training rows stay, without a prediction."""
    train, test = train_test(_flagged(t), "line_id", TEST_SHARE, SEED)
    model = ensemble.per_group_fit(GaussianNB, train.where("l_returnflag <> 'A'"), "l_returnflag", LINE_FEATURES, min_variance=1.5)
    return model.transform(test).select("line_id", "l_returnflag", "label", "prediction")


@query(
    "metric_accuracy_gaps",
    f"""WITH {SCORED}, g AS (SELECT label, CASE WHEN prediction <> 4 THEN prediction END AS prediction FROM scored)
        SELECT round(avg(CAST(coalesce(label = prediction, false) AS INTEGER)), 6) AS accuracy,
               round(1 - avg(CAST(coalesce(label = prediction, false) AS INTEGER)), 6) AS error FROM g""",
)
def metric_accuracy_gaps(t):
    """A missing prediction is wrong."""
    some = scored(t).withColumn("prediction", F.when(F.col("prediction") != 4, F.col("prediction")))
    return V.accuracy(some).select(r6("accuracy").alias("accuracy"), r6("error").alias("error"))


@query("src_csv_drop", "SELECT event_id FROM events WHERE event_type <> 'error'")
def src_csv_drop(t):
    """Malformed rows are left out, also if the bad cell is not asked for."""
    path = new_path(t.spark, "events-csv")
    value = F.when(F.col("event_type") == "error", "not a number").otherwise(F.col("value").cast("string"))
    t.events.select("event_id", "user_id", value.alias("value")).write.csv(path, header=True)
    return io.read_csv(t.spark, path, "event_id long, user_id int, value double", on_bad="drop").select("event_id")


@query("src_csv_reordered", "SELECT c_custkey, c_acctbal FROM customer")
def src_csv_reordered(t):
    """Columns are found by their header, wherever they stand."""
    path = new_path(t.spark, "customer-csv")
    t.customer.select("c_acctbal", "c_name", "c_custkey").write.csv(path, header=True)
    df = io.read_csv_named(t.spark, path, {"c_custkey": "long", "c_acctbal": "double"}, on_bad="fail")
    return df.select("c_custkey", "c_acctbal")


@query("strip_suffix", "SELECT c_custkey AS c_custkey, c_name AS c_name, c_acctbal AS c_acctbal FROM customer")
def strip_suffix(t):
    """The columns with a suffix, without it."""
    named = t.customer.select(*[F.col(c).alias(f"{c}_x") for c in ("c_custkey", "c_name", "c_acctbal")], "c_mktsegment")
    return C.strip_suffix(named.select(C.cols_like(named, suffix="_x")), "_x")


@query(
    "predictions_wide",
    """SELECT vec_id, label, CAST(vec_id % 10 AS INTEGER) AS by_key, 3 AS always_3 FROM embeddings""",
)
def predictions_wide(t):
    """Predictions of two models side by side, joined by key."""
    v = t.embeddings.select("vec_id", "label")
    by_key = v.withColumn("prediction", (F.col("vec_id") % 10).cast("int"))
    return board.predictions_wide({"by_key": by_key, "always_3": v.withColumn("prediction", F.lit(3))}, "vec_id", "label")
