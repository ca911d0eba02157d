"""Cross-validation and parameter searches (H1-H4, H6, H8).

Folds are a column made from the key, the data are kept once, and several fits run at a time as Spark jobs.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.models.learner import label_number
from tabforge.operators import metrics as V
from tabforge.operators.metrics import cv_summary
from tabforge.operators.profile import classes_of
from tabforge.operators.split import kfold, stratified_kfold
from tabforge.plans.folds import FoldModels, all_sums
from tabforge.runtime import in_parallel

# Metrics that are one aggregate over the scored rows.
ONE_AGGREGATE = {"accuracy", "error", "mae", "log_loss"}
# Metrics of which the smaller value is the better one.
SMALLER_IS_BETTER = {"error", "mae", "log_loss"}


def score(df: DataFrame, metric: str, label: str = "label", labels: Sequence | None = None) -> float:
    """One number for a table with true and predicted class."""
    if metric in ("accuracy", "error"):
        return V.accuracy(df, label).first()[metric]
    if metric == "mae":
        return V.mae(df, label).first()["mae"]
    if metric in ("auc_macro", "auc_micro"):
        return V.auc_hard(df, metric.removeprefix("auc_"), label).first()["auc"]
    if metric == "log_loss":
        p = F.get("probability", label_number(label, labels).cast("int"))
        return df.agg(-F.avg(F.ln(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(1e-15))))).first()[0]
    raise ValueError(f"unknown metric {metric}")


def better(metric: str, a: float, b: float) -> bool:
    return a < b if metric in SMALLER_IS_BETTER else a > b


def folded(df: DataFrame, key: str, label: str, k: int, seed: int = 0, stratified: bool = True) -> DataFrame:
    if stratified:
        return stratified_kfold(df, key, label, k, seed, out="_fold")
    return kfold(df, key, k, seed=seed, out="_fold")


def cv_scores(
    est: Estimator, df: DataFrame, grid: Sequence[Mapping], key: str, label: str, k: int,
    metric: str = "accuracy", seed: int = 0, stratified: bool = True, parallelism: int = 4,
    labels: Sequence | None = None,
) -> DataFrame:
    """Score of every parameter set on every fold: (candidate, fold, score).

    Models that are sums need one pass for all fits and one for all scores; others are fitted one by one.
    """
    data = folded(df, key, label, k, seed, stratified).persist()
    candidates = [est.copy(dict(params)) for params in grid]

    def one(task):
        (i, candidate), fold = task
        model = candidate.fit(data.where(F.col("_fold") != fold))
        return i, fold, float(score(model.transform(data.where(F.col("_fold") == fold)), metric, label, labels))

    try:
        data.count()  # filled once, before several fits ask for it at the same time
        if all_sums(candidates) and metric in ONE_AGGREGATE:
            rows = _scores_of_sums(candidates, data, label, k, metric, labels)
        else:
            rows = in_parallel(one, list(product(enumerate(candidates), range(k))), parallelism)
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "candidate int, fold int, score double")


def _scores_of_sums(candidates: Sequence, data: DataFrame, label: str, k: int, metric: str, labels: Sequence | None) -> list[tuple]:
    models = FoldModels(candidates, data, label, k)
    labels = list(labels or sorted({x for s in models.whole for x in s["labels"]}))
    scores = [_aggregate(metric, label, f"_p{i}", labels).alias(f"s{i}") for i in range(len(candidates))]
    rows = models.scored(data, labels).groupBy("_fold").agg(*scores).collect()
    return [(i, r["_fold"], float(r[f"s{i}"])) for i in range(len(candidates)) for r in rows]


def _aggregate(metric: str, label: str, pred: str, labels: Sequence):
    if metric in ("accuracy", "error"):
        share = V.accuracy_of(label, pred)
        return share if metric == "accuracy" else 1 - share
    if metric == "mae":
        return F.avg(F.abs(F.col(label) - F.col(pred)))
    p = F.get(f"{pred}_prob", label_number(label, labels).cast("int"))
    return -F.avg(F.ln(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(1e-15))))


def cross_val(est: Estimator, df: DataFrame, key: str, label: str, k: int, metric: str = "accuracy", **kw) -> DataFrame:
    """Score per fold."""
    return cv_scores(est, df, [{}], key, label, k, metric, **kw).drop("candidate")


@dataclass
class Search:
    """Outcome of a parameter search."""

    best: Model
    best_params: dict
    best_score: float
    table: DataFrame


def param_grid(space: Mapping[Param, Sequence]) -> list[dict]:
    """Every combination of the values."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def param_draws(space: Mapping[Param, Sequence], n: int, seed: int = 0) -> list[dict]:
    """``n`` distinct random combinations; all of them when there are no more."""
    every = 1
    for values in space.values():
        every *= len(values)
    rng, names = random.Random(seed), list(space)
    numbers = range(every) if n >= every else rng.sample(range(every), n)
    out = []
    for number in numbers:
        pick = {}
        for name in names:
            number, i = divmod(number, len(space[name]))
            pick[name] = space[name][i]
        out.append(pick)
    return out


def _named(params: Mapping[Param, object]) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in params.items())


def grid_search(
    est: Estimator, grid: Sequence[Mapping], df: DataFrame, key: str, label: str, k: int, metric: str = "accuracy", **kw
) -> Search:
    """Best parameter set by mean fold score, fitted again on all rows. On ties the first one wins."""
    spark = df.sparkSession
    scores = cv_scores(est, df, grid, key, label, k, metric, **kw)
    names = spark.createDataFrame([(i, _named(g)) for i, g in enumerate(grid)], "candidate int, params string")
    summary = cv_summary(scores, by=["candidate"]).join(F.broadcast(names), "candidate")
    rows = sorted(summary.collect(), key=lambda r: r["candidate"])
    best = rows[0]
    for r in rows[1:]:
        if better(metric, r["mean_score"], best["mean_score"]):
            best = r
    table = summary.select(
        "candidate",
        "params",
        "mean_score",
        (F.col("std_score") / 2).alias("half_std"),
        (F.col("candidate") == best["candidate"]).alias("best"),
    ).orderBy("candidate")
    params = dict(grid[best["candidate"]])
    return Search(est.copy(params).fit(df), params, best["mean_score"], table)


def random_search(est: Estimator, space: Mapping[Param, Sequence], n: int, df: DataFrame, key: str, label: str, k: int,
                  metric: str = "accuracy", seed: int = 0, **kw) -> Search:
    """Grid search over ``n`` random combinations."""
    return grid_search(est, param_draws(space, n, seed), df, key, label, k, metric, seed=seed, **kw)


def sweep(est: Estimator, space: Mapping[Param, Sequence], train: DataFrame, val: DataFrame, metric: str = "accuracy",
          label: str = "label") -> DataFrame:
    """Train and validation score for each value of each parameter, the others at their defaults."""
    labels = classes_of(train, label) if metric == "log_loss" else None
    train, val = train.persist(), val.persist()

    def one(setting):
        param, v = setting
        model = est.copy({param: v}).fit(train)
        return (param.name, str(v), *[float(score(model.transform(d), metric, label, labels)) for d in (train, val)])

    try:
        train.count(), val.count()
        rows = in_parallel(one, [(param, v) for param, values in space.items() for v in values])
    finally:
        train.unpersist()
        val.unpersist()
    schema = f"parameter string, param_value string, train_{metric} double, test_{metric} double"
    return train.sparkSession.createDataFrame(rows, schema)
