"""Voting, blending, stacking, out-of-fold predictions, models per group, pseudo-labels.

Base models are applied to the same row one after the other, so their outputs are columns of one table and
no join by key is needed. Out-of-fold columns are made fold by fold and put together by union.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.models.bayes import GaussianNB
from tabforge.models.discriminant import Qda
from tabforge.models.learner import label_number
from tabforge.models.saving import SavedInParts
from tabforge.operators.cols import low_variance_cols
from tabforge.operators.profile import classes_of
from tabforge.models.moments import class_shares, fit_by_group, group_table, is_sum, with_group_models
from tabforge.operators.ranking import hashed_position
from tabforge.operators.split import hash_sample, stratified_split
from tabforge.plans.folds import FoldModels, all_sums
from tabforge.plans.tune import better, folded, score
from tabforge.runtime import cut_lineage, in_parallel


def vote(preds: Sequence[DataFrame], key: str, pred: str = "prediction", weights: Sequence[float] | None = None) -> DataFrame:
    """Majority of several prediction tables by key; on equal weight the smaller label wins."""
    weights = weights or [1.0] * len(preds)
    parts = [p.select(key, F.col(pred).alias("_label"), F.lit(float(w)).alias("_w")) for p, w in zip(preds, weights)]
    every = reduce(DataFrame.unionByName, parts)
    per = every.groupBy(key, "_label").agg(F.sum("_w").alias("_w"))
    best = F.min_by("_label", F.struct((-F.col("_w")).alias("w"), "_label"))
    return per.groupBy(key).agg(best.alias("prediction"))


def vote_columns(cols: Sequence[str], labels: Sequence, weights: Sequence[float] | None = None) -> Column:
    """The same for predictions that are columns of one table: no shuffle. ``labels`` in ascending order."""
    weights = weights or [1.0] * len(cols)
    sums = F.array(
        *[sum((F.when(F.col(c) == F.lit(k), w).otherwise(0.0) for c, w in zip(cols, weights)), F.lit(0.0)) for k in labels]
    )
    return F.element_at(F.array(*[F.lit(k) for k in labels]), F.array_position(sums, F.array_max(sums)).cast("int"))


def _apply(models: Sequence[Model], df: DataFrame, labels: Sequence, use_proba: bool, prefix: str = "_b") -> tuple[DataFrame, list[str]]:
    """Outputs of all models as number columns: probabilities per class, or the class number."""
    names = []
    for i, m in enumerate(models):
        df = m.transform(df)
        if use_proba and "probability" in df.columns:
            made = {f"{prefix}{i}_{j}": F.get("probability", F.lit(j)) for j in range(len(labels))}
        else:
            made = {f"{prefix}{i}": label_number("prediction", labels)}
        df = df.withColumns(made).drop("prediction", "probability")
        names += made
    return df, names


class _Group(Estimator):
    """Estimator made of others; parameters meant for a part reach it through ``copy``."""

    def __init__(self, bases: Sequence[Estimator], meta: Estimator | None = None):
        super().__init__()
        self.bases, self.meta = list(bases), meta

    def copy(self, extra=None):
        that = super().copy(extra)
        that.bases = [b.copy(extra) for b in self.bases]
        if self.meta is not None:
            that.meta = self.meta.copy(extra)
        return that

    def _fit_meta(self, wide: DataFrame, names: list[str]) -> Model:
        """The base outputs are made once and kept, because the meta model passes over them many times."""
        meta = self.meta.copy()
        meta._set(inputCols=names)
        rows = wide.select(self.key, self.label, *names).persist()
        try:
            return meta.fit(rows)
        finally:
            rows.unpersist()


class VotingModel(SavedInParts, Model):
    PLAIN, PARTS = ("labels", "weights"), ("models",)

    def __init__(self, models, labels, weights):
        super().__init__()
        self.models, self.labels, self.weights = models, labels, weights

    def _transform(self, df: DataFrame) -> DataFrame:
        names = []
        for i, m in enumerate(self.models):
            df = m.transform(df).withColumnRenamed("prediction", f"_v{i}").drop("probability")
            names.append(f"_v{i}")
        return df.withColumn("prediction", vote_columns(names, self.labels, self.weights)).drop(*names)


class Voting(_Group):
    """Weighted majority of several classifiers."""

    def __init__(self, bases: Sequence[Estimator], label: str = "label", weights: Sequence[float] | None = None):
        super().__init__(bases)
        self.label, self.weights = label, weights

    def _fit(self, df: DataFrame) -> VotingModel:
        return VotingModel(in_parallel(lambda b: b.fit(df), self.bases), classes_of(df, self.label), self.weights)


class StackedModel(SavedInParts, Model):
    """Base models, then a model on their outputs."""

    PLAIN, PARTS = ("labels", "use_proba"), ("models", "meta")

    def __init__(self, models, meta, labels, use_proba):
        super().__init__()
        self.models, self.meta, self.labels, self.use_proba = models, meta, labels, use_proba

    def _transform(self, df: DataFrame) -> DataFrame:
        wide, names = _apply(self.models, df, self.labels, self.use_proba)
        return self.meta.transform(wide).drop(*names)


class Blend(_Group):
    """Bases learn from one part of the rows, the meta model from their outputs on the other part.

    The input columns of ``meta`` are set when they are known.
    """

    def __init__(self, bases, meta: Estimator, key: str, label: str = "label", frac: float = 0.5,
                 use_proba: bool = False, seed: int = 0):
        super().__init__(bases, meta)
        self.key, self.label = key, label
        self.frac, self.use_proba, self.seed = frac, use_proba, seed

    def _fit(self, df: DataFrame) -> StackedModel:
        labels = classes_of(df, self.label)
        parts = stratified_split(df, self.key, self.label, self.frac, self.seed, out="_part").persist()
        try:
            parts.count()
            first = parts.where(F.col("_part") == "train").drop("_part")
            models = in_parallel(lambda b: b.fit(first), self.bases)
            wide, names = _apply(models, parts.where(F.col("_part") == "test").drop("_part"), labels, self.use_proba)
            meta = self._fit_meta(wide, names)
        finally:
            parts.unpersist()
        return StackedModel(models, meta, labels, self.use_proba)


def oof_table(bases: Sequence[Estimator], data: DataFrame, label: str, k: int, labels: Sequence, use_proba: bool = False):
    """Outputs of models that never saw the row, for every row: table, output columns, models per fold.

    ``data`` holds the fold number in ``_fold``. Bases that are sums need one pass for the fits and are one projection.
    """
    if all_sums(bases):
        sums = FoldModels(bases, data, label, k)
        wide, names = _sum_outputs(sums, data, labels, use_proba)
        return wide, names, [sums.models(f) for f in range(k)]
    tasks = [(i, b) for i in range(k) for b in bases]
    fitted = in_parallel(lambda t: t[1].fit(data.where(F.col("_fold") != t[0])), tasks)
    parts, per_fold, names = [], [], []
    for i in range(k):
        models = fitted[i * len(bases) : (i + 1) * len(bases)]
        part, names = _apply(models, data.where(F.col("_fold") == i), labels, use_proba)
        parts.append(part)
        per_fold.append(models)
    return reduce(DataFrame.unionByName, parts), names, per_fold


def _sum_outputs(sums: FoldModels, data: DataFrame, labels: Sequence, use_proba: bool) -> tuple[DataFrame, list[str]]:
    """Outputs of each row's own fold's models, named as ``_apply`` names them."""
    wide, made, spare = sums.scored(data, labels), {}, []
    for i in range(len(sums.ests)):
        if use_proba:
            made |= {f"_b{i}_{j}": F.get(f"_p{i}_prob", F.lit(j)) for j in range(len(labels))}
        else:
            made[f"_b{i}"] = label_number(f"_p{i}", labels)
        spare += [f"_p{i}", f"_p{i}_prob"]
    return wide.withColumns(made).drop(*spare), list(made)


def _dealt(df: DataFrame, key: str, label: str, k: int, seed: int, stratified: bool) -> DataFrame:
    """``df`` with ``_fold``. Folds that count rows are dealt once and written; folds by hash are a projection."""
    data = folded(df, key, label, k, seed, stratified)
    return cut_lineage(data) if stratified else data


class Stack(_Group):
    """The meta model learns from out-of-fold outputs of the bases; the bases are then fitted on all rows.

    ``stratified=False`` takes folds straight from the key hash, which moves no row.
    """

    def __init__(self, bases, meta: Estimator, key: str, label: str = "label", k: int = 5, use_proba: bool = True,
                 seed: int = 0, stratified: bool = True):
        super().__init__(bases, meta)
        self.key, self.label = key, label
        self.k, self.use_proba, self.seed, self.stratified = k, use_proba, seed, stratified

    def _fit(self, df: DataFrame) -> StackedModel:
        labels = classes_of(df, self.label)
        data = _dealt(df, self.key, self.label, self.k, self.seed, self.stratified)
        if all_sums(self.bases):
            sums = FoldModels(self.bases, data, self.label, self.k)
            wide, names = _sum_outputs(sums, data, labels, self.use_proba)
            return StackedModel(sums.models(), self._fit_meta(wide, names), labels, self.use_proba)
        data = data.persist()
        try:
            data.count()  # filled once, before several fits ask for it at the same time
            wide, names, _ = oof_table(self.bases, data, self.label, self.k, labels, self.use_proba)
            meta = self._fit_meta(wide, names)
        finally:
            data.unpersist()
        return StackedModel(in_parallel(lambda b: b.fit(df), self.bases), meta, labels, self.use_proba)


def oof(est: Estimator, train: DataFrame, test: DataFrame, key: str, label: str, k: int, use_proba: bool = False,
        seed: int = 0, stratified: bool = True) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold outputs for the train rows, and the mean of the k models' outputs for the test rows.

    Outputs are class numbers (their mean for the test rows), or one probability per class.
    ``stratified=False`` takes folds straight from the key hash, which moves no row.
    """
    labels = classes_of(train, label)
    data = _dealt(train, key, label, k, seed, stratified)
    kept = None if is_sum(est) else data.persist()
    try:
        if kept is not None:
            kept.count()  # filled once, before several fits ask for it at the same time
        wide, names, per_fold = oof_table([est], data, label, k, labels, use_proba)
    finally:
        if kept is not None:
            kept.unpersist()
    models = [m[0] for m in per_fold]
    tested, many = _apply(models, test, labels, use_proba)
    if use_proba:
        out = {n: sum((F.col(f"_b{i}_{j}") for i in range(1, k)), F.col(f"_b0_{j}")) / k for j, n in enumerate(names)}
    else:
        out = {names[0]: sum((F.col(c) for c in many[1:]), F.col(many[0])) / k}
    means = tested.select(key, *[c.alias(n) for n, c in out.items()])
    return wide.select(key, label, *names), means


class PerGroupModel(SavedInParts, Model):
    """Rows of a group that no model knows, or without a group, keep a null prediction."""

    PLAIN, PARTS = ("group",), ("models",)

    def __init__(self, group, models):
        super().__init__()
        self.group, self.models = group, models

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = [m.transform(df.where(F.col(self.group) == F.lit(g))) for g, m in self.models.items()]
        parts.append(_unknown(df, self.group, list(self.models)))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _unknown(df: DataFrame, group: str, known: Sequence) -> DataFrame:
    return df.where(~F.coalesce(F.col(group).isin(list(known)), F.lit(False)))


def per_group_fit(make: Callable[[list[str]], Estimator], df: DataFrame, group: str, cols: Sequence[str],
                  min_variance: float | None = None, max_groups: int = 100) -> Model:
    """One model per value of ``group``, each on the columns that vary within the group.

    Naive Bayes and quadratic discriminants: a table of models for any number of groups, one scan for the fit and one to
    score. Other estimators: the groups are few (checked), and every fit and ``transform`` runs on a filter of the table.
    """
    est = make(list(cols))
    if by_table(est):
        return fit_by_group(est, df, group, min_variance)
    groups = classes_of(df, group, max_groups)

    def fit(g):
        rows = df.where(F.col(group) == F.lit(g))
        return make(_varying(rows, cols, min_variance)).fit(rows)

    return PerGroupModel(group, dict(zip(groups, in_parallel(fit, groups))))


def by_table(est) -> bool:
    """Whether models of an estimator come as one table for all groups."""
    return isinstance(est, (GaussianNB, Qda))


def _varying(rows: DataFrame, cols: Sequence[str], min_variance: float | None) -> list[str]:
    dull = set(low_variance_cols(rows, cols, min_variance)) if min_variance is not None else set()
    kept = [c for c in cols if c not in dull]
    if not kept:
        raise ValueError("no column varies in the group")
    return kept


def per_group_oof(make: Callable[[list[str]], Estimator], train: DataFrame, test: DataFrame, group: str, key: str, label: str,
                  cols: Sequence[str], k: int, min_variance: float | None = None, seed: int = 0,
                  max_groups: int = 100) -> tuple[DataFrame, DataFrame]:
    """Per group: out-of-fold probabilities of the train rows, mean of the k models' for the test rows.

    Columns ``p_<label>`` for every label of the table; a class that a group does not have gets 0 there. Rows of unknown
    groups, or without a group, get nulls. Naive Bayes and quadratic discriminants take any number of groups.
    """
    labels = classes_of(train, label)
    est = make(list(cols))
    if by_table(est):
        return _table_oof(est, train, test, group, key, label, k, labels, min_variance, seed)
    groups = classes_of(train, group, max_groups)
    nulls = [F.lit(None).cast("double").alias(f"p_{x}") for x in labels]
    inner = [_unknown(train, group, groups).select(key, label, *nulls)]
    outer = [_unknown(test, group, groups).select(key, *nulls)]
    for g in groups:
        rows, asked = (d.where(F.col(group) == F.lit(g)) for d in (train, test))
        own = classes_of(rows, label)
        est = make(_varying(rows, cols, min_variance))
        seen, new = oof(est, rows, asked, key, label, k, use_proba=True, seed=seed)
        probs = [F.col(f"_b0_{own.index(x)}").alias(f"p_{x}") if x in own else F.lit(0.0).alias(f"p_{x}") for x in labels]
        inner.append(seen.select(key, label, *probs))
        outer.append(new.select(key, *probs))
    return reduce(DataFrame.unionByName, inner), reduce(DataFrame.unionByName, outer)


def _table_oof(est, train, test, group, key, label, k, labels, min_variance, seed) -> tuple[DataFrame, DataFrame]:
    """Folds are dealt within (group, class) and written once; then one aggregate, one join for either table."""
    dealt = hashed_position(train.where(F.col(group).isNotNull()), key, seed, by=[group, label], out="_pos")
    dealt = cut_lineage(dealt.withColumn("_fold", F.pmod("_pos", F.lit(k)).cast("int")).drop("_pos"))
    table = group_table(est, dealt, group, min_variance, "_fold", k)
    pairs, cols = isinstance(est, Qda), est.cols()

    def outputs(model: Column) -> Column:
        shares = class_shares(model, F.col("_used"), cols, pairs)
        at = [F.array_position(model["labels"], F.lit(x)) for x in labels]
        own = F.get(F.transform(F.array(shares), lambda s: F.array(*[F.when(a > 0, F.get(s, a.cast("int") - 1)).otherwise(0.0) for a in at])), 0)
        return F.when(model.isNotNull() & shares.isNotNull(), own)

    seen = with_group_models(dealt, table, group).withColumn("_out", outputs(F.get("_models", F.col("_fold"))))
    every = F.filter(F.transform("_models", outputs), lambda o: o.isNotNull())
    asked = with_group_models(test, table, group).withColumn("_all", every)

    def mean_of(j: int) -> Column:
        return F.aggregate("_all", F.lit(0.0), lambda a, o: a + F.get(o, j)) / F.nullif(F.size("_all"), F.lit(0))

    mean = [mean_of(j) for j in range(len(labels))]
    inner = seen.select(key, label, *[F.get("_out", j).alias(f"p_{x}") for j, x in enumerate(labels)])
    rest = train.where(F.col(group).isNull() | F.col(label).isNull())
    nulls = rest.select(key, label, *[F.lit(None).cast("double").alias(f"p_{x}") for x in labels])
    return inner.unionByName(nulls), asked.select(key, *[m.alias(f"p_{x}") for m, x in zip(mean, labels)])


def pseudo_union(train: DataFrame, labelled: DataFrame, key: str, frac: float, seed: int = 0, label: str = "label") -> DataFrame:
    """Train rows and a share of the self-labelled rows, told apart by ``is_pseudo``."""
    extra = hash_sample(labelled.drop(label).withColumnRenamed("prediction", label), key, frac, seed)
    return train.withColumn("is_pseudo", F.lit(False)).unionByName(
        extra.withColumn("is_pseudo", F.lit(True)).select(*train.columns, "is_pseudo")
    )


def pseudo_label(
    est: Estimator, train: DataFrame, holdout: DataFrame, test: DataFrame, key: str, label: str = "label",
    start: float = 0.02, step: float = 0.01, target: float = 0.95, max_rounds: int = 5, metric: str = "accuracy",
    seed: int = 0, labels: Sequence | None = None,
) -> tuple[Model, DataFrame]:
    """Refit with a growing sample of self-labelled test rows until the score is good enough.

    The score is taken on true labels that no fit has seen. Rounds are bounded. Each round's added rows are
    written once, so a lost executor does not replay earlier rounds.
    """
    model, rows = est.fit(train), []
    for i in range(max_rounds + 1):
        value = float(score(model.transform(holdout), metric, label, labels))
        frac = 0.0 if i == 0 else start + (i - 1) * step
        rows.append((i, frac, value))
        if better(metric, value, target) or i == max_rounds:
            break
        frac = min(1.0, start + i * step)
        scored = model.transform(hash_sample(test, key, frac, seed)).drop("probability")
        added = scored.drop(label).withColumnRenamed("prediction", label).select(*train.columns)
        model = est.fit(train.unionByName(cut_lineage(added)))
    history = train.sparkSession.createDataFrame(rows, "round int, share double, score double")
    return model, history
