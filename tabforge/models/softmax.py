"""Gradient boosting for K classes at once (D4): softmax, one tree a class and round, grown together.

Gradients and curvatures of the log loss are statistics of the level-wise grower, in fixed point. Margins are kept beside
the rows and written anew every few rounds; the rounds between are added up while reading. Several ensembles can advance in
step on the same rows, each without one fold, which gives the staged loss of a cross-validation from one run.

Draws of rows and columns are hashes, so a fit does not depend on the layout of the rows. Rows without label or with a
missing feature are not learned from; a row with a missing feature gets a null prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import hashed_below
from tabforge.models.base import ColumnEstimator, ColumnModel
from tabforge.models.forest import complete, spread_rows
from tabforge.models.trees import (
    MAX_BINS,
    Block,
    Grower,
    Rules,
    Slopes,
    Walker,
    blocks_of,
    compact,
    find_bins,
    fixed_point,
    grow,
    importances,
    laid_out,
    mix,
    mix_rows,
    routed,
    with_bins,
)
from tabforge.operators.profile import class_sizes
from tabforge.operators.split import kfold, stratified_kfold
from tabforge.runtime import cut_lineage

ROUNDS_PER_CUT = 5

KNOBS = {
    "rounds": "most rounds",
    "rate": "step size",
    "maxDepth": "levels of a tree",
    "minChildWeight": "least curvature of a leaf",
    "subsample": "share of rows a round",
    "colsample": "share of columns a tree",
    "ridge": "penalty on squared leaf values",
    "leastGain": "least gain of a split",
    "validation": "share of rows set aside by key hash, which stop the rounds",
    "patience": "rounds without a better loss before stopping",
    "bins": "most bins of a column",
    "seed": "seed",
}


def softmax(margins: np.ndarray, axis: int = -1) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def staged_margins(block: Block, recent: list, ensembles: int, classes: int) -> Iterator[np.ndarray]:
    """Margins of a block (ensembles, classes, rows) as written, then after each recent round; one array, changed in place."""
    n = block["_bins"].shape[1]
    out = block["_f"].reshape(ensembles, classes, n).copy() if len(block["_f"]) else np.zeros((ensembles, classes, n))
    yield out
    for trees in recent:
        for t, (router, values) in trees.items():
            out[t // classes, t % classes] += values[routed(router, block["_bins"])]
        yield out


@dataclass
class Boosting:
    """Ensembles on one table. Ensemble ``e`` learns from rows whose ``_fold`` is not ``e`` and is judged on the others."""

    data: DataFrame  # blocks: _bins, _y, _id, _fold, and _f: margins of all ensembles and classes, empty for zeros
    grower: Grower
    ensembles: int
    classes: int
    options: dict
    recent: list  # for each round since the margins were written, by tree number: router and leaf values
    rounds: list  # compact trees of every round, by tree number
    losses: list  # by round: mean held-out log loss of each ensemble

    @property
    def columns(self) -> int:
        return len(self.grower.bins.uppers)

    def _weigh(self, number: int):
        n, k, recent, unit = self.ensembles, self.classes, self.recent, self.grower.objective.unit
        seed, share = self.options["seed"], self.options["subsample"]
        last: dict = {}

        def weigh(block: Block, tree: int):
            e, c = divmod(tree, k)
            if last.get("block") is not block:
                *_, margins = staged_margins(block, recent, n, k)
                last.clear()
                last.update(block=block, p=softmax(margins, 1))
            if ("seen", e) not in last:
                inside = block["_fold"] != e
                if share < 1:
                    inside &= mix_rows(mix(seed, number, e, 11), block["_id"]) < share
                last["seen", e] = np.flatnonzero(inside)
            seen = last["seen", e]
            p = last["p"][e, c][seen]
            stats = np.ones((3, len(seen)), np.int64).T
            stats[:, 0] = np.rint((p - (block["_y"][seen] == c)) / unit)
            stats[:, 1] = np.rint(np.maximum(2 * p * (1 - p), 1e-16) / unit)
            return seen, stats

        return weigh

    def round(self) -> None:
        number, seed, d = len(self.rounds), self.options["seed"], self.columns
        seeds = {t: mix(seed, number, t, 5) for t in range(self.ensembles * self.classes)}
        wanted = max(1, round(self.options["colsample"] * d))
        columns = {t: set(sorted(range(d), key=lambda j: mix(s, j, 3))[:wanted]) for t, s in seeds.items()}
        trees = grow(self.data, self.grower, self._weigh(number), seeds, d, columns)
        rate, objective = self.options["rate"], self.grower.objective
        values = {t: np.array([rate * objective.value(s)[0] for s in tree.stats]) for t, tree in trees.items()}
        self.recent.append({t: (tree.router(), values[t]) for t, tree in trees.items()})
        self.rounds.append({t: compact(tree, self.grower) for t, tree in trees.items()})

    def judge(self) -> None:
        """Held-out losses after each recent round, in one pass."""
        recent, d, unit = self.recent, self.columns, self.grower.objective.unit
        n, k = self.ensembles, self.classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(recent), n, 2), np.int64)
            for block in (x for batch in batches for x in blocks_of(batch, d)):
                for i, margins in enumerate(staged_margins(block, recent, n, k)):
                    for e in range(n if i else 0):
                        held = np.flatnonzero(block["_fold"] == e)
                        p = softmax(margins[e][:, held], 0)[block["_y"][held], np.arange(len(held))]
                        loss = np.rint(-np.log(np.maximum(p, 1e-15)) / (64 * unit))
                        sums[i - 1, e] += int(loss.sum()), len(held)
            for i in range(len(recent)):
                for e in range(n):
                    row = [pa.array([v]) for v in (i, e, *sums[i, e])]
                    yield pa.RecordBatch.from_arrays(row, names=["round", "ensemble", "loss", "n"])

        rows = self.data.mapInArrow(run, "round long, ensemble long, loss long, n long")
        table = {}
        for r in rows.groupBy("round", "ensemble").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).collect():
            table[r["round"], r["ensemble"]] = r["loss"] * 64 * unit / r["n"] if r["n"] else float("nan")
        self.losses += [[table[i, e] for e in range(n)] for i in range(len(recent))]

    def write(self) -> None:
        """Margins with all recent rounds, written to the shared folder."""
        recent, d, old = self.recent, self.columns, self.data
        n, k = self.ensembles, self.classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, block in enumerate(blocks_of(batch, d)):
                    *_, margins = staged_margins(block, recent, n, k)
                    yield pa.RecordBatch.from_arrays([*[c.slice(i, 1) for c in batch.columns[:4]], pa.array([margins.tobytes()], pa.binary())], names=batch.schema.names)

        self.data = cut_lineage(old.mapInArrow(run, old.schema)).persist()
        old.unpersist()
        self.recent = []

    def best_rounds(self) -> int:
        """Rounds with the least mean loss; all of them if nothing was held out."""
        means = [float(np.mean(x)) for x in self.losses]
        return int(np.argmin(means)) + 1 if means and not np.isnan(means).all() else len(self.rounds)

    def stopped(self) -> int | None:
        """Rounds run before patience ended, or None."""
        best, since = np.inf, 0
        for i, losses in enumerate(self.losses):
            mean = float(np.mean(losses))
            best, since = (mean, 0) if mean < best else (best, since + 1)
            if since >= self.options["patience"]:
                return i + 1
        return None

    def run(self, judged: bool) -> None:
        total, done = self.options["rounds"], False
        while len(self.rounds) < total and not done:
            for _ in range(min(ROUNDS_PER_CUT, total - len(self.rounds))):
                self.round()
            if judged:
                self.judge()
                end = self.stopped()
                if end is not None:
                    self.rounds, self.losses, done = self.rounds[:end], self.losses[:end], True
            if len(self.rounds) < total and not done:
                self.write()


class SoftmaxModel(ColumnModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        state, cols = self.fitted(), self.cols()
        walker, classes = Walker(state["trees"]), len(state["labels"])
        rate = state["rate"]

        @F.pandas_udf("array<double>")
        def shares(rows: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in rows:
                x = np.stack([c.to_numpy(float) for c in columns], axis=1)
                whole = ~np.isnan(x).any(axis=1)
                margins = np.zeros((int(whole.sum()), classes))
                for i in range(len(walker.trees)):
                    margins[:, i % classes] += rate * walker.values(i, x[whole])[:, 0]
                yield spread_rows(softmax(margins), whole)

        scored = df.withColumn("probability", shares(*[F.col(c).cast("double") for c in cols]))
        best = F.array_position("probability", F.array_max("probability"))
        names = F.array(*[F.lit(k) for k in state["labels"]])
        return scored.withColumn(self.getOrDefault("predictionCol"), F.when(F.col("probability").isNotNull(), F.element_at(names, best.cast("int"))))

    def rounds(self) -> int:
        return len(self.fitted()["trees"]) // len(self.fitted()["labels"])

    def importances(self) -> dict[str, float]:
        return importances(self.fitted()["trees"], self.cols())


class SoftmaxBoosted(ColumnEstimator):
    """Boosted trees on the softmax log loss, second order, with shares of rows and columns."""

    keyCol = Param(Params._dummy(), "keyCol", "row key of draws", TypeConverters.toString)
    rounds, rate, maxDepth, minChildWeight, subsample, colsample, ridge, leastGain, validation, patience, bins, seed = (
        Param(Params._dummy(), name, doc, TypeConverters.identity) for name, doc in KNOBS.items()
    )

    def __init__(
        self, inputCols=None, labelCol="label", keyCol=None, rounds=100, rate=0.1, maxDepth=4, minChildWeight=1.0, subsample=1.0,
        colsample=1.0, ridge=1.0, leastGain=0.0, validation=0.0, patience=20, bins=MAX_BINS, seed=0,
    ):
        super().__init__()
        self._set(labelCol=labelCol, rounds=rounds, rate=rate, maxDepth=maxDepth, minChildWeight=minChildWeight, subsample=subsample,
                  colsample=colsample, ridge=ridge, leastGain=leastGain, validation=validation, patience=patience, bins=bins, seed=seed)
        if inputCols:
            self._set(inputCols=list(inputCols))
        if keyCol:
            self._set(keyCol=keyCol)

    def boosting(self, df: DataFrame, labels: Sequence, fold: Column, ensembles: int, count: int) -> Boosting:
        """Ensembles before the first round, over complete rows."""
        cols, get = self.cols(), self.getOrDefault
        options = {name: get(name) for name in KNOBS}
        bins = find_bins(df, cols, get("bins"))
        row_id = F.xxhash64(get("keyCol")) if self.isDefined("keyCol") else F.xxhash64(*cols, self.label())
        number = F.array_position(F.array(*[F.lit(k) for k in labels]), F.col(self.label())).cast("int") - 1
        keep = [number.alias("_y"), row_id.alias("_id"), fold.cast("int").alias("_fold")]
        named = df.select(*[F.col(c).alias(f"_c{j}") for j, c in enumerate(cols)], *keep)
        data = with_bins(named, [f"_c{j}" for j in range(len(cols))], bins, ["_y", "_id", "_fold"])
        data = laid_out(data.withColumn("_f", F.lit(b"")), count)
        slopes = Slopes(fixed_point(1.0, count), get("ridge"), get("leastGain"))
        rules = Rules(max_depth=get("maxDepth"), min_weight=float(get("minChildWeight")))
        return Boosting(data, Grower(bins, slopes, rules), ensembles, len(labels), options, [], [], [])

    def _fit(self, df: DataFrame) -> SoftmaxModel:
        rows = complete(df, self.cols(), self.label())
        sizes = class_sizes(rows, self.label())
        labels, share = list(sizes), self.getOrDefault("validation")
        if len(labels) < 2:
            raise ValueError(f"{self.label()} needs two classes, found {labels}")
        fold = F.lit(-1)
        if share > 0:
            held = hashed_below(self.getOrDefault("keyCol"), f"validate{self.getOrDefault('seed')}", share)
            fold = F.when(held, 0).otherwise(-1)
        boost = self.boosting(rows, labels, fold, 1, sum(sizes.values()))
        try:
            boost.run(judged=share > 0)
        finally:
            boost.data.unpersist()
        kept = boost.rounds[: boost.best_rounds()]
        trees = [r[t] for r in kept for t in range(len(labels))]
        return SoftmaxModel.of(self, {"labels": labels, "trees": trees, "rate": self.getOrDefault("rate")})


def rounds_by_cv(
    est: SoftmaxBoosted, df: DataFrame, key: str, label: str = "label", k: int = 5, seed: int = 0, stratified: bool = True
) -> tuple[DataFrame, int]:
    """Held-out log loss after each round, mean and deviation over the folds, and the best number of rounds.

    The folds' ensembles advance in step over one table until the mean has not been better for ``patience`` rounds.
    """
    rows = complete(df, est.cols(), label)
    rows = stratified_kfold(rows, key, label, k, seed, out="_cv") if stratified else kfold(rows, key, k, seed=seed, out="_cv")
    sizes = class_sizes(rows, label)
    boost = est.boosting(rows, list(sizes), F.col("_cv"), k, sum(sizes.values()))
    try:
        boost.run(judged=True)
    finally:
        boost.data.unpersist()
    table = [(i + 1, float(np.mean(x)), float(np.std(x))) for i, x in enumerate(boost.losses)]
    history = df.sparkSession.createDataFrame(table, "round int, test_mean double, test_std double")
    return history, boost.best_rounds()
