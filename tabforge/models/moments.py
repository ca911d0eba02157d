"""Models that are sums over rows: sizes, means and (co)variances per class add up over any parts of the data.

One aggregate by (part, class) serves every model over those parts: without one fold, for one group, or for all. Gaussian
naive Bayes needs variances, discriminants covariances; ``state_of`` of the estimators turns merged moments into a model.

Rows without label or with a missing feature (NaN counted) are left out. A class that is missing from a part has no moments
there, and probability 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.models.bayes import GaussianNB, GaussianNBModel
from tabforge.models.discriminant import Lda, LdaModel, Qda, QdaModel
from tabforge.models.saving import TableReader, TableWriter
from tabforge.runtime import cut_lineage

MODELS = {GaussianNB: GaussianNBModel, Lda: LdaModel, Qda: QdaModel}
BROADCAST_BYTES = 64 << 20


def is_sum(est) -> bool:
    """Whether an estimator's model follows from moments."""
    return type(est) in MODELS


@dataclass(frozen=True)
class Needs:
    """Columns of an estimator, and whether it looks at pairs of them."""

    cols: tuple[str, ...]
    pairs: bool

    @classmethod
    def of(cls, est) -> Needs:
        return cls(tuple(est.cols()), not isinstance(est, GaussianNB))

    def places(self) -> list[tuple[int, int]]:
        d = len(self.cols)
        return [(i, j) for i in range(d) for j in range(i, d)] if self.pairs else [(i, i) for i in range(d)]

    def aggregates(self, prefix: str) -> list[Column]:
        """Rows, means and second moments of the rows that are whole in these columns."""
        x = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in self.cols]
        whole = x[0].isNotNull()
        for c in x[1:]:
            whole = whole & c.isNotNull()
        x = [F.when(whole, c) for c in x]
        second = [F.var_pop(x[i]) if i == j else F.covar_pop(x[i], x[j]) for i, j in self.places()]
        return [
            F.count_if(whole).alias(f"{prefix}n"),
            F.array(*[F.avg(c) for c in x]).alias(f"{prefix}m"),
            F.array(*second).alias(f"{prefix}c"),
        ]

    def moments(self, label, n: int, m: Sequence[float], c: Sequence[float]) -> tuple | None:
        """(label, rows, mean, variances or covariance), None without rows."""
        if not n:
            return None
        if not self.pairs:
            return label, n, np.array(m), np.array(c)
        cov = np.zeros((len(m), len(m)))
        for (i, j), v in zip(self.places(), c):
            cov[i, j] = cov[j, i] = v
        return label, n, np.array(m), cov


def merged(parts: Sequence[tuple]) -> list[tuple]:
    """Moments of each class over several parts, labels ascending."""
    by_label: dict = {}
    for part in parts:
        by_label.setdefault(part[0], []).append(part)
    out = []
    for label in sorted(by_label):
        own = by_label[label]
        n = sum(p[1] for p in own)
        mean = sum(p[1] * p[2] for p in own) / n
        second = 0
        for _, rows, m, c in own:
            shift = m - mean
            second = second + rows * (c + (np.outer(shift, shift) if c.ndim == 2 else shift * shift))
        out.append((label, n, mean, second / n))
    return out


# ---------------------------------------------------------------- many groups


def _parameters(est, moments: list[tuple], used: np.ndarray) -> dict:
    """A model as scores ``const - |root (x - mean)|^2 / 2``, with zeros for the columns that are not used."""
    d = len(used)
    at = np.flatnonzero(used)
    own = [(k, n, m[at], c[np.ix_(at, at)] if c.ndim == 2 else c[at]) for k, n, m, c in moments]
    state = est.state_of(own)
    means, roots = np.zeros((len(own), d)), []
    means[:, at] = state["mean"]
    if isinstance(est, Qda):
        consts = state["const"]
        for root in state["root"]:
            wide = np.zeros((d, d))
            wide[np.ix_(at, at)] = root
            roots.append(wide.ravel())
    else:
        var = np.array(state["var"])
        consts = np.log(state["prior"]) - 0.5 * np.log(2 * np.pi * var).sum(axis=1)
        for v in var:
            wide = np.zeros(d)
            wide[at] = 1 / np.sqrt(v)
            roots.append(wide)
    return {
        "labels": state["labels"],
        "const": [float(c) for c in consts],
        "mean": means.tolist(),
        "root": [r.tolist() for r in roots],
    }


def group_table(est, df: DataFrame, group: str, min_variance: float | None, fold: str | None = None, k: int = 1) -> DataFrame:
    """One row per group: ``_used`` columns and ``_models``, one per fold (without its rows), or one for all rows.

    One aggregate by (group, fold, class); its rows, not the data, are gathered by group and solved in the tasks.
    """
    needs, label = Needs.of(est), est.label()
    if not isinstance(est, (GaussianNB, Qda)):
        raise ValueError("only naive Bayes and quadratic discriminants are fitted by group")
    known = df.where(F.col(label).isNotNull() & F.col(group).isNotNull())
    by = [F.col(group).alias("_group"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("_part"), F.col(label).alias("_label")]
    stats = known.groupBy(*by).agg(*needs.aggregates("_")).where("_n > 0")
    one = T.StructType(
        [
            T.StructField("labels", T.ArrayType(df.schema[label].dataType)),
            T.StructField("const", T.ArrayType(T.DoubleType())),
            T.StructField("mean", T.ArrayType(T.ArrayType(T.DoubleType()))),
            T.StructField("root", T.ArrayType(T.ArrayType(T.DoubleType()))),
        ]
    )
    schema = T.StructType(
        [
            T.StructField("_group", df.schema[group].dataType),
            T.StructField("_used", T.ArrayType(T.BooleanType())),
            T.StructField("_models", T.ArrayType(one)),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def solve(table: pa.Table) -> pa.Table:
        rows = [(r["_part"], needs.moments(r["_label"], r["_n"], r["_m"], r["_c"])) for r in table.to_pylist()]
        whole = merged([m for _, m in rows])
        n = sum(m[1] for m in whole)
        mean = sum(m[1] * m[2] for m in whole) / n
        spread = sum(m[1] * ((np.diag(m[3]) if m[3].ndim == 2 else m[3]) + (m[2] - mean) ** 2) for m in whole) / n
        used = spread > min_variance if min_variance is not None else np.ones(len(mean), bool)
        models = []
        for f in range(k if fold else 1):
            own = merged([m for part, m in rows if part != f]) if fold else whole
            models.append(_parameters(est, own, used) if used.any() and own else None)
        row = {"_group": table["_group"][0].as_py(), "_used": used.tolist(), "_models": models}
        return pa.Table.from_pylist([row], schema=arrow)

    solved = cut_lineage(stats.groupBy("_group").applyInArrow(solve, schema))
    dull = solved.where(~F.exists("_used", lambda u: u)).limit(1).collect()
    if dull:
        raise ValueError(f"no column varies in the group {dull[0]['_group']}")
    return solved


def class_shares(model: Column, used: Column, cols: Sequence[str], pairs: bool) -> Column:
    """Probabilities of a row under the model of its group, in the order of the model's labels; null if a used cell is missing."""
    d = len(cols)
    x = F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols])
    x = F.zip_with(x, used, lambda v, u: F.when(u, v).otherwise(F.lit(0.0)))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    def distance(c):
        diff = F.zip_with(x, F.get(model["mean"], c), lambda v, m: v - m)
        root = F.get(model["root"], c)
        if not pairs:
            return total(F.zip_with(diff, root, lambda a, b: a * b * a * b))
        rows = F.sequence(F.lit(0), F.lit(d - 1))

        def along(diff):
            z = F.transform(rows, lambda i: total(F.zip_with(diff, F.slice(root, i * d + 1, F.lit(d)), lambda a, b: a * b)))
            return total(F.transform(z, lambda v: v * v))

        return F.get(F.transform(F.array(diff), along), 0)

    at = F.sequence(F.lit(0), F.size(model["labels"]) - 1)
    scores = F.transform(at, lambda c: F.get(model["const"], c) - 0.5 * distance(c))
    return F.get(F.transform(F.array(scores), _softmax), 0)


def _softmax(scores: Column) -> Column:
    parts = F.get(F.transform(F.array(F.array_max(scores)), lambda top: F.transform(scores, lambda s: F.exp(s - top))), 0)

    def shares(p):
        return F.get(F.transform(F.array(F.aggregate(p, F.lit(0.0), lambda a, v: a + v)), lambda t: F.transform(p, lambda v: v / t)), 0)

    return F.get(F.transform(F.array(parts), shares), 0)


def with_group_models(df: DataFrame, table: DataFrame, group: str) -> DataFrame:
    """``df`` with ``_used`` and ``_models`` of its group, null where no model knows the group.

    The table is broadcast if its numbers are counted to fit BROADCAST_BYTES; else both sides meet in a join that Spark
    splits when a group is much larger than others.
    """
    numbers = table.agg(F.sum(F.aggregate("_models", F.lit(0), lambda a, m: a + F.size(F.flatten(m["root"])) + F.size(F.flatten(m["mean"]))))).first()[0]
    small = 8 * (numbers or 0) <= BROADCAST_BYTES
    return df.join(F.broadcast(table) if small else table, F.col(group) == F.col("_group"), "left").drop("_group")


class GroupTableModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A table of models, one row per group, joined to the rows it scores.

    Rows of a group that no model knows, or without a group, keep a null prediction.
    """

    group = Param(Params._dummy(), "group", "group column", TypeConverters.toString)
    cols = Param(Params._dummy(), "cols", "feature columns", TypeConverters.toListString)
    pairs = Param(Params._dummy(), "pairs", "whether columns are looked at in pairs", TypeConverters.toBoolean)

    def __init__(self, table: DataFrame | None = None, group: str = "", cols: Sequence[str] = (), pairs: bool = False):
        super().__init__()
        self._set(group=group, cols=list(cols), pairs=pairs)
        self.train = table

    def write(self):
        return TableWriter(self)

    @classmethod
    def read(cls):
        return TableReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        joined = with_group_models(df, self.train, get("group"))
        model = F.get("_models", 0)
        scored = joined.withColumn("probability", class_shares(model, F.col("_used"), get("cols"), get("pairs")))
        best = F.array_position("probability", F.array_max("probability"))
        label = F.when(F.col("probability").isNotNull(), F.get(model["labels"], best.cast("int") - 1))
        return scored.withColumn("prediction", label).drop("_models", "_used")


def fit_by_group(est, df: DataFrame, group: str, min_variance: float | None = None) -> GroupTableModel:
    """One model per group, however many, each on the columns that vary within its group."""
    return GroupTableModel(group_table(est, df, group, min_variance), group, est.cols(), isinstance(est, Qda))
