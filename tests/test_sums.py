"""Models that are sums: folds by subtraction and thousands of groups, against separate fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.models import moments
from tabforge.models.bayes import GaussianNB
from tabforge.models.discriminant import Lda, Qda
from tabforge.models.learner import decision_tree
from tabforge.plans import ensemble, tune
from tabforge.plans.folds import FoldModels
from tabforge.runtime import cut_lineage

COLS = ["a", "b"]


def rows(spark, n=600, groups=1, seed=4):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    x = rng.normal(size=(n, 2)) + np.stack([y, -2 * y], axis=1)
    g = rng.integers(0, groups, n)
    data = [(i, int(g[i]), float(x[i, 0]), float(x[i, 1]), "uvw"[y[i]]) for i in range(n)]
    data += [(n, 0, None, 1.0, "u"), (n + 1, 0, float("nan"), 1.0, "v"), (n + 2, 0, 1.0, 1.0, None), (n + 3, None, 1.0, 1.0, "w")]
    return spark.createDataFrame(data, "key long, g int, a double, b double, label string").repartition(4)


def close(a, b):
    return a.keys() == b.keys() and all((a[k] is None) == (b[k] is None) and (a[k] is None or np.allclose(a[k], b[k], atol=1e-9)) for k in a)


@pytest.mark.parametrize("est", [GaussianNB(COLS), Lda(COLS), Qda(COLS)])
def test_fold_models_are_those_of_refits(spark, est):
    df = rows(spark).withColumn("_fold", F.pmod("key", F.lit(4)).cast("int"))
    df = df.withColumn("_fold", F.when(F.col("label") == "w", 1).otherwise(F.col("_fold"))).cache()  # without fold 1 no class w
    sums = FoldModels([est], df, "label", 4)
    found = {r.key: (r["_p0"], r["_p0_prob"]) for r in sums.scored(df, ["u", "v", "w"]).collect()}
    for f in range(4):
        model = est.fit(df.where(F.col("_fold") != f))
        kept = model.fitted()["labels"]
        want = {r.key: (r.prediction, r.probability) for r in model.transform(df.where((F.col("_fold") == f) & ~F.isnan("a"))).collect()}
        for key, (label, shares) in want.items():
            assert found[key][0] == label
            if shares and shares[0] is not None:
                assert np.allclose([found[key][1]["uvw".index(k)] for k in kept], shares, atol=1e-9)
                assert abs(sum(found[key][1]) - 1) < 1e-9
    whole, refit = sums.models()[0].fitted(), est.fit(df).fitted()
    assert whole.keys() == refit.keys() and np.allclose(whole["const"] if "const" in whole else whole["prior"], refit["const"] if "const" in refit else refit["prior"])


def jobs_of(spark, name, action):
    """Spark jobs that an action starts."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_one_scan_for_fits_and_one_for_scores(spark):
    """Jobs do not grow with folds and candidates; the out-of-fold table is a projection of one scan."""
    df = rows(spark).where("label IS NOT NULL").withColumn("_fold", F.pmod("key", F.lit(5)).cast("int"))
    data = cut_lineage(df)
    counts = []
    for k, bases in ((2, [GaussianNB(COLS)]), (5, [GaussianNB(COLS), Lda(COLS), GaussianNB(["a"])])):
        (wide, names, per_fold), n = jobs_of(spark, f"k{k}", lambda: ensemble.oof_table(bases, data, "label", k, ["u", "v", "w"], True))
        counts.append(n)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan ExistingRDD") == 1 and "Union" not in plan and "Exchange" not in plan
        assert len(names) == 3 * len(bases) and len(per_fold) == k
    assert counts[0] == counts[1]


@pytest.mark.parametrize("metric", ["accuracy", "error", "log_loss"])
def test_cv_scores_are_those_of_refits(spark, monkeypatch, metric):
    est = GaussianNB(COLS)
    df, grid, labels = rows(spark), tune.param_grid({est.smoothing: [1e-9, 0.3]}), ["u", "v", "w"]
    df = df.where("NOT isnan(a)")
    fast = {(r.candidate, r.fold): r.score for r in tune.cv_scores(est, df, grid, "key", "label", 3, metric, labels=labels).collect()}
    monkeypatch.setattr(tune, "ONE_AGGREGATE", set())
    slow = {(r.candidate, r.fold): r.score for r in tune.cv_scores(est, df, grid, "key", "label", 3, metric, labels=labels).collect()}
    assert close(fast, slow)


@pytest.mark.parametrize("est", [GaussianNB(["a", "b", "flat"]), Qda(["a", "b", "flat"])])
@pytest.mark.parametrize("small", [0, 64 << 20])
def test_group_table_is_that_of_single_fits(spark, monkeypatch, est, small):
    """Each group's own columns and model, broadcast or joined; unknown and missing groups keep nulls."""
    monkeypatch.setattr(moments, "BROADCAST_BYTES", small)
    df = rows(spark, 900, 3).withColumn("flat", F.when(F.col("g") == 1, F.col("key") % 7).otherwise(1.0).cast("double")).cache()
    model = ensemble.per_group_fit(lambda cols: est.copy({est.inputCols: cols}), df, "g", ["a", "b", "flat"], min_variance=0.3)
    more = df.unionByName(df.where("g = 0").withColumn("g", F.lit(77)))
    out = model.transform(more).where("NOT isnan(a)").collect()
    for g in range(3):
        cols = ["a", "b", "flat"] if g == 1 else ["a", "b"]
        one = est.copy({est.inputCols: cols}).fit(df.where(F.col("g") == g)).transform(df.where((F.col("g") == g) & ~F.isnan("a")))
        want = {r.key: r for r in one.collect()}
        mine = {r.key: r for r in out if r.g == g}
        assert mine.keys() == want.keys() and all(mine[k].prediction == want[k].prediction for k in want)
        whole = [k for k in want if want[k].a is not None]
        assert np.allclose([mine[k].probability for k in whole], [want[k].probability for k in whole], atol=1e-9)
    assert all(r.prediction is None for r in out if r.g in (None, 77)) and len(out) > 900


def test_thousands_of_groups(spark):
    """5,000 groups: as many jobs as three need, and each group's mean is its own."""
    counts = []
    for groups in (3, 5000):
        df = spark.range(groups * 8).select(
            F.col("id").alias("key"), F.pmod("id", F.lit(groups)).alias("g"),
            (F.pmod("id", F.lit(groups)) * 10.0 + F.floor(F.col("id") / groups)).alias("a"),
            F.when(F.floor(F.col("id") / groups) < 4, "lo").otherwise("hi").alias("label"),
        )
        model, n = jobs_of(spark, f"groups{groups}", lambda: ensemble.per_group_fit(GaussianNB, df, "g", ["a"]))
        counts.append(n)
        hits = model.transform(df).where("prediction = label").count()
        assert hits == 8 * groups
    assert counts[0] == counts[1]


def test_group_folds(spark):
    """Out-of-fold shares by group against single fits; a group without a class gives it 0."""
    df = rows(spark, 500, 2).where("NOT isnan(a) AND a IS NOT NULL AND NOT (coalesce(g, 0) = 1 AND label = 'w')").cache()
    inner, outer = ensemble.per_group_oof(GaussianNB, df, df, "g", "key", "label", COLS, 3, seed=5)
    found = {r.key: (r.p_u, r.p_v, r.p_w) for r in inner.collect()}
    mean = {r.key: (r.p_u, r.p_v, r.p_w) for r in outer.collect()}
    for g, labels in ((0, "uvw"), (1, "uv")):
        one = df.where((F.col("g") == g) & F.col("label").isNotNull())
        folds = tune.folded(one, "key", "label", 3, 5).cache()
        want, sums = {}, {}
        for f in range(3):
            model = GaussianNB(COLS).fit(folds.where(F.col("_fold") != f))
            for r in model.transform(folds).collect():
                shares = [*r.probability] + [0.0] * (3 - len(labels))
                sums[r.key] = sums.get(r.key, 0) + np.array(shares) / 3
                if r["_fold"] == f:
                    want[r.key] = shares
        assert all(np.allclose(found[k], want[k], atol=1e-9) and np.allclose(mean[k], sums[k], atol=1e-9) for k in want)
    lost = [r.key for r in df.where("g IS NULL").collect()]
    assert lost and all(found[k] == (None,) * 3 == mean[k] for k in lost)


def test_other_estimators_go_group_by_group(spark):
    df = rows(spark, 200, 2).where("NOT isnan(a) AND a IS NOT NULL")
    model = ensemble.per_group_fit(lambda cols: decision_tree(cols, max_depth=2), df, "g", COLS)
    assert isinstance(model, ensemble.PerGroupModel) and model.transform(df).count() == df.count()
