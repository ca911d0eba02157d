"""The level-wise grower against a plain recursion; boosting and its rounds against refits; layouts and limits."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabforge.models import softmax as S
from tabforge.models import trees as G
from tabforge.models.boost import Boosted
from tabforge.models.forest import ForestClassifier, ForestModel, ForestRegressor, bagged_forest, extra_forest
from tabforge.models.softmax import SoftmaxBoosted, SoftmaxModel, rounds_by_cv
from tabforge.plans import tune

COLS = ["a", "b", "c"]


def made(spark, n=3000, seed=1, noise=0.15):
    """Few values in ``a``, a few hundred in ``b``, any in ``c``; three classes with noise; some gaps."""
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 7, n), rng.integers(0, 300, n) / 4, rng.normal(size=n)
    y = (2 * (a > 3) + (b + 20 * c > 40) + (rng.random(n) < noise)) % 3
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), "xyz"[int(y[i])], float(b[i] * (a[i] > 2) + c[i])) for i in range(n)]
    gaps = [(n, None, 1.0, 1.0, "x", 1.0), (n + 1, 1.0, float("nan"), 1.0, "y", 1.0), (n + 2, 1.0, 1.0, 1.0, None, None)]
    return spark.createDataFrame(rows + gaps, "key long, a double, b double, c double, label string, y double").repartition(5)


def table(df):
    rows = sorted((r for r in df.collect() if r.key < 3000), key=lambda r: r.key)
    return np.array([[r.a, r.b, r.c] for r in rows]), np.array(["xyz".index(r.label) for r in rows]), np.array([r.y for r in rows])


def squares(y):
    return sum(float((y == k).sum()) ** 2 for k in range(3)) / len(y)


def grown(x, y, depth, min_leaf=1, min_split=2):
    """A nested tree by comparing all cuts between neighbouring values."""
    best = None
    if depth and len(y) >= min_split and len(set(y)) > 1:
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for lo, hi in zip(values, values[1:]):
                left = x[:, j] <= lo
                if min(left.sum(), (~left).sum()) >= min_leaf:
                    score = squares(y[left]) + squares(y[~left])
                    if best is None or score > best[0]:
                        best = (score, j, (lo + hi) / 2, left)
    if best is None:
        return np.bincount(y, minlength=3) / len(y)
    _, j, cut, left = best
    return j, cut, grown(x[left], y[left], depth - 1, min_leaf, min_split), grown(x[~left], y[~left], depth - 1, min_leaf, min_split)


def nested(tree, node=0):
    if tree["feature"][node] < 0:
        return np.array(tree["value"][node])
    sides = (nested(tree, tree[s][node]) for s in ("left", "right"))
    return (tree["feature"][node], tree["threshold"][node], *sides)


def same(a, b):
    if isinstance(a, np.ndarray):
        return isinstance(b, np.ndarray) and np.allclose(a, b)
    return not isinstance(b, np.ndarray) and a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("small", [0, 200, 10**6])
def test_tree_is_that_of_all_cuts(spark, monkeypatch, small):
    """The same tree whether nodes are split by levels, finished in groups, or both; several passes a level."""
    monkeypatch.setattr(G, "SMALL_NODE", small)
    monkeypatch.setattr(G, "HISTOGRAM_BYTES", 3 * 8 * 3 * 300 * 8)
    df = made(spark).withColumn("c", F.round("c", 1))
    x, y, _ = table(df)
    x = np.column_stack([x[:, 0], np.round(x[:, 1] / 3), x[:, 2]])
    df = df.withColumn("b", F.rint(F.col("b") / 3))
    for depth, leaf, split in ((6, 5, 2), (None if small else 7, 1, 40)):
        model = ForestClassifier(COLS, maxDepth=depth, minLeaf=leaf, minSplit=split).fit(df)
        assert same(grown(x, y, 99 if depth is None else depth, leaf, split), nested(model.fitted()["trees"][0]))


def test_predictions_gaps_and_saving(spark, tmp_path):
    df = made(spark)
    model = ForestClassifier(COLS, maxDepth=4).fit(df)
    out = {r.key: r for r in model.transform(df).collect()}
    assert out[3000].prediction is None and out[3001].prediction is None and out[3002].prediction in "xyz"
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in out.values() if r.probability)
    assert np.mean([r.label == r.prediction for k, r in out.items() if k < 3000]) > 0.75
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(again, ForestModel) and again.fitted() == model.fitted()
    assert abs(sum(model.importances().values()) - 1) < 1e-9
    with pytest.raises(ValueError):
        ForestClassifier(COLS).fit(df.where("label = 'x'"))


def test_limits(spark):
    df = made(spark)
    n = 3000

    def sizes(tree, rows=None):
        x, y, _ = table(df)
        router = [np.array(tree[k]) for k in ("feature", "threshold", "left", "right")]
        node = np.zeros(n, int)
        for _ in range(60):
            f = router[0][node]
            node = np.where(f < 0, node, np.where(x[np.arange(n), np.maximum(f, 0)] <= router[1][node], router[2][node], router[3][node]))
        return np.bincount(node)[np.array(tree["feature"]) < 0]

    for given, least in ((50, 50), (0.1, 300)):
        tree = ForestClassifier(COLS, minLeaf=given).fit(df).fitted()["trees"][0]
        assert sizes(tree).min() >= least and sizes(tree).sum() == n
    assert sizes(ForestClassifier(COLS, minWeightShare=0.2).fit(df).fitted()["trees"][0]).min() >= 600
    assert ForestClassifier(COLS, minSplit=1.0, maxDepth=3).fit(df).leaves()[0] == 2
    whole = ForestClassifier(COLS, minLeaf=20).fit(df)
    for leaves in (2, 9):
        model = ForestClassifier(COLS, minLeaf=20, maxLeaves=leaves).fit(df)
        assert model.leaves() == [leaves] and leaves < whole.leaves()[0]
        gains = sorted((g for f, g in zip(model.fitted()["trees"][0]["feature"], model.fitted()["trees"][0]["gain"]) if f >= 0), reverse=True)
        # No split that the limit left out gains more than the last one made, unless it lies below one that was left out.
        full = whole.fitted()["trees"][0]
        frontier, taken = [(-full["gain"][0], 0)], []
        while len(taken) < leaves - 1:
            frontier.sort()
            g, node = frontier.pop(0)
            taken.append(-g)
            frontier += [(-full["gain"][c], c) for c in (full["left"][node], full["right"][node]) if full["feature"][c] >= 0]
        assert np.allclose(sorted(taken, reverse=True), gains)
    few = ForestClassifier(COLS, minGain=0.02).fit(df).fitted()["trees"][0]
    assert all(g >= 0.02 * n - 1e-6 for f, g in zip(few["feature"], few["gain"]) if f >= 0)


@pytest.mark.parametrize("make", [
    lambda: ForestClassifier(COLS, maxDepth=8),
    lambda: bagged_forest(COLS, key="key", trees=3),
    lambda: extra_forest(COLS, trees=3),
    lambda: ForestRegressor(COLS, "y", keyCol="key", trees=2, bootstrap=True, maxDepth=6),
    lambda: SoftmaxBoosted(COLS, keyCol="key", rounds=3, maxDepth=3, subsample=0.7, colsample=0.7),
])
def test_layout_does_not_matter(spark, make):
    df = made(spark)
    one, other = (make().fit(d).fitted()["trees"] for d in (df.repartition(2), df.orderBy("c").repartition(9, "b")))
    assert one == other


def test_forests(spark):
    """Samples and columns differ between trees; drawn cuts lie inside the node; sampling weights have mean 1."""
    df = made(spark)
    model = bagged_forest(COLS, key="key", trees=20).fit(df)
    trees = model.fitted()["trees"]
    assert len(trees) == 20 and len({str(t["threshold"]) for t in trees}) == 20
    assert {t["feature"][0] for t in trees} == {0, 1, 2}
    x, y, _ = table(df)
    hit = model.transform(df).where("label = prediction AND key < 3000").count() / 3000
    assert hit > 0.9
    extra = extra_forest(COLS, trees=5, max_features="all").fit(df).fitted()["trees"]
    assert all(x[:, t["feature"][0]].min() <= t["threshold"][0] < x[:, t["feature"][0]].max() for t in extra)
    assert len({t["threshold"][0] for t in extra}) > 1
    weights = G.bootstrap_weights(5, np.arange(100_000))
    assert abs(weights.mean() - 1) < 0.02 and abs((weights == 0).mean() - np.exp(-1)) < 0.01


def test_regression_forest(spark):
    df = made(spark)
    x, _, y = table(df)
    tree = ForestRegressor(COLS, "y", maxDepth=1).fit(df).fitted()["trees"][0]
    best = None
    for j in range(2):
        for v in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= v
            score = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum()
            best = max(best or (0,), (score, j, y[left].mean(), y[~left].mean()))
    assert tree["feature"][0] == best[1]
    assert np.allclose([tree["value"][tree[s][0]][0] for s in ("left", "right")], best[2:], atol=1e-6)
    rows = df.where("key < 3000").select("key", *COLS, F.col("y").alias("label"))
    est = ForestRegressor(COLS, keyCol="key", trees=8, bootstrap=True, maxFeatures=2, minLeaf=3)
    scores = tune.cross_val(est, rows, "key", "label", 3, metric="mae", stratified=False)
    middle = np.abs(y - np.median(y)).mean()
    assert scores.count() == 3 and max(r.score for r in scores.collect()) < middle / 4
    one = ForestRegressor(COLS, "y").fit(df.where("key = 5"))
    assert one.transform(df.where("key = 6")).first().prediction == pytest.approx(y[5])


def test_bins(spark):
    df = spark.createDataFrame([(float(i % 9), float(i)) for i in range(2000)], "u double, v double").repartition(7)
    bins = G.find_bins(df, ["u", "v"], 20)
    assert bins.uppers[0] == [float(i) for i in range(9)] and bins.exact == [True, False]
    codes = bins.codes([np.array([0.0, 8.0, 99.0]), np.array([-5.0, 1000.0, 1e9])])
    assert codes[:, 0].tolist() == [0, 8, 8] and codes[0, 1] == 0 and codes[2, 1] == len(bins.uppers[1]) - 1
    counts = np.bincount(bins.codes([np.zeros(2000), np.arange(2000.0)])[:, 1])
    assert counts.min() >= 99 and counts.max() <= 101
    with pytest.raises(ValueError):
        G.find_bins(df, ["u"], 300)


def plain_boost(x, y, rounds, rate):
    """Stumps on the softmax loss, by comparing all cuts of the first two columns."""
    margins = np.zeros((len(y), 3))
    losses = []
    for _ in range(rounds):
        p, steps = S.softmax(margins), np.zeros_like(margins)
        for k in range(3):
            g, h = p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k])
            best = None
            for j in range(x.shape[1]):
                for v in np.unique(x[:, j])[:-1]:
                    left = x[:, j] <= v
                    if min(h[left].sum(), h[~left].sum()) >= 1:
                        score = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
                        if best is None or score > best[0] + 1e-9:
                            best = (score, left)
            for s in (best[1], ~best[1]):
                steps[s, k] = -rate * g[s].sum() / (h[s].sum() + 1)
        margins += steps
        losses.append(float(-np.log(S.softmax(margins)[np.arange(len(y)), y]).mean()))
    return S.softmax(margins), losses


def test_boosting_is_that_of_all_cuts(spark, monkeypatch):
    """Also when margins are written between the rounds."""
    monkeypatch.setattr(S, "ROUNDS_PER_CUT", 2)
    df = made(spark).withColumn("b", F.rint(F.col("b") / 5))
    x, y, _ = table(df)
    model = SoftmaxBoosted(["a", "b"], keyCol="key", rounds=5, rate=0.5, maxDepth=1).fit(df)
    assert model.rounds() == 5
    out = {r.key: r.probability for r in model.transform(df).collect()}
    want, _ = plain_boost(x[:, :2], y, 5, 0.5)
    assert np.allclose([out[i] for i in range(3000)], want, atol=1e-6)
    assert out[3000] is None and out[3001] is None


def test_softmax_beats_one_model_a_class(spark):
    df = made(spark, noise=0).where("key < 3000")
    train, test = df.where("key % 3 > 0").cache(), df.where("key % 3 = 0").cache()
    one = SoftmaxBoosted(COLS, keyCol="key", rounds=20, rate=0.3, maxDepth=3).fit(train).transform(test)
    many = Boosted(COLS, keyCol="key", rounds=20, rate=0.3, maxDepth=3).fit(train).transform(test)
    losses = [tune.score(d, "log_loss", "label", ["x", "y", "z"]) for d in (one, many)]
    assert losses[0] < losses[1]


def test_rounds_by_cv_are_those_of_refits(spark):
    """The staged loss of each fold is that of a model of so many rounds fitted without the fold."""
    df = made(spark, 900).where("key < 900").withColumns({"b": F.rint("b"), "c": F.round("c", 1)})
    est = SoftmaxBoosted(COLS, keyCol="key", rounds=40, rate=1.0, maxDepth=3, patience=3)
    history, best = rounds_by_cv(est, df, "key", k=3, seed=2)
    rows = history.orderBy("round").collect()
    means = [r.test_mean for r in rows]
    assert best == int(np.argmin(means)) + 1 and len(means) == best + 3 < 40
    folds = tune.folded(df, "key", "label", 3, 2).cache()
    for rounds in (1, best):
        losses = []
        for f in range(3):
            model = est.copy({est.rounds: rounds}).fit(folds.where(F.col("_fold") != f))
            losses.append(tune.score(model.transform(folds.where(F.col("_fold") == f)), "log_loss", "label", ["x", "y", "z"]))
        assert means[rounds - 1] == pytest.approx(np.mean(losses), abs=1e-4)
        assert rows[rounds - 1].test_std == pytest.approx(np.std(losses), abs=1e-4)


def test_boosting_stops_and_saves(spark, tmp_path):
    df = made(spark, 900).where("key < 900")
    model = SoftmaxBoosted(COLS, keyCol="key", rounds=60, rate=1.0, validation=0.3, patience=3).fit(df)
    assert 1 <= model.rounds() < 57
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(again, SoftmaxModel) and again.fitted() == model.fitted()


def test_short_routes_end_where_long_ones_do():
    """Bit tables of small trees against walking from node to node."""
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 255, (4, 5000)).astype(np.uint8)
    for leaves in (1, 2, 7, 64, 65):
        tree, open_ = G.Tree(1), [0]
        tree.add(np.zeros(3, np.int64), 0, 1)
        while len(open_) < leaves:
            node = open_.pop(int(rng.integers(len(open_))))
            open_ += tree.split(node, (1.0, int(rng.integers(4)), int(rng.integers(255)), 0.5, np.zeros(3, np.int64)))
        router = tree.router()
        assert (router.tables is None) == (leaves > 64)
        got, router.tables = G.routed(router, codes), None
        assert (got == G.routed(router, codes)).all()


def test_sums_are_exact_whatever_their_size():
    rng = np.random.default_rng(4)
    codes, slots = rng.integers(0, 9, (2, 4000)).astype(np.uint8), rng.integers(0, 3, 4000)
    for top in (1, 2**12, 2**20, 2**38, 2**46, 2**60):
        stats = np.stack([rng.integers(-top, top, 4000) // (4000 if top > 2**50 else 1), rng.integers(0, 2, 4000), np.ones(4000, np.int64)], axis=1)
        want = np.zeros((3, 2, 9, 3), np.int64)
        for j in range(2):
            np.add.at(want[:, j], (slots, codes[j]), stats)
        assert (G.histograms(codes, slots, stats, 3, 9) == want).all()


@pytest.mark.parametrize("driver", [0, 1 << 25])
def test_fit_starts_few_jobs(spark, monkeypatch, driver):
    """The jobs of a fit do not grow with the rows; the trees are the same wherever nodes are judged."""
    monkeypatch.setattr("tabforge.operators.ranking.ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(G, "DRIVER_BYTES", driver)
    monkeypatch.setattr(G, "SMALL_NODE", 500)
    df, sc = made(spark).cache(), spark.sparkContext
    sc.setJobGroup(f"bins{driver}", "")
    bins = G.find_bins(df.dropna().where("not isnan(b)"), COLS)
    sc.setJobGroup(f"rest{driver}", "")
    assert not bins.exact[2] and len(sc.statusTracker().getJobIdsForGroup(f"bins{driver}")) < 30
    trees = extra_forest(COLS, trees=3, minLeaf=3).fit(df).fitted()["trees"]
    assert trees == _fits.setdefault("trees", trees)


_fits: dict = {}
