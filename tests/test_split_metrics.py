import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import metrics as V
from tabforge.operators import split as S


@pytest.fixture(scope="module")
def keyed(spark):
    """One class holds most of the rows."""
    return spark.range(1000).select(F.col("id").alias("key"), F.when(F.col("id") % 10 < 8, "big").when(F.col("id") % 10 == 8, "mid").otherwise("small").alias("y"))


def by_key(df, c):
    return {r["key"]: r[c] for r in df.collect()}


@pytest.mark.parametrize(
    "make",
    [
        lambda d: S.hash_split(d, "key", 0.3, 1, out="o"),
        lambda d: S.stratified_split(d, "key", "y", 0.3, 1, out="o"),
        lambda d: S.kfold(d, "key", 7, "blocks", out="o"),
        lambda d: S.kfold(d, "key", 7, "hash", out="o"),
        lambda d: S.stratified_kfold(d, "key", "y", 11, out="o"),
        lambda d: S.shuffle(d, "key", 4, out="o"),
    ],
)
def test_does_not_depend_on_partitions(keyed, make):
    a, b = by_key(make(keyed.repartition(1)), "o"), by_key(make(keyed.repartition(8)), "o")
    assert a == b and len(a) == 1000


def test_stratified_split_is_exact(keyed):
    parts = S.stratified_split(keyed, "key", "y", 0.25)
    got = {(r["y"], r["split"]): r["n_rows"] for r in S.split_report(parts, "y").collect()}
    assert got == {("big", "test"): 200, ("big", "train"): 600, ("mid", "test"): 25, ("mid", "train"): 75, ("small", "test"): 25, ("small", "train"): 75}


def test_folds_differ_by_one(keyed):
    blocks = by_key(S.kfold(keyed, "key", 7, "blocks"), "fold")
    assert [blocks[k] for k in sorted(blocks)] == sorted(blocks.values())
    sizes = [list(blocks.values()).count(i) for i in range(7)]
    assert sizes == [143, 143, 143, 143, 143, 143, 142]
    strat = S.stratified_kfold(keyed, "key", "y", 11).groupBy("y", "fold").count().collect()
    for y in ("big", "mid", "small"):
        counts = [r["count"] for r in strat if r["y"] == y]
        assert len(counts) == 11 and max(counts) - min(counts) <= 1


def test_more_folds_than_rows(spark):
    few = by_key(S.kfold(spark.range(3).withColumnRenamed("id", "key"), "key", 5, "blocks"), "fold")
    assert few == {0: 0, 1: 1, 2: 2}


def test_shuffle_is_a_permutation(keyed):
    a = by_key(S.shuffle(keyed, "key", 1), "pos")
    assert sorted(a.values()) == list(range(1000))
    assert a != by_key(S.shuffle(keyed, "key", 2), "pos")


def test_samples_nest(keyed):
    small = {r["key"] for r in S.hash_sample(keyed, "key", 0.1, 3).collect()}
    large = {r["key"] for r in S.hash_sample(keyed, "key", 0.2, 3).collect()}
    assert small < large and S.hash_sample(keyed, "key", 1.0).count() == 1000 and S.hash_sample(keyed, "key", 0.0).count() == 0


@pytest.mark.parametrize("n", [1, 17, 999, 1000, 5000])
def test_cap_rows(keyed, n):
    got = {r["key"] for r in S.cap_rows(keyed, "key", n, 5).collect()}
    order = by_key(S.shuffle(keyed, "key", 5), "pos")
    assert got == {k for k, p in order.items() if p < n}


def test_null_class_is_left_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "key long, y string")
    assert by_key(S.stratified_kfold(df, "key", "y", 2), "fold") == {1: 0}


@pytest.fixture(scope="module")
def scored(spark):
    """Class 3 is never predicted, class 4 never true."""
    data = [(1, 1), (1, 2), (2, 2), (2, 2), (3, 1), (3, 4)]
    return spark.createDataFrame(data, "label int, prediction int")


def test_confusion_has_all_pairs(scored):
    got = {(r["label"], r["prediction"]): r["n"] for r in V.confusion(scored).collect()}
    assert len(got) == 16 and got[2, 2] == 2 and got[3, 3] == 0 and got[4, 4] == 0 and sum(got.values()) == 6


def test_report(scored):
    got = {r["cls"]: r for r in V.class_report(scored).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["support"]) == (0.5, 0.5, 2)
    assert (got["3"]["precision"], got["3"]["recall"], got["3"]["f1"]) == (0.0, 0.0, 0.0)
    assert got["4"]["support"] == 0
    assert math.isclose(got["2"]["f1"], 0.8)
    assert math.isclose(got["macro avg"]["recall"], (0.5 + 1 + 0 + 0) / 4)
    assert math.isclose(got["weighted avg"]["recall"], 0.5)


def auc(truth, score):
    """Area by counting pairs."""
    pos = [s for t, s in zip(truth, score) if t]
    neg = [s for t, s in zip(truth, score) if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_pair_counting(spark):
    data = [(i % 3, (i * 7 // 4) % 3) for i in range(50)]
    df = spark.createDataFrame(data, "label int, prediction int")
    per = [auc([y == c for y, _ in data], [int(p == c) for _, p in data]) for c in range(3)]
    assert math.isclose(V.auc_hard(df, "macro").first()[0], sum(per) / 3)
    truth = [y == c for y, _ in data for c in range(3)]
    score = [int(p == c) for _, p in data for c in range(3)]
    assert math.isclose(V.auc_hard(df, "micro").first()[0], auc(truth, score))


def test_auc_of_two_classes(spark):
    data = [(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)]
    df = spark.createDataFrame(data, "label int, prediction int")
    want = auc([y for y, _ in data], [p for _, p in data])
    assert math.isclose(V.auc_hard(df, "macro").first()[0], want)
    assert math.isclose(V.auc_hard(df, "micro").first()[0], want)


def test_other_metrics(scored, spark):
    assert V.accuracy(scored).first()["accuracy"] == 0.5
    assert math.isclose(V.mae(scored).first()[0], 4 / 6)
    zero = spark.createDataFrame([(0, 1), (2, 1)], "label int, prediction int")
    assert tuple(V.mape_accuracy(zero).first()) == (50.0, 1)
    proba = spark.createDataFrame([("a", 0.5, 0.5), ("b", 1.0, 0.0)], "label string, pa double, pb double")
    want = -(math.log(0.5) + math.log(1e-15)) / 2
    assert math.isclose(V.log_loss(proba, {"a": "pa", "b": "pb"}).first()[0], want)


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "label int, prediction int")
    assert V.accuracy(empty).first()["accuracy"] is None
    assert V.confusion(empty).count() == 0
    assert V.auc_hard(empty).first()[0] is None
