import math

import pytest
from pyspark.sql import functions as F

from tabforge.functions import encode as E
from tabforge.functions import rowmath as M
from tabforge.operators import encoders as EN
from tabforge.sources.io import soil_table


def one(df, *cols):
    return tuple(df.select(*cols).first())


@pytest.fixture(scope="module")
def row(spark):
    return spark.createDataFrame([(3.0, 4.0, None, -7.0)], "a double, b double, n double, m double")


def test_null_rules(row):
    got = one(row, M.row_sum(["a", "n"]), M.row_mean(["a", "n"]), M.row_mean(["n"]), M.row_sum(["n"]), M.row_norm(["a", "b"]), M.row_norm(["a", "n"]))
    assert got == (3.0, 3.0, None, 0.0, 5.0, None)


def test_small_formulas(row):
    assert one(row, M.bin_floor("m", 2), M.row_max(["a", "n"]), M.row_min(["a", "m"])) == (-4, 3.0, -7.0)
    assert one(row, M.safe_ratio("a", "b"), M.safe_ratio("a", F.lit(-1.0))) == (0.6, None)
    assert one(row, M.weighted_sum({"a": 2.0, "n": 5.0}))[0] == 6.0
    assert math.isclose(one(row, M.cos_deg(F.lit(60.0)))[0], 0.5)
    assert math.isclose(one(row, M.cos_deg(F.lit(30.0), 90.0))[0], 0.5)
    assert one(row, M.log_or_null("m")) == (None,)


def test_zero_rows(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 4.0)], "a double, b double")
    unit = M.row_normalize(["a", "b"])
    assert [tuple(r) for r in df.select(unit["a"], unit["b"]).collect()] == [(0.0, 0.0), (0.6, 0.8)]
    share = M.row_shares(["a", "b"])
    assert [r[0] for r in df.select(share["a"]).collect()] == [None, 3 / 7]


def test_weights_by_name_and_group(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "elevation double, soil_1 double, slope double")
    cells = M.weight_columns(df.columns, {"elevation": 8.0}, {"soil": 400.0})
    assert one(df, *cells.values()) == (8.0, 400.0, 1.0)
    with pytest.raises(ValueError):
        M.weight_columns(["a"], {"b": 1.0})


def test_arrays(spark):
    df = spark.createDataFrame([([[0.0, 255.0], [51.0, 102.0]],)], "img array<array<double>>")
    flat = df.select(M.array_affine(M.flatten_array("img"), 2 / 255, -1.0).alias("x")).first()["x"]
    assert [round(v, 6) for v in flat] == [-1.0, 1.0, -0.6, -0.2]


FLAGS = ["a1", "a2", "a3", "a4"]


@pytest.fixture(scope="module")
def one_hot_4(spark):
    data = [(1, 1, 0, 0, 0), (2, 0, 1, 0, 0), (3, 0, 0, 1, 0), (4, 0, 0, 0, 1), (5, 0, 0, 0, 0), (6, 1, 0, 1, 0)]
    return spark.createDataFrame(data, "key int, a1 int, a2 int, a3 int, a4 int")


def test_onehot_encodings(one_hot_4):
    got = [
        tuple(r)
        for r in one_hot_4.orderBy("key")
        .select(E.onehot_to_index(FLAGS), E.onehot_to_bitmask(FLAGS), E.row_argmax(FLAGS), E.exactly_one(FLAGS))
        .collect()
    ]
    assert got == [(1, 8, 0, True), (2, 4, 1, True), (3, 2, 2, True), (4, 1, 3, True), (0, 0, 0, False), (4, 10, 0, False)]


def test_bitmask_limit():
    with pytest.raises(ValueError):
        E.onehot_to_bitmask([f"c{i}" for i in range(63)])


def test_onehot_counts(one_hot_4):
    got = {r["col"]: (r["n_train"], r["n_test"]) for r in EN.onehot_counts(one_hot_4, one_hot_4.where("key < 3"), FLAGS).collect()}
    assert got == {"a1": (2, 1), "a2": (1, 1), "a3": (2, 0), "a4": (1, 0)}


@pytest.mark.parametrize("limit", [100, 2])
def test_label_codes_sorted_and_missing(spark, limit):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("é",), ("b",)], "s string")
    codes = {r["value"]: r["code"] for r in EN.code_table(df, "s", max_small=limit).collect()}
    assert codes == {"a": 0, "b": 1, "é": 2}
    assert sorted(r["c"] for r in EN.label_encode(df, "s", "c").collect()) == [-1, 0, 1, 1, 2]


def test_phrases(spark):
    text = "12 Cathedral family - Rock outcrop, very stony.\n\nZürich 3 naïve-end\r\n"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, t string")
    got = {r["id"]: r["p"] for r in df.select("id", E.split_phrases("t").alias("p")).collect()}
    assert got[1] == ["Cathedral family", "Rock outcrop", "very stony", "Zürich", "naïve", "end"]
    assert got[2] == [] and got[3] is None


def test_soil_marks(spark):
    """The 40 descriptions, against plain string rules."""
    table = soil_table(spark).withColumn("p", E.split_phrases("description"))
    flags = E.keyword_flags("p", {"rocky": "Rock", "stony": "stony", "rubbly": "rubbly"})
    got = table.select("code", "description", *[c.alias(n) for n, c in flags.items()]).collect()
    assert len(got) == 40
    for r in got:
        assert (r["rocky"], r["stony"], r["rubbly"]) == tuple(int(w in r["description"]) for w in ("Rock", "stony", "rubbly"))
    vocab = sorted(r[0] for r in EN.vocabulary(table, "p").collect())
    matrix = table.select("code", *[c.alias(n) for n, c in E.phrase_matrix("p", vocab).items()]).collect()
    pairs = EN.phrase_pairs(table, "code", "p").count()
    assert sum(sum(r[1:]) for r in matrix) == pairs
