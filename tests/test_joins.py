import pytest

from tabforge.operators import joins as J


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, k string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("a", 10), ("b", 20), (None, 99)], "k string, v int")


def test_enrich_keeps_every_row_once(fact, dim, rows):
    assert [r[-1] for r in sorted(J.enrich(fact, dim, "k").select("id", "v").collect())] == [10, 20, None, None]


def test_enrich_null_keys(fact, dim):
    out = {r["id"]: r["v"] for r in J.enrich(fact, dim, "k", null_keys_match=True).collect()}
    assert out == {1: 10, 2: 20, 3: 99, 4: None}


def test_enrich_refuses_repeated_key(fact, spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError, match="not a key"):
        J.enrich(fact, twice, "k")


@pytest.mark.parametrize("nulls", [False, True])
def test_salted_enrich_is_the_same(spark, nulls):
    """A hot key on the left, spread over several salts."""
    hot = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(300)], "id int, k string")
    table = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    plain = J.enrich(hot, table, "k", null_keys_match=nulls)
    salted = J.enrich(hot, table, "k", null_keys_match=nulls, salts=5)
    assert salted.columns == plain.columns
    assert sorted(salted.select("id", "v").collect(), key=str) == sorted(plain.select("id", "v").collect(), key=str)


def test_range_join_matches_brute_force(spark):
    ranges = [("a", 0.0, 10.0), ("b", 10.0, 20.0), ("c", 5.0, 15.0), ("none", 7.0, 7.0)]
    values = [-1.0, 0.0, 4.9, 5.0, 9.99, 10.0, 14.9, 15.0, 19.99, 20.0, 30.0]
    r = spark.createDataFrame(ranges, "name string, lo double, hi double")
    v = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double")
    got = sorted((row["x"], row["name"]) for row in J.range_join(v, "x", r, bins=7).collect())
    assert got == sorted((x, n) for x in values for n, lo, hi in ranges if lo <= x < hi)
    assert "CartesianProduct" not in J.range_join(v, "x", r)._jdf.queryExecution().toString()
    assert "NestedLoop" not in J.range_join(v, "x", r)._jdf.queryExecution().toString()


def test_glue_checks_rows_and_keys(spark):
    a = spark.createDataFrame([(1, 2), (2, 3)], "k int, a int")
    b = spark.createDataFrame([(1, 4), (2, 5)], "k int, b int")
    assert sorted(tuple(r) for r in J.glue([a, b], "k").collect()) == [(1, 2, 4), (2, 3, 5)]
    with pytest.raises(ValueError):
        J.glue([a, b.where("k = 1")], "k")
    with pytest.raises(ValueError):
        J.glue([a, spark.createDataFrame([(1, 4), (3, 5)], "k int, b int")], "k")


def test_lookup_join(spark, fact):
    table = spark.createDataFrame([("a", 1)], "k string, code int")
    assert {r["id"]: r["code"] for r in J.lookup_join(fact, table, "k").collect()} == {1: 1, 2: None, 3: None, 4: None}
