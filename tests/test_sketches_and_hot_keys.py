"""Mergeable profiles within their stated errors in any merge order; joins with hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import joins as J
from tabforge.operators import sketches as S


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    n = 60_000
    x, few = rng.lognormal(0, 2, n), rng.geometric(0.2, n)
    rows = zip(range(n), x.tolist(), few.tolist(), (f"w{int(v)}" for v in rng.integers(0, 30_000, n)))
    df = spark.createDataFrame(list(rows), "id long, x double, few long, word string")
    df = df.withColumn("x", F.when(F.col("id") % 100 == 0, F.lit(float("nan"))).when(F.col("id") % 101 == 0, None).otherwise(F.col("x")))
    return df.repartition(6).cache()


COLS = ["x", "few", "word"]


@pytest.mark.parametrize("order", ["id % 7", "CAST(log2(1 + id) AS INT)", "few % 3"])
def test_merged_profiles_keep_their_bounds(spark, table, tmp_path, order):
    """Three ways to cut and merge; stored between the two merges."""
    parts = S.profile_parts(table, COLS, F.expr(f"CAST({order} AS STRING)"))
    parts.write.parquet(str(tmp_path / "parts"))
    stored = spark.read.parquet(str(tmp_path / "parts"))
    once = S.merge_profiles(stored, F.substring("part", 1, 1))
    rows = {r.column: r for r in S.read_profile(S.merge_profiles(once), (0.1, 0.5, 0.99), top=3).collect()}
    data = table.toPandas()
    x = data["x"].dropna().to_numpy()
    assert (rows["x"].n, rows["x"].nulls) == (len(x), 60_000 - len(x)) and rows["word"].mean is None and rows["word"].q50 is None
    assert np.allclose([rows["x"].mean, rows["x"].std, rows["x"].least, rows["x"].largest], [x.mean(), x.std(ddof=1), x.min(), x.max()])
    for c, values in (("x", x), ("few", data["few"].to_numpy()), ("word", data["word"].to_numpy())):
        exact = len(set(values.tolist()))
        assert abs(rows[c].distinct - exact) <= max(S.DISTINCT_ERROR * exact, 0.5)
    for c, values in (("x", x), ("few", data["few"].to_numpy())):
        for q, found in ((0.1, rows[c].q10), (0.5, rows[c].q50), (0.99, rows[c].q99)):
            low, high = (values < found).mean(), (values <= found).mean()
            assert low - S.RANK_ERROR <= q <= high + S.RANK_ERROR
    counts = data["few"].value_counts()
    assert [(int(t["item"]), t["count"]) for t in rows["few"].top] == list(counts.head(3).items())


def test_profile_of_files_and_nothing(spark, table, tmp_path):
    table.select("x").repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    parts = S.profile_parts(df, ["x"])
    assert parts.count() == 3 and S.merge_profiles(parts).first().n == df.where("x IS NOT NULL AND NOT isnan(x)").count()
    nothing = spark.createDataFrame([(None, None)] * 3, "x double, word string")
    rows = {r.column: r for r in S.read_profile(S.merge_profiles(S.profile_parts(nothing, ["x", "word"], F.lit("p")))).collect()}
    assert (rows["x"].n, rows["x"].nulls, rows["x"].mean, rows["x"].std, rows["x"].distinct) == (0, 3, None, None, 0)
    assert S.profile_parts(nothing.limit(0), ["x"], F.lit("p")).collect() == []


def test_heavy_keys(spark):
    keys = [7] * 400 + [8] * 120 + [None] * 300 + list(range(100, 580))
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long").repartition(5)
    hashes = {r.h: r.k for r in df.selectExpr("k", "xxhash64(k) AS h").distinct().collect()}
    assert sorted(hashes[h] for h in J.heavy_keys(df, ["k"], 0.05)) == [7, 8]
    assert sorted(hashes[h] for h in J.heavy_keys(df, ["k"], 0.2)) == [7]
    assert J.heavy_keys(df, ["k"], 0.5) == [] and J.heavy_keys(df.limit(0), ["k"], 0.1) == []


def test_hot_join(spark):
    """Every fact once; only hot dimension rows are copied; null keys and unknown keys get nulls."""
    keys = [7] * 500 + [None] * 200 + [i % 40 for i in range(800)]
    fact = spark.createDataFrame([(i, k, "p") for i, k in enumerate(keys)], "id long, k long, part string").repartition(5)
    dim = spark.createDataFrame([(k, "p", k * 10) for k in range(30)] + [(None, "p", -1)], "k long, part string, v long")
    found = J.enrich_hot(fact, dim, ["k", "part"], share=0.2, salts=8)
    assert found.columns == ["k", "part", "id", "v"]
    got = {r.id: r.v for r in found.collect()}
    assert len(got) == found.count() == 1500
    assert all(got[i] == (k * 10 if k is not None and k < 30 else None) for i, k in enumerate(keys))
    copies = found._jdf.queryExecution().analyzed().toString()
    assert "Generate explode" in copies or "explode" in copies.lower()
    hot = J.heavy_keys(fact, ["k", "part"], 0.2)
    assert len(hot) == 1
    copied = dim.where("part = 'p'").select(F.when(F.xxhash64("k", "part").isin(hot), 8).otherwise(1).alias("n")).agg(F.sum("n")).first()[0]
    assert copied == 31 + 7
    with pytest.raises(ValueError):
        J.enrich_hot(fact, dim.unionByName(dim), ["k", "part"])


def test_hot_key_is_dealt_out(spark):
    """No task gets the rows of the hot key alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        fact = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 1000).alias("k"))
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        plain, hot = ([n for n in j.select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]]
                      for j in (J.enrich(fact, dim, "k"), J.enrich_hot(fact, dim, "k", share=0.1, salts=64)))
        assert max(plain) > 13_000 and max(hot) < 5_000 and sum(hot) == 20_000
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "3")
