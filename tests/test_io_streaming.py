import csv
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions import rowmath as M
from tabforge.models.bayes import GaussianNB
from tabforge.plans import recipes
from tabforge.runtime import bounded_rows, broadcast_if_small, cut_lineage, shared_dir, spread
from tabforge.sources import io
from tabforge.streaming.stateless import score_stream


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


def test_bad_cells(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["id", "x"], [(1, "2.5"), (2, "oops"), (3, "")])
    got = {r["id"]: r for r in io.read_csv(spark, path, "id int, x double").cache().collect()}
    assert got[1]["x"] == 2.5 and got[2]["x"] is None and got[2][io.BAD_ROW] and got[3]["x"] is None
    assert got[1][io.BAD_ROW] is None and got[3][io.BAD_ROW] is None
    dropped = io.read_csv(spark, path, "id int, x double", on_bad="drop")
    assert sorted(r["id"] for r in dropped.select("id", "x").collect()) == [1, 3]
    with pytest.raises(Exception):
        io.read_csv(spark, path, "id int, x double", on_bad="fail").collect()
    with pytest.raises(ValueError):
        io.read_csv(spark, path, "id int", on_bad="ignore")


def test_csv_by_name(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", ["x", "other", "id"], [(1.5, "t", 7)])
    df = io.read_csv_named(spark, path, {"id": "bigint", "x": "double"}).drop(io.BAD_ROW)
    assert df.dtypes == [("x", "double"), ("other", "string"), ("id", "bigint")] and df.first()["id"] == 7
    assert [f.dataType.typeName() for f in io.infer_csv_schema(spark, path)] == ["double", "string", "integer"]
    with pytest.raises(ValueError):
        io.read_csv_named(spark, path, {"nothing": "int"})


def test_keys(spark):
    good = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    assert io.require_key(good, ["k", "l"]) is good
    with pytest.raises(ValueError):
        io.require_key(good, "k")
    with pytest.raises(ValueError):
        io.require_key(spark.createDataFrame([(1,), (None,)], "k int"), "k")


def test_times(spark):
    df = spark.createDataFrame([("2016 01 02 03:04:05",), ("2016-01-02 03:04:05",), ("junk",), (None,)], "t string")
    one = [r[0] for r in df.select(F.date_format(io.parse_ts("t", ["yyyy MM dd HH:mm:ss"]), "HHmmss")).collect()]
    two = [r[0] for r in df.select(F.date_format(io.parse_ts("t", recipes.READING_TIMES), "HHmmss")).collect()]
    assert one == ["030405", None, None, None] and two == ["030405", "030405", None, None]


def test_cache_is_built_once_per_input(spark, tmp_path):
    source = write_csv(tmp_path / "in.csv", ["a"], [(1,)])
    calls = []

    def build():
        calls.append(1)
        return io.read_csv(spark, source, "a int", on_bad="fail")

    def read():
        return io.cached(spark, str(tmp_path / "cache"), build, io.inputs_fingerprint(spark, [source], "p")).collect()

    assert [r["a"] for r in read()] == [1] and [r["a"] for r in read()] == [1] and len(calls) == 1
    write_csv(tmp_path / "in.csv", ["a"], [(2,), (3,)])
    assert sorted(r["a"] for r in read()) == [2, 3] and len(calls) == 2


def test_half_written_cache_is_not_used(spark, tmp_path):
    os.makedirs(tmp_path / "cache" / "mark" / "_temporary")
    got = io.cached(spark, str(tmp_path / "cache"), lambda: spark.range(3), "mark")
    assert got.count() == 3


def test_predictions_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, 3.0, "y")], "Id long, Cover_Type double, other string")
    io.write_predictions(df, str(tmp_path / "out"), "Id", "Cover_Type")
    lines = [line for p in (tmp_path / "out").glob("*.csv") for line in p.read_text().split()]
    assert sorted(set(lines)) == ["1,2", "2,3", "Id,Cover_Type"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    cut = cut_lineage(spark.range(5).withColumn("x", F.col("id") + 1))
    assert cut.count() == 5 and "Scan ExistingRDD" in cut._jdf.queryExecution().toString()


def test_sizes_are_checked(spark):
    assert len(bounded_rows(spark.range(5), 5, "x")) == 5
    with pytest.raises(ValueError):
        bounded_rows(spark.range(6), 5, "x")
    small, large = broadcast_if_small(spark.range(5), 5), broadcast_if_small(spark.range(6), 5)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in large._jdf.queryExecution().analyzed().toString()
    a = [r["id"] for r in spread(spark.range(100).repartition(1), 100, "id").collect()]
    b = [r["id"] for r in spread(spark.range(100).repartition(7), 100, "id").collect()]
    assert a == b


def test_features_and_models_on_a_file_stream(spark, two_blobs, tmp_path):
    source, target, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    model = GaussianNB(["a", "b"]).fit(two_blobs)

    def apply(df):
        return model.transform(df.withColumn("norm", M.row_norm(["a", "b"]))).select("key", "norm", "prediction")

    two_blobs.where("key < 100").write.mode("append").parquet(source)
    score_stream(spark, source, two_blobs.schema, apply, target, marks).awaitTermination()
    two_blobs.where("key >= 100").write.mode("append").parquet(source)
    score_stream(spark, source, two_blobs.schema, apply, target, marks).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == sorted(map(tuple, apply(two_blobs).collect()))


def test_energy_files(spark, tmp_path):
    write_csv(tmp_path / "building_metadata.csv", ["site_id", "building_id", "primary_use", "square_feet"],
              [(0, 1, "Office", 1000), (1, 2, "Lodging", 3000), (1, 3, "Office", 2000)])
    weather = ["site_id", "timestamp", *recipes.WEATHER]
    for part in ("train", "test"):
        write_csv(tmp_path / f"weather_{part}.csv", weather, [(0, "2016-01-01 00:00:00", 25.0, 6, 20, "", 1019.7, 0, 0)])
    write_csv(tmp_path / "train.csv", ["building_id", "meter", "timestamp", "meter_reading"],
              [(1, 0, "2016-01-01 00:00:00", 5.5), (2, 0, "2016 01 01 00:00:00", 6.5), (9, 0, "x", 1)])
    write_csv(tmp_path / "test.csv", ["row_id", "building_id", "meter", "timestamp"], [(70_000, 3, 0, "2016-01-01 00:00:00")])
    train, test = recipes.energy_tables(spark, str(tmp_path), str(tmp_path / "cache"))
    got = {r["building_id"]: r for r in train.collect()}
    assert len(got) == 3 and got[1]["air_temperature"] == 25.0 and got[1]["precip_depth_1_hr"] is None
    assert got[2]["primary_use"] == "Lodging" and got[2]["air_temperature"] is None
    assert got[9]["timestamp"] is None and got[9]["primary_use"] is None
    assert test.first()["row_id"] == 70_000 and dict(train.dtypes)["wind_speed"] == "float"
    profile = recipes.energy_profile(train, [1000.0, 2000.0])
    assert {r["primary_use"]: r["n"] for r in profile["sites"].collect()} == {"Office": 1, "Lodging": 1}
    assert profile["area"].count() == 32 and profile["density"].count() == 0


def cover_rows(spark, n, seed, label):
    rng = np.random.default_rng(seed)
    names = ["Id", "Elevation", "Aspect", "Slope", recipes.HYDRO, recipes.RISE, recipes.ROAD, *recipes.SHADES, recipes.FIRE,
             *recipes.WILDERNESS, *recipes.SOIL] + (["Cover_Type"] if label else [])
    data = []
    for i in range(n):
        wild, soil = rng.integers(0, 4), rng.integers(0, 40)
        numbers = [2000 + 10 * i, 90, 60, 3, -4, 30, 100, 200, 150, 60]
        row = [i, *numbers, *[int(j == wild) for j in range(4)], *[int(j == soil) for j in range(40)]]
        data.append(tuple(int(v) for v in row + ([1 + i % 7] if label else [])))
    return spark.createDataFrame(data, ", ".join(f"{c} long" for c in names))


def test_cover_features(spark):
    train, test = recipes.cover_inputs(cover_rows(spark, 14, 1, True), cover_rows(spark, 5, 2, False), {"Soil": 400.0})
    assert test.columns == [c for c in train.columns if c != "Cover_Type"]
    plain = recipes.cover_table(cover_rows(spark, 14, 1, True)).orderBy("Id").collect()
    r = plain[0]
    assert r["distance_to_hydrology"] == 5.0 and r["distance_sum"] == 93.0 and r["distance_mean"] == 31.0
    assert math.isclose(r["hillshade"], 0.299 * 100 + 0.587 * 200 + 0.114 * 150)
    assert math.isclose(r["cosine_of_slope"], 0.5) and (r["elevation_bin"], r["aspect_bin"], r["slope_bin"]) == (10, 2, 10)
    assert [x["Cover_Type"] for x in plain] == [i % 7 for i in range(14)]
    assert all(x[f"Soil_Type{x['soil']}"] == 1 and x[f"Wilderness_Area{x['wilderness'] + 1}"] == 1 for x in plain)
    unit = train.first()
    assert math.isclose(sum(unit[c] ** 2 for c in train.columns[2:12]) + sum(unit[c] ** 2 for c in recipes.cover_features()), 1.0)
    assert {unit[c] for c in recipes.SOIL} == {0.0, 400.0}


def test_tumour_table(spark):
    raw = spark.createDataFrame([(1, "M", 2.0, None), (2, "B", 1.0, None)], "id long, diagnosis string, radius_mean double, x string")
    df = recipes.tumour_table(raw)
    assert sorted(map(tuple, df.select("id", "radius_mean", "label").collect())) == [(1, 2.0, 1), (2, 1.0, 0)]
    models = recipes.classifiers(["radius_mean"], "id")
    assert len(models) == 16


def test_scaled_classifier(two_blobs):
    est = recipes.scaled(recipes.classifiers(["a", "b"], "key")["logistic C=1"], ["a", "b"])
    assert est.fit(two_blobs).transform(two_blobs).where("label = prediction").count() > 280
