"""The three worked problems, from raw files to features and models, as plans over the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions import rowmath as M
from tabforge.functions.encode import keyword_flags, onehot_to_index, row_argmax, split_phrases
from tabforge.functions.fixed import SHADE_WEIGHTS
from tabforge.models.bayes import GaussianNB
from tabforge.models.boost import AdaBoost, Boosted
from tabforge.models.discriminant import Lda, Qda
from tabforge.models.features import extra_trees, rbf_svm, rbm_logistic
from tabforge.models.knn import KnnClassifier
from tabforge.models.learner import decision_tree, linear_svm, logistic, perceptron, random_forest
from tabforge.models.scale import Standardize
from tabforge.operators import profile as P
from tabforge.operators.cols import align, cols_range, drop_all_null, downcast, reorder, shift_label
from tabforge.operators.encoders import label_encode
from tabforge.operators.joins import enrich, lookup_join
from tabforge.sources import io

# ---------------------------------------------------------------- building energy

READING_TIMES = ["yyyy MM dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]
WEATHER_TIMES = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm"]
WEATHER = [
    "air_temperature",
    "cloud_coverage",
    "dew_temperature",
    "precip_depth_1_hr",
    "sea_level_pressure",
    "wind_direction",
    "wind_speed",
]


def energy_readings(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    df = io.read_csv_named(spark, path, dict(types)).drop(io.BAD_ROW)
    return df.withColumn("timestamp", io.parse_ts("timestamp", READING_TIMES))


def energy_weather(spark: SparkSession, path: str) -> DataFrame:
    types = {"site_id": "int", "timestamp": "string", **dict.fromkeys(WEATHER, "double")}
    df = io.read_csv_named(spark, path, types).drop(io.BAD_ROW)
    return downcast(df.withColumn("timestamp", io.parse_ts("timestamp", WEATHER_TIMES)), WEATHER, floats=True)


def energy_table(readings: DataFrame, buildings: DataFrame, weather: DataFrame, salts: int = 1) -> DataFrame:
    """Readings with their building and the weather at its site and time; every reading once."""
    built = enrich(readings, buildings, "building_id", salts=salts)
    return enrich(built, weather, ["site_id", "timestamp"])


def energy_tables(spark: SparkSession, folder: str, cache: str) -> tuple[DataFrame, DataFrame]:
    """Train and test tables from the five files, kept as Parquet until an input changes."""
    folder = folder.rstrip("/")
    out = []
    for part, types in (
        ("train", {"building_id": "int", "meter": "smallint", "meter_reading": "double"}),
        ("test", {"row_id": "bigint", "building_id": "int", "meter": "int"}),
    ):
        files = [f"{folder}/{part}.csv", f"{folder}/weather_{part}.csv", f"{folder}/building_metadata.csv"]

        def build(files=files, types=types):
            buildings = io.read_csv_named(
                spark, files[2], {"building_id": "int", "site_id": "int", "square_feet": "bigint"}
            ).drop(io.BAD_ROW)
            return energy_table(energy_readings(spark, files[0], types), buildings, energy_weather(spark, files[1]))

        mark = io.inputs_fingerprint(spark, files, part, sorted(types.items()))
        out.append(io.cached(spark, f"{cache}/{part}", build, mark))
    return out[0], out[1]


def energy_profile(df: DataFrame, grid: Sequence[float]) -> dict[str, DataFrame]:
    """Sites per use, distribution of the floor area, its density per use."""
    return {
        "sites": P.nunique_by(df, "primary_use", "site_id"),
        "area": P.histogram(df, "square_feet", 32),
        "density": P.kde(df, "square_feet", "primary_use", grid),
    }


# ---------------------------------------------------------------- forest cover

HYDRO, RISE = "Horizontal_Distance_To_Hydrology", "Vertical_Distance_To_Hydrology"
ROAD, FIRE = "Horizontal_Distance_To_Roadways", "Horizontal_Distance_To_Fire_Points"
SHADES = ["Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm"]
WILDERNESS = [f"Wilderness_Area{i}" for i in range(1, 5)]
SOIL = [f"Soil_Type{i}" for i in range(1, 41)]


def _pairs(stem: str, measure) -> dict[str, Column]:
    """One column for each two of the three distances."""
    named = {"road_fire": [ROAD, FIRE], "hydro_fire": [FIRE, HYDRO], "road_hydro": [ROAD, HYDRO]}
    return {f"{stem}_{name}": measure(two) for name, two in named.items()}


def cover_features() -> dict[str, Column]:
    """Derived columns of the forest cover problem; all of them fit one projection."""
    distances = [ROAD, FIRE, HYDRO]
    return {
        "distance_to_hydrology": M.row_norm([HYDRO, RISE]),
        "distance_mean": M.row_mean(distances),
        "distance_sum": M.row_sum(distances),
        **_pairs("distance", M.row_mean),
        **_pairs("distance_sum", M.row_sum),
        "distance_dif_road_fire": M.pair_diff(ROAD, FIRE),
        "distance_dif_hydro_road": M.pair_diff(HYDRO, ROAD),
        "distance_dif_hydro_fire": M.pair_diff(HYDRO, FIRE),
        "cosine_of_slope": M.cos_deg("Slope"),
        "hillshade": M.weighted_sum(dict(zip(SHADES, SHADE_WEIGHTS))),
        "shade_mean": M.row_mean(SHADES),
        "shade_noon_diff": M.pair_diff(SHADES[0], SHADES[1]),
        "shade_3pm_diff": M.pair_diff(SHADES[1], SHADES[2]),
        "shade_all_diff": M.pair_diff(SHADES[0], SHADES[2]),
        "elevation_above_water": M.pair_diff("Elevation", RISE),
        "elevation_plus_rise": M.row_sum(["Elevation", RISE]),
        "elevation_bin": M.bin_floor("Elevation", 200),
        "aspect_bin": M.bin_floor("Aspect", 45),
        "slope_bin": M.bin_floor("Slope", 6),
    }


def soil_flags(spark: SparkSession) -> DataFrame:
    """Rocky, stony and rubbly marks of the 40 soil classes, read from their descriptions."""
    phrases = io.soil_table(spark).withColumn("phrases", split_phrases("description"))
    flags = keyword_flags("phrases", {"rocky": "Rock", "stony": "stony", "rubbly": "rubbly"})
    return phrases.select(F.col("code").cast("long").alias("soil"), *[c.alias(n) for n, c in flags.items()])


def cover_table(df: DataFrame, label: str = "Cover_Type") -> DataFrame:
    """Base numbers, derived numbers, wilderness and soil codes with soil marks, one-hot columns; label from 0."""
    base = cols_range(df, "Elevation", FIRE)
    derived = cover_features()
    wide = df.withColumns({**derived, "wilderness": row_argmax(WILDERNESS), "soil": onehot_to_index(SOIL)})
    wide = lookup_join(wide, soil_flags(df.sparkSession), "soil")
    if label in df.columns:
        wide = shift_label(wide, label, -1)
    head = ["Id"] + ([label] if label in df.columns else [])
    codes = ["wilderness", "soil", "rocky", "stony", "rubbly"]
    return reorder(wide, [head, base, list(derived), codes, WILDERNESS, SOIL])


def cover_inputs(train: DataFrame, test: DataFrame, weights: Mapping[str, float] | None = None, label: str = "Cover_Type"):
    """Train and test tables with the same columns: numbers divided by the row's length, then weighted."""
    out = []
    for df in (train, test):
        wide = cover_table(df, label)
        numbers = cols_range(wide, "Elevation", "slope_bin")
        unit = wide.withColumns(M.row_normalize(numbers))
        scaled = M.weight_columns(numbers + WILDERNESS + SOIL, {}, weights or {})
        out.append(unit.withColumns(scaled))
    return out[0], align(out[1], out[0].drop(label))


# ---------------------------------------------------------------- tumours


def tumour_table(raw: DataFrame) -> DataFrame:
    """Without empty columns; diagnosis as 0 (B) and 1 (M) in ``label``."""
    return label_encode(drop_all_null(raw), "diagnosis", "label").drop("diagnosis")


def classifiers(cols: Sequence[str], key: str, label: str = "label", seed: int = 0) -> dict[str, Estimator]:
    """The compared classifiers by name. Scale the columns first, or take ``scaled``."""
    return {
        "logistic C=1": logistic(cols, label, C=1.0),
        "logistic C=10000": logistic(cols, label, C=10_000.0),
        "rbm 100": rbm_logistic(cols, label, units=100, seed=seed),
        "rbf svm": rbf_svm(cols, label, C=2.8, gamma=0.0073, seed=seed),
        "linear svm": linear_svm(cols, label, C=0.025),
        "nearest neighbour": KnnClassifier(inputCols=list(cols), keyCol=key, labelCol=label, k=1),
        "3 neighbours": KnnClassifier(inputCols=list(cols), keyCol=key, labelCol=label, k=3),
        "tree": decision_tree(cols, label, seed=seed),
        "forest": random_forest(cols, label, trees=50, max_depth=10, seed=seed, keyCol=key),
        "extra trees": extra_trees(cols, label, seed=seed),
        "ada boost": AdaBoost(cols, label, seed=seed),
        "naive bayes": GaussianNB(cols, label),
        "gradient boosting": Boosted(cols, label, key, seed=seed),
        "linear discriminant": Lda(cols, label),
        "quadratic discriminant": Qda(cols, label),
        "perceptron": perceptron(cols, label, hidden=(80, 10), seed=seed),
    }


def scaled(est: Estimator, cols: Sequence[str]) -> Pipeline:
    """The estimator behind a scaler that learns from the same rows."""
    return Pipeline(stages=[Standardize(list(cols)), est])
