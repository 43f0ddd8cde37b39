"""Model jobs J20-J23 on the driver's tables.

Splits are by digests of the key, drawn alike by other engines, and keep day
pairs together: a station is wholly in training or wholly in validation. Each
model is trained once per input and kept in the model store; the jobs load it.

What doesn't depend on a random learner has an oracle: the splits, label
indexes, day pairs, class centroids and their predictions, and the metrics of
"tomorrow is as today". The forests' and perceptrons' own scores have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.colour import lab_grid, representative_rgb
from tessera.operators import ml
from tessera.operators.aggregate import argmax_one
from tessera.operators.centroid import fit_centroids, nearest_centroid
from tessera.operators.joins import with_previous_day
from tessera.operators.model_store import fitted, model_key
from tessera.operators.partition import digest_part, digest_split
from tessera.plans import data

SEED = 123
WEIGHTS = (0.75, 0.25)
PARTS = ("train", "validation")
CHANNELS = ("R", "G", "B")
#: Part of the models' keys: to be raised when the derived training data or the pipelines change.
VERSION = 1
COLOUR_VERSION = 2


def _daily(spark, sf_dir) -> DataFrame:
    return data.daily_tmax(data.table(spark, sf_dir, "events"))


def _stations(daily: DataFrame) -> list[DataFrame]:
    return digest_split(daily, "station", WEIGHTS, SEED)


def _tmax_model(spark, sf_dir, with_yesterday: bool = True) -> PipelineModel:
    def fit() -> PipelineModel:
        train = ml.training_set(_stations(_daily(spark, sf_dir))[0])
        try:
            return ml.fit_on_kept_features(ml.tmax_pipeline(with_yesterday=with_yesterday, seed=SEED), train)
        finally:
            train.unpersist()

    settings = {"model": "tmax", "with_yesterday": with_yesterday, "seed": SEED, "weights": WEIGHTS, "version": VERSION}
    return fitted(spark, "tmax", model_key(spark, [f"{sf_dir}/events.parquet"], settings), fit)


def _labelled(parts, names=PARTS) -> DataFrame:
    first, second = (part.withColumn("split", F.lit(name)) for part, name in zip(parts, names))
    return first.unionByName(second)


def tmax_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J21 + J22: the stored forest's r² / RMSE on both splits, from one scoring pass."""
    model = _tmax_model(spark, sf_dir)
    scored = _labelled([model.transform(part).select("tmax", "prediction") for part in _stations(_daily(spark, sf_dir))])
    return scored.groupBy("split").agg(*ml.fit_quality()).select("split", "r2", "rmse")


def tmax_yesterday_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J22 comparison: validation r² / RMSE with and without yesterday's maximum as a feature, on the same day pairs."""
    validation = _stations(_daily(spark, sf_dir))[1]
    models = ml.fit_concurrently(lambda yes: _tmax_model(spark, sf_dir, yes), (True, False))
    scored = _labelled([model.transform(part).select("tmax", "prediction")
                        for model, part in zip(models, (validation, ml.pair_days(validation)))], ("with_yesterday", "without_yesterday"))
    return scored.groupBy(F.col("split").alias("features")).agg(*ml.fit_quality()).select("features", "r2", "rmse")


def tmax_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT4: which part each station-day is in."""
    return _daily(spark, sf_dir).select("station", "date", digest_part(PARTS, "station", WEIGHTS, SEED).alias("split"))


def tmax_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML8: what "tomorrow is as today" scores on each part, the bound that a model has to beat."""
    pairs = _labelled([with_previous_day(part, "station", "date", "tmax") for part in _stations(_daily(spark, sf_dir))])
    quality = pairs.groupBy("split").agg(*ml.fit_quality("tmax", "yesterday_tmax"))
    return quality.select("split", "n", F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"))


def tmax_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML10: feature importances of the stored forest."""
    return ml.feature_importances(spark, _tmax_model(spark, sf_dir))


def tmax_tomorrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted maximum for the day after each station's last day, by the stored forest.

    The last day per station is a partial ``max(struct)`` aggregate; the day
    after is appended with an unknown tmax, and the pipeline's self-join
    pairs it with the last day.
    """
    last = argmax_one(_daily(spark, sf_dir), "station", "date", tie=["latitude", "longitude", "elevation", "tmax"])
    last = last.select("station", "date", "latitude", "longitude", "elevation", "tmax")
    nxt = last.select(
        "station", F.date_add("date", 1).alias("date"), "latitude", "longitude", "elevation",
        F.lit(None).cast("float").alias("tmax"),
    )
    scored = _tmax_model(spark, sf_dir).transform(last.unionByName(nxt))
    return scored.select("station", "date", "yesterday_tmax", F.col("prediction").alias("predicted_tmax"))


def tmax_tomorrow_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J23 without the model: for each station the day to predict and the features it is predicted from."""
    scored = tmax_tomorrow(spark, sf_dir)
    return scored.select("station", "date", F.dayofyear("date").alias("dayofyear"), "yesterday_tmax",
                         F.col("predicted_tmax").isNotNull().alias("predicted"))


# J20 -------------------------------------------------------------------------

def _colours(spark, sf_dir) -> DataFrame:
    return data.colour_words(data.table(spark, sf_dir, "lineitem"))


def _colour_split(spark, sf_dir) -> DataFrame:
    return _colours(spark, sf_dir).withColumn("split", digest_part(PARTS, [*CHANNELS, "word"], WEIGHTS, SEED))


@contextmanager
def _colour_parts(spark, sf_dir) -> Iterator[list[DataFrame]]:
    """Training and validation colours, each once with its number of rows ``n``: counted when first read, kept meanwhile.

    What is kept has the word and the part in it, so no colour is named again to be filtered.
    """
    counts = data.with_word(data.colour_counts(data.table(spark, sf_dir, "lineitem")))
    kept = ml.training_set(counts.withColumn("split", digest_part(PARTS, [*CHANNELS, "word"], WEIGHTS, SEED)))
    try:
        yield [kept.filter(F.col("split") == part).drop("split") for part in PARTS]
    finally:
        kept.unpersist()


def _colour_model(spark, sf_dir, space: str, train: DataFrame) -> PipelineModel:
    def fit() -> PipelineModel:
        n_labels = train.select("word").distinct().count()
        return ml.colour_pipeline(space, n_labels=n_labels, seed=SEED, weight_col="n").fit(train)

    settings = {"model": "colour", "space": space, "seed": SEED, "weights": WEIGHTS, "version": COLOUR_VERSION}
    return fitted(spark, "colour", model_key(spark, [f"{sf_dir}/lineitem.parquet"], settings), fit)


def _colour_models(spark, sf_dir, train: DataFrame) -> dict[str, PipelineModel]:
    spaces = ("rgb", "lab")
    return dict(zip(spaces, ml.fit_concurrently(lambda space: _colour_model(spark, sf_dir, space, train), spaces)))


def colour_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT4 + FN19's words: every colour row with its nearest colour word and its part."""
    return _colour_split(spark, sf_dir)


def colour_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3 / FN18: index and text of the labels, from the stored RGB model's indexer, with the colour that paints each."""
    with _colour_parts(spark, sf_dir) as (train, _):
        labels = ml.label_index(spark, _colour_model(spark, sf_dir, "rgb", train))
    return labels.select("label_index", "label", representative_rgb(F.col("label")).alias("rgb"))


def colour_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the stored perceptrons on the validation rows, RGB and LAB inputs."""
    with _colour_parts(spark, sf_dir) as (train, validation):
        models = _colour_models(spark, sf_dir, train)
        rows = ml.fit_concurrently(lambda space: (space, float(ml.accuracy(models[space].transform(validation), weight="n"))), models)
    return spark.createDataFrame(rows, "space string, accuracy double")


def colour_grid(spark: SparkSession, sf_dir: str, resolution: int = 256) -> DataFrame:
    """ML11: predicted word and its colour over a LAB slice at luminance 70, by the RGB and the LAB model."""
    with _colour_parts(spark, sf_dir) as (train, _):
        models = _colour_models(spark, sf_dir, train)
    painted = [ml.prediction_grid(spark, model, lum=70.0, resolution=resolution).withColumn("space", F.lit(space))
               for space, model in models.items()]
    return painted[0].unionByName(painted[1])


def _centroids(spark, sf_dir) -> dict:
    rows = _colour_split(spark, sf_dir)
    return fit_centroids(rows.withColumn("word", F.when(F.col("split") == PARTS[0], F.col("word"))), CHANNELS, "word")


def colour_centroid_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML7 without a random learner: per word, validation rows and how many the nearest centroid of the training rows finds."""
    scored = _colour_split(spark, sf_dir).withColumn("predicted_word", nearest_centroid(CHANNELS, _centroids(spark, sf_dir)))
    validation = F.col("split") == PARTS[1]
    found = scored.groupBy("word").agg(F.count_if(validation).alias("n"), F.count_if(validation & (F.col("predicted_word") == F.col("word"))).alias("hits"))
    return found.filter(F.col("n") > 0)


def colour_grid_centroid(spark: SparkSession, sf_dir: str, resolution: int = 256) -> DataFrame:
    """ML11 without a random learner: the LAB slice painted by the nearest centroid of the training rows."""
    grid = lab_grid(spark, lum=70.0, resolution=resolution)
    grid = grid.withColumn("predicted_word", nearest_centroid(CHANNELS, _centroids(spark, sf_dir)))
    rounded = [F.round(c, 4).alias(c) for c in ("labA", "labB", *CHANNELS)]
    return grid.select("row_index", "col_index", *rounded, "predicted_word", representative_rgb(F.col("predicted_word")).alias("predicted_rgb"))


ML_QUERIES = {
    "tmax_model": tmax_model,
    "tmax_importances": tmax_importances,
    "tmax_yesterday_effect": tmax_yesterday_effect,
    "tmax_tomorrow": tmax_tomorrow,
    "tmax_tomorrow_inputs": tmax_tomorrow_inputs,
    "tmax_split": tmax_split,
    "tmax_persistence": tmax_persistence,
    "colour_model": colour_model,
    "colour_grid": colour_grid,
    "colour_split": colour_split,
    "colour_label_index": colour_label_index,
    "colour_centroid_accuracy": colour_centroid_accuracy,
    "colour_grid_centroid": colour_grid_centroid,
}
