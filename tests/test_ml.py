import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tessera.functions.colour import COLOUR_RGB, nearest_word
from tessera.operators import ml, model_store
from tessera.operators.centroid import fit_centroids, nearest_centroid
from tessera.operators.partition import digest_split
from tessera.plans import ml_jobs
from tessera.session import hadoop_path

SF = "/root/testdata/sf0.001"


def test_tmax_model_metrics_and_tomorrow(spark):
    metrics = {r.split: (r.r2, r.rmse) for r in ml_jobs.tmax_model(spark, SF).collect()}
    assert set(metrics) == {"train", "validation"}
    assert metrics["train"][1] >= 0
    tomorrow = ml_jobs.tmax_tomorrow(spark, SF).collect()
    stations = spark.read.parquet(f"{SF}/events.parquet").select("user_id").distinct().count()
    assert len(tomorrow) == stations and all(r.predicted_tmax is not None for r in tomorrow)
    imp = ml_jobs.tmax_importances(spark, SF).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)


def test_lab_pipeline_saves_and_loads(spark, tmp_out):
    rows = [(r, g, b, "dark" if r + g + b < 300 else "light") for r in range(0, 256, 40) for g in range(0, 256, 40) for b in range(0, 256, 40)]
    df = spark.createDataFrame(rows, "R int, G int, B int, word string")
    model = ml.colour_pipeline("lab", n_labels=2, max_iter=50).fit(df)
    ml.save_model(model, f"{tmp_out}/m")
    loaded = PipelineModel.load(f"{tmp_out}/m")
    assert ml.accuracy(loaded.transform(df)) > 0.8
    grid = ml.prediction_grid(spark, loaded, resolution=8).collect()
    assert len(grid) == 64 and {r.predicted_word for r in grid} <= {"dark", "light"}


def test_fit_quality_equals_the_evaluators_and_skips_unknown_values(spark):
    draw = random.Random(1)
    rows = [(1e6 + draw.gauss(0, 3), 1e6 + draw.gauss(0, 4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "tmax double, prediction double")
    got = ml.regression_metrics(df.unionByName(spark.createDataFrame([(None, 1.0), (1.0, None)], df.schema)))
    assert got["n"] == 500
    for name in ("r2", "rmse"):
        assert got[name] == pytest.approx(RegressionEvaluator(labelCol="tmax", metricName=name).evaluate(df), rel=1e-9)
    assert ml.regression_metrics(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], df.schema)) == {"n": 2, "r2": None, "rmse": 1.0}
    assert ml.regression_metrics(df.limit(0)) == {"n": 0, "r2": None, "rmse": None}


def test_nearest_word_and_centroids_equal_plain_loops(spark):
    draw = random.Random(2)
    rows = [tuple(draw.randrange(256) for _ in range(3)) for _ in range(400)] + [(0, 0, 0), (None, 1, 2)]
    df = spark.createDataFrame(rows, "R int, G int, B int").withColumn("word", nearest_word(F.col("R"), F.col("G"), F.col("B")))

    def nearest(rgb, centres):
        return None if None in rgb else min(centres, key=lambda w: (sum((x - y) ** 2 for x, y in zip(rgb, centres[w])), w))

    words = [nearest(rgb, COLOUR_RGB) for rgb in rows]
    assert [r.word for r in df.collect()] == words
    centres = fit_centroids(df, ("R", "G", "B"), "word")
    for word, centre in centres.items():
        own = [rgb for rgb, w in zip(rows, words) if w == word]
        assert centre == pytest.approx([sum(x) / len(own) for x in zip(*own)])
    assert [r[0] for r in df.select(nearest_centroid(("R", "G", "B"), centres)).collect()] == [nearest(rgb, centres) for rgb in rows]
    assert df.limit(1).select(nearest_centroid(("R", "G", "B"), {})).first()[0] is None
    with pytest.raises(ValueError):
        fit_centroids(df, ("R",), "word", max_labels=2)


def test_digest_split_is_a_partition_of_the_rows(spark):
    df = spark.range(4000).select("id", (F.col("id") % 7).alias("k"))
    parts = digest_split(df.repartition(9), "id", (2, 1, 1), seed=5)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 4000 and abs(sizes[0] - 2000) < 150 and abs(sizes[1] - 1000) < 120
    again = digest_split(df, "id", (2, 1, 1), seed=5)
    assert [sorted(r.id for r in p.collect()) for p in parts] == [sorted(r.id for r in p.collect()) for p in again]


def test_model_store_trains_once_per_input_and_never_loads_a_half_saved_model(spark, tmp_out):
    from tessera.session import scratch_path

    source = f"{tmp_out}/in"
    rows = [(float(i), float(2 * i)) for i in range(50)]
    df = spark.createDataFrame(rows, "x double, tmax double")
    df.write.parquet(source)
    fits = []

    def fit():
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import LinearRegression

        fits.append(1)
        return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="tmax")]).fit(spark.read.parquet(source))

    key = model_store.model_key(spark, [source], {"a": 1})
    name = f"test-{tmp_out.rsplit('-', 1)[1]}"
    first = model_store.fitted(spark, name, key, fit)
    second = model_store.fitted(spark, name, model_store.model_key(spark, [source], {"a": 1}), fit)
    assert len(fits) == 1 and isinstance(second, PipelineModel)
    assert [r.prediction for r in first.transform(df).collect()] == [r.prediction for r in second.transform(df).collect()]
    # other settings and other input files give other keys
    assert model_store.model_key(spark, [source], {"a": 2}) != key
    df.limit(1).write.mode("append").parquet(source)
    changed = model_store.model_key(spark, [source], {"a": 1})
    assert changed != key
    # a save that broke off has no mark: it is trained anew and put in its place
    path = scratch_path(spark, "models", name, changed)
    first.write().save(path)
    model_store.fitted(spark, name, changed, fit)
    assert len(fits) == 2
    fs, mark = hadoop_path(spark, f"{path}/{model_store.MARK}")
    assert fs.exists(mark)
    # of two jobs that trained at once, the second finds the first one's model and leaves it
    model_store.store_model(spark, first, path)
    assert PipelineModel.load(path).transform(df).count() == 50


def test_grids_of_both_models_are_painted_whole(spark):
    rows = ml_jobs.colour_grid(spark, SF, resolution=8).collect()
    assert len(rows) == 128 and {r.space for r in rows} == {"rgb", "lab"}
    assert all(tuple(r.predicted_rgb) == COLOUR_RGB[r.predicted_word] for r in rows)
    with pytest.raises(ValueError):
        ml.label_indexer(PipelineModel([]))
