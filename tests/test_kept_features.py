import datetime as dt

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tessera.operators import ml
from tessera.plans import ml_jobs


def test_forest_learns_from_features_that_are_kept(spark, tmp_out, monkeypatch):
    rows = spark.range(600).select(
        "id", F.timestamp_seconds(1_704_067_200 + F.col("id") % 20 * 86_400).alias("ts"),
        F.floor(F.col("id") / 20).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 97).cast("double").alias("value"))
    rows.write.parquet(f"{tmp_out}/events.parquet")
    kept, fit = [], RandomForestRegressor._fit

    def watched(self, dataset):
        kept.append(dataset.storageLevel.useMemory)
        return fit(self, dataset)

    monkeypatch.setattr(RandomForestRegressor, "_fit", watched)
    tomorrow = ml_jobs.tmax_tomorrow(spark, tmp_out).collect()
    assert kept == [True]
    assert len(tomorrow) == 30 and all(r.predicted_tmax is not None for r in tomorrow)


def test_fit_on_kept_features_gives_the_pipelines_own_model(spark):
    rows = [(f"U{s}", dt.date(2024, 1, 1) + dt.timedelta(days=d), float(s), 2.0 * s, 3.0 * s, float((s * 7 + d * 3) % 31)) for s in range(12) for d in range(15)]
    daily = spark.createDataFrame(rows, "station string, date date, latitude float, longitude float, elevation float, tmax float").coalesce(1).cache()
    pipeline = ml.tmax_pipeline(num_trees=3, max_depth=4)
    one, two = ml.fit_on_kept_features(pipeline, daily), pipeline.fit(daily)
    key = ["station", "date"]
    assert [r.prediction for r in one.transform(daily).orderBy(key).collect()] == [r.prediction for r in two.transform(daily).orderBy(key).collect()]
