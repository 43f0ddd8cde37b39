"""Spark ML stages and helpers (ML1-ML11, FN18, FN19, SNK10).

Pipelines are plain ``pyspark.ml`` pipelines; the custom stages, the RGB -> LAB
converter and the day before, are column-expression and join transformers that
save and load with the pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.colour import lab_grid, representative_rgb, rgb_to_lab_columns
from tessera.operators.joins import with_previous_day
from tessera.operators.perceptron import WeightedPerceptron

DAYOFYEAR_SQL = "SELECT *, dayofyear(date) AS dayofyear FROM __THIS__"


def fit_concurrently(fn, items, threads: int | None = None) -> list:
    """``[fn(item) for item in items]`` with the fits running as concurrent Spark jobs.

    Independent models train side by side (as ``CrossValidator(parallelism=n)``
    does): an iterative learner leaves cores idle between its small per-iteration
    jobs, which the other fit uses. Each result is the same as a sequential fit.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    items = list(items)
    spark = SparkSession.getActiveSession()
    # job group, description and tags of the caller carry over to the threads
    target = inheritable_thread_target(spark)(fn) if spark is not None else fn
    with ThreadPoolExecutor(max_workers=threads or len(items)) as pool:
        return list(pool.map(target, items))


def pair_days(daily: DataFrame) -> DataFrame:
    """Daily rows restricted to the days that have the day before (the rows the
    yesterday model can score), with the daily schema unchanged."""
    return PreviousDay().transform(daily).select(*daily.columns)


class PreviousDay(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: adds the station's maximum of the day before; days without one drop out."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_previous_day(dataset, "station", "date", "tmax")


class RgbToLab(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage: RGB byte columns -> LAB columns (column expressions, no UDF)."""

    @keyword_only
    def __init__(self, inputCols: Sequence[str] = ("R", "G", "B"), outputCols: Sequence[str] = ("labL", "labA", "labB")):
        super().__init__()
        self._setDefault(inputCols=["R", "G", "B"], outputCols=["labL", "labA", "labB"])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        r, g, b = self.getInputCols()
        lab = rgb_to_lab_columns(F.col(r), F.col(g), F.col(b))
        return dataset.withColumns(dict(zip(self.getOutputCols(), lab)))


def training_set(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread a training set over the cluster's cores and keep it in memory.

    Iterative learners (L-BFGS, tree growing) pass over the data many times;
    one cached partition per core keeps every core busy on every pass. The
    cache is recomputed from lineage if an executor is lost.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n).cache()


def fit_on_kept_features(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """``pipeline.fit(train)`` for transformers and one learner: the learner's input is worked out once and kept.

    A forest passes over its input several times before it keeps a copy of its own, and would pair the days each time.
    """
    *steps, learner = pipeline.getStages()
    kept = PipelineModel(steps).transform(train).select(learner.getFeaturesCol(), learner.getLabelCol()).cache()
    try:
        return PipelineModel([*steps, learner.fit(kept)])
    finally:
        kept.unpersist()


def tmax_pipeline(with_yesterday: bool = True, num_trees: int = 40, max_depth: int = 10, seed: int = 123,
                  learner: str = "forest") -> Pipeline:
    """Next-day maximum temperature: SQL features -> vector -> tree ensemble."""
    days = [PreviousDay()] if with_yesterday else []
    inputs = ["latitude", "longitude", "elevation", "dayofyear"] + (["yesterday_tmax"] if with_yesterday else [])
    assemble = VectorAssembler(inputCols=inputs, outputCol="features")
    if learner == "gbt":
        model = GBTRegressor(featuresCol="features", labelCol="tmax", seed=seed, maxDepth=min(max_depth, 8))
    else:
        model = RandomForestRegressor(featuresCol="features", labelCol="tmax", numTrees=num_trees,
                                      maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[*days, SQLTransformer(statement=DAYOFYEAR_SQL), assemble, model])


def colour_pipeline(space: str = "rgb", n_labels: int = 11, hidden: int = 30, seed: int = 123,
                    max_iter: int = 100, label_col: str = "word", block_size: int = 128, weight_col: str | None = None) -> Pipeline:
    """Colour word from RGB (or LAB) with a one-hidden-layer perceptron.

    With ``weight_col`` a row counts as often as that column says, so equal
    rows may come once; the model is of the same kind. ``block_size`` only groups rows into matrices for the gradient; larger
    blocks train faster on big inputs (the default keeps Spark's 128).
    """
    stages = []
    if space == "lab":
        stages.append(RgbToLab())
        inputs = ["labL", "labA", "labB"]
    else:
        inputs = ["R", "G", "B"]
    layers = [3, hidden, n_labels]
    if weight_col:
        learner = WeightedPerceptron(layers, "features", "label_index", weight_col, seed=seed, max_iter=max_iter)
    else:
        learner = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_index", layers=layers, seed=seed,
                                                 maxIter=max_iter, blockSize=block_size)
    stages += [
        VectorAssembler(inputCols=inputs, outputCol="features"),
        StringIndexer(inputCol=label_col, outputCol="label_index", stringOrderType="alphabetAsc"),
        learner,
    ]
    return Pipeline(stages=stages)


def fit_quality(label: str = "tmax", prediction: str = "prediction") -> list[Column]:
    """``n``, ``r2`` and ``rmse`` as aggregates: one pass, with central moments, over rows where both values are known.

    r2 is null where the labels don't vary, and all but ``n`` where there is no row.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = y.isNotNull() & p.isNotNull()
    error = F.avg(F.when(both, (y - p) * (y - p)))
    return [F.count_if(both).alias("n"), (1 - F.try_divide(error, F.var_pop(F.when(both, y)))).alias("r2"), F.sqrt(error).alias("rmse")]


def regression_metrics(predictions: DataFrame, label: str = "tmax", prediction: str = "prediction") -> dict:
    """r² and RMSE of a scored frame, from one aggregate."""
    return predictions.agg(*fit_quality(label, prediction)).first().asDict()


def accuracy(predictions: DataFrame, label: str = "label_index", prediction: str = "prediction", weight: str | None = None) -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")
    return (ev.setWeightCol(weight) if weight else ev).evaluate(predictions)


def feature_importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``feature, importance`` of the final tree-ensemble stage."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(assembler.getInputCols(), map(float, imp))), "feature string, importance double")


def label_indexer(model: PipelineModel, output: str = "label_index") -> StringIndexerModel:
    """The stage of ``model`` that writes the label's index to ``output``."""
    for stage in model.stages:
        if stage.hasParam("outputCol") and stage.getOrDefault("outputCol") == output:
            return stage
    raise ValueError(f"no stage of the pipeline writes {output}")


def label_index(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``label_index, label`` of a fitted classifier."""
    return spark.createDataFrame(list(enumerate(label_indexer(model).labels)), "label_index int, label string")


def predict_labels(model: PipelineModel, rows: DataFrame, out: str = "predicted_word") -> DataFrame:
    """Score rows, which need no label, and turn the predicted index back into the label's text.

    The indexer only reads labels to train on, so the rows pass the other stages.
    """
    indexer = label_indexer(model)
    scored = PipelineModel([s for s in model.stages if s is not indexer]).transform(rows)
    return IndexToString(inputCol="prediction", outputCol=out, labels=indexer.labels).transform(scored)


def prediction_grid(spark: SparkSession, model: PipelineModel, lum: float = 70.0, resolution: int = 256) -> DataFrame:
    """Predicted word over a slice of LAB space with the word's representative colour."""
    scored = predict_labels(model, lab_grid(spark, lum=lum, resolution=resolution))
    return scored.select("row_index", "col_index", "labA", "labB", "R", "G", "B", "predicted_word",
                         representative_rgb(F.col("predicted_word")).alias("predicted_rgb"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
