import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.sql import functions as F

from tessera.operators import ml
from tessera.operators.perceptron import loss_and_gradient, minimise
from tessera.plans import data, ml_jobs


def test_gradient_is_the_slope_of_the_loss_and_weights_are_repeats():
    draw = np.random.default_rng(3)
    sizes = [2, 4, 3]
    rows = np.column_stack([draw.normal(size=(50, 2)), draw.integers(0, 3, 50), draw.integers(1, 5, 50)]).astype(float)
    w = draw.normal(size=2 * 4 + 4 + 4 * 3 + 3)
    out = loss_and_gradient([rows[:20], rows[20:]], w, sizes)
    for i in range(len(w)):
        up, down = (loss_and_gradient([rows], w + e * np.eye(len(w))[i], sizes)[-1] for e in (1e-5, -1e-5))
        assert out[i] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6)
    repeated = np.repeat(rows, rows[:, -1].astype(int), axis=0)
    repeated[:, -1] = 1
    assert loss_and_gradient([repeated], w, sizes) == pytest.approx(out)


def test_minimise_finds_the_bottom():
    def rosenbrock(x):
        a, b = 1 - x[0], x[1] - x[0] ** 2
        return float(a * a + 100 * b * b), np.array([-2 * a - 400 * x[0] * b, 200 * b])

    assert minimise(rosenbrock, np.array([-1.2, 1.0]), 200, 1e-14) == pytest.approx([1, 1], abs=1e-3)
    assert minimise(rosenbrock, np.array([1.0, 1.0]), 200, 1e-6).tolist() == [1, 1]


def test_weighted_rows_take_the_steps_of_sparks_own_learner_on_their_repeats(spark, tmp_out):
    rows = [(r, g, b, "dark" if r + g + b < 300 else "light", 1 + (r + b) // 100) for r in range(0, 256, 40) for g in range(0, 256, 40) for b in range(0, 256, 40)]
    df = spark.createDataFrame(rows, "R int, G int, B int, word string, n int")
    # in one block, as Spark's mean over blocks weighs the rows of a short last block more
    repeated = df.withColumn("k", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "k").coalesce(1)
    model = ml.colour_pipeline("lab", n_labels=2, max_iter=10, weight_col="n").fit(df)
    sparks = ml.colour_pipeline("lab", n_labels=2, max_iter=10, block_size=100_000).fit(repeated)
    assert isinstance(model.stages[-1], MultilayerPerceptronClassificationModel)
    assert model.stages[-1].weights.toArray() == pytest.approx(sparks.stages[-1].weights.toArray(), rel=1e-4, abs=1e-5)
    ml.save_model(model, f"{tmp_out}/m")
    loaded = PipelineModel.load(f"{tmp_out}/m")
    assert ml.accuracy(loaded.transform(df), weight="n") == pytest.approx(ml.accuracy(loaded.transform(repeated)))


def test_colour_models_train_on_each_colour_once(spark, tmp_out):
    items = spark.range(4000).select((F.col("id") % 900 * 7).alias("l_orderkey"), (F.col("id") % 900 * 13).alias("l_partkey"),
                                     (F.col("id") % 900 * 29).alias("l_suppkey"), F.lit("A").alias("l_returnflag"))
    items.write.parquet(f"{tmp_out}/lineitem.parquet")
    split = ml_jobs.colour_split(spark, tmp_out)
    with ml_jobs._colour_parts(spark, tmp_out) as parts:
        for part, name in zip(parts, ml_jobs.PARTS):
            want = split.filter(F.col("split") == name).groupBy("R", "G", "B", "word").count()
            assert sorted(map(tuple, part.select("R", "G", "B", "word", "n").collect())) == sorted(map(tuple, want.collect()))
        assert sum(p.count() for p in parts) == data.colours(items).select("R", "G", "B").distinct().count() < 4000
    assert [r.label for r in ml_jobs.colour_label_index(spark, tmp_out).collect()] == sorted({r.word for r in split.collect() if r.split == "train"})
