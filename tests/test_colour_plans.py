import re

import pytest
from pyspark.sql import functions as F

from plan_util import plan_text
from tessera.functions.colour import COLOUR_RGB, first_smallest
from tessera.operators.centroid import fit_centroids
from tessera.operators.partition import digest_part, digest_split
from tessera.plans import ml_jobs

#: Methods with more bytes of code than this are never compiled by the JVM: they run some ten times slower.
JIT_BYTES = 8000


@pytest.fixture()
def line_items(spark, tmp_out):
    rows = spark.range(3000).select((F.col("id") * 7).alias("l_orderkey"), (F.col("id") * 13 % 911).alias("l_partkey"),
                                    (F.col("id") * 29 % 401).alias("l_suppkey"), F.lit("A").alias("l_returnflag"))
    rows.write.parquet(f"{tmp_out}/lineitem.parquet")
    return tmp_out


def largest_method(df):
    df.collect()
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df._jdf.queryExecution().executedPlan()))))


def plain_words(rows):
    return [min(sorted(COLOUR_RGB), key=lambda w: sum((x - y) ** 2 for x, y in zip((r.R, r.G, r.B), COLOUR_RGB[w]))) for r in rows]


def test_colour_split_reads_the_table_once_in_code_that_is_compiled(spark, line_items):
    split = ml_jobs.colour_split(spark, line_items)
    assert plan_text(split, "simple").count("FileScan") == 1
    assert largest_method(split) < JIT_BYTES
    rows = split.collect()
    assert len(rows) == 3000 and [r.word for r in rows] == plain_words(rows)


def test_digest_part_names_the_part_of_digest_split(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 9 > 0, F.col("id") % 7).alias("k"))
    names, weights = ("a", "b", "c"), (2, 1, 1)
    want = {r.id: name for name, part in zip(names, digest_split(df, ["id", "k"], weights, 5)) for r in part.collect()}
    assert {r.id: r.p for r in df.withColumn("p", digest_part(names, ["id", "k"], weights, 5)).collect()} == want


def test_first_smallest_skips_nulls_and_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([(1, 3.0, 2.0, 2.0), (2, None, None, None), (3, None, 5.0, 4.0)], "id int, a double, b double, c double")
    got = {r.id: r.n for r in df.select("id", first_smallest([F.col(c) for c in "abc"], "abc").alias("n")).collect()}
    assert got == {1: "b", 2: None, 3: "c"}


def test_centroids_name_each_row_once(spark, line_items):
    split = ml_jobs.colour_split(spark, line_items).collect()
    accuracy = ml_jobs.colour_centroid_accuracy(spark, line_items)
    assert "md5" not in " ".join(re.findall(r"Filter .*", plan_text(accuracy, "simple")))
    assert largest_method(accuracy) < JIT_BYTES
    train = [r for r in split if r.split == "train"]
    centres = ml_jobs._centroids(spark, line_items)
    assert set(centres) == {r.word for r in train}
    for word, centre in centres.items():
        own = [r for r in train if r.word == word]
        assert centre == pytest.approx([sum(r[c] for r in own) / len(own) for c in "RGB"])
    validation = [r for r in split if r.split == "validation"]
    guess = [min(sorted(centres), key=lambda w: sum((r[c] - v) ** 2 for c, v in zip("RGB", centres[w]))) for r in validation]
    got = {r.word: (r.n, r.hits) for r in accuracy.collect()}
    assert got == {w: (sum(r.word == w for r in validation), sum(r.word == w == g for r, g in zip(validation, guess))) for w in {r.word for r in validation}}


def test_centroids_leave_out_null_labels_and_inputs(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 3, None), ("x", 5, 3), (None, 9, 9), ("y", None, 1)], "w string, a int, b int")
    assert fit_centroids(df, ("a", "b"), "w") == {"x": (3.0, 2.0)}


def test_grid_centroid_paints_by_the_training_rows_centroids(spark, line_items):
    rows = ml_jobs.colour_grid_centroid(spark, line_items, resolution=6).collect()
    assert len(rows) == 36 and {r.predicted_word for r in rows} <= set(ml_jobs._centroids(spark, line_items))
    # the centroids' own pass works the words out in its rows, not in a filter before them
    assert largest_method(ml_jobs._colour_split(spark, line_items)) < JIT_BYTES
