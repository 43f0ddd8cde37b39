"""Remaining inventory items: keyed-table reader, driver rows, SQL views,
stream output modes, partition control, hash split."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.partition import cached, hash_split, rebalance, single_file
from tessera.sinks.files import replace_table
from tessera.sources.files import read_table, register, rows, with_source_file
from tessera.streaming.regression import file_stream, running_fit, start_stream


def test_read_table_formats_and_register(spark, tmp_out):
    replace_table(spark.range(3).withColumn("s", F.lit("x")), f"{tmp_out}/kt")
    assert read_table(spark, f"{tmp_out}/kt").count() == 3
    spark.range(2).write.json(f"{tmp_out}/js")
    assert read_table(spark, f"{tmp_out}/js", fmt="json").count() == 2
    register(read_table(spark, f"{tmp_out}/kt"), "kt_view")
    assert spark.sql("SELECT count(*) AS n FROM kt_view").first().n == 3


def test_rows_with_declared_schema(spark):
    import datetime

    df = rows(spark, [("s", datetime.date(2020, 11, 13), 49.2771, -122.9146, 330.0, 12.0)], schemas.TMAX)
    assert df.schema == schemas.TMAX and df.count() == 1


def test_with_source_file(spark, tmp_out):
    spark.range(2).write.parquet(f"{tmp_out}/src")
    paths = {r.source_file for r in with_source_file(spark.read.parquet(f"{tmp_out}/src")).collect()}
    assert all(p.endswith(".parquet") and "src" in p for p in paths)


def test_stream_output_modes(spark, tmp_out):
    import os

    os.makedirs(f"{tmp_out}/in")
    with open(f"{tmp_out}/in/a.txt", "w") as f:
        f.write("1 2\n2 4\n")
    from tessera.streaming.regression import parse_points

    fit = running_fit(parse_points(file_stream(spark, f"{tmp_out}/in", "value string", fmt="text")))
    for mode in ("update", "complete"):
        q = start_stream(fit, mode=mode, sink="memory", available_now=True, queryName=f"fit_{mode}")
        q.awaitTermination(120)
        assert spark.table(f"fit_{mode}").orderBy(F.col("n").desc()).first().slope == pytest.approx(2.0)
    with pytest.raises(AnalysisException):
        start_stream(fit, mode="append", sink="memory", available_now=True, queryName="fit_append")


def test_partition_control(spark):
    df = spark.range(100)
    assert rebalance(df, 7).rdd.getNumPartitions() == 7
    assert rebalance(df, 5, "id").rdd.getNumPartitions() == 5
    assert rebalance(df).count() == 100
    assert single_file(df.repartition(4)).rdd.getNumPartitions() == 1
    with cached(df) as c:
        assert c.is_cached and c.count() == 100
    assert not df.is_cached


def test_hash_split_is_reproducible_and_complete(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 997)
    a1, b1 = hash_split(df, "k", (0.75, 0.25), seed=1)
    a2, b2 = hash_split(df.repartition(13), "k", (0.75, 0.25), seed=1)
    ids = lambda d: sorted(r.id for r in d.select("id").collect())
    assert ids(a1) == ids(a2) and ids(b1) == ids(b2)
    assert len(ids(a1)) + len(ids(b1)) == 5000
    assert 0.65 < len(ids(a1)) / 5000 < 0.85
    keys_a = {r.k for r in a1.select("k").distinct().collect()}
    keys_b = {r.k for r in b1.select("k").distinct().collect()}
    assert not keys_a & keys_b
    parts = hash_split(df, "k", (1, 1, 1), seed=2)
    assert sum(p.count() for p in parts) == 5000


def test_scale_conf():
    from tessera.session import scale_conf

    big = scale_conf(8000, 100 * 1024**4)  # 100 TiB shuffle on 8,000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000  # capped: 1 GiB partitions
    mid = scale_conf(1000, 5 * 1024**4)
    assert int(mid["spark.sql.shuffle.partitions"]) == 20480
    small = scale_conf(8, 10 * 1024**2)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_spread_if_uneven(spark, tmp_out):
    from tessera.operators.partition import spread_if_uneven

    one = spark.range(1000).coalesce(1)
    assert spread_if_uneven(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(spark.sparkContext.defaultParallelism)
    assert spread_if_uneven(many) is many


def test_spread_skips_check_for_many_files(spark, tmp_out):
    from tessera.operators.partition import spread_if_uneven

    n = spark.sparkContext.defaultParallelism
    spark.range(1000).repartition(n * 2).write.parquet(f"{tmp_out}/many")
    many = spark.read.parquet(f"{tmp_out}/many")
    assert len(many.inputFiles()) >= n and spread_if_uneven(many) is many
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_out}/one")
    one = spark.read.parquet(f"{tmp_out}/one")
    assert spread_if_uneven(one).rdd.getNumPartitions() == n


def test_spread_line_input_without_a_job(spark, tmp_out):
    """One gzip text file is one scan split: spread, decided with no job; many
    splits of plain text: left alone, also with no job."""
    import gzip

    from tessera.operators.partition import spread_if_uneven
    from tessera.sources.files import read_lines

    with gzip.open(f"{tmp_out}/a.txt.gz", "wt") as f:
        f.write("\n".join(f"line {i}" for i in range(5000)))
    with open(f"{tmp_out}/b.txt", "w") as f:
        f.write("\n".join(f"line {i}" for i in range(200_000)))
    sc, n = spark.sparkContext, spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sc.setJobGroup("spread-lines", "no job expected")
    try:
        spread = spread_if_uneven(read_lines(spark, f"{tmp_out}/a.txt.gz"), splits_hold_rows=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        plain = read_lines(spark, f"{tmp_out}/b.txt")
        kept = spread_if_uneven(plain, splits_hold_rows=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sc.statusTracker().getJobIdsForGroup("spread-lines") == []
    assert spread.rdd.getNumPartitions() == n and spread.count() == 5000
    assert kept is plain


def test_kafka_source_is_wired(spark):
    from tessera.streaming.regression import kafka_stream

    # the Kafka connector is not on this class path: Spark must say so, nothing else may fail
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:9092", "points")


def test_console_sink_update_mode(spark, tmp_out, capfd):
    import os

    from tessera.streaming.regression import parse_points

    os.makedirs(f"{tmp_out}/c")
    with open(f"{tmp_out}/c/a.txt", "w") as f:
        f.write("1 2\n2 4\n")
    fit = running_fit(parse_points(file_stream(spark, f"{tmp_out}/c", "value string", fmt="text")))
    q = start_stream(fit.select("slope", "intercept"), mode="update", sink="console", available_now=True)
    q.awaitTermination(120)
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] == 2


def test_committed_needs_the_success_marker(spark, tmp_out):
    from tessera.session import committed

    path = f"{tmp_out}/t"
    assert not committed(spark, path)
    spark.range(10).write.parquet(path)
    assert committed(spark, path)
    # data files without the marker (a job that died mid-write) do not count
    os.remove(f"{path}/_SUCCESS")
    assert not committed(spark, path)
