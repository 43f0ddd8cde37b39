"""Session factory and the shared scratch folder.

The scratch folder is where iterative jobs cut lineage (``DataFrame.checkpoint``),
where streams keep their checkpoints and where derived tables are materialised.
On a cluster it must be shared storage, so it is read from the session setting
``spark.checkpoint.dir``. Only a local-mode session without that setting (unit
tests, the bench) gets a fresh temporary folder.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets. Sizes that depend on the cluster
# (shuffle partitions, executor memory) are left to the caller.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def scale_conf(total_cores: int, largest_shuffle_bytes: int, target_partition_bytes: int = 256 * 1024**2,
               scan_split_bytes: int = 256 * 1024**2, max_partitions: int = 100_000) -> dict[str, str]:
    """Partition sizing for a cluster run, as Spark settings.

    Shuffle partitions are sized so the largest shuffle lands at about
    ``target_partition_bytes`` per partition (never fewer than 3 per core), so a
    reduce task fits in executor memory and spills little; AQE then coalesces
    small partitions towards the advisory size and splits skewed ones. Scan
    tasks read ``scan_split_bytes`` of input each. The count is capped at
    ``max_partitions``: shuffle blocks grow as map tasks x reduce partitions,
    so past the cap partitions get bigger instead (reducers spill to disk).
    """
    by_size = -(-int(largest_shuffle_bytes) // int(target_partition_bytes))
    partitions = max(3 * int(total_cores), min(by_size, int(max_partitions)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes) // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(int(target_partition_bytes)),
        "spark.sql.files.maxPartitionBytes": str(int(scan_split_bytes)),
    }


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and no UI."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and materialised tables.

    Order: ``spark.checkpoint.dir`` of the session, then the context's
    checkpoint folder; a local-mode session with neither gets a fresh
    temporary folder. Anything else is an error, since a machine-local
    folder on a cluster would lose data with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tessera-scratch-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder "
        "(HDFS, S3, ...) so checkpoints survive executor loss"
    )


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the scratch root; ``unique`` appends a random leaf."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex)
    return "/".join([scratch_root(spark), *leaf])


def hadoop_path(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path for it: works for any store that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def file_key(spark: SparkSession, path: str) -> str:
    """A digest of the files below ``path``: their paths, lengths and times. A missing path has one too."""
    fs, place = hadoop_path(spark, path)
    lines = []
    if fs.exists(place):
        if fs.getFileStatus(place).isFile():
            found = [fs.getFileStatus(place)]
        else:
            found, files = [], fs.listFiles(place, True)
            while files.hasNext():
                found.append(files.next())
        lines = sorted(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}" for f in found)
    return hashlib.sha256("\n".join([path.rstrip("/"), *lines]).encode()).hexdigest()


def committed(spark: SparkSession, path: str) -> bool:
    """True when a job finished writing ``path``: the file committer's
    ``_SUCCESS`` marker is there.

    A folder left by a job that died mid-write has no marker, so it is rebuilt
    rather than read as a partial table. (A cluster that turns the markers off
    just rebuilds every time.)
    """
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return bool(marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker))
