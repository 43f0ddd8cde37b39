"""A keyed table that changes atomically and only where it has to.

Rows are dealt by a hash of the key into buckets, and a *manifest* says which
folder holds each bucket. A load or merge writes new folders first and then
publishes the next manifest with one rename through Hadoop's file system; a
job that dies before that has changed nothing, and readers always see one
whole version. A merge rewrites the buckets that its keys fall into; the
others keep their files. A lookup by key reads the buckets of its keys only.

Layout: ``_manifests/<number>.json`` and ``data/<load>/store_bucket=<n>/``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.keyed import filter_keys, upsert_by_key
from tessera.session import hadoop_path

BUCKET = "store_bucket"


class Conflict(RuntimeError):
    """Another writer published the next version first."""


class KeyedStore:
    """The table at ``root``, keyed by ``key``, in ``buckets`` buckets (fixed when it is first written)."""

    def __init__(self, spark: SparkSession, root: str, key: str | Sequence[str], buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.buckets = buckets

    # versions ----------------------------------------------------------------

    def versions(self) -> list[int]:
        fs, folder = hadoop_path(self.spark, f"{self.root}/_manifests")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def _manifest(self, number: int | None = None) -> dict:
        if number is None:
            number = max(self.versions(), default=None)
            if number is None:
                raise FileNotFoundError(f"no version of {self.root} was ever published")
        fs, path = hadoop_path(self.spark, f"{self.root}/_manifests/{number:020d}.json")
        stream = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        if found["keys"] != self.keys:
            raise ValueError(f"{self.root} is keyed by {found['keys']}")
        return found | {"number": number}

    def _publish(self, number: int, folders: dict[str, str], schema: str, buckets: int) -> None:
        """The manifest ``number`` with one rename that fails if it is there: only one writer gets a number."""
        jvm = self.spark.sparkContext._jvm
        fs, staged = hadoop_path(self.spark, f"{self.root}/_manifests/staged-{uuid.uuid4().hex}")
        _, target = hadoop_path(self.spark, f"{self.root}/_manifests/{number:020d}.json")
        stream = fs.create(staged)
        stream.write(json.dumps({"keys": self.keys, "buckets": buckets, "schema": schema, "folders": folders}).encode())
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)
        except Py4JJavaError as error:
            fs.delete(staged, False)
            if fs.exists(target):
                raise Conflict(f"version {number} of {self.root} was published by another writer") from error
            raise

    # writing -----------------------------------------------------------------

    def _bucket(self, schema: StructType, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in self.keys]), F.lit(buckets)).cast("int")

    def _written(self, df: DataFrame, schema: StructType, buckets: int) -> dict[str, str]:
        """``df`` as new bucket folders, sorted by key inside. Large buckets (a hot key) are split over tasks and files by size."""
        load = f"data/{uuid.uuid4().hex}"
        dealt = df.withColumn(BUCKET, self._bucket(schema, buckets)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/{load}")
        fs, folder = hadoop_path(self.spark, f"{self.root}/{load}")
        names = [status.getPath().getName() for status in fs.listStatus(folder) if status.isDirectory()]
        return {n.split("=")[1]: f"{load}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def replace(self, df: DataFrame) -> DataFrame:
        """The table becomes ``df``; until that is wholly written, readers see the version before. Returns the new version."""
        if BUCKET in df.columns:
            raise ValueError(f"{BUCKET} is the store's own column")
        number = max(self.versions(), default=0) + 1
        self._publish(number, self._written(df, df.schema, self.buckets), df.schema.json(), self.buckets)
        return self.read(version=number)

    def merge(self, updates: DataFrame, seq: str | None = None, attempts: int = 3) -> DataFrame:
        """``updates`` written into the table, as :func:`~tessera.operators.keyed.upsert_by_key` does; returns the new version.

        Only buckets with an updated key are read and rewritten. If another
        writer publishes first, the merge is done again on that version.
        """
        if not self.exists():
            return self.replace(upsert_by_key(updates.limit(0), updates, self.keys, seq))
        for attempt in range(attempts):
            now = self._manifest()
            schema = StructType.fromJson(json.loads(now["schema"]))
            typed = updates.select(*[F.col(f.name).cast(f.dataType) for f in schema])
            touched = sorted(r[0] for r in typed.select(self._bucket(schema, now["buckets"])).distinct().collect())
            merged = upsert_by_key(self._open(now, touched), typed, self.keys, seq)
            folders = now["folders"] | self._written(merged, schema, now["buckets"])
            try:
                self._publish(now["number"] + 1, folders, now["schema"], now["buckets"])
                return self.read(version=now["number"] + 1)
            except Conflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError("unreachable")

    def vacuum(self, keep: int = 2, orphan_hours: float = 24.0) -> None:
        """Frees the versions before the last ``keep``, and folders of loads that died more than ``orphan_hours`` ago.

        Younger folders without a version may belong to a writer at work and stay.
        """
        numbers = self.versions()

        def loads(part: list[int]) -> set[str]:
            return {path.split("/")[1] for n in part for path in self._manifest(n)["folders"].values()}

        used, old = loads(numbers[-keep:]), loads(numbers[:-keep])
        fs, data = hadoop_path(self.spark, f"{self.root}/data")
        for number in numbers[:-keep]:
            fs.delete(hadoop_path(self.spark, f"{self.root}/_manifests/{number:020d}.json")[1], False)
        latest = time.time() - orphan_hours * 3600
        for status in fs.listStatus(data) if fs.exists(data) else ():
            name = status.getPath().getName()
            if name not in used and (name in old or status.getModificationTime() / 1000 < latest):
                fs.delete(status.getPath(), True)

    # reading -----------------------------------------------------------------

    def _open(self, manifest: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        wanted = manifest["folders"] if buckets is None else {str(b) for b in buckets} & set(manifest["folders"])
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        paths = [f"{self.root}/{manifest['folders'][b]}" for b in sorted(wanted, key=int)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """A whole version, the last by default."""
        return self._open(self._manifest(version))

    def lookup(self, keys: Iterable | DataFrame) -> DataFrame:
        """Rows with one of ``keys`` (of a one-column key): a list, or a DataFrame's first column of any size.

        The buckets of the keys are the scan; inside these a list reaches the
        Parquet reader as a filter, and files are sorted by key.
        """
        now = self._manifest()
        schema = StructType.fromJson(json.loads(now["schema"]))
        (key,) = self.keys
        if isinstance(keys, DataFrame):
            wanted = keys.select(F.col(keys.columns[0]).cast(schema[key].dataType).alias(key))
        else:
            keys = list(keys)
            wanted = self.spark.createDataFrame([(str(k),) for k in keys], f"`{key}` string").select(F.col(key).cast(schema[key].dataType))
        touched = [r[0] for r in wanted.select(self._bucket(schema, now["buckets"])).distinct().collect()]
        return filter_keys(self._open(now, touched), key, wanted if isinstance(keys, DataFrame) else keys)
