"""Fitted models kept in the shared scratch folder: trained once per input, loaded by every later job.

A model's folder is named by a key of everything it depends on: the files of
its input tables (path, length and time, listed through Hadoop's file system,
so any store works) and its settings. It is saved beside its place and moved
there when complete; a folder without the mark of a complete save is never
loaded. Two jobs that train the same model at once both save; one of them is kept.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tessera.session import file_key, hadoop_path, scratch_path

#: Written last into a saved model.
MARK = "_COMPLETE"


def model_key(spark: SparkSession, inputs: Sequence[str], settings: dict) -> str:
    """A key of the files below ``inputs``, the settings and the Spark version (a model is read by the version that wrote it)."""
    parts = [*[file_key(spark, path) for path in inputs], json.dumps(settings, sort_keys=True, default=str), spark.version]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def _complete(spark: SparkSession, path: str) -> bool:
    fs, mark = hadoop_path(spark, f"{path}/{MARK}")
    return fs.exists(mark)


def store_model(spark: SparkSession, model: PipelineModel, path: str) -> None:
    """``model`` at ``path``, complete or not at all; a complete one that is there already stays."""
    staged = f"{path}.{uuid.uuid4().hex}"
    model.write().save(staged)
    fs, mark = hadoop_path(spark, f"{staged}/{MARK}")
    fs.create(mark).close()
    source, target = hadoop_path(spark, staged)[1], hadoop_path(spark, path)[1]
    if fs.exists(target) and not _complete(spark, path):
        fs.delete(target, True)
    # a rename onto a folder that appeared meanwhile puts ours inside it or fails: the other's is as good
    if _complete(spark, path) or not fs.rename(source, target):
        fs.delete(source, True)
        if not _complete(spark, path):
            raise OSError(f"{staged} could not be moved to {path}")


def fitted(spark: SparkSession, name: str, key: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model ``name`` for ``key``: loaded if it is stored complete, else trained by ``fit`` and stored.

    Always returned as loaded, so that a first job and a later one score alike.
    """
    path = scratch_path(spark, "models", name, key)
    if not _complete(spark, path):
        store_model(spark, fit(), path)
    return PipelineModel.load(path)
