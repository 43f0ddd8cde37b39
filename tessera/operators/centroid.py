"""Nearest-centroid classification: class means from one aggregate, prediction as one column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.colour import first_smallest

#: Labels whose centroids may be put into an expression.
MAX_LABELS = 256


def fit_centroids(train: DataFrame, inputs: Sequence[str], label: str, max_labels: int = MAX_LABELS) -> dict[str, tuple[float, ...]]:
    """The mean of ``inputs`` per ``label``. Rows with a null label or input are left out.

    One aggregate with partial sums, and no filter before it: Spark would work out a derived label
    a second time for each row to filter on it. The driver holds a row per label; more than
    ``max_labels`` labels are an error, as such a model is no expression.
    """
    known = F.lit(True)
    for c in (label, *inputs):
        known = known & F.col(c).isNotNull()
    means = train.groupBy(label).agg(*[F.avg(F.when(known, F.col(c))).alias(c) for c in inputs], F.count_if(known).alias("__known"))
    rows = means.filter(F.col("__known") > 0).limit(max_labels + 1).collect()
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {label}")
    return {r[label]: tuple(float(r[c]) for c in inputs) for r in sorted(rows, key=lambda r: r[label])}


def nearest_centroid(inputs: Sequence[str], centroids: Mapping[str, Sequence[float]]) -> Column:
    """The label of the nearest centroid (squared distance; ties go to the first label); null if an input is null or there is none."""
    if not centroids:
        return F.lit(None).cast("string")

    def away(centre: Sequence[float]) -> Column:
        terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(inputs, centre)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    # a null input makes every distance null, and so the label
    labels = sorted(centroids)
    return first_smallest([away(centroids[label]) for label in labels], labels)
