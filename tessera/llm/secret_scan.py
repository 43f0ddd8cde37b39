"""Secret scans: fixed patterns, and corpus-wide ownership of what they and an entropy test find.

Each text is scanned once for the fixed (base) kinds and for ``key`` candidates:
long random-looking strings that no base span touches. Every found value is
hashed; the corpus counts the distinct owners, repositories and documents of
each hash. A value that many of the corpus's owners or repositories hold, or
very many documents, is a widely copied example; any other looks live. ``key``
candidates become spans only if they look live; base spans always stay. Values
themselves never leave the scanning task.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, table

# The base kinds in the order that breaks ties of start.
KINDS = ("assign", "access", "hex", "key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # whole runs, so the same as runs of 20 and more characters
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "secret", "token", "api")
KEY = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Copies below which a value of few owners is never a copied example; the square root of all documents, where that is more.
MANY_COPIES = 100


def entropy(value: str) -> float:
    """Bits per character."""
    return sum(-n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) if value else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the base kinds, leftmost and non-overlapping within a kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        # a short value is dropped after it was matched: it may hide a later match, as in any leftmost scan
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def key_spans(text: str, base: list[tuple[int, int, int, str]], min_entropy: float = 3.5) -> list[tuple[int, int, int, str]]:
    """Random-looking strings with letters and digits that touch no base span."""
    out = []
    for m in KEY.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= min_entropy:
            if not any(start < m.end() and m.start() < end for start, _, end, _ in base):
                out.append((m.start(), 3, m.end(), value))
    return out


SPAN = "struct<start:bigint,kind:int,end:bigint,hash:string>"


def scan(docs: DataFrame, text: str, id_col: str, owner: Column, repository: Column, min_entropy: float) -> DataFrame:
    """One row per row of ``docs``: its id, owner, repository and found spans with hashed values."""
    own = docs.select(F.col(id_col).alias("id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.col(text).alias("text"))
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("hash", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for value in batch.column(3):
                content = value.as_py() or ""
                base = base_spans(content)
                spans.append([
                    {"start": start, "kind": kind, "end": end, "hash": hashlib.blake2b(found.encode(), digest_size=16).hexdigest()}
                    for start, kind, end, found in base + key_spans(content, base, min_entropy)
                ])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, pa.list_(span))], names=["id", "owner", "repository", "spans"])

    id_type = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {id_type}, owner string, repository string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash of ``found`` (hash, owner, repository; once a document): distinct owners and repositories, and copies.

    Counted in two steps, each with partial sums in the tasks, so a value that
    a third of all rows hold is one row per task and owner.
    """
    held = found.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("copies"))
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("copies").alias("copies"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("copies").alias("copies"))


def widely_copied(rows: DataFrame, max_owners: int, many_copies: int) -> Column:
    """Of a row of ``ownership``: whether it is held by many of the owners or repositories of ``rows``, or in many copies.

    Many is the square root of how many there are: it grows with the corpus,
    so a stray copy of a live key doesn't reach it. ``max_owners`` and fewer
    owners or repositories, and fewer than ``many_copies`` copies, are never many.
    """
    by_repository = rows.groupBy("owner", "repository").agg(F.count(F.lit(1)).alias("documents"))
    by_owner = by_repository.groupBy("owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("documents").alias("documents"))
    whole = by_owner.agg(F.count(F.lit(1)).alias("owners"), F.coalesce(F.sum("repositories"), F.lit(0)).alias("repositories"),
                         F.coalesce(F.sum("documents"), F.lit(0)).alias("documents")).first()

    def many(name: str) -> Column:
        return (F.col(name) > max_owners) & (F.col(name) * F.col(name) >= whole[name])

    return many("owners") | many("repositories") | (F.col("copies") >= max(many_copies, math.isqrt(whole["documents"])))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id", owner: Column | None = None,
                 repository: Column | None = None, max_owners: int = 1, min_entropy: float = 3.5, many_copies: int = MANY_COPIES) -> DataFrame:
    """One row per row of ``docs``: its spans, and how many of its values look live or copied.

    ``owner`` is ``source`` by default and ``repository`` the source and
    language. Columns: the id, ``base`` and ``spans`` (arrays of start, kind,
    end), ``n_live`` (spans whose value isn't ``widely_copied``) and ``n_copied``.
    Null and empty texts have no spans. A null owner counts as one owner.
    Repeated rows each get a row and count as copies of one owner; a value
    repeated within a row is one copy.
    The scan is checkpointed, so row numbers stay as they are when an executor
    is lost; texts are read once and never shuffled.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    rows = checkpointed(scan(docs, text, id_col, owner, repository, min_entropy).withColumn("row", F.monotonically_increasing_id()))
    found = rows.select("row", "owner", "repository", F.explode("spans").alias("span"))
    held = ownership(rows.select("owner", "repository", F.explode(F.array_distinct("spans.hash")).alias("hash")))
    place = F.struct("span.start", "span.kind", "span.end")
    live = ~F.col("copied")
    held = held.select("hash", widely_copied(rows, max_owners, many_copies).alias("copied"))
    known = found.select("row", "span", F.col("span.hash").alias("hash")).join(held, "hash").groupBy("row").agg(
        F.collect_list(F.when(live & (F.col("span.kind") == 3), place)).alias("added"),
        F.count_if(live).alias("n_live"), F.count_if(~live).alias("n_copied"),
    )
    base = F.transform(F.filter("spans", lambda s: s["kind"] < 3), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = rows.select("row", F.col("id").alias(id_col), base.alias("base")).join(known, "row", "left")
    spans = F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
    return joined.select(id_col, "base", spans.alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def op8_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; digests of the base spans and all spans as text."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"), "n_live", "n_copied",
    )
