"""WARC records, and fixity audits of replicas by Merkle trees.

An archive is laid out in files of ``per_file`` records in a total order, so a
record has a file, a number in it and a byte offset. Each record is hashed;
``fanout`` neighbouring records, an ordered range of offsets, make a node
whose hash is taken over theirs, and so on up to the file's root. An audit
compares the roots of two replicas and goes down only below nodes that
differ, so two equal replicas cost one row per file, and damage is located to
the record and its offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, table

FANOUT, LEVELS = 16, 3
PER_FILE = FANOUT**LEVELS
CRLF = "\r\n"


def record(url: Column, payload: Column, number: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """The record as text: a WARC/1.1 resource record of the payload (nulls: empty)."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:x-page:"), F.coalesce(number.cast("string"), F.lit("")),
        F.lit(f">{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body).cast("string"),
        F.lit(CRLF * 2), body, F.lit(CRLF * 2),
    )


def digest(content: Column) -> Column:
    return F.sha2(content, 256)


def lay_out(records: DataFrame, id_col: str, per_file: int = PER_FILE) -> DataFrame:
    """``records`` (id, hash, length, ...) with ``file``, ``seq`` in it and ``offset``.

    The order is by id (null first), then hash, then length, with equal rows
    after each other. Rows are dealt into ranges of that order and numbered in
    each from the sum of the ranges before it; the driver sees one count per
    range. A hot id is spread over ranges by its hashes, equal rows by a
    number that their total order doesn't depend on.
    """
    parts = max(1, records.sparkSession.sparkContext.defaultParallelism)
    order = [F.col(id_col).asc_nulls_first(), F.col("hash"), F.col("length")]
    ranged = checkpointed(records.withColumn("_copy", F.monotonically_increasing_id())
                          .repartitionByRange(4 * parts, *order, F.col("_copy")).sortWithinPartitions(*order, F.col("_copy"))
                          .withColumn("_part", F.spark_partition_id()))
    starts, total = {}, 0
    for r in sorted(ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()):
        starts[r["_part"]] = total
        total += r["n"]
    shift = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]) if starts else F.create_map(F.lit(0), F.lit(0))
    # the id that Spark gives a row is its place in the partition, from 2^33 times the partition's number
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    numbered = ranged.withColumn("_at", shift[F.col("_part")] + place)
    numbered = numbered.withColumn("file", F.floor(F.col("_at") / per_file)).withColumn("seq", F.col("_at") % per_file)
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("_part", "_copy", "_at")


def merkle(records: DataFrame, hash_col: str, fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """Levels of (file, node, hash) from the records (level 0) to the roots; null hashes are missing records."""
    level = records.select("file", F.col("seq").alias("node"), F.col(hash_col).alias("hash"))
    out = [level]
    for _ in range(levels):
        part = F.collect_list(F.struct("node", F.coalesce("hash", F.lit("missing")).alias("hash")))
        level = level.groupBy("file", F.floor(F.col("node") / fanout).alias("parent")).agg(
            F.sha2(F.array_join(F.transform(F.sort_array(part), lambda x: x["hash"]), ""), 256).alias("hash"))
        level = level.withColumnRenamed("parent", "node")
        out.append(level)
    return out


def differing(one: list[DataFrame], other: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, node, hash_a, hash_b) of the records that differ between two trees over the same layout."""
    found = None
    for a, b in zip(reversed(one), reversed(other)):
        left, right = a.withColumnRenamed("hash", "hash_a"), b.withColumnRenamed("hash", "hash_b")
        if found is not None:  # below nodes that differ only
            below = found.select(F.col("file").alias("_file"), F.col("node").alias("_node"))
            on = (F.col("file") == F.col("_file")) & (F.floor(F.col("node") / fanout) == F.col("_node"))
            left, right = left.join(below, on, "left_semi"), right.join(below, on, "left_semi")
        found = left.join(right, ["file", "node"], "full").filter(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        if a is not one[0]:
            found = checkpointed(found)
    return found


def audit(replicas: DataFrame) -> DataFrame:
    """Damaged records of ``replicas`` (file, seq, offset, length, hash_a, hash_b, ...), with ``status``.

    A null hash says that a replica lacks the record. ``status`` is
    ``missing_a``, ``missing_b`` or ``altered``. Other columns are kept.
    """
    held = checkpointed(replicas)
    found = differing(merkle(held, "hash_a"), merkle(held, "hash_b")).select("file", F.col("node").alias("seq"))
    status = F.when(F.col("hash_a").isNull(), "missing_a").when(F.col("hash_b").isNull(), "missing_b").otherwise("altered")
    return held.join(found, ["file", "seq"]).withColumn("status", status)


def damaged(content: Column, number: Column) -> Column:
    """What the query's second replica stores: a few records cut short, overwritten or lost, by their number."""
    n = F.pmod(number, F.lit(101))
    half = F.floor(F.char_length(content) / 2).cast("int")
    return (F.when(n == 7, F.substring(content, F.lit(1), half))
            .when(n == 23, F.concat(F.substring(content, F.lit(1), half - 1), F.lit("?"), F.substring(content, half + 1, F.char_length(content))))
            .when(n == 61, F.lit(None).cast("string")).otherwise(content))


def op2_warc_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of the archive of all pages that has some damaged records; one row per damaged record."""
    pages = table(spark, sf_dir, "pages")
    content = record(F.col("url"), F.col("html"), F.col("page_id"))
    stored = pages.select("page_id", digest(content).alias("hash"), F.octet_length(content).cast("long").alias("length"),
                          digest(damaged(content, F.col("page_id"))).alias("hash_b"))
    replicas = lay_out(stored, "page_id").withColumnRenamed("hash", "hash_a")
    return audit(replicas).select("file", "seq", "offset", "length", "page_id", "hash_a", "hash_b", "status")


#: The same on DuckDB, comparing every record.
OP2_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:x-page:'
    || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\r\n]', ' ', 'g') || chr(13) || chr(10) || 'Content-Type: text/html'
    || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS content
  FROM pages
), h AS (
  SELECT page_id, content, sha256(content) AS hash_a, octet_length(encode(content)) AS length,
    sha256(CASE ((page_id % 101) + 101) % 101 WHEN 7 THEN substring(content, 1, length(content) // 2)
      WHEN 23 THEN substring(content, 1, length(content) // 2 - 1) || '?' || substring(content, length(content) // 2 + 1)
      WHEN 61 THEN NULL ELSE content END) AS hash_b
  FROM r
), n AS (
  SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, hash_a, length) - 1 AS place FROM h
), o AS (
  SELECT *, place // 4096 AS file, place % 4096 AS seq,
    coalesce(sum(length) OVER (PARTITION BY place // 4096 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM n
)
SELECT file, seq, "offset", length::BIGINT AS length, page_id, hash_a, hash_b, CASE WHEN hash_b IS NULL THEN 'missing_b' ELSE 'altered' END AS status
FROM o WHERE hash_a IS DISTINCT FROM hash_b
"""
