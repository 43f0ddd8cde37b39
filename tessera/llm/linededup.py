"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find.

1. Every line's 5-character shingles are hashed once and kept as the minimum
   per bin (one-permutation MinHash; empty bins borrow from filled ones).
   Twelve bands of five bins give its bucket keys: two lines of similarity 0.8
   share a bucket with probability 0.99 and more alike ones nearly always.
2. Lines of a bucket are compared by a sketch of one bit per bin, which only
   drops pairs far below the threshold, and hang together in clusters. A
   cluster is passed on as memberships (cluster, line), not as pairs.
3. Texts of clustered lines alone are brought together by cluster, and the
   Jaccard similarity of their shingle sets is computed exactly. Links are
   reported as a spanning forest.
4. Connected components over all links give the classes. The first line of a
   class, by document id and line number, is the one that is kept.

Equal lines have one hash (64 bits) and are one line in steps 1 to 4. Buckets
and clusters too large for one task are dealt out by pairs of blocks, so all
their pairs are still compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, free_name, table
from tessera.llm.components import components
from tessera.llm.simhash import Forest

SHINGLE, BANDS, ROWS = 5, 12, 5
BINS = BANDS * ROWS
SIMILARITY = 0.8
#: Sketches of lines at the threshold differ in 6 of 60 bits on average; 18 is over four standard deviations more.
SKETCH_BITS = 18
#: Lines of one bucket or cluster that one task compares; larger ones are split into blocks of this size.
BLOCK = 16_384
EMPTY = np.uint32(0xFFFFFFFF)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
_BLANK = r"[^\x20\x09-\x0D]"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _donors() -> np.ndarray:
    """For each attempt and bin, the bin that an empty one borrows from: fixed, so equal for all lines."""
    return np.random.default_rng(11).permuted(np.tile(np.arange(BINS), (BINS, 1)).T, axis=0)


DONORS = _donors()


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all shingles of ``lines`` in order, and how many each line has (a shorter line: one, itself padded)."""
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    h = codes[SHINGLE - 1:] * _ODD[SHINGLE - 1]
    for j in range(SHINGLE - 1):
        h += codes[j:len(codes) - SHINGLE + 1 + j] * _ODD[j]
    counts = sizes - SHINGLE + 1
    line = np.repeat(np.arange(len(lines)), counts)
    return _mix(h[np.arange(len(line)) + line * (SHINGLE - 1)]), counts  # windows across two lines are skipped


def signatures(lines: list[str]) -> np.ndarray:
    """One row of ``BINS`` minima (uint32) per line, from all its shingles."""
    h, counts = _hashed(lines)
    line = np.repeat(np.arange(len(lines)), counts)
    bins = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    out = np.full(len(lines) * BINS, EMPTY, dtype=np.uint32)
    np.minimum.at(out, line * BINS + bins.astype(np.int64), h.astype(np.uint32))
    out = out.reshape(len(lines), BINS)
    holes = out == EMPTY
    poor = np.flatnonzero(holes.any(axis=1))
    rows, empty = out[poor], holes[poor]
    for donor in DONORS.T:
        if not empty.any():
            break
        gives = ~holes[poor][:, donor]
        rows = np.where(empty & gives, out[poor][:, donor], rows)
        empty &= ~gives
    out[poor] = rows
    return out


def bucket_keys(found: np.ndarray) -> np.ndarray:
    """(line, band) keys as uint64."""
    keys = np.empty((len(found), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(found), band + 1, dtype=np.uint64)
        for j in range(ROWS):
            key = _mix(key * _ODD[0] + found[:, band * ROWS + j])
        keys[:, band] = key
    return keys


def sketches(found: np.ndarray) -> np.ndarray:
    """One bit of each bin's minimum, as uint64."""
    bits = (_mix(found.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(np.pad(bits, ((0, 0), (0, 64 - BINS))), axis=1, bitorder="little").view("<u8").ravel()


def line_id(line: str) -> int:
    """The same number as Spark's ``xxhash64`` of the line."""
    value = xxhash.xxh64_intdigest(line.encode("utf-8"), 42)
    return value - (1 << 64) if value >> 63 else value


def _bucketed(docs: DataFrame, text: str, hot: dict[int, int] | None) -> DataFrame:
    """(key, id, sketch) for each band of each line, a line once per batch; ``hot``: blocks of large buckets."""
    shared = docs.sparkSession.sparkContext.broadcast(hot or {})
    names = ["key", "id", "sketch"]

    def rows(lines: dict[str, int]) -> Iterator[pa.RecordBatch]:
        found = signatures(list(lines))
        ids = np.fromiter(lines.values(), np.int64, len(lines))
        keys, own = bucket_keys(found).view(np.int64), sketches(found).view(np.int64)
        key, line = keys.ravel(), np.repeat(np.arange(len(ids)), BANDS)
        if shared.value:
            split = np.isin(key, np.fromiter(shared.value, np.int64, len(shared.value)))
            more_keys, more_lines = [key[~split]], [line[~split]]
            for k, i in zip(key[split].tolist(), line[split].tolist()):
                blocks = shared.value[k]
                mine = int(ids[i]) % blocks
                pairs = np.array([[min(mine, b), max(mine, b)] for b in range(blocks)], dtype=np.uint64)
                made = _mix(np.uint64(k % (1 << 64)) ^ _mix(pairs[:, 0] * _ODD[1] + pairs[:, 1] + np.uint64(1)))
                more_keys.append(made.view(np.int64))
                more_lines.append(np.full(blocks, i))
            key, line = np.concatenate(more_keys), np.concatenate(more_lines)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[line]), pa.array(own[line])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[str] = set()
            lines, size = {}, 0
            for value in batch.column(0):
                for line in (value.as_py() or "").split("\n"):
                    if line not in seen and line.strip(" \t\n\x0b\x0c\r"):
                        seen.add(line)
                        lines[line] = line_id(line)
                        size += len(line)
                        if size > 1_000_000:
                            yield from rows(lines)
                            lines, size = {}, 0
            if lines:
                yield from rows(lines)

    return docs.select(text).mapInArrow(run, "key long, id long, sketch long")


def _groups(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """Sorted batches cut so that no group of equal ``column`` values spans two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(column)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _clusters(keyed: DataFrame) -> DataFrame:
    """(root, id): clusters of lines whose sketches hang together within a bucket; root is the smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches):
            key, ids, own = (part.column(i).to_numpy() for i in range(3))
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
            key, ids, own = key[fresh], ids[fresh], own[fresh].view(np.uint64)
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(start, len(key)))
            two = start[size == 2]
            two = two[np.bitwise_count(own[two] ^ own[two + 1]) <= SKETCH_BITS]
            roots, members = [ids[two], ids[two]], [ids[two], ids[two + 1]]
            for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                forest, mine = Forest(n), own[at:at + n]
                for i in range(0, n, 2_048):
                    for j in range(i, n, 2_048):
                        rows, columns = np.arange(i, min(n, i + 2_048)), np.arange(j, min(n, j + 2_048))
                        near = np.bitwise_count(mine[rows][:, None] ^ mine[columns][None, :]) <= SKETCH_BITS
                        if i == j:
                            np.fill_diagonal(near, False)
                        if near.any():
                            forest.block(near, rows, columns)
                root = np.array([forest.find(x) for x in range(n)])
                big = np.bincount(root, minlength=n)[root] > 1
                roots.append(ids[at + root[big]])
                members.append(ids[at:at + n][big])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(roots)), pa.array(np.concatenate(members))], names=["root", "id"])

    return keyed.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "root long, id long").distinct()


def shingles(line: str) -> frozenset[str]:
    """A line's shingles by their definition; ``shingle_sets`` are their hashes."""
    if len(line) < SHINGLE:
        line = line.ljust(SHINGLE, "\0")
    return frozenset([line[i:i + SHINGLE] for i in range(len(line) - SHINGLE + 1)])


def alike(a: frozenset, b: frozenset, similarity: float) -> bool:
    """Whether the Jaccard similarity is at least ``similarity``, exactly."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    shared = len(a & b)
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


def shingle_sets(lines: list[str], chars: int = 1_000_000) -> list[np.ndarray]:
    """Each line's distinct shingles as sorted 64-bit hashes, worked out for about ``chars`` characters at a time."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size < chars):
            size += len(lines[end])
            end += 1
        h, counts = _hashed(lines[at:end])
        out += [np.unique(x) for x in np.split(h, np.cumsum(counts)[:-1])]
        at = end
    return out


def alike_sets(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """:func:`alike` on ``shingle_sets``."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # two sorted runs are merged
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


#: Bits of the map that bounds what two sets share.
MAP = 4_096


def spanning_links(sets: list[np.ndarray], block: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of ``similarity`` or more that connect whatever such pairs connect; of sets in two blocks only pairs between these.

    A pair is compared exactly unless it is connected already or can't be
    alike: by its sizes, or as the sets' bit maps share too few bits. The
    second bound counts for each set what its map hides, so it is never below
    the number of common shingles.
    """
    n = len(sets)
    if n == 2:
        return [(0, 1)] if alike_sets(*sets, similarity) else []
    crossing = bool((block != block[0]).any())  # two blocks of a large cluster: pairs within one are another group's
    size = np.fromiter(map(len, sets), np.int64, n)
    maps = np.empty((n, MAP // 64), dtype=np.uint64)
    for at in range(0, n, 1_024):
        part = sets[at:at + 1_024]
        bits = np.zeros((len(part), MAP), dtype=bool)
        bits[np.repeat(np.arange(len(part)), size[at:at + 1_024]), (np.concatenate(part) % np.uint64(MAP)).astype(np.int64)] = True
        maps[at:at + 1_024] = np.packbits(bits, axis=1).view(np.uint64)
    hidden = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    label, links = np.arange(n), []
    for i in range(n - 1):
        open_ = label[i + 1:] != label[i]
        if crossing:
            open_ &= block[i + 1:] != block[i]
        js = np.flatnonzero(open_) + i + 1
        js = js[np.minimum(size[i], size[js]) >= similarity * np.maximum(size[i], size[js]) - 1e-9]
        if len(js) > 4:
            common = np.bitwise_count(maps[i] & maps[js]).sum(axis=1, dtype=np.int64) + np.minimum(hidden[i], hidden[js])
            js = js[common >= similarity * (size[i] + size[js] - common) - 1e-9]
        for j in js.tolist():
            if label[j] != label[i] and alike_sets(sets[i], sets[j], similarity):
                label[label == label[j]] = label[i]
                links.append((i, j))
    return links


def _verified(held: DataFrame, similarity: float) -> DataFrame:
    """(a, b): a spanning forest of the exact links in each cluster of ``held`` (cluster, block, id, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches):
            cluster, block, ids = (part.column(i).to_numpy() for i in range(3))
            lines = part.column(3)
            start = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1]]))
            a, b = [], []
            for at, end in zip(start.tolist(), np.append(start[1:], len(cluster)).tolist()):
                if end - at > 1:
                    links = spanning_links(shingle_sets(lines.slice(at, end - at).to_pylist()), block[at:end], similarity)
                    a += [ids[at + i] for i, _ in links]
                    b += [ids[at + j] for _, j in links]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return held.repartition("cluster").sortWithinPartitions("cluster", "id").mapInArrow(run, "a long, b long")


def lines_of(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``pos``, ``line`` for every line with a word."""
    exploded = docs.select(*keep, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("pos", "line"))
    return exploded.filter(F.col("line").rlike(_BLANK))


def _hot_buckets(docs: DataFrame, text: str, part: float = 0.02) -> dict[int, int]:
    """Buckets that a sample of the documents shows to hold over ``BLOCK`` lines and a ten-thousandth of all entries.

    At most ten thousand keys by that definition. Missing one costs time in one task, not links.
    """
    counts = _bucketed(docs.sample(part, seed=5), text, None).groupBy("key").agg(F.count_distinct("id").alias("n"))
    counts = checkpointed(counts.filter(F.col("n") >= 16))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(BLOCK * part, total / 10_000)
    return {r["key"]: int(r["n"] / part // BLOCK) + 1 for r in counts.filter(F.col("n") > least).collect()}


def line_links(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): line ids whose links connect all lines of ``similarity`` or more that share a bucket."""
    members = checkpointed(_clusters(_bucketed(docs, text, _hot_buckets(docs, text))))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).alias("block")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)).alias("other")
    dealt = members.join(sizes, "root").select("root", "id", block, other)
    dealt = dealt.select(F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("cluster"), "block", "id")
    wanted = members.select("id").distinct()
    own = lines_of(docs, text, []).select(F.xxhash64("line").alias("id"), "line")
    texts = own.groupBy("id").agg(F.first("line").alias("line")).join(wanted, "id")
    return _verified(dealt.join(texts, "id").select("cluster", "block", "id", "line"), similarity)


def line_classes(docs: DataFrame, text: str = "text", id_col: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row per line with a word: its document and number, the place of its class's first line, and ``kept``.

    Columns: ``id_col``, ``text_hash`` (of the document's text), ``line_no``
    (from 0, blank lines counted), ``class_doc_id``, ``class_line_no``,
    ``kept``. The first line of a class is the one with the smallest id (null
    last), text hash and number. Null and empty texts have no lines; equal
    rows are one document, whose copies all keep the same lines.
    """
    links = checkpointed(line_links(docs, text, similarity))
    roots = components(links)
    places = lines_of(docs.withColumn("_hash", F.xxhash64(text)).select(F.col(id_col).alias("doc"), "_hash", F.col(text).alias("text")),
                      "text", ["doc", "_hash"])
    places = places.select("doc", "_hash", "pos", F.xxhash64("line").alias("id"))
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "_hash", "pos")
    firsts = places.groupBy("id").agg(F.min(place).alias("first"))
    linked = checkpointed(firsts.join(roots.withColumnRenamed("node", "id"), "id", "left"))
    # lines without a link are a class each and take no part in the join
    several, alone = linked.filter(F.col("root").isNotNull()), linked.filter(F.col("root").isNull())
    groups = several.groupBy("root").agg(F.min("first").alias("keeper"))
    chosen = checkpointed(several.join(groups, "root").select("id", "keeper").unionAll(alone.select("id", F.col("first").alias("keeper"))))
    found = places.join(chosen, "id")
    return found.select(
        F.col("doc").alias(id_col), F.col("_hash").alias("text_hash"), F.col("pos").alias("line_no"),
        F.col("keeper.doc").alias("class_doc_id"), F.col("keeper.pos").alias("class_line_no"),
        (F.col("doc").eqNullSafe(F.col("keeper.doc")) & (F.col("_hash") == F.col("keeper._hash")) & (F.col("pos") == F.col("keeper.pos"))).alias("kept"),
    )


def keep_first_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id", chars: str = "n_chars", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the lines that are not the first of their class; ``chars`` is counted anew.

    Blank lines stay. A document that loses all its lines with a word is
    removed; one without any stays as it is. Texts are shuffled once.
    """
    gone, key, hash_ = (free_name(docs, n) for n in ("_gone", "_key", "_hash"))

    def name(column: Column) -> Column:  # ids as text, so that null equals null in the join
        return F.coalesce(column.cast("string"), F.lit("null"))

    found = line_classes(docs, text, id_col, similarity)
    dropped = found.groupBy(name(F.col(id_col)).alias(key), F.col("text_hash").alias(hash_)).agg(
        F.collect_set(F.when(~F.col("kept"), F.col("line_no"))).alias(gone), F.bool_or("kept").alias(gone + "_any"))
    dropped = dropped.filter(F.size(gone) > 0)
    own = docs.withColumn(key, name(F.col(id_col))).withColumn(hash_, F.xxhash64(text)).join(dropped, [key, hash_], "left")
    own = own.filter(F.col(gone).isNull() | F.col(gone + "_any"))
    lines = F.split(F.col(text), "\n", -1)
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)), lambda i: lines[i])
    own = own.withColumn(text, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(rest, "\n")))
    if chars in docs.columns:
        own = own.withColumn(chars, F.when(F.col(gone).isNull(), F.col(chars)).otherwise(F.char_length(text).cast(docs.schema[chars].dataType)))
    return own.select(*docs.columns)


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its class and whether it is kept."""
    found = line_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_no", "class_doc_id", "class_line_no", "kept")
