"""Document fingerprints by a threshold-scaled sketch.

A sketch holds every hash of the text's k-word shingles (A-Z lower-cased) that lies below `fraction` of the hash
range. What a sketch keeps depends on the shingle alone, so sketches of parts merge by union, sketches of very
unequal texts compare (|A and B| / |A| estimates how much of A lies in B), and equal texts have equal sketches.
A sketch grows with its text and is never cut.

Defined results: null text is empty; an empty text, and by chance a short one, has an empty sketch; two empty
sketches are alike (1.0) exactly when the texts are equal, an empty and a filled one are not (0.0). Other columns of
the input are ignored, repeated rows are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from quotewell.llm import words

FRACTION = 1 / 8
SHINGLE = 5


def sketch_texts(texts: list[str | None], fraction: float = FRACTION, k: int = SHINGLE) -> list[np.ndarray]:
    """Ascending distinct hashes below the threshold, one array per text."""
    data, offsets = words.from_texts(texts)
    return _sketch(data, offsets, fraction, k)


def _sketch(data: np.ndarray, offsets: np.ndarray, fraction: float, k: int) -> list[np.ndarray]:
    hashes, bounds = words.Words(data, offsets, fold=True).shingles(k)
    kept = np.flatnonzero(hashes < np.uint64(min(int(fraction * 2**64), 2**64 - 1)))
    cut = np.searchsorted(kept, bounds)
    hashes = hashes[kept]
    return [np.unique(hashes[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def as_lists(sketches: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
    flat = np.concatenate(sketches) if sketches else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION, k: int = SHINGLE) -> DataFrame:
    """(key, fingerprint array<bigint>) of every row, without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), as_lists(_sketch(data, offsets, fraction, k))], [key, "fingerprint"]
                )

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fingerprint array<bigint>")


def merged(sketches: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """Union of the sketches of each group as rows (by, hash): no group has to fit into one task."""
    return sketches.select(by, F.explode(fingerprint).alias("hash")).distinct()


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketch columns; NULL when both are empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; NULL when a's sketch is empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a).cast("double"))


def with_place(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(seq, guest, key, mark, text): rows dealt into buckets by descending key, each bucket followed by its guest.

    The guest is a copy of the first row of the next bucket that has rows (after the last bucket: of the first), so
    sorting a bucket by (guest, key descending, mark descending) puts every row's successor right behind it. Rows of
    one key are ordered by `mark`, a hash of the text. Rows without a key come last, spread over 16 buckets.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(
        F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 100 * buckets).alias("cuts")
    ).first()["cuts"]
    splits = sorted({float(c) for c in cuts or [0]})
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit("\0"))).alias("mark"), F.col(text).alias("text"))
    rows = rows.withColumn("number", F.col("key").cast("double"))
    rows = Bucketizer(splits=[-np.inf, *splits, np.inf], inputCol="number", outputCol="bucket", handleInvalid="keep").transform(rows)
    last = len(splits)
    # Marks descend within a bucket, so the buckets of rows without a key descend by the mark's upper four bits too.
    rows = rows.withColumn(
        "seq",
        F.when(F.col("key").isNull(), F.lit(last + 16) - F.shiftright("mark", 60)).otherwise(last - F.col("bucket")).cast("int"),
    ).select("seq", "key", "mark", "text")
    heads = rows.groupBy("seq").agg(F.max(F.struct("key", "mark")).alias("head")).collect()  # a row per bucket
    heads = sorted((r["seq"], r["head"]["key"], r["head"]["mark"]) for r in heads)
    if not heads:
        return rows.select("seq", F.lit(False).alias("guest"), "key", "mark", "text")
    before = {seq: heads[i - 1][0] for i, (seq, _, _) in enumerate(heads)}
    firsts = spark.createDataFrame(
        [(before[s], s, k, m) for s, k, m in heads], f"host int, seq int, key {docs.schema[key].dataType.simpleString()}, mark bigint"
    )
    guests = (
        rows.alias("r")
        .join(F.broadcast(firsts.alias("f")), (F.col("r.seq") == F.col("f.seq")) & F.col("r.key").eqNullSafe(F.col("f.key")) & (F.col("r.mark") == F.col("f.mark")), "left")
        .select("r.*", "f.host")
    )
    places = F.array(
        F.struct(F.col("seq").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("host").alias("at"), F.lit(True).alias("guest"))
    )
    return (
        guests.select(F.explode(places).alias("p"), "key", "mark", "text")
        .filter("p.at IS NOT NULL")
        .select(F.col("p.at").alias("seq"), "p.guest", "key", "mark", "text")
    )


def _pair(a: np.ndarray, b: np.ndarray, equal: bool) -> tuple[float, float]:
    """Jaccard similarity and the share of a in b."""
    if not len(a) or not len(b):
        same = 1.0 if equal and not len(a) and not len(b) else 0.0
        return same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / len(a)


def against_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION, k: int = SHINGLE) -> DataFrame:
    """Every row's sketch, its edited text's, and how alike they and the next row's are.

    The edit replaces the last third of the code points (rounded down) by as many first ones of the next text in
    descending key order, the first text following the last. Texts are shuffled once; a task streams over its
    buckets and holds a few MB of them.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "within_edited", "within_next"]

    def digest(rows: list[tuple]) -> pa.RecordBatch | None:
        """All rows but the last and guests, each against the row behind it if that is in the same bucket."""
        own = sketch_texts([r[3] for r in rows], fraction, k)
        at = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][1]]
        edited = []
        for i in at:
            third = len(rows[i][3]) // 3
            edited.append(rows[i][3][: len(rows[i][3]) - third] + rows[i + 1][3][:third])
        theirs = sketch_texts(edited, fraction, k)
        near = [_pair(own[i], e, rows[i][3] == t) for i, e, t in zip(at, theirs, edited)]
        after = [_pair(own[i], own[i + 1], rows[i][3] == rows[i + 1][3]) for i in at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in at], types[0]),
                pa.array([len(rows[i][3]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                as_lists([own[i] for i in at]),
                as_lists(theirs),
                *(pa.array([p[j] for p in pairs], pa.float64()) for j in (0, 1) for pairs in (near, after)),
            ],
            names,
        )

    types = [pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for seq, guest, ident, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.append((seq, guest, ident, body or ""))
                size += len(held[-1][3])
                if size > words.SLICE_BYTES and len(held) > 1:
                    yield digest(held)
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield digest(held)

    placed = with_place(docs, key, text).repartition("seq").sortWithinPartitions("seq", "guest", F.col("key").desc_nulls_last(), F.desc("mark"))
    return placed.select("seq", "guest", "key", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint array<bigint>, edited_fingerprint array<bigint>, "
        "near_edited double, near_next double, within_edited double, within_next double",
    )
