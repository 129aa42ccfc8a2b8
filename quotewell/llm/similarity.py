"""Near duplicates by fast similarity sketching, banding, and exact verification on full sets.

1. A text's set of word shingles is sketched into `BINS` coordinates. In round i < BINS each element throws itself into
   a bin drawn by a hash of (i, element); in round BINS + j all elements are thrown into bin j. A bin keeps the element that
   came first, by round and then by hash. So every bin is filled after two times BINS rounds at most, mostly after a few, and
   two sketches agree in a share of their bins that is close to the sets' Jaccard similarity, with the concentration of
   sampling without replacement even where a set has fewer elements than bins.
2. Texts with equal sets are one class. Its coordinates are cut into bands of `ROWS` bins; classes with an equal band share
   a bucket. Two sets of similarity 0.8 share none of the 80 buckets of 8 with a chance of 4 in 10 million.
3. Each class is compared with the class that is the smallest of most of its buckets. Links found form groups.
4. Buckets whose classes are all in one group are done. In the others, those of two classes are compared as they are. In larger ones every
   class outside the bucket's most frequent group meets all its classes, in units of bounded size; buckets with the same classes count
   once. So every pair of classes that shares a bucket is in one group by then, or was compared in full.
5. Connected components of all links give the groups.

Nothing is sampled and no bucket is cut short; similarity is always decided on full sets of 64-bit hashes.

Defined results: null text is empty; a text without words has an empty set and is its own group; with fewer words than
the shingle's the sequence is the one shingle; rows without a key have no group (NULL), are not kept apart (kept is NULL) and link nothing;
rows of one key are one node; repeated rows are equal; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotewell.llm import words
from quotewell.llm.graph import components, stored
from quotewell.llm.memory import tidy, tidy_group
from quotewell.llm.sieve import sieve, sifted

BINS, ROWS = 640, 8
UNIT = 1 << 19  # shingles that one comparing task holds at most, but for a single pair
_TEXTS = 1 << 11
_THROWS = 1 << 19
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, ascending distinct shingle hashes of each text), some texts at a time."""
    for a, _, data, offsets in words.slices(column):
        hashes, bounds = words.Words(data, offsets, fold=True).shingles(k)
        for b in range(0, len(bounds) - 1, _TEXTS):
            cut = bounds[b : b + _TEXTS + 1]
            yield a + b, [np.unique(hashes[i:j]) for i, j in zip(cut[:-1], cut[1:])]


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of `bins` coordinates a set; all ones for an empty set.

    A coordinate is (round, 52 bits of a hash of round and element), so that the least of all throws into a bin is the one that
    came first; throws of later rounds than a bin needs change nothing, and several rounds are thrown at once.
    """
    out = np.full((len(sets), bins), _EMPTY)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    open_sets = np.flatnonzero(sizes)
    turn = 0
    while len(open_sets) and turn < bins:
        elements = np.concatenate([sets[i] for i in open_sets])
        base = np.repeat(open_sets * bins, sizes[open_sets])
        turns = max(1, min(bins - turn, _THROWS // len(elements)))
        for part in np.array_split(np.arange(len(elements)), max(1, -(-len(elements) * turns // (2 * _THROWS)))):
            for r in range(turn, turn + turns):
                x = _thrown(elements[part], r)
                # The bin comes from other bits than the order.
                at = base[part] + ((words.mix(x) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
                value = (np.uint64(r) << np.uint64(52)) | (x >> np.uint64(12))
                first = value < flat[at]
                np.minimum.at(flat, at[first], value[first])
        turn += turns
        open_sets = open_sets[(out[open_sets] == _EMPTY).any(1)]
    for i in open_sets:  # the rounds that fill every bin
        for j in np.flatnonzero(out[i] == _EMPTY):
            out[i, j] = (np.uint64(bins + j) << np.uint64(52)) | (_thrown(sets[i], bins + int(j)) >> np.uint64(12)).min()
    return out


def _thrown(elements: np.ndarray, turn: int) -> np.ndarray:
    return words.mix(elements ^ words.mix(np.array([turn + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit name a band, different for equal contents at different places."""
    n, bins = sketch.shape
    cut = sketch.reshape(n, bins // rows, rows)
    name = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), cut.shape[:2]).copy()
    for i in range(rows):
        name = words.mix(name ^ cut[:, :, i]) + np.uint64(i)
    return name


def sketched(docs: DataFrame, key: str, text: str, k: int, bins: int, rows: int) -> DataFrame:
    """(key, n, digest, bands) of every row: its set's size and digest, and the names of its bands."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), k):
                names = bands(sketches(sets, bins), rows)
                width = names.shape[1]
                offsets = np.arange(0, width * len(sets) + 1, width, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(names.reshape(-1).view(np.int64))),
                    ],
                    [key, "n", "digest", "bands"],
                )

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(tidy(run), f"`{key}` {kind}, n bigint, digest binary, bands array<bigint>")


def full_sets(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(rep, shingles): the set of each text as bytes of ascending hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "shingles"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(tidy(run), f"rep {kind}, shingles binary")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, rep, n, low) of buckets that several classes have, low being the smallest of them.

    Ends are counted before the shuffle; a bitmap of the shared buckets keeps the rows of all others out of the second one.
    """
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    ends = rows.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    ends = stored(ends.filter("low < high").drop("high"), "buckets")
    return stored(sifted(rows, "bucket", sieve(ends, "bucket")).join(ends, "bucket"), "shared")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link. Plain joins: a class with a great many pairs is split by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                common = 0
                if len(small) * den >= num * len(large):
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    common = int(np.count_nonzero(large[at] == small))
                keep.append(common * (num + den) >= num * (len(x) + len(y)) if common else False)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(tidy(run), f"a {kind}, b {kind}")


def _between(num: int, den: int):
    """For applyInPandas over units: rows (bucket, part, turn, rep, grp, probe, shingles) to links (a, b) that join two groups."""

    def one(rows: pd.DataFrame) -> list[tuple]:
        rows = rows.sort_values(["probe", "rep"], ascending=[False, True]).drop_duplicates("rep")
        rep, probe = rows["rep"].to_numpy(), rows["probe"].to_numpy()
        group = np.unique(rows["grp"].to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        starts = np.cumsum(sizes) - sizes
        names, at = np.unique(np.concatenate(sets), return_inverse=True)
        marks = np.zeros(len(names), bool)
        out = []
        for x in np.flatnonzero(probe):
            others = np.flatnonzero((group != group[x]) & (np.minimum(sizes, sizes[x]) * den >= num * np.maximum(sizes, sizes[x])))
            if not len(others):
                continue
            own = at[starts[x] : starts[x] + sizes[x]]
            marks[own] = True
            for y in others:
                if group[y] == group[x]:
                    continue
                common = int(np.count_nonzero(marks[at[starts[y] : starts[y] + sizes[y]]]))
                if common * (num + den) >= num * (sizes[x] + sizes[y]):
                    out.append((rep[x], rep[y]))
                    group[group == group[y]] = group[x]
            marks[own] = False
        return out

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pair for _, bucket in rows.groupby(["bucket", "part", "turn"], sort=False) for pair in one(bucket)]
        return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]}, dtype=rows["rep"].dtype)

    return tidy_group(run, lambda rows: int(rows["shingles"].map(len).sum()))


def open_links(met: DataFrame, sets: DataFrame, first: DataFrame, compared: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) among classes that share a bucket, are not in one group by the links found so far, and were not compared."""
    kind = met.schema["rep"].dataType.simpleString()
    labels = components(first)
    met = met.join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n", F.coalesce("label", "rep").alias("grp"))
    names = (F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit("x"), "rep")).alias("y"))
    of_group = met.groupBy("bucket", "grp").agg(F.count("*").alias("rows"), F.sum("n").alias("size"), F.min("rep").alias("low"), F.max("rep").alias("high"), *names)
    of_bucket = of_group.groupBy("bucket").agg(
        F.count("*").alias("groups"), F.sum("rows").alias("rows"), F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max(F.struct("size", "grp")).alias("top"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).filter("groups > 1")
    one = of_bucket.groupBy("rows", "x", "y").agg(F.min(F.struct("bucket", "low", "high", "size", "top")).alias("g")).select("rows", "g.*")
    one = stored(one, "open")
    pairs = one.filter("rows = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct()
    done = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    small = stored(verified(pairs.join(done, ["a", "b"], "left_anti"), sets, num, den), "links")

    # Parts of a bucket's classes that each turn of its probes meets; small buckets share a unit.
    large = one.filter("rows > 2").select(
        "bucket", F.col("top.grp").alias("top"), F.col("size").alias("whole"),
        F.ceil(F.col("size") * 2 / UNIT).cast("int").alias("parts"),
        F.ceil((F.col("size") - F.col("top.size")) * 2 / UNIT).cast("int").alias("turns"),
    )
    large = stored(large, "large")
    volume = large.agg(F.sum(F.least(F.col("whole"), F.lit(UNIT))).alias("v")).first()["v"] or 0  # one number
    units = int(volume // (UNIT // 4)) + 1
    rest = met.join(large, "bucket").withColumn("probe", F.col("grp") != F.col("top"))
    part, turn = F.pmod(F.xxhash64("rep"), "parts").cast("int"), F.pmod(F.xxhash64(F.lit(7), "rep"), "turns").cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["bucket", "rep", "grp", "whole"]
    stays = rest.select(*columns, F.lit(False).alias("probe"), part.alias("part"), F.explode(every("turns")).alias("turn"))
    probes = rest.filter("probe").select(*columns, "probe", F.explode(every("parts")).alias("part"), turn.alias("turn"))
    rows = stays.unionByName(probes).groupBy("bucket", "part", "turn", "rep", "grp", "whole").agg(F.max("probe").alias("probe"))
    rows = rows.withColumn("unit", F.when(F.col("whole") * 4 > UNIT, F.xxhash64("bucket", "part", "turn")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(units))))
    between = rows.join(sets, "rep").groupBy("unit").applyInPandas(_between(num, den), f"a {kind}, b {kind}")
    return small.unionByName(stored(between, "links"))


def links(docs: DataFrame, classes: DataFrame, key: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """(a, b): links between classes that together connect all classes that links connect."""
    met = shared_buckets(classes)
    counts = met.filter("rep != low").groupBy("rep", "low").agg(F.count("*").alias("shared"))
    star = counts.groupBy("rep").agg(F.max_by("low", "shared").alias("low")).select(F.col("rep").alias("a"), F.col("low").alias("b"))
    star = stored(star, "star")
    found = stored(met.select("rep").distinct(), "members")
    few = sifted(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), "key", sieve(found, "rep"))
    sets = stored(full_sets(few, "key", "text", k).join(found, "rep", "left_semi").dropDuplicates(["rep"]), "sets")
    first = stored(verified(star, sets, num, den), "links")
    return first.unionByName(open_links(met, sets, first, star, num, den))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, num: int = 80, den: int = 100, bins: int = BINS, rows: int = ROWS
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row: two sets link when den * |A and B| >= num * |A or B|.

    With fewer bins or more rows a band, pairs near the threshold are lost with a chance of (1 - t^rows)^(bins / rows).
    """
    sets = stored(sketched(docs, key, text, k, bins, rows), "sketched")
    own = F.col(f"`{key}`")
    linked = sets.filter((F.col("n") > 0) & own.isNotNull())
    classes = linked.groupBy("digest").agg(F.min(own).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    labels = components(links(docs, classes.drop("digest"), key, text, k, num, den))
    names = linked.groupBy("digest").agg(F.min(own).alias("rep"))
    names = names.join(labels, names["rep"] == labels["node"], "left").select(F.col("digest").alias("_digest"), F.coalesce("label", "rep").alias("_group"))
    out = sets.select(own, "n", "digest").join(names, (F.col("digest") == F.col("_digest")) & (F.col("n") > 0) & own.isNotNull(), "left")
    out = out.select(own, F.col("n").alias("n_shingles"), F.coalesce("_group", own).alias("component_id"))
    return out.withColumn("kept", own == F.col("component_id"))
