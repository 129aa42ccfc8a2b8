"""Whitening of embeddings by exact principal components.

Every entry c of a vector becomes the integer floor(64 c) + 1,000,000. Each distinct integer vector counts once; their
sums and scatter matrix, around the rounded means, are exact integers summed over tasks. From there on nothing is
rounded: the scatter's characteristic polynomial is computed modulo primes, one Spark row a prime, and put together;
its roots are isolated to 192 bits, and each root's eigenvectors are found by inverse iteration in fixed-point integers, one
Spark row a root (`charpoly.py`). What the driver holds follows the number of dimensions, never the number of rows.

Defined results: rows whose vector is null, or holds null or a number that is not finite, are dropped; so are
vectors of another length than the most frequent one (the longest of several) among the distinct vectors. Integers beyond 2^40 on
either side become that bound. Components whose eigenvalue is 0 are left out: copies of one vector have no components. A
deviation that does not fit a bigint is NULL. Rows without a key and repeated rows are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quotewell.llm import charpoly
from quotewell.llm.graph import stored

SCALE, OFFSET, MOST = 64, 1_000_000, 1 << 40
COMPONENTS = 16
ROWS = 1 << 12
_LONG = 1 << 62


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that stay, their flat integers, bounds of each row in them) of a column of lists of doubles."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null is not a number
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = ~column.is_null().to_numpy(zero_copy_only=False) & (bad[bounds[1:]] == bad[bounds[:-1]])
    flat = values[np.repeat(keep, lengths)]
    x = np.clip(np.floor(flat * SCALE), -float(MOST), float(MOST)).astype(np.int64) + OFFSET
    return np.flatnonzero(keep), x, np.concatenate([[0], np.cumsum(lengths[keep])])


def distinct_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """(x) the distinct integer vectors as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, bounds = integers(batch.column(0))
            raw = x.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[8 * a : 8 * b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], ["x"])

    return rows.select(F.col(f"`{vector}`").cast("array<double>")).mapInArrow(run, "x binary").distinct()


def blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Rows of integers, some thousand at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.column(0).slice(a, ROWS).to_pylist()
            yield np.frombuffer(b"".join(part), "<i8").reshape(len(part), d)


def _summed(sums: dict[tuple[int, int], int]) -> pa.RecordBatch:
    i, j = (pa.array([k[a] for k in sums], pa.int32()) for a in (0, 1))
    return pa.RecordBatch.from_arrays([i, j, pa.array([str(v) for v in sums.values()], pa.string())], ["i", "j", "v"])


def totals(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension: d + 1 exact numbers, from d + 1 rows a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for x in blocks(batches, d):
            n += len(x)
            s = [a + int(b) for a, b in zip(s, x.sum(0))]  # at most ROWS numbers of 41 bits: no overflow
        yield _summed({(i, 0): v for i, v in enumerate([*s, n])})

    rows = vectors.mapInArrow(run, "i int, j int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    found = {r["i"]: int(r["v"]) for r in rows}
    return found.get(d, 0), [found.get(i, 0) for i in range(d)]


def scatter(vectors: DataFrame, d: int, n: int, sums: list[int]) -> list[list[int]]:
    """n^2 times the covariance, an integer matrix: products of distances from the rounded means, put right exactly.

    Each task gives one row an entry of the upper half.
    """
    middle = [(2 * s + n) // (2 * n) for s in sums]
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for x in blocks(batches, d):
            z = x - np.array(middle, np.int64)
            most = int(np.abs(z).max(initial=0))
            if most * most * len(z) < 1 << 53:  # exact in doubles
                z = z.astype(np.float64)
                total += (z.T @ z).astype(np.int64).astype(object)
            else:
                z = z.astype(object)
                total += z.T @ z
        yield _summed({(int(i), int(j)): int(total[i, j]) for i, j in zip(*upper)})

    rows = vectors.mapInArrow(run, "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    rest = [s - n * m for s, m in zip(sums, middle)]
    out = [[0] * d for _ in range(d)]
    for r in rows:
        i, j = r["i"], r["j"]
        out[i][j] = out[j][i] = n * int(r["v"]) - rest[i] * rest[j]
    return out


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial, from x^0 up; a Spark row a prime."""
    numbers = charpoly.primes(charpoly.coefficient_bits(matrix))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"prime": part["prime"], "rest": [charpoly.modulo(matrix, int(p)) for p in part["prime"]]})

    rows = _spread(spark, pd.DataFrame({"prime": numbers})).mapInPandas(run, "prime bigint, rest array<bigint>").collect()
    return charpoly.combined({r["prime"]: list(r["rest"]) for r in rows})


def _spread(spark: SparkSession, rows: pd.DataFrame) -> DataFrame:
    """A few numbered rows, dealt over the machines."""
    return spark.createDataFrame(rows).repartition(min(len(rows), 2 * spark.sparkContext.defaultParallelism))


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray  # dimensions x components, unit length
    values: np.ndarray  # eigenvalues of the covariance, falling
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: int64 where that fits, else Python's integers."""
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < _LONG else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened rows and their deviations."""
        y = self.centred(x)
        most = int(np.abs(y).max(initial=0))
        if y.dtype == np.int64 and most * most * max(1, y.shape[1]) < _LONG:
            deviation = (y * y).sum(1).tolist()
        else:
            deviation = [v if v < 1 << 63 else None for v in (sum(int(a) ** 2 for a in row) for row in y)]
        return (y.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values)), deviation


def fitted(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The components of all rows' distinct vectors, and the table of these (x)."""
    spark = rows.sparkSession
    vectors = stored(distinct_vectors(rows, vector), "vectors")
    lengths = vectors.groupBy(F.length("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    d = lengths[0]["size"] // 8 if lengths else 0
    vectors = vectors.filter(F.length("x") == 8 * d)
    n, sums = totals(vectors, d) if lengths else (0, [])
    none = Whitening(n, sums, np.empty((d, 0)), np.empty(0), np.empty(0))
    if not n or not d:
        return none, vectors
    matrix = scatter(vectors, d, n, sums)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return none, vectors
    roots = charpoly.Roots(polynomial(spark, matrix))
    found, left = [], components
    for root, count in roots.largest(components):
        found.append((root, min(count, left)))
        left -= found[-1][1]
    scale = roots.scale

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for place, root, count in zip(part["place"], part["root"], part["count"]):
                own = charpoly.eigenvectors(matrix, int(root), scale, int(count))
                yield pd.DataFrame({"place": [int(place)] * len(own), "turn": range(len(own)), "vector": own})

    table = pd.DataFrame([(i, str(r), c) for i, (r, c) in enumerate(found)], columns=["place", "root", "count"])
    basis = _spread(spark, table).mapInPandas(run, "place bigint, turn bigint, vector array<double>").collect()
    basis = [r["vector"] for r in sorted(basis, key=lambda r: (r["place"], r["turn"]))]
    each = [r for r, c in found for _ in range(c)]
    values = np.array([r / (n * n << scale) for r in each])
    explained = np.array([r / (trace << scale) for r in each])
    return Whitening(n, sums, np.array(basis, np.float64).T, values, explained), vectors


def identity_error(model: Whitening, vectors: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened distinct vectors, less the identity.

    Whitened vectors are centred already; their own mean, of some rounding, is taken off all the same.
    """
    d, k = model.vectors.shape
    if not k:
        return 0.0
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for x in blocks(batches, d):
            w, _ = shared.value.apply(x)
            total += w.T @ w
            sums += w.sum(0)
        both = np.concatenate([total.ravel(), sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both), dtype=np.int32)), pa.array(both)], ["i", "v"])

    rows = vectors.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    found = np.zeros(k * k + k)
    found[[r["i"] for r in rows]] = [r["v"] / model.n for r in rows]
    mean = found[k * k :]
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error, eigenvalue) of every row and component."""
    model, vectors = fitted(rows, vector, components)
    error = identity_error(model, vectors)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    d, k = model.vectors.shape
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(a, ROWS)
                keep, x, bounds = integers(part.column(1))
                fits = np.diff(bounds) == d
                x = x[np.repeat(fits, np.diff(bounds))].reshape(-1, d)
                w, deviation = own.apply(x)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(keep[fits], k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, own.n)),
                        pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                        pa.array(w.ravel()),
                        pa.array(np.tile(own.explained, m)),
                        pa.array(np.full(m * k, error)),
                        pa.array(np.tile(own.values, m)),
                    ],
                    names,
                )

    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, eigenvalue double"
    return rows.select(F.col(f"`{key}`"), F.col(f"`{vector}`").cast("array<double>")).mapInArrow(run, schema)
