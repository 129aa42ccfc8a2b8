"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

Subwords are the 2-, 3- and 4-byte windows of the UTF-8 text with A-Z lower-cased and every ASCII character that is
not a letter made a blank. Each is hashed to one of 2^18 embedding rows; a text is the mean of its rows, a linear
layer and softmax give the languages. Training is plain stochastic gradient descent in numpy on the driver over at
most `per_language` distinct texts a language, each brought there as counts of its hashed subwords (at most 2^18
pairs however long the text), so what the driver holds is bounded by languages x per_language x 2^18. A fifth of each
language's sample is kept back: it sets the temperature of the softmax and the two limits of rejection, on the calibrated
probability and on the share of subwords ever seen in training.

As embedding and output layers are both linear, prediction gathers one row of logits per subword. The model's size
is fixed by the number of languages (2^18 rows of 4 bytes each), so it is broadcast.

Defined results: null text, text without letters, and every text when nothing could be learned: `und`, score 0,
rejected. Rows without a language are predicted but not learned from. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotewell.llm import words
from quotewell.llm.memory import give_back, tidy

BITS = 18
BUCKETS = 1 << BITS
NONE = "und"
_PLAIN = np.full(256, 32, np.uint32)
_PLAIN[128:] = np.arange(128, 256)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_LETTER = re.compile(r"[^\W\d_]")


def subwords(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window width: (bucket of the window at each byte, whether it counts). `ends`: end of the text by byte.

    A window counts when it lies in its text and holds a letter or a byte of one.
    """
    b = _PLAIN[data]
    n = len(b)
    value, letter = b.copy(), b != 32
    at = np.arange(n)
    for width in (2, 3, 4):
        shift = width - 1
        if n <= shift:
            return
        nxt = np.full(n, 32, np.uint32)
        nxt[: n - shift] = b[shift:]
        value = (value << np.uint32(8)) | nxt
        letter = letter | (nxt != 32)
        bucket = ((value + np.uint32(width * 0x1000193)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        yield bucket, letter & (at + width <= ends)


def counted(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(data), words.SLICE_BYTES):  # windows start in this part and may reach 3 bytes beyond it
        part = data[a : a + words.SLICE_BYTES + 3]
        last = len(data) - a
        for bucket, counts in subwords(part, np.full(len(part), last)):
            counts = counts & (np.arange(len(part)) < words.SLICE_BYTES)
            total += np.bincount(bucket[counts], minlength=BUCKETS)
    buckets = np.flatnonzero(total)
    return buckets.astype(np.int32), total[buckets].astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x languages
    seen: np.ndarray  # BUCKETS
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: float = 0.0

    def means(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean logits of each text and the share of its subwords that training saw."""
        n, classes = len(offsets) - 1, len(self.languages)
        sums, known, total = np.zeros((n, classes)), np.zeros(n), np.zeros(n)
        ends = np.repeat(offsets[1:], np.diff(offsets))
        for bucket, counts in subwords(data, ends):
            where = np.flatnonzero(counts)
            bucket = bucket[where]
            cut = np.searchsorted(where, offsets)
            full = np.flatnonzero(cut[1:] > cut[:-1])
            if not len(full):
                continue
            for c in range(classes):
                sums[full, c] += np.add.reduceat(self.logits[c][bucket], cut[full], dtype=np.float64)
            known[full] += np.add.reduceat(self.seen[bucket], cut[full], dtype=np.int64)
            total += np.diff(cut)
        count = np.maximum(total, 1)
        return sums / count[:, None], known / count

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language or -1, score, rejected) of each text."""
        if not self.languages:
            n = len(offsets) - 1
            return np.full(n, -1), np.zeros(n), np.ones(n, bool)
        means, known = self.means(data, offsets)
        best, score = calibrated(means, self.temperature)
        plain = np.cumsum(np.concatenate([[0], (_PLAIN[data] != 32) & (data < 128)]))[offsets]
        for i in np.flatnonzero(np.diff(plain) == 0):  # no ASCII letter: look at the code points
            if not _LETTER.search(data[offsets[i] : offsets[i + 1]].tobytes().decode()):
                best[i], score[i], known[i] = -1, 0.0, -1.0
        return best, score, (best < 0) | (score < self.least_score) | (known < self.least_seen)


def calibrated(means: np.ndarray, temperature: float) -> tuple[np.ndarray, np.ndarray]:
    z = means / temperature
    z = np.exp(z - z.max(1, keepdims=True))
    p = z / z.sum(1, keepdims=True)
    return p.argmax(1), p.max(1)


def sample(docs: DataFrame, label: str, text: str, per_language: int) -> DataFrame:
    """(label, mark, buckets, counts) of at most `per_language` distinct texts a label, chosen by a hash of the text.

    The hash threshold is set from the label's count of distinct text hashes before any text moves, so copies do not
    thin the sample; a rank by the hash then bounds what is left. Copies of a text fall in or out together and count once.
    """
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    marks = rows.select("label", F.xxhash64("text").alias("mark")).distinct()
    sizes = marks.groupBy("label").count().withColumn("share", F.least(F.lit(1.0), 4.0 * per_language / F.col("count"))).collect()
    if not sizes:
        return rows.select("label", F.lit(0).alias("mark"), F.array().cast("array<int>").alias("buckets"), F.array().cast("array<int>").alias("counts"))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["label"], r["share"])])
    near = (
        rows.withColumn("mark", F.xxhash64("text"))
        .filter(F.shiftrightunsigned("mark", 1) / F.lit(float(2**63)) < share[F.col("label")])
    )
    chosen = (
        near.select("label", "mark").distinct()
        .withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(F.shiftrightunsigned("mark", 1), "mark")))
        .filter(F.col("place") <= per_language).drop("place")
    )  # at most languages x per_language pairs of two columns: broadcast below
    texts = near.join(F.broadcast(chosen), ["label", "mark"], "left_semi").groupBy("label", "mark").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, body in enumerate(batch.column(2).to_pylist()):
                pair = counted(np.frombuffer(body.encode(), np.uint8))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), pa.array(p)) for p in pair]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), *lists], ["label", "mark", "buckets", "counts"])

    return texts.select("label", "mark", "text").mapInArrow(tidy(run), "label string, mark bigint, buckets array<int>, counts array<int>")


def fit(bags: list[tuple[str, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 12, rate: float = 4.0, seed: int = 7) -> Model:
    """Stochastic gradient descent, one text a step; every fifth text of a language is kept back to calibrate.

    A language of fewer than five texts learns from all of them, and these also calibrate.
    """
    languages = sorted({b[0] for b in bags})
    if not languages:
        return Model([], np.empty((0, BUCKETS), np.float32), np.zeros(BUCKETS, bool))
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out = rng.uniform(-1 / dim, 1 / dim, (dim, len(languages))).astype(np.float32)
    index = {name: i for i, name in enumerate(languages)}
    bags = [(index[a], b, (c / max(c.sum(), 1)).astype(np.float32)) for a, b, c in bags]  # int32 buckets
    held, learned = [], []
    for language in range(len(languages)):
        own = [b for b in bags if b[0] == language]
        learned += [b for i, b in enumerate(own) if i % 5 != 4]
        held += own[4::5] or own
    seen = np.zeros(BUCKETS, bool)
    for _, b, _ in learned:
        seen[b] = True
    steps, done = epochs * len(learned), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learned)):
            target, buckets, weight = learned[i]
            rows = embed[buckets]
            mean = weight @ rows
            z = mean @ out
            z = np.exp(z - z.max())
            error = z / z.sum()
            error[target] -= 1
            step = rate * (1 - done / steps)
            back = out @ error
            out -= step * np.outer(mean, error)
            embed[buckets] = rows - step * weight[:, None] * back
            done += 1
    logits = embed @ out
    means = np.array([w @ logits[b] for _, b, w in held])
    known = np.array([w @ seen[b].astype(np.float32) for _, b, w in held])
    truth = np.array([t for t, _, _ in held])

    def loss(temperature: float) -> float:
        z = means / temperature
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), truth]))

    # Texts in the wild are shorter than the mean of the sample: a temperature under 0.05 of a logit would make any
    # of them certain, so the search stops there.
    temperature = min((float(t) for t in np.geomspace(0.05, 5, 60)), key=loss)
    best, score = calibrated(means, temperature)
    right = best == truth
    floor = 1 / len(languages)
    least_score = floor + 0.5 * (float(score[right].min()) - floor) if right.any() else 0.0
    least_seen = 0.5 * float(known.min())
    return Model(languages, np.ascontiguousarray(logits.T), seen, temperature, min(least_score, 0.5 + floor / 2), least_seen)


def learn(docs: DataFrame, label: str = "lang", text: str = "text", per_language: int = 600) -> Model:
    """The model of the rows given (leave out held-out rows before).

    The sample comes as Arrow columns: as Python's numbers it would take some ten times its size on the driver.
    """
    table = sample(docs, label, text, per_language).toArrow()
    order = sorted(zip(table.column("mark").to_pylist(), table.column("label").to_pylist(), range(table.num_rows)))
    columns = [table.column(c).combine_chunks() for c in ("buckets", "counts")]
    del table
    bags = []
    for _, name, i in order:
        buckets, counts = (c[i].values.to_numpy(zero_copy_only=False) for c in columns)
        if len(buckets):
            bags.append((name, buckets, counts))
    model = fit(bags)
    del bags, columns
    give_back()
    return model


def predicted(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) of every row, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [key, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        labels = np.array([*own.languages, NONE], object)
        for batch in batches:
            for a, b, data, offsets in words.slices(batch.column(1)):
                best, score, rejected = own.predict(data, offsets)
                arrays = [batch.column(0).slice(a, b - a), pa.array(labels[best], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(key, text).mapInArrow(tidy(run), f"`{key}` {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def accepted_rows(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns as they are, that the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.slices(batch.column(at)):
                yield batch.slice(a, b - a).filter(pa.array(~shared.value.predict(data, offsets)[2]))

    return docs.mapInArrow(tidy(run), docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its key as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2
