"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Pieces are dealt into blocks of about `BLOCK`; each block is packed on `ISLANDS` islands. An island starts from
best-fit decreasing and from orders shaken at random; a child takes whole well-filled sequences of one parent, loses
the other parent's sequences that hold a piece twice, and best-fits the displaced pieces. Each island's best solution
moves to the next island (a shuffle), both evolve again, and the better one is the block's. An island stops when it
reaches the lower bound. Pieces of sequences that stay below `FULL` of the capacity are then pooled over all blocks,
dealt into new blocks and packed once more, so what blocks lose at their ends does not add up.

Defined results: an empty text is one piece of its end id; pieces of the capacity or more fill a sequence alone;
repeated rows are packed each on its own; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from quotewell.llm.bytepairs import parts
from quotewell.llm.memory import tidy
from quotewell.session import shared_dir

CAPACITY = 2048
BLOCK = 4096
ISLANDS = 2
FULL = 0.98
CACHE = 300_000
# White space in places where a text cannot be taken apart at every blank and newline.
_ODD = ("  ", " \n", "\n ", "\n\n", "\t", "\r", "\x0b", "\x0c", "\0")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_ODD_WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# How byte-level files write a byte: printable Latin-1 characters as they are, the others from U+0100 on, in order.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_TEXT = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_KEPT)))}


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian unsigned 32-bit bytes.

    For byte-level BPE with the usual split pattern: it never joins what a single blank or newline between two visible
    characters parts, so such texts go word by word, each word split and merged by the library once as long as the
    caches have room. Other texts, words with an added token, and other kinds of tokenizer take the library's encode.
    """

    def __init__(self, model: str):
        self.model, self.words, self.pieces = Tokenizer.from_str(model), {"": b""}, {"": b""}
        told = json.loads(model)
        split, merges = told.get("pre_tokenizer") or {}, told["model"]
        self.added = [t["content"] for t in told.get("added_tokens") or []]
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not told.get("normalizer")
            and merges.get("type") == "BPE" and not any(merges.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
            and not told.get("truncation") and not told.get("padding") and not any(" " in t or "\n" in t for t in self.added)
        )
        self.split, self.merge = getattr(self.model.pre_tokenizer, "pre_tokenize_str", None), self.model.model.tokenize

    def forget(self) -> None:
        """Empty the caches: a worker lives on after its task, and other work needs the memory."""
        self.words, self.pieces = {"": b""}, {"": b""}

    def whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        for added in self.added:
            if added in word:
                return self.whole(word)
        start = word.rstrip(string.punctuation)
        letters = start[1:] if start[:1] == " " else start
        if letters.isascii() and letters.isalpha():  # a word, then marks
            pieces = ["\u0120" + letters if letters is not start else start]
        elif letters.isalpha() and max(letters) < "\u0250":  # the same with other Latin letters
            pieces = [start.encode().decode("latin-1").translate(_AS_TEXT)]
        else:
            start, pieces = word, [piece for piece, _ in self.split(word)]
        if len(start) < len(word):
            pieces.append(word[len(start) :])
        out = []
        for piece in pieces:
            ids = self.pieces.get(piece)
            if ids is None:
                merged = [t.id for t in self.merge(piece)]
                ids = struct.pack(f"<{len(merged)}I", *merged)
                if len(self.pieces) < CACHE:
                    self.pieces[piece] = ids
            out.append(ids)
        out = b"".join(out)
        if len(self.words) < CACHE:
            self.words[word] = out
        return out

    def taken_apart(self, text: str) -> bool:
        if not self.by_word or any(o in text for o in _ODD):
            return False
        return not any(c in text for c in _SEPARATORS) if text.isascii() else not _ODD_WIDE.search(text)

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if self.taken_apart(text):
                words = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
                ids = list(map(self.words.get, words))
                if None in ids:
                    ids = [self.word(w) if i is None else i for i, w in zip(ids, words)]
            else:
                ids = map(self.whole, parts(text))
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=2)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document; only the first may be shorter than the capacity."""
    first = total % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """(key, piece, start, length, ids_crc32, and with `with_ids` ids as bytes) of every document, without a shuffle."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [key, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        for batch in batches:
            keys, held, size, first = batch.column(0), [], 0, 0
            for i, t in enumerate(batch.column(1)):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size < 1 << 20 and i + 1 < batch.num_rows:
                    continue
                rows = []
                for j, ids in enumerate(encode(held)):
                    ids += end
                    for n, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append((first + j, n, start, length, zlib.crc32(part), *([part] if with_ids else [])))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds[1:]))], names
                )
                held, size, first = [], 0, i + 1
        encode.forget()

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return docs.select(key, text).mapInArrow(tidy(run), schema)


class Packing:
    """One solution: the bin of each piece and the space left in each bin."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bin = np.full(len(sizes), -1, np.int64)
        self.left: list[int] = []

    def place(self, order: np.ndarray) -> Packing:
        """Best fit of the pieces in this order into the bins there are, opening new ones as needed."""
        spaces = sorted((space, b) for b, space in enumerate(self.left))
        sizes, where = self.sizes, self.bin
        for i in order.tolist():
            size = int(sizes[i])
            at = bisect_left(spaces, (size, -1))
            if at < len(spaces):
                space, b = spaces.pop(at)
            else:
                space, b = self.capacity, len(self.left)
                self.left.append(space)
            where[i] = b
            self.left[b] = space - size
            if space > size:
                insort(spaces, (space - size, b))
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then uneven filling, which leaves room to empty a bin."""
        fill = 1 - np.array(self.left) / self.capacity
        return -len(self.left), float((fill**2).sum())


def child(mine: Packing, other: Packing, rng: np.random.Generator) -> Packing:
    """`mine` with whole well-filled bins of `other` put in; bins that hold a piece twice are dissolved and best-fitted."""
    left = np.array(other.left)
    good = np.flatnonzero(left <= np.quantile(left, 0.5))
    inject = rng.permutation(good)[: max(1, len(good) // 2)]
    chosen = np.zeros(len(left), bool)
    chosen[inject] = True
    moved = chosen[other.bin]
    broken = np.zeros(len(mine.left), bool)
    broken[mine.bin[moved]] = True
    keep = ~broken[mine.bin] & ~moved
    out = Packing(mine.sizes, mine.capacity)
    kept_bins, kept_index = np.unique(mine.bin[keep], return_inverse=True)
    new_bins, new_index = np.unique(other.bin[moved], return_inverse=True)
    out.bin[keep] = kept_index
    out.bin[moved] = new_index + len(kept_bins)
    out.left = [*np.array(mine.left)[kept_bins].tolist(), *left[new_bins].tolist()]
    displaced = np.flatnonzero(~keep & ~moved)
    return out.place(displaced[np.argsort(-mine.sizes[displaced], kind="stable")])


def evolve(sizes: np.ndarray, capacity: int, seed: int, elites: list[np.ndarray], population: int = 4, generations: int = 6) -> np.ndarray:
    """The bin of each piece in the best solution found; `elites` are solutions to start from."""
    rng = np.random.default_rng(seed)
    bound = -(-int(sizes.sum()) // capacity)
    solutions = []
    for bins in elites:
        p = Packing(sizes, capacity)
        _, p.bin = np.unique(bins, return_inverse=True)
        p.left = (capacity - np.bincount(p.bin, weights=sizes).astype(np.int64)).tolist()
        solutions.append(p)
    if not solutions:
        solutions = [Packing(sizes, capacity).place(np.argsort(-sizes, kind="stable"))]
    while len(solutions) < population and -max(s.fitness() for s in solutions)[0] > bound:
        shaken = sizes * rng.uniform(0.85, 1.15, len(sizes))
        solutions.append(Packing(sizes, capacity).place(np.argsort(-shaken, kind="stable")))
    for _ in range(generations):
        solutions.sort(key=Packing.fitness, reverse=True)
        if len(solutions[0].left) <= bound or len(solutions) < 2:
            break
        a, b = rng.choice(len(solutions), 2, replace=False)
        solutions = [*solutions[: population - 1], child(solutions[a], solutions[b], rng)]
    return max(solutions, key=Packing.fitness).bin


def _packed(items: DataFrame, capacity: int, columns: list[str], stage: int) -> DataFrame:
    """`columns` and sequence, offset, free of the items, which have item, block and length."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.select(*columns).schema)

    def island(round_no: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            block, place = key
            first = rows["origin"].iloc[0] if round_no else None
            each = [g.sort_values("item") for _, g in rows.groupby("origin")] if round_no else [rows.sort_values("item")]
            sizes = each[0]["length"].to_numpy(np.int64)
            elites = [g["bin"].to_numpy() for g in each] if round_no else []
            del first
            out = each[0].copy()
            out["bin"] = evolve(sizes, capacity, (block * 31 + place) * 7 + round_no + stage, elites)
            out["origin"] = place
            return out[[*columns, "item", "block", "island", "origin", "bin"]].assign(island=place)

        return run

    schema = f"{kinds}, item bigint, block bigint, island int, origin int, bin bigint"
    homes = F.array(*[F.lit(i) for i in range(ISLANDS)])
    rows = items.select(*columns, "item", "block", F.explode(homes).alias("island")).withColumns({"origin": F.col("island"), "bin": F.lit(-1).cast("bigint")})
    rows = rows.groupBy("block", "island").applyInPandas(island(0), schema)
    onward = F.explode(F.array(F.col("origin"), (F.col("origin") + 1) % ISLANDS)).alias("island")
    rows = rows.select(*columns, "item", "block", "origin", "bin", onward)
    rows = rows.groupBy("block", "island").applyInPandas(island(1), schema)

    def best(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        def merit(g: pd.DataFrame) -> tuple:
            fill = g.groupby("bin")["length"].sum().to_numpy() / capacity
            return -len(fill), float((fill**2).sum()), -int(g["origin"].iloc[0])

        g = max((g for _, g in rows.groupby("origin")), key=merit).sort_values(["bin", "item"])
        of_bin = g.groupby("bin")["length"]
        g["offset"] = of_bin.cumsum() - g["length"]
        g["free"] = capacity - of_bin.transform("sum")
        g["sequence_id"] = g["block"] * BLOCK * 16 + g["bin"]
        return g[[*columns, "sequence_id", "offset", "free"]]

    return rows.groupBy("block").applyInPandas(best, f"{kinds}, sequence_id bigint, offset bigint, free bigint")


def packed(stored: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """All columns of the stored pieces with sequence_id and offset.

    `stored` has to be a written table: items are numbered by their place in its files, which a lost task reads
    again in the same way. Repeated rows get numbers of their own, so no block grows beyond its share.
    """
    spark = stored.sparkSession
    columns = stored.columns
    numbered = stored.withColumn("item", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") >= capacity).select(*columns, (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    short = numbered.filter(F.col("length") < capacity)
    blocks = max(1, -(-short.count() // block))
    first = _packed(short.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), capacity, columns, 0)
    first.write.parquet(path := shared_dir(spark, "packed"))
    first = spark.read.parquet(path)
    loose = first.filter(F.col("free") > (1 - FULL) * capacity).select(*columns).withColumn("item", F.monotonically_increasing_id())
    again = max(1, -(-loose.count() // block))
    second = _packed(loose.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(again)) + blocks), capacity, columns, 1)
    tight = first.filter(F.col("free") <= (1 - FULL) * capacity)
    return full.unionByName(tight.drop("free")).unionByName(second.drop("free"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset of each."""
    made = pieces(docs, tokenizer_path, capacity, end_id, key, text, with_ids=False)
    made.write.parquet(path := shared_dir(docs.sparkSession, "pieces"))
    return packed(docs.sparkSession.read.parquet(path), capacity)


def sequences(placed: DataFrame, with_ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """(sequence_id, ids): the ids of each sequence in order, from the places and the pieces with their ids."""
    rows = placed.select(key, "piece", "sequence_id", "offset").join(with_ids.select(key, "piece", "ids"), [key, "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.concat_ws("", F.transform(ordered, lambda x: F.hex(x["ids"]))).alias("ids")).withColumn("ids", F.unhex("ids"))
