"""Byte-level BPE with the tiktoken library and a local rank file.

The rank file is read on the driver and broadcast (its size is fixed by the file); each Python worker builds the
encoder once. Long texts are split first, only at a space between a visible character and an ASCII letter or digit:
no match of the split pattern spans such a point, so the parts encode to what the whole would. Decoding joins raw
bytes, so ids whose bytes end inside a code point decode too.

Defined results: null text is empty and has no ids; other columns are ignored; repeated rows are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

LONG = 1 << 16
_SAFE = re.compile(r"(?<=\S) (?=[A-Za-z0-9])")


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def parts(text: str, long: int = LONG) -> list[str]:
    """The text in pieces of about `long` characters that encode apart; one piece where no safe point follows."""
    out, start = [], 0
    while len(text) - start > long:
        cut = _SAFE.search(text, start + long)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def encode(enc: tiktoken.Encoding, texts: list[str], long: int = LONG) -> list[np.ndarray]:
    """Ids of each text, little-endian unsigned 32-bit."""
    pieces = [parts(t, long) for t in texts]
    ids = iter(enc.encode_ordinary_batch([p for ps in pieces for p in ps], num_threads=1))
    return [np.concatenate([np.array(next(ids), "<u4") for _ in ps]) for ps in pieces]


def decode(enc: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def _groups(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) with about `limit` characters or one text each."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _worker(docs: DataFrame, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    return lambda: encoder(shared.value, pattern)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row."""
    make, kind = _worker(docs, ranks_path, pattern), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make()
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                ids = encode(enc, texts)
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), lists], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(ids: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", column: str = "ids") -> DataFrame:
    """(key, bytes binary) of every row of ids."""
    make, kind = _worker(ids, ranks_path, pattern), ids.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.column(1)[i].as_py() or []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([enc.decode_bytes(row)], pa.binary())], [key, "bytes"]
                )

    return ids.select(key, column).mapInArrow(run, f"`{key}` {kind}, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, both made by the functions above in one pass."""
    make, kind = _worker(docs, ranks_path, pattern), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make()
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                ids = encode(enc, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(decode(enc, i)).hexdigest() for i in ids], pa.string()),
                    ],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
