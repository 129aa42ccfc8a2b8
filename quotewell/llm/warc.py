"""WARC archives through a table of chunks.

A payload never stands in one piece in the writer or reader: it is rows of (record, chunk number, at most
`CHUNK` bytes), sorted by both, that stream into and out of gzip members of 64 KB at a time. The reader carries a
running SHA-1 and byte count on every chunk row, so the last chunk of a record holds the digest of its payload.

Archives are written through pyarrow's file systems into a folder that all executors see, one file a task under a name
of its own; a manifest, committed by Spark, lists the files of the tasks that succeeded. A file left by a lost
task is in no manifest and is never read.

Of records with equal payloads (SHA-256 and length) of at least `least` bytes, that with the largest key is a
`response` and the others are `revisit` records that refer to it. Defined results: null payload is empty; null keys
sort below all others; of repeated rows with that largest key one is the response and the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

CHUNK = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_roles(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000) -> DataFrame:
    """(page, copy, url, body, n_bytes, sha1, refers): each row as a record. Payloads are shuffled once, by row;
    equal payloads meet as digests only, and are counted before they meet."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("page"), F.col(key).alias("order"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"n_bytes": F.octet_length("body").cast("bigint"), "same": F.unhex(F.sha2("body", 256))})
    narrow = rows.filter(F.col("n_bytes") >= least).select("page", "order", "same")
    tops = narrow.groupBy("same").agg(F.max(F.struct(F.col("order").isNotNull().alias("known"), "order", "page")).alias("top"))
    # One row for each key and payload: where the largest key of the payload is.
    roles = (
        narrow.distinct().join(tops, "same")
        .select(F.coalesce("page", F.lit("")).alias("at"), "same", F.col("page").eqNullSafe(F.col("top.page")).alias("first"), F.coalesce("top.page", F.lit("")).alias("top"))
    )
    rows = rows.withColumn("at", F.coalesce("page", F.lit("")))
    copies = Window.partitionBy("at", "same").orderBy("url")
    rows = rows.withColumn("copy", F.row_number().over(copies)).join(roles, ["at", "same"], "left")
    alone = F.col("top").isNull() | (F.col("first") & (F.col("copy") == 1))
    return rows.select("page", "at", "copy", "url", "body", "n_bytes", F.sha1("body").alias("sha1"), F.when(~alone, F.col("top")).alias("refers"))


def chunks(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """Each record as rows of (record, chunk, data); a revisit is one row without data."""
    last = F.when(F.col("refers").isNull(), F.greatest(F.lit(0), F.ceil(F.col("n_bytes") / size).cast("int") - 1)).otherwise(0)
    rows = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    data = F.when(F.col("refers").isNull(), F.substring("body", F.col("chunk") * size + 1, F.lit(size))).otherwise(F.lit(b""))
    return rows.select("page", "at", "copy", "url", "n_bytes", "sha1", "refers", "chunk", data.alias("data"))


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(folder)
    return fs, path.rstrip("/")


def _plain(text: str) -> str:
    """A header value without control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


class Writer:
    """Records into one file, each a gzip member of its own."""

    def __init__(self, out, date: str):
        self.out, self.date, self.member = out, date, None

    def begin(self, row: dict) -> None:
        self.end()
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
        length = len(_HTTP) + (0 if row["refers"] is not None else row["n_bytes"])
        lines = [
            "WARC/1.1",
            "WARC-Type: " + ("response" if row["refers"] is None else "revisit"),
            f"WARC-Record-ID: <urn:page:{_plain(row['at'])}:{row['sha1']}:{row['copy']}>",
            f"WARC-Date: {self.date}",
            f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {row['n_bytes']}",
        ]
        if row["url"] is not None:
            lines.append("WARC-Target-URI: " + _plain(row["url"]))
        if row["refers"] is not None:
            lines += [f"WARC-Refers-To: <urn:page:{_plain(row['refers'])}:{row['sha1']}:1>", f"WARC-Profile: {_PROFILE}"]
        lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {length}", "", ""]
        self.data("\r\n".join(lines).encode() + _HTTP)

    def data(self, part: bytes) -> None:
        self.out.write(self.member.compress(part))

    def end(self) -> None:
        if self.member:
            self.out.write(self.member.compress(b"\r\n\r\n") + self.member.flush())
            self.member = None


def write_archives(records: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", size: int = CHUNK) -> None:
    """One .warc.gz a task under `folder`, and the manifest of those that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        task = TaskContext.get()
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        name, n = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz", 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            writer = Writer(out, date)
            batch = first
            while batch is not None:
                names = [c for c in batch.schema.names if c != "data"]
                data = batch.column(batch.schema.get_field_index("data"))
                for i, row in enumerate(batch.select(names).to_pylist()):
                    if row["chunk"] == 0:
                        writer.begin(row)
                        n += 1
                    part = data[i].as_py()
                    if part:
                        writer.data(part)
                batch = next(batches, None)
            writer.end()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "n_records"])

    rows = chunks(records, size).sortWithinPartitions("at", "copy", "sha1", "chunk")
    rows.mapInArrow(run, "file string, n_records bigint").write.parquet(f"{folder}/manifest")


class _Members:
    """The bytes of a file of gzip members, read in parts."""

    def __init__(self, raw, part: int = 1 << 16):
        self.raw, self.part, self.held, self.unzip = raw, part, bytearray(), zlib.decompressobj(31)

    def more(self) -> bool:
        rest = self.unzip.unconsumed_tail
        if self.unzip.eof:  # what follows a member is unused; the tail may repeat it
            rest, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
        if not rest:
            rest = self.raw.read(self.part)
            if not rest:
                return False
        self.held += self.unzip.decompress(rest, self.part)
        return True

    def line(self) -> bytes | None:
        while (at := self.held.find(b"\r\n")) < 0:
            if not self.more():
                return None
        out = bytes(self.held[:at])
        del self.held[: at + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def records(raw, size: int = CHUNK) -> Iterator[tuple[dict[str, str], int, bytes, bool]]:
    """(headers, chunk number, data, whether it is the last) of each record in turn; payload without HTTP headers."""
    source = _Members(raw)
    while (line := source.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while line := source.line():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        left = int(headers["content-length"])
        while left > 0 and (line := source.line()) is not None:  # HTTP headers
            left -= len(line) + 2
            if not line:
                break
        number = 0
        while True:
            data = source.take(min(size, left))
            left -= len(data)
            last = left <= 0 or not data
            yield headers, number, data, last
            if last:
                break
            number += 1


def read_chunks(spark: SparkSession, folder: str, size: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The archives as chunk rows: record, page, type, refers, chunk, last, bytes and SHA-1 so far, data.

    `n_bytes` and `sha1` of a revisit are those of its headers.
    """
    manifest = spark.read.schema("file string, n_records bigint").parquet(f"{folder}/manifest")
    files = max(1, manifest.count())
    names = ["record", "page", "record_type", "refers", "chunk", "last", "n_bytes", "sha1", "data"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]

    def page_of(record: str | None) -> str | None:
        return None if record is None else record.strip("<>").removeprefix("urn:page:").rsplit(":", 2)[0]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    for headers, number, data, last in records(raw, size):
                        if number == 0:
                            digest, total = hashlib.sha1(), 0
                        digest.update(data)
                        total += len(data)
                        kind, refers = headers["warc-type"], headers.get("warc-refers-to")
                        sha1, n = digest.hexdigest(), total
                        if kind == "revisit":
                            sha1 = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                            n = int(headers["x-payload-length"])
                        if with_data or last:
                            rows.append((headers["warc-record-id"], page_of(headers["warc-record-id"]), kind, page_of(refers), number, last, n, sha1, data if with_data else None))
                            held += len(data) if with_data else 0
                        if held > 1 << 22 or len(rows) >= 10_000:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    return manifest.select("file").repartitionByRange(files, "file").mapInArrow(
        run, "record string, page string, record_type string, refers string, chunk bigint, last boolean, n_bytes bigint, sha1 string, data binary"
    )
