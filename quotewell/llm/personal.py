"""Personal data by bootstrapped contextual extraction.

Four base patterns find seed entities. The two words before an entity are a lexical pattern; a pattern and the things
found behind it are a graph, in which Spark scores, for a fixed number of rounds,

- a pattern for a kind: (sum of its instances' scores) / (its distinct instances + 1), with at least
  `support` distinct instances that count for the kind; patterns below `least` count for nothing,
- an instance that is no seed: 1 - product over its patterns of (1 - pattern score).

Instances are seeds and identifier-like strings (digits with separators, or words around a masked @) that no base
pattern matched. In the end, patterns of at least `confident` mark the identifier-like strings behind them as
`context_<kind>`. Graph nodes are 64-bit hashes, so no personal text is stored or shuffled; texts are read once and
leave no more than their spans.

Defined results: null text is empty; rows without a key or repeated get their own results; an entity at the start of
a text has no pattern; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from quotewell.session import shared_dir

# The kinds in order, and the base patterns.
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LIKE = re.compile(r"(?<![\w.@])(?:\(?[0-9][0-9\x20().\-/]{4,40}[0-9]|[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9.-]{1,64})(?![\w@])")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base entities, ascending. Each pattern runs from left to right without overlap."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        # The local part is all of the run before the @ that the last match left: a shorter one would start later.
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at) if first < at else None
        if m:
            out.append((first, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def like_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of identifier-like strings of six digits or a masked @ that overlap no base entity."""
    out = []
    for m in _LIKE.finditer(text):
        if sum(c.isdigit() for c in m[0]) < 6 and "at" not in m[0]:
            continue
        if not any(s < m.end() and m.start() < e for s, _, e in taken):
            out.append((m.start(), m.end()))
    return out


def context(text: str, start: int) -> int | None:
    """Hash of the two words before a place, lower-cased, without punctuation around them; None without any."""
    words = [w.strip(".,;:!?\"'()[]<>=").lower() for w in _WORDS.findall(text[max(0, start - 80) : start])[-2:]]
    words = [w for w in words if w]
    return xxhash.xxh3_64_intdigest(" ".join(words).encode()) - (1 << 63) if words else None


def _instance(text: str) -> int:
    return xxhash.xxh3_64_intdigest("".join(c for c in text.lower() if c.isalnum() or c == "@").encode()) - (1 << 63)


MENTION = "array<struct<start:bigint,end:bigint,kind:int,pattern:bigint,instance:bigint>>"


def mentions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, found): base entities (kind 0 to 3) and identifier-like strings (kind -1) of every row, without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("pattern", pa.int64()), ("instance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(1):
                body = value.as_py() or ""
                base = base_spans(body)
                rows = [(s, e, k) for s, k, e in base] + [(s, e, -1) for s, e in like_spans(body, base)]
                found.append([{"start": s, "end": e, "kind": k, "pattern": context(body, s), "instance": _instance(body[s:e])} for s, e, k in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], [key, "found"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, found {MENTION}")


def _stored(df: DataFrame, label: str) -> DataFrame:
    df.write.parquet(path := shared_dir(df.sparkSession, label))
    return df.sparkSession.read.parquet(path)


def patterns(found: DataFrame, rounds: int = 3, support: int = 5, least: float = 0.5) -> DataFrame:
    """(pattern, kind, score) after the rounds. Each round is two joins on hashed nodes over distinct edges."""
    each = found.select(F.explode("found").alias("m")).select("m.kind", "m.pattern", "m.instance").filter("pattern IS NOT NULL")
    edges = _stored(each.select("pattern", "instance").distinct(), "edges")
    degree = edges.groupBy("pattern").agg(F.count("*").alias("degree")).filter(F.col("degree") >= support)
    edges = edges.join(degree, "pattern")  # patterns that never can be kept leave the graph here
    seeds = each.filter("kind >= 0").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    scores, seeds = None, _stored(seeds, "seeds")
    for _ in range(rounds):
        known = seeds
        if scores is not None:
            guessed = (
                edges.join(scores, "pattern").groupBy("instance", "kind")
                .agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("score"))
                .join(seeds.select("instance").distinct(), "instance", "left_anti")
            )
            known = seeds.unionByName(guessed)
        scores = (
            edges.join(known, "instance").groupBy("pattern", "kind", "degree")
            .agg(F.sum("score").alias("mass"), F.count("*").alias("n"))
            .filter(F.col("n") >= support)
            .select("pattern", "kind", (F.col("mass") / (F.col("degree") + 1)).alias("score"))
            .filter(F.col("score") >= least)
        )
        scores = _stored(scores, "patterns")
    return scores


def extracted(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = 3, support: int = 5, confident: float = 0.8) -> DataFrame:
    """(key, spans array<struct<start,place,end,kind>>) of every row: base entities (place 0 to 3) and those found by
    context (place 4 to 7)."""
    found = _stored(mentions(docs, key, text), "mentions").withColumn("row", F.monotonically_increasing_id())
    best = patterns(found, rounds, support).filter(F.col("score") >= confident)
    best = best.groupBy("pattern").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("place"))
    unseen = found.select("row", F.explode(F.filter("found", lambda m: m["kind"] < 0)).alias("m"))
    added = unseen.join(best, F.col("m.pattern") == best["pattern"])
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"context_{k}") for k in KINDS])

    def span(start: Column, place: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), place.alias("place"), end.alias("end"), F.element_at(names, place + 1).alias("kind"))

    added = added.groupBy("row").agg(F.collect_set(span(F.col("m.start"), F.col("place") + 4, F.col("m.end"))).alias("added"))
    base = F.transform(F.filter("found", lambda m: m["kind"] >= 0), lambda m: span(m["start"], m["kind"], m["end"]))
    both = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast(added.schema["added"].dataType))))
    return found.withColumn("base", base).join(added, "row", "left").select(key, both.alias("spans"))


def digest(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""
    def text(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["place"] < len(KINDS))
    places = F.transform("spans", lambda s: s["place"])
    counts = [F.size(F.filter(places, lambda p: p == i)).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]  # noqa: B023
    return rows.select(key, *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
