"""Secret scans with an incremental ledger of blobs. DataFrame functions only: no Python runs on the data.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds, for each blob, which rules at
which version have scanned it and what they found. A scan takes the distinct blobs, leaves out the pairs of blob and
rule version that the ledger has, scans the rest once however many paths share them, appends them, and joins the
findings of the asked rules back to all paths. Each scan appends in one committed write, so a failed one leaves
nothing and a repeated one finds its pairs done; should two scans run at once, equal findings are counted once.

Positions come from the lengths of the text between matches and of the matches, summed up in a window by blob and
rule; no text leaves the scan but in the one shuffle that brings equal blobs together.

Defined results: null text is empty; a path with a null key is a path like any other; repeated rows each get their
findings; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quotewell.llm.graph import unused


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    version: int = 1
    least: int = 0  # fewest characters of the match, or of `group` where one is named
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules, then the ones this operator adds.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=6, group=2),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),  # a run of 24 or more is a whole run: shorter ones would be dropped
]
ADDED = [
    Rule("vendor", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,})"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
]
RULES = BASE + ADDED
LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:bigint,end:bigint>>"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; empty where the folder does not exist."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LEDGER)


def _lengths(rule: Rule) -> Column:
    """For each match in order: characters since the last match, of the match, and of the part that is measured."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split("text", rule.pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length)
    measured = F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length) if rule.group else matches
    return F.arrays_zip(F.slice(between, F.lit(1), F.size(matches)).alias("gap"), matches.alias("size"), measured.alias("part"))


def scan(versions: DataFrame, ledger: str, rules: list[Rule] = RULES, text: str = "text") -> None:
    """Bring the ledger up to date: scan each distinct text with the rules that have not seen it, and append."""
    spark = versions.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    done = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
    blobs = versions.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    todo = (
        blobs.join(done, "blob", "left")
        .withColumn("rules", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))))
        .filter(F.size("rules") > 0)
    )
    empty = F.array().cast("array<struct<gap:int,size:int,part:int>>")
    per_rule = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.least).alias("least"),
            F.when(F.array_contains("rules", r.name) & F.col("text").rlike(r.pattern), _lengths(r)).otherwise(empty).alias("hits"),
        )
        for r in rules
    ]
    # Only texts with a match become rows here; a blob without any goes on as itself.
    hits = todo.select("blob", F.array(*per_rule).alias("per_rule"), "rules")
    flat = hits.select("blob", "rules", F.filter("per_rule", lambda x: F.size(x["hits"]) > 0).alias("per_rule"))
    rows = (
        flat.select("blob", "rules", F.explode_outer("per_rule").alias("r"))
        .select("blob", "rules", "r.rule", "r.least", F.posexplode_outer("r.hits").alias("place", "hit"))
    )
    before = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("end", F.sum(F.col("hit.gap").cast("bigint") + F.col("hit.size")).over(before))
    finding = F.when(
        F.col("hit").isNotNull() & (F.col("hit.part") >= F.col("least")),
        F.struct("rule", (F.col("end") - F.col("hit.size")).alias("start"), "end"),
    )
    found.groupBy("blob").agg(F.first("rules").alias("rules"), F.array_sort(F.collect_list(finding)).alias("findings")).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """(blob, found: array of start, place of the rule, end, kind, ascending) of the blobs where these rules found some."""
    kinds = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    labels = F.array(*[F.lit(r.kind) for r in rules])
    each = read_ledger(spark, ledger).select("blob", F.explode("findings").alias("f")).withColumn("place", kinds[F.col("f.rule")])
    one = F.struct(F.col("f.start").alias("start"), "place", F.col("f.end").alias("end"), F.element_at(labels, F.col("place") + 1).alias("kind"))
    return each.filter("place IS NOT NULL").groupBy("blob").agg(F.array_sort(F.collect_set(one)).alias("found"))


def found_in(versions: DataFrame, ledger: str, rules: list[Rule] = RULES, text: str = "text", into: str = "found") -> DataFrame:
    """All rows and columns of `versions` and, as `into`, the findings of their text (empty where there are none)."""
    if into in versions.columns:
        raise ValueError(f"there is a column {into} already; name another by `into`")
    blob = unused(versions, "blob")
    found = findings(versions.sparkSession, ledger, rules).withColumnsRenamed({"blob": blob, "found": into})
    none = F.array().cast(found.schema[into].dataType)
    return versions.withColumn(blob, address(F.col(text))).join(found, blob, "left").drop(blob).withColumn(into, F.coalesce(into, none))


def spans(found: Column) -> Column:
    """kind:start:end of each finding in order, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))


def digest(rows: DataFrame) -> DataFrame:
    """The counts, the digest of the base findings and all spans of rows that have `found`."""
    base = F.filter("found", lambda f: f["place"] < len(BASE))
    places = F.transform("found", lambda f: f["place"])
    counts = [F.size(F.filter(places, lambda p: p == i)).cast("bigint").alias(f"n_{r.kind}") for i, r in enumerate(BASE)]  # noqa: B023
    return rows.select("doc_id", *counts, F.sha2(spans(base).cast("binary"), 256).alias("base_sha256"), spans(F.col("found")).alias("spans"))


def redacted(versions: DataFrame, ledger: str, mark: str = "[SECRET]", rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows with every found span replaced by `mark`; overlapping spans become one."""
    found = unused(versions, "found")
    rows = found_in(versions, ledger, rules, text, found)
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, f: Column) -> Column:
        clean = F.col(text).substr((acc["upto"] + 1).cast("int"), (f["start"] - acc["upto"]).cast("int"))
        grown = F.when(f["start"] >= acc["upto"], F.concat(acc["out"], F.array(clean, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["upto"], f["end"]).alias("upto"), grown.alias("out"))

    def close(acc: Column) -> Column:
        rest = F.col(text).substr((acc["upto"] + 1).cast("int"), F.length(text))
        return F.array_join(F.concat(acc["out"], F.array(rest)), "")

    masked = F.when(F.size(found) == 0, F.col(text)).otherwise(F.aggregate(found, start, step, close))
    return rows.withColumn(text, masked).drop(found)
