"""Merkle manifest of a dataset: one tree of SHA-256 digests a group, one tree over the groups' roots, proofs, folding.

A leaf is the digest of a row's columns, each written as `-` (null) or its UTF-8 byte count, `:` and its value. In a group
leaves ascend by key; while a level has several nodes, every three consecutive ones (the last run: fewer, even one)
become one, the digest of their hex digests in order. What remains is the group's root, a lone leaf its own. The roots, ordered by group
(null first, then bytewise), become one root by the same rule.

Each level is one window pass: the two rows before and after a node, masked by its slot in its run and the run's length,
are its siblings, and the first row of a run hashes the run. Windows are cut into blocks of `BLOCK` consecutive nodes, a
power of three, so no run is cut and no group, however large, is one task. Places come from a range sort with a running
number as its last key, so a third of all rows may be copies of one. A level holds a third of the rows of the one
below; it is written to the shared folder, as no later step then depends on the work of a lost executor. Paths go
down from the root, each level's rows joined with their parents' paths.

Defined results: a null group is a group of its own; rows without a key come first in theirs; rows with the same key ascend
by leaf, and equal rows are neighbours; an empty table has no rows and no root; other columns are carried along or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotewell.llm.graph import stored

ARITY = 3
BLOCK = ARITY**7
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts), 256)


def encoded(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return digest(*[encoded(c) for c in columns])


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows (group, ...) with `at`, the place in their group from 0, and `size`, the group's rows."""
    spread = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("group", *order, "tie")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sort = spread.sortWithinPartitions("group", *order, "tie").withColumns({"part": F.spark_partition_id(), "position": position})
    sort = stored(sort.drop("tie"), "merkle-sorted")
    parts = sort.groupBy("group", "part").agg(F.min("position").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("group")
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    parts = parts.select("group", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("size"))
    return sort.join(parts, ["group", "part"]).withColumn("at", F.col("position") + F.col("shift")).drop("part", "position", "shift")


def level(nodes: DataFrame) -> DataFrame:
    """Nodes (group, at, size, hash, ...) with `step`, their siblings, and on the first of each run `parent`.

    A node that is alone in its group is its root and has no step.
    """
    run = Window.partitionBy("group", F.expr(f"at div {BLOCK}")).orderBy("at")
    slot = F.col("at") % ARITY
    length = F.least(F.lit(ARITY), F.col("size") - (F.col("at") - slot))
    before = [F.when(slot >= k, F.lag("hash", k).over(run)) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("hash", k).over(run)) for k in range(1, ARITY)]
    near = {f"near{i}": F.coalesce(c, F.lit("")) for i, c in enumerate([*before, *after])}
    left, right = [F.col(f"near{i}") for i in range(ARITY - 1)], [F.col(f"near{i}") for i in range(ARITY - 1, 2 * ARITY - 2)]
    inner = F.col("size") > 1
    step = F.when(inner, F.struct(F.concat(*left).alias("left"), F.concat(*right).alias("right")))
    parent = F.when(inner & (slot == 0), digest(F.col("hash"), *right))
    return nodes.withColumns(near).withColumns({"step": step, "parent": parent}).drop(*near)


def tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels from the leaves up, each written, and (group, hash, height) of every group's root.

    A node's height is 0 for a leaf; a group of n leaves ends at the height where ceil(n / 3) to the power of it is 1.
    """
    levels, roots, height = [], None, 0
    most = nodes.agg(F.max("size")).first()[0] or 0  # one number
    while True:
        tops = nodes.filter("size = 1").select("group", "hash", F.lit(height).alias("height"))
        roots = tops if roots is None else roots.unionByName(tops)
        if height and most <= 1:
            return levels, roots
        levels.append(stored(level(nodes.filter("size > 1") if height else nodes), "merkle-level"))
        up = levels[-1].filter(F.col("parent").isNotNull())
        nodes = up.select("group", F.expr(f"at div {ARITY}").alias("at"), F.ceil(F.col("size") / ARITY).alias("size"), F.col("parent").alias("hash"))
        most, height = -(-most // ARITY), height + 1


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with `path`, their steps from the leaf up, followed by what `tops` (group, height, path, ...) has for
    their group, and the other columns of `tops`."""
    more = [c for c in tops.columns if c not in ("group", "height", "path")]
    above = None
    for height in range(len(levels) - 1, -1, -1):
        ends = tops.filter(F.col("height").isin([0, 1] if height == 0 else [height + 1])).select("group", F.lit(0).cast("bigint").alias("up"), F.col("path").alias("_path"), *more)
        above = ends if above is None else above.unionByName(ends)
        rows = levels[height].withColumn("up", F.expr(f"if(size > 1, at div {ARITY}, 0)")).join(above, ["group", "up"])
        path = F.concat(F.when(F.col("step").isNull(), F.array().cast(STEP)).otherwise(F.array("step")), F.col("_path"))
        rows = rows.withColumn("path", path).drop("_path", "up")
        above = rows.select("group", F.col("at").alias("up"), F.col("path").alias("_path"), *more)
    return rows.drop("step", "parent")


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str) -> DataFrame:
    """The rows (columns: the group, those of `order`, the leaf's digest, any others) with `subroot`, `root` and `path`.

    `path` is an array of (left, right): the hex digests of the siblings on either side, from the leaf to the root.
    Names used inside start anew, so columns of any name may come along.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    # Null before all texts; a prefix keeps the empty text apart from it.
    name = F.concat(F.lit("="), F.col(f"`{group}`").cast("string"))
    inside = rows.select(F.coalesce(name, F.lit("")).alias("group"), *[F.col(f"`{c}`").alias(f"order{i}") for i, c in enumerate(order)], F.col(f"`{leaf}`").alias("hash"), own)
    keys = [f"order{i}" for i in range(len(order))]
    levels, roots = tree(placed(stored(inside, "merkle-leaves"), [*keys, "hash"]).drop(*keys))
    roots = stored(roots, "merkle-roots")
    upper, top = tree(placed(roots.select(F.lit(0).alias("group"), F.col("group").alias("member"), "height", "hash"), ["member"]))
    root = top.select("hash").first()  # one value
    end = top.select("group", "height", F.array().cast(STEP).alias("path"))
    # The upper tree's leaves are named by member and carry the height their own tree ends at.
    known = paths([upper[0].withColumnRenamed("height", "ends"), *upper[1:]], end)
    known = known.select(F.col("member").alias("group"), F.col("ends").alias("height"), "path", F.col("hash").alias("subroot"))
    out = paths(levels, stored(known, "merkle-groups"))
    return out.select("row.*", "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "path")


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Every document's leaf, proof and roots, and whether it still verifies after every second one lost its line breaks.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); rows without a key are not tampered with.
    """
    columns = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(F.coalesce(touched, F.lit(False)), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", leaf(*columns(F.col("text"))).alias("leaf"), leaf(*columns(text)).alias("found"))
    rows = manifest(rows, "source", ["doc_id"], "leaf")
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(F.col("found"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
