"""Chat formatting over a prefix tree of turns.

Conversations that begin with the same turns share the nodes of these turns. Every node's text is emitted once, in
one stream in depth-first order over the whole table, with

- `position`: the position id of its first token, counted from the root along its own path,
- `attend`: the intervals of the stream that its tokens may look at: its ancestors' and its own (causally),
- `loss_start`, `loss_end`: the part of the stream under the loss mask (texts of the assistant).

A token is a code point of the formatted text. A turn reads `### role: text</turn>` and a newline; in roles and
texts `\\`, `#` and `<` (in roles `:` too) are preceded by `\\`, so no text can hold a control string and
reading drops one `\\` before each of them.

A node is named by the running XOR of two 64-bit hashes of (place, role, text) and its depth, made in a window that
streams over a conversation. Paths stay rows: running sums along them give the size of each node's subtree, a sort of
siblings over all machines what lies between a node and its parent, and running sums along the paths the offsets.
Siblings go by descending size, so a node that does not follow its parent has at most half of its parent's size, and no
path has more intervals than the stream's length has bits, however long the conversation. Conversations with the same
turns are one path; a root shared by a third of all conversations is counted before it is shuffled.

Defined results: turns are ordered by (turn, role, text); a null turn comes first; null role and text are empty; rows
without a conversation id form one conversation; repeated rows are turns of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotewell.session import shared_dir

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.S)
_NODE = ["hi", "lo", "depth"]


def escaped(text: Column, characters: str = r"\\#<") -> Column:
    return F.regexp_replace(text, f"([{characters}])", r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of formatted text; raises where it is not whole turns."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, depth, hi, lo, up_hi, up_lo, formatted, position, before_text, assistant): every turn with its node."""
    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("depth", F.row_number().over(order))
    rows = rows.withColumns({"hi": F.bit_xor(F.xxhash64(F.lit(1), "depth", "role", "text")).over(upto), "lo": F.bit_xor(F.xxhash64(F.lit("2"), "text", "role", "depth")).over(upto)})
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), r"\\#<:"), F.lit(MIDDLE))
    rows = rows.withColumns({"up_hi": F.lag("hi").over(order), "up_lo": F.lag("lo").over(order), "head": head})
    rows = rows.withColumn("formatted", F.concat("head", escaped(F.col("text")), F.lit(CLOSE)))
    rows = rows.withColumn("n", F.length("formatted").cast("bigint"))
    return rows.select(
        "conv", "depth", "hi", "lo", "up_hi", "up_lo", "formatted", "n", (F.sum("n").over(upto) - F.col("n")).alias("position"),
        F.length("head").cast("bigint").alias("before_text"), (F.col("role") == "assistant").alias("assistant"),
    )


def prefix_tree(conversations: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(tree, paths): the emitted nodes, and (conv, depth, hi, lo) naming the nodes of every conversation."""
    spark = conversations.sparkSession
    turns_of(conversations, **columns).write.parquet(path := shared_dir(spark, "turns"))
    turns = spark.read.parquet(path)
    paths = turns.select("conv", "depth", "hi", "lo")
    # One conversation of each set of equal ones stands for their path.
    leaves = paths.groupBy("conv").agg(F.max(F.struct("depth", "hi", "lo")).alias("leaf"))
    chosen = leaves.groupBy("leaf").agg(F.min(F.struct("conv")).alias("first")).select("first.conv")
    chosen.withColumn("path", F.monotonically_increasing_id()).write.parquet(place := shared_dir(spark, "chosen"))
    chosen = spark.read.parquet(place).withColumnRenamed("conv", "of")
    steps = paths.join(chosen, F.col("conv").eqNullSafe(F.col("of"))).select("path", *_NODE)
    steps.write.parquet(place := shared_dir(spark, "steps"))
    steps = spark.read.parquet(place)
    # A node's size is the length of its subtree: along a path, the nodes it owns from there on; added up over the paths.
    owner = steps.groupBy(*_NODE).agg(F.min("path").alias("owner"))
    shape = turns.groupBy(*_NODE).agg(*[F.first(c).alias(c) for c in ("up_hi", "up_lo", "n", "position")]).join(owner, _NODE)
    down = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    tails = steps.join(shape, _NODE).withColumn("tail", F.sum(F.when(F.col("path") == F.col("owner"), F.col("n")).otherwise(0)).over(down))
    sizes = tails.groupBy(*_NODE).agg(F.sum("tail").alias("size"), *[F.first(c).alias(c) for c in ("up_hi", "up_lo", "n", "position", "owner")])
    _before(sizes).write.parquet(place := shared_dir(spark, "places"))
    places = spark.read.parquet(place)
    # Along a path offsets and intervals follow: a new interval wherever a node does not come right behind its parent.
    along = Window.partitionBy("path").orderBy("depth")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    walk = steps.join(places, _NODE).withColumn("offset", F.col("position") + F.sum("before").over(upto))
    walk = walk.withColumn("last_end", F.lag(F.col("offset") + F.col("n")).over(along))
    jump = F.col("last_end").isNull() | (F.col("before") > 0)
    walk = walk.withColumns({"starts": F.collect_list(F.when(jump, F.col("offset"))).over(upto), "ends": F.collect_list(F.when(jump, F.col("last_end"))).over(upto)})
    ends = F.concat("ends", F.array(F.col("offset") + F.col("n")))
    nodes = walk.filter("path = owner").select(*_NODE, "offset", F.arrays_zip(F.col("starts").alias("start"), ends.alias("end")).alias("attend"))
    texts = turns.groupBy(*_NODE).agg(*[F.first(c).alias(c) for c in ("up_hi", "up_lo", "formatted", "n", "position", "before_text", "assistant")])
    tree = texts.join(nodes, _NODE).withColumns(
        {
            "loss_start": F.when(F.col("assistant"), F.col("offset") + F.col("before_text")),
            "loss_end": F.when(F.col("assistant"), F.col("offset") + F.col("n") - len(CLOSE)),
        }
    )
    return tree.drop("assistant", "before_text"), paths


def _before(sizes: DataFrame) -> DataFrame:
    """(node, n, position, owner, before): how much of the stream lies between a node's parent and the node.

    That is the size of its earlier siblings. Siblings are sorted by descending size over all machines; a running sum
    in each sorted part and one row a part give sums over parts, so siblings of one parent may lie in many parts.
    """
    spark = sizes.sparkSession
    order = ["depth", "up_hi", "up_lo", F.desc("size"), "hi", "lo"]
    ranked = sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id())
    ranked.write.parquet(place := shared_dir(spark, "ranks"))
    inside = Window.partitionBy("part").orderBy("rank")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = spark.read.parquet(place).withColumns({"part": F.shiftright("rank", 33), "up": F.struct("depth", "up_hi", "up_lo")})
    ranked = ranked.withColumns({"start": F.sum("size").over(upto) - F.col("size"), "last_up": F.lag("up").over(inside)})
    opens = F.col("last_up").isNotNull() & ~F.col("last_up").eqNullSafe(F.col("up"))
    ranked = ranked.withColumn("opened", F.last(F.when(opens, F.col("start")), ignorenulls=True).over(upto))
    parts = ranked.groupBy("part").agg(
        F.sum("size").alias("total"), F.min_by("up", "rank").alias("head"), F.max_by("up", "rank").alias("tail"), F.max("opened").alias("latest")
    )
    by_part = Window.orderBy("part")
    parts = parts.withColumns({"base": F.sum("total").over(by_part) - F.col("total"), "last_tail": F.lag("tail").over(by_part)})
    at_head = F.when(~F.col("last_tail").eqNullSafe(F.col("head")), F.col("base"))
    parts = parts.withColumns({"at_head": at_head, "latest": F.coalesce(F.col("base") + F.col("latest"), at_head)})
    earlier = F.last("latest", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "base", F.coalesce("at_head", earlier).alias("carried"))
    before = F.col("base") + F.col("start") - F.coalesce(F.col("base") + F.col("opened"), F.col("carried"))
    return ranked.join(F.broadcast(parts), "part").select(*_NODE, "n", "position", "owner", before.alias("before"))


def read_back(tree: DataFrame, paths: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the emitted stream says of each conversation: counts and digests of its turns and of the text under the mask.

    A conversation's nodes stream through a task in order; nothing of it is held but running digests.
    """
    kind = paths.schema["conv"].dataType.simpleString()
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = paths.join(tree.select(*_NODE, "formatted", "offset", "position", "loss_start", "loss_end"), _NODE)
    rows = rows.repartition("conv").sortWithinPartitions("conv", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None
        id_type = None

        def pack() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def close() -> None:
            if now is not None:
                done.append((now["conv"], now["turns"], now["all"].hexdigest(), now["loss"], now["masked"].hexdigest(), now["chars"]))

        for batch in batches:
            id_type = batch.schema.field("conv").type
            for r in batch.to_pylist():
                if now is None or r["conv"] != now["conv"]:
                    close()
                    now = {"conv": r["conv"], "turns": 0, "all": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0}
                if r["position"] != now["chars"]:
                    raise ValueError("position ids do not follow on")
                for role, body in parse(r["formatted"]):
                    now["turns"] += 1
                    now["all"].update(f"{role}\n{body}\n".encode())
                if r["loss_start"] is not None:
                    masked = unescape(r["formatted"][r["loss_start"] - r["offset"] : r["loss_end"] - r["offset"]])
                    now["loss"] += len(masked)
                    now["masked"].update(masked.encode())
                now["chars"] += len(r["formatted"])
            if len(done) > 5000:
                yield pack()
                done = []
        close()
        if done:
            yield pack()

    return rows.select("conv", "formatted", "offset", "position", "loss_start", "loss_end").mapInArrow(
        run, f"`{conv}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
