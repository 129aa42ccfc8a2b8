"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quotewell.session import with_checkpoint_dir


def with_dense_keys(df: DataFrame, order: list[str], out: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """Number rows start, start+1, ... without gaps in `order`, which must identify a row.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the rows in
    earlier partitions. The numbered rows are checkpointed once: positions then hold even if an executor
    is lost between counting and shifting. The only ungrouped window runs over one row per partition.
    """
    with_checkpoint_dir(df.sparkSession)
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    inside_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        spread.sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", inside_partition)
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", before.alias("_before"))
    return (
        placed.join(F.broadcast(shifts), "_part")  # one row per partition
        .withColumn(out, (F.col("_before") + F.col("_pos") + start).cast("bigint"))
        .drop("_part", "_pos", "_before")
    )


def with_block_keys(df: DataFrame, out: str, start: int = 1) -> DataFrame:
    """Number rows start, start+1, ... without gaps, in no given order and without a sort.

    Rows are numbered inside their partition and shifted by the rows of the partitions before. The numbered rows are
    checkpointed once, so the numbers hold whatever happens to an executor. `start` comes from the store's marks
    (`Store.reserve`), so no scan looks for the highest number in use.
    """
    with_checkpoint_dir(df.sparkSession)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.withColumns({"_part": F.spark_partition_id(), "_pos": position}).checkpoint()
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", before.alias("_before"))
    return (
        placed.join(F.broadcast(shifts), "_part")  # one row per partition
        .withColumn(out, (F.col("_before") + F.col("_pos") + start).cast("bigint"))
        .drop("_part", "_pos", "_before")
    )


def day_key(entity: str, day: str = "id_data", kind: Column | None = None) -> Column:
    """A surrogate key made of the row's own: entity and YYYYMMDD, and a digit for the kind where several share a day.

    Unique where the row is, the same in every run, and nothing to look up.
    """
    key = F.col(entity).cast("bigint") * 100_000_000 + F.col(day)
    return key if kind is None else key * 10 + kind
