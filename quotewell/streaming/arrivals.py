"""Files that arrive in a folder, each taken once, duplicate keys ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from quotewell.operators.joins import insert_if_absent
from quotewell.operators.typed import Typing, apply_typing, passed, rejected
from quotewell.sources.csv_files import BAD_LINE, CsvSource, bad_lines, staging_columns


def stream_lines(spark: SparkSession, folder: str, source: CsvSource, files_per_batch: int | None = None) -> DataFrame:
    """The folder's CSV files as a stream of text columns, bound by position."""
    if source.by_header:
        raise ValueError("streamed sources bind by position")
    fields = [T.StructField(c, T.StringType()) for c in [*source.columns, BAD_LINE]]
    reader = (
        spark.readStream.schema(T.StructType(fields))
        .options(sep=source.sep, encoding=source.encoding, header=True, quote='"', escape='"')
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, columnPruning=False, recursiveFileLookup=True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return reader.csv(folder).select("*", place.alias("_place"))


def load_arrivals(
    spark: SparkSession,
    folder: str,
    source: CsvSource,
    typing: Typing,
    target: str,
    keys: list[str],
    checkpoint: str,
    day: str = "dt_data",
    files_per_batch: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Take every new file, type its rows, and append those whose key the target does not hold yet.

    The stream's checkpoint remembers the files taken and so replaces a date mark. A batch that is repeated
    after a failure finds its keys present and appends nothing. The target is partitioned by year, and a
    batch reads only the years it touches. Of equal keys in a batch the first in file order stays. Lines that are
    malformed or fail typing go to `rejects` (by default beside the target) with their reason, in a folder of their
    batch that a repeat writes again.
    """
    typed_fields = [F.col(f.name) for f in typing.fields]
    rejects = rejects or f"{target.rstrip('/')}_rejects"

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("_place", F.struct("_place", F.monotonically_increasing_id().alias("line")))
        typed = apply_typing(staging_columns(batch, source), typing)
        malformed = bad_lines(batch).select(F.lit("malformed line").alias("ds_erro"), "ds_dados")
        lost = malformed.unionByName(rejected(typed).select("ds_erro", "ds_dados"))
        lost.withColumn("ds_fonte", F.lit(source.name)).write.mode("overwrite").parquet(f"{rejects}/lote={number}")
        rows = passed(typed).select(*typed_fields, "_place")
        rows = rows.withColumn("nr_ano", F.year(day))
        session = batch.sparkSession
        stored = rows.drop("_place").schema
        session.createDataFrame([], stored).write.mode("ignore").partitionBy("nr_ano").parquet(target)
        held = session.read.schema(stored).parquet(target)
        new = insert_if_absent(held, rows, keys, [F.col("_place")], prune_on=["nr_ano", day]).drop("_place")
        new.hint("rebalance", "nr_ano").write.mode("append").partitionBy("nr_ano").parquet(target)

    return (
        stream_lines(spark, folder, source, files_per_batch)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
