"""Tables as Parquet folders under one root on the cluster's file system.

Text staging lies in folders by source, row state and load. All other tables are versioned: every write goes to a folder of its
own, and a commit (see `snapshots`) says which folders are the table. `with store.commit():` publishes the writes inside it
together or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from quotewell.functions.calendar import year_of
from quotewell.schemas import STAGING_TABLES, TABLES, data_type
from quotewell.sources.snapshots import Commits, Snapshot

# Staging lies in folders by source, row state and load, so a state change or a reload rewrites whole folders.
STAGING_LAYOUT = ["ds_fonte", "fl_processado", "id_carga"]
BY_YEAR = ["fato_cotacao", "fato_indicador_macro", "fato_dem_financeira", "fato_indicadores", "hist_preco_ajustado", "hist_dem_versao"]
_PARTITION_TYPES = {"ds_fonte": "string", "fl_processado": "int", "id_carga": "bigint", "nr_ano": "int"}
SMALL = 32 << 20  # bytes under which folders of one table are worth merging


def literal_row(spark: SparkSession, schema: T.StructType, values: list) -> DataFrame:
    """One row of literals (missing ones NULL), made by the JVM alone."""
    padded = [*values, *[None] * (len(schema) - len(values))]
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(padded, schema)])


@dataclass
class Store:
    spark: SparkSession
    root: str
    _draft: Snapshot | None = None
    _created: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self._commits = Commits(self.spark, self.root)

    # ---- commits ----------------------------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """What readers see; inside `commit` also what it has written so far."""
        return self._draft or self._commits.newest()

    @contextmanager
    def commit(self) -> Iterator[None]:
        """The writes inside are published together at the end; a failure publishes none of them.

        An inner block belongs to the outer one.
        """
        if self._draft is not None:
            yield
            return
        before = self._commits.newest()
        self._draft = before.next()
        try:
            yield
            if (self._draft.tables, self._draft.marks) != (before.tables, before.marks):
                self._commits.publish(self._draft)
        finally:
            self._draft = None

    def versions(self) -> list[int]:
        """Numbers of the commits that can still be read, ascending."""
        return self._commits.numbers()

    def vacuum(self, keep: int = 10) -> int:
        """Drop all but the newest commits and what only they used. Readers of a dropped commit fail."""
        return self._commits.drop_older(max(1, keep))

    def reserve(self, column: str, count: int) -> int:
        """The first of `count` numbers that nobody else gets; they are taken once the commit is published."""
        with self.commit():
            first = self._draft.marks.get(column, 0) + 1
            self._draft.marks[column] = first + count - 1
        return first

    def mark(self, column: str, highest: int) -> None:
        """The highest number in use, where it is known only after a write."""
        with self.commit():
            self._draft.marks[column] = max(highest, self._draft.marks.get(column, 0))

    def set_mark(self, column: str, value: int) -> None:
        """A number that goes with the tables."""
        with self.commit():
            self._draft.marks[column] = value

    # ---- schemas and reading ----------------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def layout(self, table: str) -> list[str]:
        if table in STAGING_TABLES:
            return STAGING_LAYOUT
        return ["nr_ano"] if table in BY_YEAR else []

    def schema(self, table: str) -> T.StructType:
        layout = self.layout(table)
        stored = [f for f in TABLES[table] if f.name not in layout]
        return T.StructType([*stored, *[T.StructField(c, data_type(_PARTITION_TYPES[c])) for c in layout]])

    def create(self, table: str) -> None:
        """An empty staging table, unless it is there already."""
        if table in self._created or table not in STAGING_TABLES:
            return
        self.empty(table).write.mode("ignore").partitionBy(*self.layout(table)).parquet(self.path(table))
        self._created.add(table)

    def write_once(self, df: DataFrame, table: str) -> None:
        """Fill a table that no commit has yet; leave one that is there."""
        if table not in self.snapshot().tables:
            self.overwrite(df, table)

    def empty(self, table: str) -> DataFrame:
        return literal_row(self.spark, self.schema(table), []).limit(0)

    def folders(self, table: str, at: int | None = None) -> list[str]:
        """The folders that are the table now, or at a commit."""
        snapshot = self.snapshot() if at is None else self._commits.read(at)
        return [f"{self.path(table)}/{f}" for f in snapshot.tables.get(table, [])]

    def read(self, table: str, at: int | None = None) -> DataFrame:
        """The table as of the newest commit, or of commit `at`."""
        schema = self.schema(table)
        if table in STAGING_TABLES:
            self.create(table)
            return self.spark.read.schema(schema).parquet(self.path(table))
        folders = self.folders(table, at)
        if not folders:
            return self.empty(table)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*folders).select(*schema.fieldNames())

    def fit(self, df: DataFrame, table: str) -> DataFrame:
        """The table's columns in order and type; columns the frame lacks are NULL."""
        if "nr_ano" in self.layout(table) and "nr_ano" not in df.columns:
            df = df.withColumn("nr_ano", year_of(F.col("id_data")))
        return df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema(table)]
        )

    def is_there(self, place: str) -> bool:
        """Whether a delivered path exists."""
        return self._commits.exists(place)

    # ---- versioned tables -------------------------------------------------------------------------

    def _written(self, df: DataFrame, table: str, sort: list[str] | None = None, gathered: bool = False) -> list[str]:
        """Write rows to a new folder; the folders, relative to the table, that hold them."""
        rows, layout = self.fit(df, table), self.layout(table)
        rows = rows if gathered else self._gathered(rows, table)
        if sort:
            rows = rows.sortWithinPartitions(*layout, *sort)
        folder = f"versao={self.snapshot().number:012d}-{uuid.uuid4().hex[:8]}"
        writer = rows.write.partitionBy(*layout) if layout else rows.write
        writer.parquet(f"{self.path(table)}/{folder}")
        if not layout:
            return [folder]
        return [f"{folder}/{part}" for part in self._commits.children(f"{self.path(table)}/{folder}") if "=" in part]

    def append(self, df: DataFrame, table: str, sort: list[str] | None = None, gathered: bool = False) -> None:
        """Add rows. Within its files a fact is sorted by key, for row-group skipping. Rows that lie together by folder already
        (`gathered`) are written as they come."""
        with self.commit():
            self._draft.tables.setdefault(table, []).extend(self._written(df, table, sort, gathered))

    def append_numbered(self, df: DataFrame, table: str, number: str) -> None:
        """Add rows numbered above all numbers given so far: tasks number theirs in ranges of their own, and the highest comes from
        the write itself."""
        with self.commit():
            start, seen = self._draft.marks.get(f"{table}.{number}", 0) + 1, Observation()
            rows = df.withColumn(number, F.lit(start) + F.monotonically_increasing_id())
            self.append(rows.observe(seen, F.max(number).alias("last")), table)
            self.mark(f"{table}.{number}", seen.get["last"] or 0)

    def overwrite(self, df: DataFrame, table: str, sort: list[str] | None = None) -> None:
        """The rows become the whole table. They may be computed from the table itself."""
        with self.commit():
            self._draft.tables[table] = self._written(df, table, sort)

    swap = overwrite

    def replace_partitions(self, df: DataFrame, table: str, sort: list[str] | None = None, gathered: bool = False) -> None:
        """Rewrite exactly the partitions the frame has rows for; the files of the others stay. Repeating it changes nothing."""
        if table in STAGING_TABLES:
            rows = self.fit(df, table)
            (rows if gathered else self._gathered(rows, table)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *self.layout(table)
            ).parquet(self.path(table))
            return
        with self.commit():
            new = self._written(df, table, sort, gathered)
            parts = {f.split("/", 1)[1] for f in new}
            old = self._draft.tables.get(table, [])
            self._draft.tables[table] = [f for f in old if f.split("/", 1)[1] not in parts] + new

    def compact(self, *tables: str, small: int = SMALL) -> None:
        """Merge the small folders of each table (of each year, where it lies by year) into one file."""
        with self.commit():
            for table in tables:
                groups: dict[str, list[str]] = {}
                for f in self._draft.tables.get(table, []):
                    groups.setdefault(f.partition("/")[2], []).append(f)
                for folders in groups.values():
                    few = [f for f in folders if self._commits.bytes_in(f"{self.path(table)}/{f}") < small] if len(folders) > 1 else []
                    if len(few) > 1:
                        rows = self.spark.read.schema(self.schema(table)).option("basePath", self.path(table))
                        rows = rows.parquet(*[f"{self.path(table)}/{f}" for f in few]).coalesce(1)
                        kept = [f for f in self._draft.tables[table] if f not in few]
                        self._draft.tables[table] = kept + self._written(rows, table)

    def _gathered(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows of one folder brought together, so that tasks x folders files do not arise.

        The rebalance hint lets AQE merge small partitions and split large ones: a year with most of the
        rows is written by many tasks.
        """
        layout = self.layout(table)
        return rows.hint("rebalance", *layout) if layout else rows

    # ---- staging ----------------------------------------------------------------------------------

    def replace_pending(self, batch: DataFrame, table: str, source: str, load_id: int) -> None:
        """The batch becomes the only pending data of its source; processed rows stay.

        The pending folder itself is overwritten, so an empty batch clears it as well.
        """
        folder = f"{self.path(table)}/ds_fonte={source}/fl_processado=0"
        rows = self.fit(batch.withColumn("id_carga", F.lit(load_id)), table).drop("ds_fonte", "fl_processado")
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("id_carga")
            .parquet(folder)
        )

    def pending_loads(self, table: str, source: str) -> list[int]:
        """The loads whose rows wait in a source's pending folder, by the folders' names."""
        names = self._commits.children(f"{self.path(table)}/ds_fonte={source}/fl_processado=0")
        return [int(n.split("=")[1]) for n in names if n.startswith("id_carga=")]

    def settle(self, typed: DataFrame, table: str, source: str) -> None:
        """Move a source's pending rows to their new states 1 or 2, then clear the pending folder.

        The settled rows replace the folders of their own load, so a repeat after a failure adds nothing. The pending rows of a
        load lie in files of their own, and a task that reads some of them writes two files a load at most: no shuffle is needed.
        """
        self.replace_partitions(typed, table, gathered=True)
        self.drop_folder(table, {"ds_fonte": source, "fl_processado": 0})

    def drop_folder(self, table: str, partition: dict[str, object]) -> None:
        """Delete one partition folder of a staging table on whatever file system the store lies."""
        self._commits.delete("/".join([self.path(table), *[f"{column}={value}" for column, value in partition.items()]]))


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "id_acao", day: str = "id_data") -> None:
    """Save a fact as a catalog table bucketed by share and sorted by day.

    Windows and joins on the share then need no shuffle of the fact.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, day).saveAsTable(table)
