"""Quotes that arrive in a folder: into the store, or as returns kept in the stream's own state.

Quotes may come in any order. The session after a late quote has its return corrected, and a day that came first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quotewell.operators.typed import QUOTES as TYPING, REJECTED, apply_typing, passed
from quotewell.plans.warehouse import load_quotes
from quotewell.session import shared_dir
from quotewell.sources.csv_files import BAD_LINE, QUOTES, CsvSource, staging_columns
from quotewell.sources.loading import log_errors
from quotewell.sources.store import Store
from quotewell.streaming.arrivals import stream_lines

SHARES = 16  # shares a group of the stream's state, a power of two


def stream_quotes(store: Store, folder: str, checkpoint: str, source: CsvSource = QUOTES, files_per_batch: int | None = None) -> StreamingQuery:
    """Every new file of the folder into fato_cotacao, each batch in one commit with its state, its rejects and its number.

    What a batch needs to know of the past is the state that `load_quotes` keeps beside the fact: a row per share and year.
    The batch's number is committed with it under the query's own id, so a batch that is repeated after a failure finds itself
    done. Malformed lines, rows that fail typing, unknown tickers and impossible days go to the error log.
    """

    def merge(batch: DataFrame, number: int) -> None:
        name = f"stream.{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        if store.snapshot().marks.get(name, 0) > number:
            return
        batch = batch.withColumn("_place", F.struct("_place", F.monotonically_increasing_id().alias("line")))
        # One pass over the files: the lines of all outcomes become a table of the store's own session.
        typed = apply_typing(staging_columns(batch, source, with_bad=True), TYPING)
        typed.write.parquet(path := shared_dir(store.spark, "arrived"))
        typed = store.spark.read.schema(typed.schema).parquet(path)
        bad = F.col(BAD_LINE).isNotNull()
        good = passed(typed.filter(~bad)).drop(BAD_LINE).withColumnRenamed("_place", "id_staging")
        lost = typed.filter(bad | (F.col("fl_processado") == REJECTED)).select(
            F.when(bad, "malformed line").otherwise(F.col("ds_erro")).alias("ds_erro"), F.coalesce(BAD_LINE, "ds_dados").alias("ds_dados")
        )
        with store.commit():
            if not lost.isEmpty():
                log_errors(store, lost, ds_etapa="STREAM", ds_fonte=source.name, ds_procedure="stream_quotes")
            load_quotes(store, good)
            store.mark(name, number + 1)

    return (
        stream_lines(store.spark, folder, source, files_per_batch)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stateful_returns(
    quotes: DataFrame, key: str = "id_acao", day: str = "id_data", close: str = "vl_fechamento", order: str | None = None, keep: int | None = None
) -> DataFrame:
    """Closes of a stream as rows (key, day, close, vl_anterior, vl_retorno_diario), new ones and corrected ones, in update mode.

    The state holds each share's days and closes, in order. A quote of a new day gives its own row; if the share has a later session,
    that one's row comes again with its new predecessor. A day that is there already is ignored; of equal days in a batch the one
    lowest in `order` counts, NULL last. With `keep` the state holds only the latest `keep` sessions, and a quote before the first of
    these is ignored; without, it grows with the calendar, 16 bytes a session. Shares of neighbouring whole numbers, SHARES of them
    at most, have one group and state, as a group costs Spark more than its rows; a key of another type has a group of its
    own. Groups are read in pieces, so a batch of many repeats is never in memory as a whole. Returns are decimal, as in batch. Rows
    without a key, a day or a close are left out.
    """
    fields = dict(quotes.dtypes)
    unit = 10_000  # closes have four digits: whole numbers in the state
    whole = fields[key] in ("tinyint", "smallint", "int", "bigint")
    none = (np.empty(0, np.int64),) * 2

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        if state.exists:
            slots, sizes, *both = (np.frombuffer(a, np.int64) for a in state.get)
            held = dict(zip(slots.tolist(), zip(*[np.split(a, np.cumsum(sizes)[:-1]) for a in both])))
        new: dict[int, tuple] = {}
        for part in parts:
            rows = [part[name].to_numpy(np.int64) for name in ("_slot", "_day", "_close", "_order")]
            for slot in np.unique(rows[0]).tolist():
                days = held.get(slot, none)[0]
                d, c, o = (a[rows[0] == slot] for a in rows[1:])
                fresh = ~np.isin(d, days)
                if keep and len(days) >= keep:
                    fresh &= d > days[0]
                d, c, o = (np.concatenate([a, b[fresh]]) for a, b in zip(new[slot], (d, c, o))) if slot in new else (d[fresh], c[fresh], o[fresh])
                order = np.lexsort((c, o, d))
                d, c, o = d[order], c[order], o[order]
                first = np.append(True, d[1:] != d[:-1])[: len(d)]
                new[slot] = d[first], c[first], o[first]
        out = []
        for slot, (d, c, _) in new.items():
            if not len(d):
                continue
            days, closes = held.get(slot, none)
            spots = np.searchsorted(days, d)
            days, closes = np.insert(days, spots, d), np.insert(closes, spots, c)
            own = np.searchsorted(days, d)
            at = np.unique(np.concatenate([own, own + 1]))
            at = at[at < len(days)]
            before = closes[at - 1].astype(object)
            if at[0] == 0:
                before[0] = None
            out.append((np.full(len(at), slot), days[at], closes[at], before))
            held[slot] = (days[-keep:], closes[-keep:]) if keep else (days, closes)
        if not out:
            return
        sizes = [len(days) for days, _ in held.values()]
        columns = [np.array(list(held), np.int64), np.array(sizes, np.int64), *[np.concatenate(a) for a in zip(*held.values())]]
        state.update(tuple(a.tobytes() for a in columns))
        slot, day_, close_, before = (np.concatenate(a) for a in zip(*out))
        yield pd.DataFrame({"_key": group[0] * SHARES + slot if whole else group[0], "_day": day_, "_close": close_, "_before": before})

    amount = (F.col(close).cast("decimal(18,4)") * unit).cast("bigint")
    rank = F.lit(0).cast("bigint") if order is None else F.coalesce(F.col(order).cast("bigint"), F.lit(2**63 - 1))
    number = F.col(key).cast("bigint") if whole else F.lit(0)
    slot = number.bitwiseAND(F.lit(SHARES - 1)).cast("bigint").alias("_slot")
    group = (F.shiftright(number, SHARES.bit_length() - 1) if whole else F.col(key)).alias("_group")
    kind = "bigint" if whole else fields[key]
    rows = quotes.dropna(subset=[key]).select(group, slot, F.col(day).cast("bigint").alias("_day"), amount.alias("_close"), rank.alias("_order"))
    out = rows.dropna(subset=["_day", "_close"]).groupBy("_group").applyInPandasWithState(
        run, f"_key {kind}, _day bigint, _close bigint, _before bigint", "slots binary, sizes binary, days binary, closes binary", "update", GroupStateTimeout.NoTimeout
    )
    price = lambda c: (F.col(c).cast("decimal(14,0)") * F.expr("0.0001")).cast("decimal(18,4)")
    out = out.select(F.col("_key").cast(fields[key]).alias(key), F.col("_day").cast(fields[day]).alias(day), price("_close").alias(close), price("_before").alias("vl_anterior"))
    change = F.try_divide(F.col(close), F.col("vl_anterior")) - 1
    return out.withColumn("vl_retorno_diario", change.try_cast("decimal(10,6)"))


def write_changes(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Each batch of an update stream as a folder of its own number; a repeat writes the same folder again."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/lote={number}")

    return rows.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last row of every key among the batches, folded map-side."""
    rest = [c for c in changes.columns if c not in (*keys, "lote")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "lote").alias("_last")).select(*keys, "_last.*")
