"""A bitmap of keys, to leave most rows of a large table out of a shuffle.

Rows whose slot is not set have none of the keys for sure; the others go on to an exact join. The bitmap takes 16 bits a
key up to `MOST` bits (8 MB, broadcast): with more keys it lets more rows through, which costs shuffle and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quotewell.llm.graph import unused
from quotewell.llm.memory import tidy

MOST = 1 << 26


@dataclass(frozen=True)
class Sieve:
    bits: int
    words: np.ndarray  # of 32 bits each

    def holds(self, slots: np.ndarray) -> np.ndarray:
        return (self.words[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1) == 1


def slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def sieve(keys: DataFrame, column: str, most: int = MOST) -> Sieve:
    """The bitmap of a column's values; at most `most` / 32 numbers come to the driver."""
    bits = min(most, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    place = slot(F.col(column), bits)
    rows = keys.select(F.shiftright(place, 5).alias("at"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(32)).cast("int")).alias("bit"))
    table = rows.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(bits >> 5, np.uint32)
    words[table.column("at").to_numpy()] = table.column("bit").to_numpy().astype(np.uint32)
    return Sieve(bits, words)


def sifted(rows: DataFrame, key: str, found: Sieve, inside: bool = True) -> DataFrame:
    """The rows, with all columns, whose key's slot is set (or, not `inside`, is not set). Rows without a key are never
    inside."""
    shared = rows.sparkSession.sparkContext.broadcast(found)
    name = unused(rows, "slot")
    at = F.when(F.col(key).isNotNull(), slot(F.col(key), found.bits)).otherwise(F.lit(-1).cast("bigint"))
    last = len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            slots = batch.column(last).to_numpy()
            keep = (slots >= 0) & own.holds(np.maximum(slots, 0))
            yield batch.select(list(range(last))).filter(pa.array(keep if inside else ~keep))

    return rows.withColumn(name, at).mapInArrow(tidy(run), rows.schema)
