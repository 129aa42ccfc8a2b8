"""Audit trail from two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotewell.functions.parsing import row_json


def audit_changes(before: DataFrame, after: DataFrame, keys: list[str], table: str, now: Column | None = None) -> DataFrame:
    """INSERT, UPDATE and DELETE rows with JSON images; unchanged rows give nothing.

    Keys are unique on both sides, so the full join is one row per key.
    """
    columns = before.columns
    old = before.select(*keys, F.struct(*columns).alias("_old"), row_json(*columns).alias("ds_dados_antes"))
    new = after.select(*keys, F.struct(*columns).alias("_new"), row_json(*columns).alias("ds_dados_depois"))
    operation = (
        F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").otherwise("UPDATE")
    )
    return (
        old.join(new, keys, "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(
            *keys,
            F.lit(table).alias("ds_tabela"),
            operation.alias("ds_operacao"),
            F.current_user().alias("ds_usuario"),
            (F.current_timestamp() if now is None else now).alias("dt_operacao"),
            "ds_dados_antes",
            "ds_dados_depois",
        )
    )
