"""Data-quality checks: each returns (regra, violacoes), or the offending keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quotewell import schemas
from quotewell.functions.labels import volume_status
from quotewell.operators.joins import orphan_keys


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one scan. A rule that is NULL passes, as in SQL CHECK."""
    if not rules:
        return df.sparkSession.createDataFrame([], "regra string, violacoes bigint")
    broken = [F.count_if(~rule).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    counts = F.array(
        *[F.struct(F.lit(name).alias("regra"), F.col(f"_{i}").alias("violacoes")) for i, name in enumerate(rules)]
    )
    return df.agg(*broken).select(F.inline(counts))


def required_rules(columns: list[str]) -> dict[str, Column]:
    return {f"{c} is required": F.col(c).isNotNull() for c in columns}


def row_rules(conditions: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(condition) for name, condition in conditions.items()}


def allowed_rules(values: dict[str, list[str]]) -> dict[str, Column]:
    return {f"{c} in list": F.col(c).isin(allowed) for c, allowed in values.items()}


def width_rules(widths: dict[str, int]) -> dict[str, Column]:
    return {f"{c} at most {n}": F.length(c) <= n for c, n in widths.items()}


def precision_rules(decimals: dict[str, str]) -> dict[str, Column]:
    """Values that do not fit the declared decimal type."""
    return {f"{c} fits {d}": F.col(c).isNull() | F.col(c).try_cast(d).isNotNull() for c, d in decimals.items()}


def table_rules(table: str) -> dict[str, Column]:
    """All row-level rules declared for a table."""
    return (
        required_rules(schemas.REQUIRED.get(table, []))
        | row_rules(schemas.ROW_CHECKS.get(table, {}))
        | allowed_rules(schemas.ALLOWED_VALUES.get(table, {}))
        | width_rules(schemas.TEXT_WIDTHS.get(table, {}))
    )


def stored_rules(table: str, columns: list[str]) -> dict[str, Column]:
    """The table's row rules that these columns can answer, and that its decimals fit: what a row must pass to be stored."""
    here = set(columns)
    decimals = {f.name: f.dataType.simpleString() for f in schemas.TABLES[table] if f.name in here and f.dataType.typeName() == "decimal"}
    conditions = {n: c for n, c in schemas.ROW_CHECKS.get(table, {}).items() if all(w in here for w in schemas.columns_in(c))}
    return (
        required_rules([c for c in schemas.REQUIRED.get(table, []) if c in here])
        | row_rules(conditions)
        | allowed_rules({c: v for c, v in schemas.ALLOWED_VALUES.get(table, {}).items() if c in here})
        | width_rules({c: n for c, n in schemas.TEXT_WIDTHS.get(table, {}).items() if c in here})
        | precision_rules(decimals)
    )


def broken_mask(rules: dict[str, Column]) -> Column:
    """The rules a row breaks as bits of one number, the first rule lowest; 0 for a good row. A rule that is NULL passes."""
    if len(rules) > 63:
        raise ValueError("a mask holds 63 rules")
    bits = [F.when(~rule, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules.values())]
    return reduce(Column.__add__, bits, F.lit(0)).cast("bigint")


def broken_names(mask: Column, rules: dict[str, Column]) -> Column:
    """The names of the rules in a mask, joined by semicolons."""
    return F.concat_ws("; ", *[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, name) for i, name in enumerate(rules)])


def check_table(df: DataFrame, table: str) -> DataFrame:
    """Violations of the table's row rules. Rows that have no column yet for the table's own number are not blamed for it."""
    rules, number = table_rules(table), schemas.TABLES[table].fieldNames()[0]
    if number not in df.columns:
        rules.pop(f"{number} is required", None)
    return count_violations(df, rules)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row. Counted map-side first, so a key with many copies shuffles as one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("linhas")).filter("linhas > 1")


def minimum_rows(df: DataFrame, minimum: int, table: str = "fato_cotacao") -> DataFrame:
    return df.agg(F.count("*").alias("total_registros")).select(
        F.lit(table).alias("tabela"), "total_registros", volume_status(F.col("total_registros"), minimum).alias("status")
    )


def check_model(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared rule, unique key and reference over the tables given: (tabela, regra, violacoes).

    Row rules of a table take one scan; keys and references are counted per value before anything is joined.
    """
    parts = []
    for name, df in tables.items():
        if table_rules(name):
            parts.append(check_table(df, name).select(F.lit(name).alias("tabela"), "regra", "violacoes"))
        if name in schemas.UNIQUE_KEYS:
            keys = schemas.UNIQUE_KEYS[name]
            parts.append(_total(duplicate_keys(df, keys), F.count("*"), name, f"unique {', '.join(keys)}"))
    for child, column, parent, parent_key, optional in schemas.FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = orphan_keys(tables[child], column, tables[parent], parent_key)
            parts.append(_total(orphans, F.coalesce(F.sum("linhas"), F.lit(0)), child, f"{column} in {parent}"))
            if not optional and column not in schemas.REQUIRED.get(child, []):
                parts.append(_total(tables[child].filter(F.col(column).isNull()), F.count("*"), child, f"{column} is required"))
    return reduce(DataFrame.unionByName, parts)


def _total(df: DataFrame, count: Column, table: str, rule: str) -> DataFrame:
    return df.agg(count.alias("violacoes")).select(F.lit(table).alias("tabela"), F.lit(rule).alias("regra"), "violacoes")
