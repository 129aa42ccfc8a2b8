"""Text staging to typed rows, with the rows that fail kept apart together with the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from quotewell.functions.parsing import is_active, is_filled, parse_date, parse_decimal, parse_integer, row_json

PASSED, REJECTED = 1, 2


def text(column: Column) -> Column:
    return F.when(is_filled(column), F.trim(column))


@dataclass(frozen=True)
class Field:
    """One typed column: its name, the staging column it comes from, how it is read, whether it must be there."""

    name: str
    source: str
    parse: Callable[[Column], Column] = text
    required: bool = True


@dataclass(frozen=True)
class Typing:
    fields: list[Field]
    rules: dict[str, str] = field(default_factory=dict)

    def raw(self) -> list[str]:
        return list(dict.fromkeys(f.source for f in self.fields))


money = parse_decimal
rate = partial(parse_decimal, precision=18, scale=6)

QUOTES = Typing(
    [
        Field("cd_ticker", "ticker"),
        Field("dt_data", "dt_pregao", parse_date),
        Field("vl_abertura", "vl_abertura", money),
        Field("vl_fechamento", "vl_fechamento", money),
        Field("vl_maximo", "vl_maximo", money),
        Field("vl_minimo", "vl_minimo", money),
        Field("vl_volume", "vl_volume", parse_integer),
    ],
    {"high below low": "vl_maximo < vl_minimo", "negative volume": "vl_volume < 0"},
)

SERIES = Typing(
    [
        Field("cd_indicador", "cd_indicador"),
        Field("dt_data", "dt_referencia", parse_date),
        Field("vl_indicador", "vl_indicador", rate),
    ]
)

STATEMENTS = Typing(
    [
        Field("cd_cvm", "cd_cvm"),
        Field("dt_data", "dt_referencia", parse_date),
        Field("cd_conta", "cd_conta"),
        Field("ds_conta", "ds_conta", required=False),
        Field("vl_conta", "vl_conta", partial(parse_decimal, precision=20, scale=2)),
        Field("ds_tipo_dem", "ds_tipo_dem"),
        Field("nr_versao", "nr_versao", lambda c: parse_integer(c).cast("int"), required=False),
        Field("ds_escala", "ds_escala", required=False),
    ]
)

REGISTRY = Typing(
    [
        Field("cd_cvm", "cd_cvm"),
        Field("nr_cnpj", "nr_cnpj", required=False),
        Field("ds_razao_social", "ds_razao_social"),
        Field("ds_nome_pregao", "ds_nome_pregao", required=False),
        Field("ds_setor_atividade", "ds_setor_atividade", required=False),
        Field("fl_ativa", "ds_situacao", is_active, required=False),
        Field("dt_listagem", "dt_registro", parse_date, required=False),
        Field("dt_constituicao", "dt_constituicao", parse_date, required=False),
    ]
)

DIVIDENDS = Typing(
    [
        Field("cd_ticker", "ticker"),
        Field("dt_data", "dt_aprovacao", parse_date),
        Field("vl_dividendo", "vl_provento", rate),
        Field("ds_tipo", "ds_tipo"),
        Field("dt_ex", "dt_ex", parse_date, required=False),
        Field("dt_pagamento", "dt_pagamento", parse_date, required=False),
    ],
    {"dividend not above zero": "vl_dividendo <= 0"},
)

SPLITS = Typing(
    [
        Field("cd_ticker", "ticker"),
        Field("dt_data", "dt_evento", parse_date),
        Field("ds_tipo", "ds_tipo", lambda c: F.upper(text(c))),
        Field("vl_fator", "vl_fator", partial(parse_decimal, precision=10, scale=4)),
        Field("ds_descricao", "ds_descricao", required=False),
    ],
    {
        "unknown split type": "ds_tipo NOT IN ('SPLIT', 'GRUPAMENTO', 'BONIFICACAO')",
        "factor not above zero": "vl_fator <= 0",
    },
)

TYPINGS = {
    "stg_cotacao": QUOTES,
    "stg_indicadores_macro": SERIES,
    "stg_dem_financeira": STATEMENTS,
    "stg_cadastro_empresa": REGISTRY,
    "stg_dividendos": DIVIDENDS,
    "stg_desdobramento": SPLITS,
}


def apply_typing(staging: DataFrame, typing: Typing, keep_raw: bool = False) -> DataFrame:
    """Typed columns plus `fl_processado` 1 or 2, `ds_erro` (all reasons) and `ds_dados` (the raw row as JSON).

    Raw columns whose name a typed column takes are replaced; other columns pass through. Nothing is dropped:
    rows in = rows passed + rows rejected, and one scan serves both. `keep_raw` leaves the text in `_raw`.
    """
    raw = staging.select("*", F.struct(*typing.raw()).alias("_raw"))
    typed = raw.withColumns({f.name: f.parse(F.col(f"_raw.{f.source}")) for f in typing.fields})
    reasons = []
    for f in typing.fields:
        filled = is_filled(F.col(f"_raw.{f.source}"))
        if f.required:
            reasons.append(F.when(~filled, f"{f.source} missing"))
        reasons.append(F.when(filled & F.col(f.name).isNull(), f"{f.source} invalid"))
    reasons += [F.when(F.expr(condition), message) for message, condition in typing.rules.items()]
    why = F.concat_ws("; ", *reasons)
    leftover = [c for c in typing.raw() if c not in {f.name for f in typing.fields}]
    return (
        typed.withColumn("ds_erro", F.when(why != "", why))
        .withColumn("fl_processado", F.when(F.col("ds_erro").isNull(), PASSED).otherwise(REJECTED))
        .withColumn("ds_dados", F.when(F.col("ds_erro").isNotNull(), row_json("_raw.*")))
        .drop(*([] if keep_raw else ["_raw"]), *leftover)
    )


def passed(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("fl_processado") == PASSED).drop("fl_processado", "ds_erro", "ds_dados")


def rejected(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("fl_processado") == REJECTED)


def reasons_count(typed: DataFrame) -> DataFrame:
    """Rejected rows per reason; a row with several reasons counts under each."""
    each = rejected(typed).select(F.explode(F.split("ds_erro", "; ")).alias("ds_erro"))
    return each.groupBy("ds_erro").agg(F.count("*").alias("linhas"))
