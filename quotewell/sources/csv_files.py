"""The six kinds of input file and how each becomes text staging."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quotewell.functions.parsing import is_filled, same_text
from quotewell.operators.keys import with_dense_keys

BAD_LINE = "_bad_line"


@dataclass(frozen=True)
class CsvSource:
    """One kind of delivered CSV file.

    `columns` maps file columns to staging columns, in file order. With `by_header` the file may hold
    further columns in any order and is read by header name; otherwise columns bind by position.
    """

    name: str
    table: str
    columns: dict[str, str]
    sep: str = ";"
    encoding: str = "UTF-8"
    by_header: bool = False
    not_blank: str | None = None
    only: dict[str, str] = field(default_factory=dict)
    literals: dict[str, str] = field(default_factory=dict)


QUOTES = CsvSource(
    name="KAGGLE_COTACAO",
    table="stg_cotacao",
    sep=",",
    columns={
        "ticker": "ticker",
        "date": "dt_pregao",
        "open": "vl_abertura",
        "close": "vl_fechamento",
        "high": "vl_maximo",
        "low": "vl_minimo",
        "volume": "vl_volume",
    },
)

REGISTRY = CsvSource(
    name="CVM_CADASTRO",
    table="stg_cadastro_empresa",
    encoding="ISO-8859-1",
    by_header=True,
    not_blank="cd_cvm",
    columns={
        "CD_CVM": "cd_cvm",
        "CNPJ_CIA": "nr_cnpj",
        "DENOM_SOCIAL": "ds_razao_social",
        "DENOM_COMERC": "ds_nome_pregao",
        "SETOR_ATIV": "ds_setor_atividade",
        "SIT": "ds_situacao",
        "DT_REG": "dt_registro",
        "DT_CONST": "dt_constituicao",
    },
)

DIVIDENDS = CsvSource(
    name="DIVIDENDOS",
    table="stg_dividendos",
    columns={
        "ticker": "ticker",
        "cd_cvm": "cd_cvm",
        "dt_aprovacao": "dt_aprovacao",
        "valor": "vl_provento",
        "tipo": "ds_tipo",
        "dt_ex": "dt_ex",
        "dt_pagamento": "dt_pagamento",
    },
)

SPLITS = CsvSource(
    name="DESDOBRAMENTOS",
    table="stg_desdobramento",
    columns={
        "ticker": "ticker",
        "data": "dt_evento",
        "tipo": "ds_tipo",
        "fator": "vl_fator",
        "descricao": "ds_descricao",
    },
)


def series_source(indicator: str, code: str) -> CsvSource:
    """A macro series `data;valor`, tagged with its indicator and series code; blank dates are dropped."""
    return CsvSource(
        name=f"BCB_{indicator}",
        table="stg_indicadores_macro",
        columns={"data": "dt_referencia", "valor": "vl_indicador"},
        not_blank="dt_referencia",
        literals={"cd_indicador": indicator, "cd_serie_bcb": code},
    )


def statement_source(kind: str, family: str = "DFP") -> CsvSource:
    """Filed statements of one kind (DRE, BPA, BPP), yearly (DFP) or quarterly (ITR); only the current period's column
    set, company code not blank."""
    return CsvSource(
        name=f"CVM_{family}_{kind}",
        table="stg_dem_financeira",
        encoding="ISO-8859-1",
        by_header=True,
        not_blank="cd_cvm",
        only={"ORDEM_EXERC": "ÚLTIMO"},
        literals={"ds_tipo_dem": kind},
        columns={
            "CD_CVM": "cd_cvm",
            "DS_CONTA": "ds_conta",
            "CD_CONTA": "cd_conta",
            "VL_CONTA": "vl_conta",
            "DT_REFER": "dt_referencia",
            "VERSAO": "nr_versao",
            "ESCALA_MOEDA": "ds_escala",
        },
    )


# The full load in order: stage name and source.
FULL_LOAD: list[tuple[str, CsvSource]] = [
    ("COTACOES", QUOTES),
    ("BCB_SELIC", series_source("SELIC", "11")),
    ("BCB_IPCA", series_source("IPCA", "433")),
    ("BCB_CAMBIO", series_source("CAMBIO", "1")),
    ("BCB_CDI", series_source("CDI", "12")),
    ("CVM_CADASTRO", REGISTRY),
    ("CVM_DFP_DRE", statement_source("DRE")),
    ("CVM_DFP_BPA", statement_source("BPA")),
    ("CVM_DFP_BPP", statement_source("BPP")),
    ("DIVIDENDOS", DIVIDENDS),
    ("DESDOBRAMENTOS", SPLITS),
]


def _options(source: CsvSource) -> dict[str, object]:
    return {"sep": source.sep, "encoding": source.encoding, "header": True, "quote": '"', "escape": '"'}


def header_groups(spark: SparkSession, path: str, source: CsvSource) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of each header line that the delivered files have.

    One pass over the first part of every file finds its first line; the driver gets a row per different header.
    """
    lines = spark.read.option("encoding", source.encoding).text(path)
    first = lines.select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    heads = first.filter("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect()
    names = lambda header: [c.strip().strip('"') for c in header.lstrip("\ufeff").rstrip("\r").split(source.sep)]
    return sorted((names(r["header"]), r["files"]) for r in groups)


def read_text_columns(spark: SparkSession, path: str, source: CsvSource) -> DataFrame:
    """Every line as text columns; a line with missing or extra fields also has its text in `_bad_line`.

    Sources bound by name are read once per different header line, and the wanted columns united by name; a file
    without one of them fails the load. Column pruning is off in the parser because a pruned parse cannot see that a
    line is too short.
    """

    def read(names: list[str], where: str | list[str]) -> DataFrame:
        fields = [T.StructField(n, T.StringType()) for n in [*names, BAD_LINE]]
        options = {**_options(source), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": False}
        return spark.read.schema(T.StructType(fields)).options(**options).csv(where)

    groups = header_groups(spark, path, source) if source.by_header else []
    if len(groups) < 2:
        return read(groups[0][0] if groups else list(source.columns), path)
    wanted = [*dict.fromkeys([*source.columns, *source.only]), BAD_LINE]
    return reduce(DataFrame.unionByName, [read(names, files).select(*wanted, "_metadata") for names, files in groups])


def placed(lines: DataFrame, files: DataFrame, count: int) -> DataFrame:
    """The lines with `_place`, a number that ascends in file order: by file name, then by position in the file.

    `files` lists the delivered files (`ds_uri`, `ds_arquivo`; see `loading.file_checksums`), `count` of them; they are numbered by
    Spark, not by the driver. A line of a split has the split's first byte plus its number in the task, which is below the first
    byte of the next split, as every line takes a byte at least. Eight TB a file and a million files fit; a file that is
    not in the list fails the load.
    """
    task_line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = lines.withColumn("_at", F.col("_metadata.file_block_start") + task_line)
    if count == 1:
        return rows.withColumnRenamed("_at", "_place")
    ranks = with_dense_keys(files.select("ds_arquivo", F.col("ds_uri").alias("_uri")), ["ds_arquivo"], "_rank", 0).select("_uri", "_rank")
    ranked = rows.withColumn("_file", F.col("_metadata.file_path")).join(ranks, F.col("_file") == F.col("_uri"), "left")
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("file not listed: "), F.col("_file"))).cast("bigint"))
    return ranked.withColumn("_place", F.shiftleft(rank, 43) + F.col("_at")).drop("_file", "_uri", "_rank", "_at")


def staging_columns(lines: DataFrame, source: CsvSource, with_bad: bool = False) -> DataFrame:
    """Well-formed lines of the source: wanted rows and columns, renamed, with the source's literals.

    `with_bad` keeps the malformed lines as well, whatever is in them, with their text in `_bad_line`.
    """
    bad, wanted = F.col(BAD_LINE).isNotNull(), F.lit(True)
    for column, value in source.only.items():
        wanted = wanted & same_text(F.col(column), F.lit(value))
    if source.not_blank:
        wanted = wanted & is_filled(F.col(next(a for a, b in source.columns.items() if b == source.not_blank)))
    return lines.filter(bad | wanted if with_bad else ~bad & wanted).select(
        *[F.col(a).alias(b) for a, b in source.columns.items()],
        *[F.lit(v).alias(c) for c, v in source.literals.items()],
        *[c for c in lines.columns if c == "_place" or (with_bad and c == BAD_LINE)],
    )


def read_staging(spark: SparkSession, path: str, source: CsvSource) -> DataFrame:
    return staging_columns(read_text_columns(spark, path, source), source)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Text of the lines that do not have the declared number of fields.

    Spark refuses to read the bad-line column alone, hence the first column beside it.
    """
    return lines.filter(F.col(BAD_LINE).isNotNull()).select(F.coalesce(BAD_LINE, lines.columns[0]).alias("ds_dados"))


def write_csv(df: DataFrame, path: str, source: CsvSource) -> None:
    """Text columns out in the source's dialect, for extracts and fixtures."""
    df.write.options(**_options(source)).mode("overwrite").csv(path)
