"""Rows every new warehouse starts with.

All values in this file are fixed values of the data model.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotewell.schemas import TABLES

SEGMENTS = [
    ("NM", "Novo Mercado", "Maior nível de governança corporativa da B3"),
    ("N2", "Nível 2", "Alto nível de governança, permite ações PN"),
    ("N1", "Nível 1", "Governança básica diferenciada"),
    ("MA", "Bovespa Mais", "Segmento para empresas de menor porte"),
    ("TRAD", "Tradicional", "Segmento padrão sem requisitos adicionais"),
]

SHARE_TYPES = [
    ("ON", "Ordinária", "Ação com direito a voto"),
    ("PN", "Preferencial", "Ação com prioridade em dividendos, sem voto"),
    ("UNIT", "Unit", "Certificado de depósito de ações ON e PN"),
]

SECTORS = [
    ("FIN", "Financeiro e Seguros"),
    ("CONS", "Consumo Cíclico"),
    ("CONB", "Consumo Não Cíclico"),
    ("UTIL", "Utilidade Pública"),
    ("MATS", "Materiais Básicos"),
    ("SAUDE", "Saúde"),
    ("PETRO", "Petróleo, Gás e Biocombustíveis"),
    ("TELE", "Telecomunicações"),
    ("TI", "Tecnologia da Informação"),
    ("IMOV", "Imóveis"),
    ("INDU", "Bens Industriais"),
    ("AGRO", "Agropecuária"),
]

INDICATORS = [
    ("SELIC", "Taxa de Juros Selic", "% ao dia", "Banco Central do Brasil", "11"),
    ("IPCA", "IPCA - Inflação", "% ao mês", "Banco Central do Brasil", "433"),
    ("CAMBIO", "Taxa de Câmbio USD/BRL", "R$/USD", "Banco Central do Brasil", "1"),
    ("CDI", "Taxa CDI", "% ao dia", "Banco Central do Brasil", "12"),
]

CRISIS_PERIODS = [
    ("Crise Financeira Global 2008", date(2008, 9, 1), date(2009, 3, 31), "Crise do subprime nos EUA"),
    ("Crise Política Brasil 2015-2016", date(2015, 1, 1), date(2016, 12, 31), "Recessão e crise política no Brasil"),
    ("Lava Jato - Pico 2017", date(2017, 5, 1), date(2017, 6, 30), "Gravações JBS e crise política"),
    ("Pandemia COVID-19", date(2020, 2, 1), date(2020, 12, 31), "Crise econômica causada pela pandemia"),
    ("Alta da Selic 2022-2023", date(2022, 1, 1), date(2023, 6, 30), "Ciclo de aperto monetário agressivo"),
]

PARAMETERS = [
    ("ULTIMA_CARGA_COTACAO", "1900-01-01", "Data da última carga de cotações"),
    ("ULTIMA_CARGA_MACRO", "1900-01-01", "Data da última carga de indicadores macro"),
    ("ULTIMA_CARGA_DFP", "1900-01-01", "Data da última carga de demonstrações financeiras"),
    ("VERSAO_BANCO", "1.0.0", "Versão atual do banco de dados"),
]

# table: (rows, columns the rows fill, generated key)
_SEEDS = {
    "dim_segmento_listagem": (SEGMENTS, ["cd_segmento", "ds_segmento", "ds_descricao"], "id_segmento"),
    "dim_tipo_acao": (SHARE_TYPES, ["cd_tipo", "ds_tipo", "ds_descricao"], "id_tipo_acao"),
    "dim_setor": (SECTORS, ["cd_setor", "ds_setor"], "id_setor"),
    "dim_indicador_macro": (
        INDICATORS,
        ["cd_indicador", "ds_indicador", "ds_unidade", "ds_fonte", "cd_serie_bcb"],
        "id_indicador",
    ),
    "dim_periodo_crise": (CRISIS_PERIODS, ["ds_crise", "dt_inicio", "dt_fim", "ds_descricao"], "id_crise"),
    "parametros_sistema": (PARAMETERS, ["cd_parametro", "vl_parametro", "ds_descricao"], "id_parametro"),
}


def seed_table(spark: SparkSession, table: str) -> DataFrame:
    """The starting rows of `table` in its full schema, keys numbered from 1 in listed order."""
    rows, columns, key = _SEEDS[table]
    schema = TABLES[table]
    listed = [(number, *row) for number, row in enumerate(rows, start=1)]
    filled = {key, *columns}
    df = spark.createDataFrame(listed, ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in [key, *columns]))
    return df.select(
        *[
            F.col(f.name)
            if f.name in filled
            else (F.current_timestamp() if f.name.startswith("dt_") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def seed_names() -> list[str]:
    return list(_SEEDS)
