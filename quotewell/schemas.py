"""Table schemas and their constraints, declared once and never inferred."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def data_type(text: str) -> T.DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", text)
    return T.DecimalType(int(decimal[1]), int(decimal[2])) if decimal else _SIMPLE[text]


def struct(columns: str) -> T.StructType:
    """A schema from `name type, ...`; unlike StructType.fromDDL it needs no running session."""
    pairs = re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", columns)
    return T.StructType([T.StructField(name, data_type(kind)) for name, kind in pairs])


BATCH = "dt_carga timestamp, fl_processado int, ds_erro string"

_DDL = {
    # text staging: business columns stay text until typed
    "stg_cotacao": "id_staging bigint, ticker string, dt_pregao string, vl_abertura string, vl_fechamento string, "
    f"vl_maximo string, vl_minimo string, vl_volume string, {BATCH}",
    "stg_indicadores_macro": "id_staging bigint, cd_indicador string, cd_serie_bcb string, dt_referencia string, "
    f"vl_indicador string, {BATCH}",
    "stg_dem_financeira": "id_staging bigint, cd_cvm string, ds_conta string, cd_conta string, vl_conta string, "
    f"dt_referencia string, ds_tipo_dem string, nr_versao string, ds_escala string, {BATCH}",
    "stg_cadastro_empresa": "id_staging bigint, cd_cvm string, nr_cnpj string, ds_razao_social string, "
    "ds_nome_pregao string, ds_setor_atividade string, ds_situacao string, dt_registro string, "
    f"dt_constituicao string, ds_segmento string, {BATCH}",
    "stg_dividendos": "id_staging bigint, ticker string, cd_cvm string, dt_aprovacao string, vl_provento string, "
    f"ds_tipo string, dt_ex string, dt_pagamento string, {BATCH}",
    "stg_desdobramento": "id_staging bigint, ticker string, dt_evento string, ds_tipo string, vl_fator string, "
    f"ds_descricao string, {BATCH}",
    # dimensions
    "dim_setor": "id_setor int, cd_setor string, ds_setor string, ds_descricao string, dt_criacao timestamp, "
    "dt_atualizacao timestamp",
    "dim_subsetor": "id_subsetor int, id_setor int, cd_subsetor string, ds_subsetor string, dt_criacao timestamp",
    "dim_segmento_listagem": "id_segmento int, cd_segmento string, ds_segmento string, ds_descricao string, "
    "dt_criacao timestamp",
    "dim_tipo_acao": "id_tipo_acao int, cd_tipo string, ds_tipo string, ds_descricao string",
    "dim_empresa": "id_empresa int, cd_cvm string, nr_cnpj string, ds_razao_social string, ds_nome_pregao string, "
    "id_setor int, id_subsetor int, id_segmento int, dt_constituicao date, dt_listagem date, fl_ativa boolean, "
    "dt_criacao timestamp, dt_atualizacao timestamp",
    "dim_acao": "id_acao int, cd_ticker string, id_empresa int, id_tipo_acao int, ds_acao string, "
    "nr_total_acoes bigint, fl_ativa boolean, dt_criacao timestamp, dt_atualizacao timestamp",
    "dim_data": "id_data int, dt_data date, nr_ano int, nr_mes int, nr_dia int, nr_trimestre int, nr_semestre int, "
    "ds_dia_semana string, nr_dia_semana int, fl_feriado boolean, fl_dia_util boolean, ds_mes string",
    "dim_periodo_crise": "id_crise int, ds_crise string, dt_inicio date, dt_fim date, ds_descricao string",
    "dim_indicador_macro": "id_indicador int, cd_indicador string, ds_indicador string, ds_unidade string, "
    "ds_fonte string, cd_serie_bcb string, ds_descricao string",
    # facts
    "fato_cotacao": "id_cotacao bigint, id_acao int, id_data int, vl_abertura decimal(18,4), "
    "vl_fechamento decimal(18,4), vl_maximo decimal(18,4), vl_minimo decimal(18,4), vl_volume bigint, "
    "vl_retorno_diario decimal(10,6), vl_amplitude decimal(18,4), dt_carga timestamp",
    "fato_indicador_macro": "id_fato bigint, id_indicador int, id_data int, vl_indicador decimal(18,6), "
    "dt_carga timestamp",
    "fato_dem_financeira": "id_fato bigint, id_empresa int, id_data int, vl_receita_liquida decimal(20,2), "
    "vl_lucro_liquido decimal(20,2), vl_ebitda decimal(20,2), vl_divida_bruta decimal(20,2), "
    "vl_patrimonio_liq decimal(20,2), vl_ativo_total decimal(20,2), ds_tipo_dem string, dt_carga timestamp",
    "fato_indicadores": "id_fato bigint, id_acao int, id_data int, vl_pl decimal(10,4), vl_roe decimal(10,6), "
    "vl_dy decimal(10,6), vl_ev_ebitda decimal(10,4), vl_sharpe decimal(10,6), vl_volatilidade decimal(10,6), "
    "vl_market_cap decimal(20,2), dt_carga timestamp",
    # history
    "hist_dividendos": "id_dividendo bigint, id_acao int, id_data int, vl_dividendo decimal(18,6), ds_tipo string, "
    "dt_ex date, dt_pagamento date, dt_carga timestamp",
    "hist_desdobramento": "id_desdobramento int, id_acao int, id_data int, ds_tipo string, vl_fator decimal(10,4), "
    "ds_descricao string, dt_carga timestamp",
    "hist_preco_ajustado": "id_preco_aj bigint, id_acao int, id_data int, vl_fechamento_aj decimal(18,4), "
    "vl_retorno_aj decimal(10,6), dt_carga timestamp",
    # every version of every filed account, and when it became known
    "hist_dem_versao": "id_empresa int, id_data int, ds_tipo_dem string, ds_quadro string, cd_conta string, nr_versao int, "
    "vl_conta decimal(20,2), dt_entrega date, dt_carga timestamp",
    # what a later batch needs of the facts without reading them: each share's sessions by year, and what has
    # changed since the derived facts were last brought up to date (id_acao NULL: all shares)
    "estado_cotacao": "id_acao int, nr_ano int, id_primeiro int, id_ultimo int, vl_fechamento decimal(18,4), nr_pregoes bigint",
    "estado_mudanca": "ds_destino string, id_acao int, id_de int, ds_causa string",
    # control
    "quarentena": "id_carga bigint, ds_tabela string, nr_regras bigint, ds_regras string, ds_dados string, dt_carga timestamp",
    "etl_arquivos": "id_carga bigint, ds_fonte string, ds_arquivo string, ds_checksum string, nr_bytes bigint, dt_carga timestamp",
    "log_auditoria": "id_log bigint, ds_tabela string, ds_operacao string, ds_usuario string, dt_operacao timestamp, "
    "ds_dados_antes string, ds_dados_depois string",
    "etl_log_erros": "id_erro bigint, id_carga bigint, ds_etapa string, ds_fonte string, ds_procedure string, "
    "ds_erro string, ds_dados string, dt_erro timestamp",
    "etl_controle_carga": "id_carga bigint, ds_fonte string, ds_arquivo string, ds_tabela_destino string, "
    "dt_inicio_carga timestamp, dt_fim_carga timestamp, nr_registros_lidos bigint, nr_registros_carga bigint, "
    "nr_registros_erro bigint, ds_status string, ds_erro string, ds_checksum string",
    "parametros_sistema": "id_parametro int, cd_parametro string, vl_parametro string, ds_descricao string, "
    "dt_atualizacao timestamp",
}

TABLES: dict[str, T.StructType] = {name: struct(columns) for name, columns in _DDL.items()}

STAGING_TABLES = [name for name in TABLES if name.startswith("stg_")]

# The columns that identify a row, for the uniqueness check and the merges.
UNIQUE_KEYS = {
    "dim_setor": ["cd_setor"],
    "dim_subsetor": ["cd_subsetor"],
    "dim_segmento_listagem": ["cd_segmento"],
    "dim_tipo_acao": ["cd_tipo"],
    "dim_empresa": ["cd_cvm"],
    "dim_acao": ["cd_ticker"],
    "dim_data": ["dt_data"],
    "dim_indicador_macro": ["cd_indicador"],
    "parametros_sistema": ["cd_parametro"],
    "fato_cotacao": ["id_acao", "id_data"],
    "fato_indicador_macro": ["id_indicador", "id_data"],
    "hist_preco_ajustado": ["id_acao", "id_data"],
    "hist_dem_versao": ["id_empresa", "id_data", "ds_tipo_dem", "ds_quadro", "cd_conta", "nr_versao"],
    "estado_cotacao": ["id_acao", "nr_ano"],
    # without a declared key in the model, kept unique here
    "fato_dem_financeira": ["id_empresa", "id_data", "ds_tipo_dem"],
    "fato_indicadores": ["id_acao", "id_data"],
}

_STAGED = ["id_staging", "dt_carga", "fl_processado"]

# The columns declared NOT NULL, keys included.
REQUIRED = {
    "stg_cotacao": _STAGED,
    "stg_indicadores_macro": _STAGED,
    "stg_dem_financeira": _STAGED,
    "stg_cadastro_empresa": _STAGED,
    "stg_dividendos": _STAGED,
    "stg_desdobramento": _STAGED,
    "dim_setor": ["id_setor", "cd_setor", "ds_setor"],
    "dim_subsetor": ["id_subsetor", "id_setor", "cd_subsetor", "ds_subsetor"],
    "dim_segmento_listagem": ["id_segmento", "cd_segmento", "ds_segmento"],
    "dim_tipo_acao": ["id_tipo_acao", "cd_tipo", "ds_tipo"],
    "dim_empresa": ["id_empresa", "cd_cvm", "ds_razao_social"],
    "dim_acao": ["id_acao", "cd_ticker", "id_empresa", "id_tipo_acao"],
    "dim_data": [
        "id_data", "dt_data", "nr_ano", "nr_mes", "nr_dia", "nr_trimestre", "nr_semestre", "ds_dia_semana", "nr_dia_semana", "ds_mes",
    ],
    "dim_periodo_crise": ["id_crise", "ds_crise", "dt_inicio", "dt_fim"],
    "dim_indicador_macro": ["id_indicador", "cd_indicador", "ds_indicador", "ds_unidade", "ds_fonte"],
    "fato_cotacao": ["id_cotacao", "id_acao", "id_data", "vl_abertura", "vl_fechamento", "vl_maximo", "vl_minimo", "vl_volume"],
    "fato_indicador_macro": ["id_fato", "id_indicador", "id_data", "vl_indicador"],
    "fato_dem_financeira": ["id_fato", "id_empresa", "id_data"],
    "fato_indicadores": ["id_fato", "id_acao", "id_data"],
    "hist_dividendos": ["id_dividendo", "id_acao", "id_data", "vl_dividendo", "ds_tipo"],
    "hist_desdobramento": ["id_desdobramento", "id_acao", "id_data", "ds_tipo", "vl_fator"],
    "hist_preco_ajustado": ["id_preco_aj", "id_acao", "id_data", "vl_fechamento_aj"],
    "log_auditoria": ["id_log", "ds_tabela", "ds_operacao"],
    "etl_log_erros": ["id_erro", "ds_etapa", "ds_procedure", "ds_erro", "dt_erro"],
    "etl_controle_carga": ["id_carga", "ds_fonte", "ds_tabela_destino", "dt_inicio_carga", "ds_status"],
    "parametros_sistema": ["id_parametro", "cd_parametro", "vl_parametro"],
}

# Row conditions; as in SQL, a condition that is NULL passes.
ROW_CHECKS = {
    "dim_data": {"month in range": "nr_mes BETWEEN 1 AND 12", "day in range": "nr_dia BETWEEN 1 AND 31"},
    "dim_periodo_crise": {"period ends after start": "dt_fim >= dt_inicio"},
    "fato_cotacao": {"high at or above low": "vl_maximo >= vl_minimo", "volume not negative": "vl_volume >= 0"},
    "hist_dividendos": {"dividend above zero": "vl_dividendo > 0"},
}

ALLOWED_VALUES = {
    "fato_dem_financeira": {"ds_tipo_dem": ["ANUAL", "TRIMESTRAL"]},
    "hist_desdobramento": {"ds_tipo": ["SPLIT", "GRUPAMENTO", "BONIFICACAO"]},
    "log_auditoria": {"ds_operacao": ["INSERT", "UPDATE", "DELETE"]},
}

# The declared width of every text column that has one.
TEXT_WIDTHS = {
    "stg_cotacao": {
        "ticker": 10, "dt_pregao": 20, "vl_abertura": 20, "vl_fechamento": 20, "vl_maximo": 20, "vl_minimo": 20, "vl_volume": 30, "ds_erro": 500,
    },
    "stg_indicadores_macro": {"cd_indicador": 20, "cd_serie_bcb": 20, "dt_referencia": 20, "vl_indicador": 30, "ds_erro": 500},
    "stg_dem_financeira": {
        "cd_cvm": 20, "ds_conta": 200, "cd_conta": 50, "vl_conta": 30, "dt_referencia": 20, "ds_tipo_dem": 20, "nr_versao": 10, "ds_erro": 500,
    },
    "stg_cadastro_empresa": {
        "cd_cvm": 20, "nr_cnpj": 20, "ds_razao_social": 200, "ds_nome_pregao": 100, "ds_setor_atividade": 200, "ds_situacao": 50,
        "dt_registro": 20, "dt_constituicao": 20, "ds_segmento": 100, "ds_erro": 500,
    },
    "stg_dividendos": {
        "ticker": 10, "cd_cvm": 20, "dt_aprovacao": 20, "vl_provento": 30, "ds_tipo": 50, "dt_ex": 20, "dt_pagamento": 20, "ds_erro": 500,
    },
    "stg_desdobramento": {"ticker": 10, "dt_evento": 20, "ds_tipo": 30, "vl_fator": 20, "ds_descricao": 200, "ds_erro": 500},
    "dim_setor": {"cd_setor": 20, "ds_setor": 100, "ds_descricao": 500},
    "dim_subsetor": {"cd_subsetor": 20, "ds_subsetor": 100},
    "dim_segmento_listagem": {"cd_segmento": 20, "ds_segmento": 100, "ds_descricao": 500},
    "dim_tipo_acao": {"cd_tipo": 10, "ds_tipo": 50, "ds_descricao": 200},
    "dim_empresa": {"cd_cvm": 20, "nr_cnpj": 20, "ds_razao_social": 200, "ds_nome_pregao": 100},
    "dim_acao": {"cd_ticker": 10, "ds_acao": 200},
    "dim_data": {"ds_dia_semana": 20, "ds_mes": 20},
    "dim_periodo_crise": {"ds_crise": 100, "ds_descricao": 500},
    "dim_indicador_macro": {"cd_indicador": 20, "ds_indicador": 100, "ds_unidade": 50, "ds_fonte": 100, "cd_serie_bcb": 20, "ds_descricao": 500},
    "fato_dem_financeira": {"ds_tipo_dem": 20},
    "hist_dividendos": {"ds_tipo": 50},
    "hist_desdobramento": {"ds_tipo": 20, "ds_descricao": 200},
    "log_auditoria": {"ds_tabela": 100, "ds_operacao": 10, "ds_usuario": 100},
    "etl_log_erros": {"ds_etapa": 50, "ds_fonte": 100, "ds_procedure": 100},
    "etl_controle_carga": {"ds_fonte": 100, "ds_arquivo": 500, "ds_tabela_destino": 100, "ds_status": 20, "ds_checksum": 64},
    "parametros_sistema": {"cd_parametro": 50, "vl_parametro": 200, "ds_descricao": 500},
}

# (child table, column, parent table, parent key, optional)
FOREIGN_KEYS = [
    ("dim_subsetor", "id_setor", "dim_setor", "id_setor", False),
    ("dim_empresa", "id_setor", "dim_setor", "id_setor", True),
    ("dim_empresa", "id_subsetor", "dim_subsetor", "id_subsetor", True),
    ("dim_empresa", "id_segmento", "dim_segmento_listagem", "id_segmento", True),
    ("dim_acao", "id_empresa", "dim_empresa", "id_empresa", False),
    ("dim_acao", "id_tipo_acao", "dim_tipo_acao", "id_tipo_acao", False),
] + [
    (fact, column, parent, column, False)
    for fact, entity, entity_table in [
        ("fato_cotacao", "id_acao", "dim_acao"),
        ("fato_indicador_macro", "id_indicador", "dim_indicador_macro"),
        ("fato_dem_financeira", "id_empresa", "dim_empresa"),
        ("fato_indicadores", "id_acao", "dim_acao"),
        ("hist_dividendos", "id_acao", "dim_acao"),
        ("hist_desdobramento", "id_acao", "dim_acao"),
        ("hist_preco_ajustado", "id_acao", "dim_acao"),
    ]
    for column, parent in [(entity, entity_table), ("id_data", "dim_data")]
]


def columns_in(condition: str) -> list[str]:
    """The columns a row condition names."""
    return re.findall(r"\b(?:id|nr|vl|dt|ds|cd|fl)_\w+", condition)
