"""The driver's tables in the roles of the market model."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotewell.functions.calendar import calendar_columns, date_key
from quotewell.operators.returns import with_amplitude, with_daily_return


def price(units: Column) -> Column:
    """Whole ten-thousandths as a price."""
    return (units.cast("decimal(14,0)") * F.expr("0.0001")).cast("decimal(18,4)")


class Market:
    """Lazy views: lineitem as quotes, orders as macro series, supplier/nation/region as share/company/sector."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def ticks(self) -> DataFrame:
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        price = 1_000_000 + F.call_function("div", cents + 5, F.lit(10))  # 100 + price / 1000, in ten-thousandths
        sequence = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 262144 + F.col("l_partkey") % 262144
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("id_acao"),
            F.col("l_shipdate").cast("date").alias("dt_data"),
            price.alias("p"),
            F.col("l_quantity").cast("bigint").alias("q"),
            sequence.alias("k"),
            "l_returnflag",
            "l_linenumber",
        )

    @cached_property
    def bars(self) -> DataFrame:
        return self.daily_bars(self.ticks)

    @staticmethod
    def daily_bars(ticks: DataFrame) -> DataFrame:
        """One row per (share, day). Every aggregate combines map-side on primitive buffers."""
        return (
            ticks.groupBy("id_acao", "dt_data")
            .agg(
                price(F.min_by("p", "k")).alias("vl_abertura"),
                price(F.max_by("p", "k")).alias("vl_fechamento"),
                price(F.max("p")).alias("vl_maximo"),
                price(F.min("p")).alias("vl_minimo"),
                F.sum("q").alias("vl_volume"),
            )
            .withColumn("id_data", date_key(F.col("dt_data")))
        )

    def quotes_of(self, shares: DataFrame) -> DataFrame:
        """Quotes with returns of some shares only: the others leave before anything is shuffled."""
        ticks = self.ticks.join(shares.select("id_acao"), "id_acao", "left_semi")
        return with_daily_return(self.daily_bars(ticks))

    @cached_property
    def quotes(self) -> DataFrame:
        return with_amplitude(with_daily_return(self.bars))

    @cached_property
    def setor(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("id_setor"), F.col("r_name").alias("cd_setor"), F.col("r_name").alias("ds_setor")
        )

    @cached_property
    def empresa(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("id_empresa"),
            F.col("n_name").alias("ds_razao_social"),
            F.col("n_regionkey").alias("id_setor"),
        )

    @cached_property
    def acao(self) -> DataFrame:
        key = F.col("s_suppkey")
        segments = F.array(*[F.lit(s) for s in ["NM", "N2", "N1", "MA", "TRAD"]])
        return self.table("supplier").select(
            key.alias("id_acao"),
            F.concat(F.lit("T"), key).alias("cd_ticker"),
            F.col("s_nationkey").alias("id_empresa"),
            (key + 1_000_000).alias("nr_total_acoes"),
            (key % 10 != 7).alias("fl_ativa"),
            F.element_at(segments, (key % 5 + 1).cast("int")).alias("cd_segmento"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Order days plus the 120 days in which their lines ship."""
        day = F.col("o_orderdate").cast("date")
        bounds = self.table("orders").agg(F.min(day).alias("a"), F.date_add(F.max(day), 120).alias("b"))
        return calendar_columns(bounds.select(F.explode(F.sequence("a", "b")).alias("dt_data")))

    @cached_property
    def macro(self) -> DataFrame:
        total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
        return (
            self.table("orders")
            .groupBy(
                F.substring("o_orderpriority", 1, 1).cast("int").alias("id_indicador"),
                F.col("o_orderdate").cast("date").alias("dt_data"),
            )
            .agg((total / (F.count("*") * 1_000_000)).cast("decimal(18,6)").alias("vl_indicador"))
            .withColumn("id_data", date_key(F.col("dt_data")))
        )

    @cached_property
    def indicators(self) -> DataFrame:
        digit = F.substring("o_orderpriority", 1, 1)
        codes = F.array(*[F.lit(c) for c in ["SELIC", "IPCA", "CAMBIO", "CDI", "OUTRO"]])
        return (
            self.table("orders")
            .select(
                digit.cast("int").alias("id_indicador"),
                F.element_at(codes, digit.cast("int")).alias("cd_indicador"),
                F.col("o_orderpriority").alias("ds_indicador"),
            )
            .distinct()
        )

    def series(self, number: int) -> DataFrame:
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
        return (
            self.table("orders")
            .filter(digit == number)
            .groupBy(F.col("o_orderdate").cast("date").alias("dt_data"))
            .agg((total / (F.count("*") * 1_000_000)).cast("decimal(18,6)").alias("vl_indicador"))
            .withColumn("id_data", date_key(F.col("dt_data")))
        )

    @cached_property
    def splits(self) -> DataFrame:
        return self.ticks.filter("l_returnflag = 'R' AND l_linenumber = 1").select(
            "id_acao",
            date_key(F.col("dt_data")).alias("id_data"),
            "dt_data",
            F.lit("BONIFICACAO").alias("ds_tipo"),
            F.lit("1.1").cast("decimal(10,4)").alias("vl_fator"),
        )

    @cached_property
    def dividends(self) -> DataFrame:
        return self.ticks.filter("l_returnflag = 'A' AND l_linenumber = 2").select(
            "id_acao",
            date_key(F.col("dt_data")).alias("id_data"),
            "dt_data",
            F.col("dt_data").alias("dt_ex"),
            F.lit("DIVIDENDO").alias("ds_tipo"),
            (price(F.col("p")) * F.expr("0.0137")).cast("decimal(18,4)").cast("decimal(18,6)").alias("vl_dividendo"),
        )

    @cached_property
    def statements(self) -> DataFrame:
        value = F.col("o_totalprice").cast("decimal(18,2)")

        def total(column, name):
            return F.sum(column).cast("decimal(20,2)").alias(name)

        def of_state(state):
            return F.when(F.col("o_orderstatus") == state, value)

        return (
            self.table("orders")
            .groupBy((F.col("o_custkey") % 25).alias("id_empresa"), F.last_day(F.col("o_orderdate").cast("date")).alias("dt_data"))
            .agg(
                total(value, "vl_receita_liquida"),
                total(of_state("F"), "vl_lucro_liquido"),
                total(of_state("O"), "vl_ebitda"),
                total(of_state("P"), "vl_divida_bruta"),
                total(value * 2, "vl_patrimonio_liq"),
                total(value * 3, "vl_ativo_total"),
            )
            .withColumn("id_data", date_key(F.col("dt_data")))
        )

    @cached_property
    def texts(self) -> DataFrame:
        """Order rows as untidy series text: two date and number formats, blank dates, unreadable values."""
        key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        day, odd = F.col("o_orderdate"), F.col("o_orderkey") % 2 == 1
        return self.table("orders").select(
            key.alias("id_staging"),
            F.lit("SELIC").alias("cd_indicador"),
            F.lit("11").alias("cd_serie_bcb"),
            F.when(key % 97 == 0, "")
            .when(odd, F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "yyyy-MM-dd"))
            .alias("dt_referencia"),
            F.when(key % 89 == 0, "abc").when(odd, F.translate(price, ".", ",")).otherwise(price).alias("vl_indicador"),
        )

    @cached_property
    def states(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id_carga"),
            F.when(status == "F", 1).when(status == "O", 0).otherwise(2).alias("fl_processado"),
        )

    @cached_property
    def control(self) -> DataFrame:
        status, client = F.col("o_orderstatus"), F.col("o_custkey")
        end = F.col("o_orderdate") + F.make_dt_interval(secs=(client % 3600).cast("decimal(18,6)"))
        return (
            self.table("orders")
            .filter("o_orderkey % 5 <> 0")
            .select(
                F.col("o_orderkey").alias("id_carga"),
                F.concat(F.lit("F"), client % 7).alias("ds_fonte"),
                F.concat(F.lit("arquivo_"), F.col("o_orderkey")).alias("ds_arquivo"),
                F.lit("stg_cotacao").alias("ds_tabela_destino"),
                F.col("o_orderdate").alias("dt_inicio_carga"),
                F.when(status != "O", end).alias("dt_fim_carga"),
                client.alias("nr_registros_carga"),
                (client % 10).alias("nr_registros_erro"),
                F.when(status == "F", "SUCESSO").when(status == "O", "EXECUTANDO").otherwise("ERRO").alias("ds_status"),
            )
        )

    @cached_property
    def errors(self) -> DataFrame:
        sequence = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 262144 + F.col("l_partkey") % 262144
        return (
            self.table("lineitem")
            .filter("l_returnflag = 'R'")
            .select(
                sequence.alias("id_erro"),
                F.when(F.col("l_linenumber") != 1, F.col("l_orderkey")).alias("id_carga"),
                F.lit("EXTRACT").alias("ds_etapa"),
                F.col("l_linestatus").alias("ds_fonte"),
                F.lit("carga").alias("ds_procedure"),
                F.concat(F.lit("erro "), F.col("l_linenumber")).alias("ds_erro"),
                F.col("l_shipdate").alias("dt_erro"),
            )
        )
