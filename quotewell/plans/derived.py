"""Adjusted prices and indicators, brought up to date with what has changed.

Every load notes, in the commit that writes its rows, which shares have changed and from which day on (`estado_mudanca`). Deriving
takes the notes of its table, reads as much of those shares' history as the figures need, computes their rows from the changed day on, and
replaces the years in which a row differs from the stored one. Other years keep their files, other shares' rows are
copied, and the notes go in the same commit. A table that is empty is simply derived as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window as W, functions as F

from quotewell.functions.calendar import date_key, year_of
from quotewell.operators.corporate import adjusted_prices
from quotewell.operators.fundamentals import MEASURES, indicator_fact
from quotewell.operators.keys import day_key
from quotewell.operators.returns import SESSIONS_PER_YEAR
from quotewell.plans.market import series_values
from quotewell.session import stored
from quotewell.sources.store import Store

ADJUSTED, INDICATORS = "hist_preco_ajustado", "fato_indicadores"


def note_changes(store: Store, rows: DataFrame, targets: list[str], cause: str) -> None:
    """Note (id_acao, id_de): the share's figures in the target tables may change from that day on. NULL stands for all shares."""
    each = rows.select("id_acao", "id_de", F.explode(F.array(*[F.lit(t) for t in targets])).alias("ds_destino"))
    store.append(each.withColumn("ds_causa", F.lit(cause)).coalesce(1), "estado_mudanca")


def first_days(store: Store, target: str, whole: bool = False) -> DataFrame:
    """(id_acao, id_de) of the shares with quotes whose rows in the target have to be looked at."""
    notes = store.read("estado_mudanca").filter(F.col("ds_destino") == target)
    shares = store.read("estado_cotacao").select("id_acao").distinct()
    if whole:
        return shares.withColumn("id_de", F.lit(0))
    for_all = notes.filter("id_acao IS NULL").agg(F.min("id_de")).first()[0]  # one number
    named = notes.filter("id_acao IS NOT NULL").groupBy("id_acao").agg(F.min("id_de").alias("_own"))
    rows = shares.join(named, "id_acao", "left").select("id_acao", F.least("_own", F.lit(for_all).cast("int")).alias("id_de"))
    return rows.filter("id_de IS NOT NULL")


def computed(todo: DataFrame) -> tuple[DataFrame, int | None]:
    """The changed shares as a table, and the first changed day of all (None if nothing has changed)."""
    seen = Observation()
    return stored(todo.observe(seen, F.min("id_de").alias("lowest")), "changes"), seen.get["lowest"]


def forget_notes(store: Store, target: str) -> None:
    store.overwrite(store.read("estado_mudanca").filter(F.col("ds_destino") != target).coalesce(1), "estado_mudanca")


def history_of(store: Store, todo: DataFrame, sessions: int) -> DataFrame:
    """Quotes of the shares in `todo`, from a year that leaves at least `sessions` sessions (or all) before the year of `id_de`.

    The state tells how many sessions a share has in each year; the fact is read from the earliest such year on.
    """
    earlier = store.read("estado_cotacao").join(todo, "id_acao").filter(F.col("nr_ano") < year_of(F.col("id_de")))
    nearer = W.partitionBy("id_acao").orderBy(F.desc("nr_ano")).rowsBetween(W.unboundedPreceding, -1)
    needed = earlier.withColumn("_between", F.coalesce(F.sum("nr_pregoes").over(nearer), F.lit(0))).filter(F.col("_between") < sessions)
    start = needed.groupBy("id_acao").agg(F.min("nr_ano").alias("_from"))
    start = todo.join(start, "id_acao", "left").select("id_acao", F.coalesce("_from", year_of(F.col("id_de"))).alias("_from"))
    lowest = start.agg(F.min("_from")).first()[0]  # one number: prunes the folders
    quotes = store.read("fato_cotacao").filter(F.col("nr_ano") >= (lowest or 0))
    return quotes.join(start, "id_acao").filter(F.col("nr_ano") >= F.col("_from")).drop("_from")


def rewrite_changed(store: Store, table: str, fresh: DataFrame, todo: DataFrame, lowest: int) -> None:
    """The fresh rows in place of the shares' stored rows from `id_de` on, in the years where one of them differs."""
    key = ["id_acao", "id_data"]
    if not store.folders(table):
        store.append(fresh, table, key)
        return
    values = [c for c in fresh.columns if c not in (*key, "nr_ano", "dt_carga")]
    fresh = stored(fresh, table)
    held = store.read(table).filter(F.col("nr_ano") >= lowest // 10_000).join(todo, "id_acao").filter("id_data >= id_de")
    years = differing_years(store, table, held, fresh, [*key, *values])
    if not years:
        return
    rest = store.read(table).filter(F.col("nr_ano").isin(years)).join(todo, "id_acao", "left").filter("id_de IS NULL OR id_data < id_de")
    rows = rest.drop("id_de").unionByName(fresh.filter(F.col("nr_ano").isin(years)), allowMissingColumns=True)
    store.replace_partitions(rows, table, key)


def differing_years(store: Store, table: str, old: DataFrame, new: DataFrame, columns: list[str]) -> list[int]:
    """The years in which the two do not hold the same rows, in the stored types; rows are unique by key.

    A year's rows are folded map-side to their number and to 160 bits that do not depend on their order, so nothing is joined.
    """
    cells = [F.col(c).cast(store.schema(table)[c].dataType) for c in columns]
    cells += [F.isnull(c) for c in columns]  # a hash passes over NULL
    side = lambda df, name: df.select(year_of(F.col("id_data")).alias("_year"), F.lit(name).alias("_side"), F.xxhash64(*cells).alias("_a"), F.xxhash64(F.lit(1), *cells).alias("_b"))
    sums = [F.count("*").alias("n"), F.bit_xor("_a").alias("a"), F.bit_xor("_b").alias("b"), F.sum(F.shiftright("_a", 32)).alias("s")]
    folded = side(old, "old").unionByName(side(new, "new")).groupBy("_year", "_side").agg(*sums)
    found: dict[int, list] = {}
    for r in folded.collect():  # two rows a year
        found.setdefault(r["_year"], []).append((r["n"], r["a"], r["b"], r["s"]))
    return sorted(year for year, both in found.items() if len(both) < 2 or both[0] != both[1])


def derive_adjusted(store: Store, whole: bool = False) -> None:
    """Adjusted prices of the shares with news.

    New quotes change the rows from their day on; a dividend whose last day with the right is not before them hangs on
    the price by then and changes all the share's rows, as does a new event.
    """
    with store.commit():
        todo = first_days(store, ADJUSTED, whole)
        paid = store.read("hist_dividendos").groupBy("id_acao").agg(F.max(date_key(F.col("dt_ex"))).alias("_event"))
        reached = F.when(F.col("_event") >= F.col("id_de"), 0).otherwise(F.col("id_de"))
        todo, lowest = computed(todo.join(paid, "id_acao", "left").select("id_acao", reached.alias("id_de")))
        if lowest is None:
            return
        dividends = store.read("hist_dividendos").join(todo.select("id_acao"), "id_acao", "left_semi")
        splits = store.read("hist_desdobramento").join(todo.select("id_acao"), "id_acao", "left_semi")
        quotes = history_of(store, todo, 1).select("id_acao", "id_data", "vl_fechamento")
        fresh = adjusted_prices(quotes, splits, dividends).join(todo, "id_acao").filter("id_data >= id_de").drop("id_de")
        fresh = fresh.withColumns({"id_preco_aj": day_key("id_acao"), "dt_carga": F.current_timestamp(), "nr_ano": year_of(F.col("id_data"))})
        rewrite_changed(store, ADJUSTED, fresh, todo, lowest)
        forget_notes(store, ADJUSTED)


def derive_indicators(store: Store, window: int = SESSIONS_PER_YEAR, whole: bool = False, min_returns: int | None = None) -> None:
    """Indicators of the shares with news, from the month of the first changed day on.

    A month's row stands on its last session, so a later session of the month takes its place. The risk figures look back
    `window` sessions, dividends a year, statements to the last one filed.
    """
    with store.commit():
        month = F.call_function("div", F.col("id_de"), F.lit(100)).cast("int") * 100
        todo, lowest = computed(first_days(store, INDICATORS, whole).select("id_acao", month.alias("id_de")))
        if lowest is None:
            return
        one = todo.select("id_acao")
        rate = series_values(store.read("fato_indicador_macro"), store.read("dim_indicador_macro"), "SELIC")
        fresh = indicator_fact(
            history_of(store, todo, window + 1).select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario"),
            store.read("dim_acao").join(one, "id_acao", "left_semi").select("id_acao", "id_empresa", "nr_total_acoes"),
            store.read("fato_dem_financeira").filter("ds_tipo_dem = 'ANUAL'").select("id_empresa", "id_data", *MEASURES),
            store.read("hist_dividendos").join(one, "id_acao", "left_semi").select("id_acao", "id_data", "vl_dividendo"),
            rate.withColumnRenamed("vl_indicador", "vl_taxa"),
            window=window,
            min_returns=min_returns,
        )
        fresh = fresh.join(todo, "id_acao").filter("id_data >= id_de").drop("id_de")
        fresh = fresh.withColumns({"id_fato": day_key("id_acao"), "dt_carga": F.current_timestamp(), "nr_ano": year_of(F.col("id_data"))})
        rewrite_changed(store, INDICATORS, fresh, todo, lowest)
        forget_notes(store, INDICATORS)
