"""From delivered files to the star schema: extract, type, look up keys, load, derive."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

from quotewell.functions.calendar import build_calendar, date_key
from quotewell.functions.parsing import row_json, share_type, statement_period, whole_currency
from quotewell.operators.fundamentals import known_versions, statement_measures
from quotewell.operators.joins import expand_monthly, insert_if_absent, keep_first, lookup_key, scd1_upsert
from quotewell.operators.keys import day_key, with_block_keys, with_dense_keys
from quotewell.operators.quality import broken_mask, broken_names, stored_rules
from quotewell.operators.returns import change_on_previous, returns_out_of_range
from quotewell.operators.typed import PASSED, REJECTED, TYPINGS, apply_typing
from quotewell.plans.derived import ADJUSTED, INDICATORS, derive_adjusted, derive_indicators, note_changes
from quotewell.seeds import seed_names, seed_table
from quotewell.session import stored
from quotewell.sources.csv_files import CsvSource
from quotewell.sources.loading import after_mark, full_extract, log_errors, move_mark, read_mark
from quotewell.sources.store import Store

MONTHLY_SERIES = ["IPCA"]  # fixed value: filed once a month, repeated for every day of it
EARLIEST = "1960-01-01"  # business days before it, or over a year after today, are taken for errors
RATE = "SELIC"
ROWS_A_FILE = 500_000  # of a year of quotes, about
LOGS = ["etl_controle_carga", "etl_log_erros", "etl_arquivos", "quarentena", "log_auditoria", "estado_mudanca"]


def create_tables(store: Store, first: str = "2000-01-01", last: str = "2024-12-31", holidays: DataFrame | None = None) -> None:
    """Seed rows and the calendar, once."""
    with store.commit():
        for table in seed_names():
            store.write_once(seed_table(store.spark, table), table)
        create_calendar(store, first, last, holidays)


def create_calendar(store: Store, first: str, last: str, holidays: DataFrame | None = None) -> None:
    if "dim_data" not in store.snapshot().tables:
        store.overwrite(build_calendar(store.spark, first, last, holidays), "dim_data")
        mark_calendar(store, date.fromisoformat(first), date.fromisoformat(last))


def settle_staging(store: Store, table: str, source: str) -> DataFrame:
    """Classify a source's pending rows as passed or rejected, store that, log the rejects; return passed rows typed.

    The one classifying pass writes both outcomes to their folders; rejects and passed rows are then read from
    the folder that holds them.
    """
    typing = TYPINGS[table]
    pending = store.read(table).filter((F.col("ds_fonte") == source) & (F.col("fl_processado") == 0))
    loads = store.pending_loads(table, source)
    states = apply_typing(pending.drop("ds_erro", "fl_processado"), typing, keep_raw=True)
    states = states.select("id_staging", "id_carga", "ds_fonte", "dt_carga", "_raw.*", "fl_processado", "ds_erro")
    seen = Observation()
    store.settle(states.observe(seen, F.count_if(F.col("fl_processado") == REJECTED).alias("rejects")), table, source)
    done = store.read(table).filter((F.col("ds_fonte") == source) & F.col("id_carga").isin(loads))
    rejects = done.filter(F.col("fl_processado") == REJECTED).select(
        "id_carga",
        F.lit("TRANSFORM").alias("ds_etapa"),
        "ds_fonte",
        F.lit("settle_staging").alias("ds_procedure"),
        "ds_erro",
        F.to_json(F.struct(*typing.raw()), {"ignoreNullFields": "false"}).alias("ds_dados"),
    )
    if loads and seen.get["rejects"]:
        log_errors(store, rejects)
    kept = done.filter(F.col("fl_processado") == PASSED)
    return apply_typing(kept.drop("ds_erro", "fl_processado"), typing).drop("ds_erro", "ds_dados", "fl_processado")


def log_lost(store: Store, rows: DataFrame, reason: Column, source: str, columns: list[str]) -> None:
    """Put rows on record in the error log with their reason."""
    load = F.col("id_carga") if "id_carga" in rows.columns else F.lit(None).cast("bigint").alias("id_carga")
    lost = rows.select(
        load,
        F.lit("LOAD").alias("ds_etapa"),
        F.lit(source).alias("ds_fonte"),
        F.lit("arrived").alias("ds_procedure"),
        reason.alias("ds_erro"),
        F.to_json(F.struct(*[c for c in columns if c in rows.columns])).alias("ds_dados"),
    )
    log_errors(store, lost)


def in_range(day: str = "dt_data", earliest: str = EARLIEST) -> Column:
    """Whether a business day can be one: not before `earliest`, at most a year after today."""
    return F.col(day).between(F.lit(earliest).cast("date"), F.date_add(F.current_date(), 366))


@dataclass(frozen=True)
class Batch:
    """A delivery's good rows and their first and last day (None without any)."""

    rows: DataFrame
    low: date | None
    high: date | None

    def bounds(self) -> dict[str, tuple[int, int]]:
        """Of the year and the date key, the month around either end included: what of a fact has to be read."""
        if self.low is None:
            return {"nr_ano": (0, -1)}
        low, high = self.low.year * 10_000 + self.low.month * 100, self.high.year * 10_000 + self.high.month * 100 + 31
        return {"nr_ano": (self.low.year, self.high.year), "id_data": (low, high)}


def arrived(store: Store, rows: DataFrame, key: str | None, natural: str, source: str, day: str | None = "dt_data") -> Batch:
    """The delivery, computed once, without rows whose key is unknown or whose day is impossible.

    Those go to the error log with the reason; how many there are, and the days of the others, come from the write itself.
    """
    why = F.lit(None).cast("string")
    if day:
        why = F.when(~F.coalesce(in_range(day), F.lit(False)), "day out of range")
    if key:
        why = F.when(F.col(key).isNull(), f"unknown {natural}").otherwise(why)
    marked, seen = rows.withColumn("_why", why), Observation()
    good = F.when(F.col("_why").isNull(), F.col(day) if day else F.current_date())
    marked = stored(marked.observe(seen, F.count("_why").alias("lost"), F.min(good).alias("low"), F.max(good).alias("high")), "arrived")
    found = seen.get
    if found["lost"]:
        log_lost(store, marked.filter("_why IS NOT NULL"), F.col("_why"), source, [natural, *([day] if day else [])])
    return Batch(marked.filter("_why IS NULL").drop("_why"), found["low"], found["high"])


def checked(store: Store, rows: DataFrame, table: str) -> tuple[DataFrame, int]:
    """The rows to be stored, computed once, without those that break a rule of the table; these go to quarantine. And how many
    are left.

    All rules make one bit each of one number a row, so the batch is judged in the pass that stores it.
    """
    rules = stored_rules(table, rows.columns)
    counts = Observation()
    mask = F.col("_mask")
    marked = rows.withColumn("_mask", broken_mask(rules)).observe(counts, F.count_if(mask != 0).alias("broken"), F.count_if(mask == 0).alias("good"))
    marked = stored(marked, f"batch-{table}")
    if counts.get["broken"]:
        load = F.col("id_carga") if "id_carga" in rows.columns else F.lit(None)
        store.append(
            marked.filter("_mask <> 0").select(
                load.cast("bigint").alias("id_carga"),
                F.lit(table).alias("ds_tabela"),
                F.col("_mask").alias("nr_regras"),
                broken_names(F.col("_mask"), rules).alias("ds_regras"),
                row_json(*rows.columns).alias("ds_dados"),
                F.current_timestamp().alias("dt_carga"),
            ),
            "quarentena",
        )
    return marked.filter("_mask = 0").drop("_mask"), counts.get["good"]


def load_companies(store: Store, registry: DataFrame, sectors: DataFrame | None = None, listing: DataFrame | None = None) -> None:
    """Registry rows upserted into dim_empresa by company code.

    `sectors` maps ds_setor_atividade to cd_setor; activities it does not list leave the sector NULL. `listing` gives
    cd_cvm with cd_segmento and, if it has them, cd_subsetor and ds_subsetor: sub-sectors not known yet are added to dim_subsetor
    under their company's sector. A segment that the model does not have is logged.
    """
    rows = keep_first(registry, ["cd_cvm"], [F.desc("fl_ativa"), F.col("id_staging")])
    if sectors is None:
        rows = rows.withColumn("id_setor", F.lit(None).cast("int"))
    else:
        codes = sectors.select("ds_setor_atividade", "cd_setor").dropDuplicates(["ds_setor_atividade"])
        rows = rows.join(codes, "ds_setor_atividade", "left").join(
            store.read("dim_setor").select("cd_setor", "id_setor"), "cd_setor", "left"
        )
    attributes = [
        "nr_cnpj", "ds_razao_social", "ds_nome_pregao", "id_setor", "dt_constituicao", "dt_listagem", "fl_ativa",
    ]
    with store.commit():
        if listing is not None:
            rows = rows.join(listing.dropDuplicates(["cd_cvm"]), "cd_cvm", "left")
            rows = rows.join(store.read("dim_segmento_listagem").select("cd_segmento", "id_segmento"), "cd_segmento", "left")
            unknown = rows.filter("cd_segmento IS NOT NULL AND id_segmento IS NULL")
            log_lost(store, unknown, F.lit("unknown cd_segmento"), "LISTAGEM", ["cd_cvm", "cd_segmento"])
            attributes.append("id_segmento")
            if "cd_subsetor" in listing.columns:
                add_subsectors(store, rows)
                rows = rows.join(store.read("dim_subsetor").select("cd_subsetor", "id_subsetor"), "cd_subsetor", "left")
                attributes.append("id_subsetor")
        current = store.read("dim_empresa")
        merged = scd1_upsert(current, rows, "cd_cvm", attributes, F.current_timestamp(), images=True)
        rewrite_dimension(store, "dim_empresa", merged, "cd_cvm", "id_empresa", current)


def add_subsectors(store: Store, companies: DataFrame) -> None:
    """Sub-sectors of companies with a sector that dim_subsetor does not have."""
    held = store.read("dim_subsetor")
    name = F.col("ds_subsetor") if "ds_subsetor" in companies.columns else F.col("cd_subsetor")
    new = companies.filter("cd_subsetor IS NOT NULL AND id_setor IS NOT NULL").groupBy("cd_subsetor").agg(
        F.min("id_setor").alias("id_setor"), F.min(name).alias("ds_subsetor")
    )
    new = new.join(held.select("cd_subsetor"), "cd_subsetor", "left_anti").withColumn("dt_criacao", F.current_timestamp())
    highest = held.agg(F.max("id_subsetor")).first()[0] or 0
    store.append(with_dense_keys(new, ["cd_subsetor"], "id_subsetor", highest + 1), "dim_subsetor")


def load_shares(store: Store, tickers: DataFrame) -> None:
    """Tickers (cd_ticker, cd_cvm, nr_total_acoes) upserted into dim_acao; the type comes from the ticker's suffix.

    A share whose number of shares or company changes has its indicators derived again.
    """
    types = store.read("dim_tipo_acao").select("cd_tipo", "id_tipo_acao")
    companies = store.read("dim_empresa").select("cd_cvm", "id_empresa", "ds_nome_pregao")
    rows = (
        tickers.withColumn("cd_tipo", share_type(F.col("cd_ticker")))
        .join(types, "cd_tipo", "left")
        .join(companies, "cd_cvm", "left")
        .withColumn("ds_acao", F.concat_ws(" ", "ds_nome_pregao", "cd_tipo"))
        .withColumn("fl_ativa", F.lit(True))
    )
    with store.commit():
        rows = arrived(store, rows, "id_empresa", "cd_cvm", "TICKERS", None).rows
        untyped = rows.filter("id_tipo_acao IS NULL")
        if not untyped.isEmpty():
            log_lost(store, untyped, F.lit("unknown cd_tipo"), "TICKERS", ["cd_ticker", "cd_tipo"])
            rows = rows.filter("id_tipo_acao IS NOT NULL")
        attributes = ["id_empresa", "id_tipo_acao", "ds_acao", "nr_total_acoes", "fl_ativa"]
        current = store.read("dim_acao")
        merged = scd1_upsert(current, rows, "cd_ticker", attributes, F.current_timestamp(), images=True)
        rewrite_dimension(store, "dim_acao", merged, "cd_ticker", "id_acao", current)
        if "estado_cotacao" in store.snapshot().tables:
            was = current.select("id_acao", F.struct("id_empresa", "nr_total_acoes").alias("_was"))
            now = store.read("dim_acao").select("id_acao", F.struct("id_empresa", "nr_total_acoes").alias("_now"))
            changed = was.join(now, "id_acao").filter(~F.col("_was").eqNullSafe(F.col("_now")))
            note_changes(store, changed.select("id_acao", F.lit(0).alias("id_de")), [INDICATORS], "acao")


def rewrite_dimension(store: Store, table: str, merged: DataFrame, natural: str, key: str, current: DataFrame) -> None:
    """Write a dimension's new snapshot and what it changed to log_auditoria, in one commit.

    Present rows keep their key, new ones are numbered after the highest. `merged` comes from `scd1_upsert` with images:
    `_antes` is the old row as JSON, `_operacao` what happened to it. The merge is computed once; both tables are written from that.
    Without any change nothing is written.
    """
    known = current.select(F.col(natural).alias("_natural"), F.col(key).alias("_key"))
    merged = merged.drop(key).join(known, F.col(natural) == F.col("_natural"), "left").drop("_natural")
    seen = Observation()
    added, changed = F.count_if(F.col("_key").isNull()), F.count("_operacao")
    merged = stored(merged.observe(seen, added.alias("added"), changed.alias("changed"), F.max("_key").alias("highest")), f"merge-{table}")
    if not seen.get["changed"]:
        return
    whole = merged.filter("_key IS NOT NULL").withColumnRenamed("_key", key)
    if seen.get["added"]:
        new = with_dense_keys(merged.filter("_key IS NULL").drop("_key"), [natural], key, (seen.get["highest"] or 0) + 1)
        whole = whole.unionByName(new)
    columns = [f.name for f in store.schema(table)]
    with store.commit():
        store.overwrite(whole, table)
        log = whole.filter("_operacao IS NOT NULL").select(
            F.lit(table).alias("ds_tabela"),
            F.col("_operacao").alias("ds_operacao"),
            F.current_user().alias("ds_usuario"),
            F.current_timestamp().alias("dt_operacao"),
            F.col("_antes").alias("ds_dados_antes"),
            row_json(*columns).alias("ds_dados_depois"),
        )
        store.append_numbered(log, "log_auditoria", "id_log")


def extend_calendar(store: Store, days: DataFrame, day: str = "dt_data", holidays: DataFrame | None = None) -> None:
    """Add the days that lie outside the stored calendar, up to the year ends around the rows'."""
    reach_calendar(store, *days.agg(F.min(day), F.max(day)).first(), holidays)


def reach_calendar(store: Store, low: date | None, high: date | None, holidays: DataFrame | None = None) -> None:
    """Add whole years to the calendar until it holds both days; how far it reaches is a mark of the store."""
    if low is None:
        return
    marks = store.snapshot().marks
    if "dim_data.primeiro" not in marks:
        first, last = store.read("dim_data").agg(F.min("dt_data"), F.max("dt_data")).first()
    else:
        first, last = (date.fromisoformat(f"{marks[f'dim_data.{c}']}") for c in ("primeiro", "ultimo"))
    if first is None:
        missing = [(date(low.year, 1, 1), date(high.year, 12, 31))]
    else:
        missing = [(date(low.year, 1, 1), first - timedelta(days=1))] if low < first else []
        missing += [(last + timedelta(days=1), date(high.year, 12, 31))] if high > last else []
    with store.commit():
        for a, b in missing:
            store.append(build_calendar(store.spark, a, b, holidays), "dim_data")
            first, last = min(first or a, a), max(last or b, b)
        if missing:
            mark_calendar(store, first, last)


def mark_calendar(store: Store, first: date, last: date) -> None:
    store.set_mark("dim_data.primeiro", int(f"{first:%Y%m%d}"))
    store.set_mark("dim_data.ultimo", int(f"{last:%Y%m%d}"))


# ---- quotes ---------------------------------------------------------------------------------------


def sessions_by_year(quotes: DataFrame) -> DataFrame:
    """First and last session, last close and number of sessions of every share and year; folded map-side."""
    return quotes.groupBy("id_acao", "nr_ano").agg(
        F.min("id_data").alias("id_primeiro"),
        F.max("id_data").alias("id_ultimo"),
        F.max_by("vl_fechamento", "id_data").alias("vl_fechamento"),
        F.count("*").alias("nr_pregoes"),
    )


def merged_sessions(state: DataFrame, new: DataFrame) -> DataFrame:
    """The state with the sessions of new quotes: a row per share and year."""
    return state.unionByName(new).groupBy("id_acao", "nr_ano").agg(
        F.min("id_primeiro").alias("id_primeiro"),
        F.max("id_ultimo").alias("id_ultimo"),
        F.max_by("vl_fechamento", "id_ultimo").alias("vl_fechamento"),
        F.sum("nr_pregoes").alias("nr_pregoes"),
    )


def closes_before(state: DataFrame, series: DataFrame) -> DataFrame:
    """For each (share, year) the share's last close of an earlier year; NULL without one."""
    past = state.select("id_acao", F.col("nr_ano").alias("_year"), F.struct("id_ultimo", "vl_fechamento").alias("_last"))
    last = series.join(past, (past["id_acao"] == series["id_acao"]) & (past["_year"] < series["nr_ano"]), "left").groupBy(series["id_acao"], "nr_ano")
    last = last.agg(F.max("_last").alias("_last"))  # a share has a row a year at most
    return last.select("id_acao", "nr_ano", F.col("_last.id_ultimo").alias("id_data"), F.col("_last.vl_fechamento").alias("vl_fechamento"))


def load_quotes(store: Store, rows: DataFrame, holidays: DataFrame | None = None) -> date | None:
    """New (share, day) quotes into the fact, with amplitude and return, and into the state kept beside it; gives the last day delivered.

    The delivery is computed once. Quotes later than all of their share's are appended; the return on the first of them is
    measured on the close in the state, so no folder of the fact outside the delivery's own years is read. Quotes that fill earlier
    days also change the return of the session after them: then the shares concerned are computed again in the years concerned,
    which are replaced; other shares' rows of these years are copied and other years stay as they are. Fact, state and the
    changes that derived facts have to follow are one commit.
    """
    with store.commit():
        batch = arrived(store, lookup_key(rows, store.read("dim_acao"), "cd_ticker", "id_acao"), "id_acao", "cd_ticker", "KAGGLE_COTACAO")
        if batch.low is None:
            return None
        rows = batch.rows.withColumns({"id_data": date_key(F.col("dt_data")), "nr_ano": F.year("dt_data")})
        fact, state = store.read("fato_cotacao"), store.read("estado_cotacao")
        new = insert_if_absent(fact, rows, ["id_acao", "id_data"], [F.col("id_staging")], bounds=batch.bounds())
        new = new.withColumns({"dt_carga": F.current_timestamp(), "id_cotacao": day_key("id_acao")})
        load = ["id_carga"] if "id_carga" in new.columns else []
        new = new.select(
            "id_cotacao", "id_acao", "id_data", "nr_ano", "vl_abertura", "vl_fechamento", "vl_maximo", "vl_minimo", "vl_volume", "dt_carga", *load
        )
        new, count = checked(store, new, "fato_cotacao")
        if not count:
            return batch.high
        new = new.drop(*load)
        reach_calendar(store, batch.low, batch.high, holidays)
        ends = state.groupBy("id_acao").agg(F.max("id_ultimo").alias("_end"))
        series, seen = sessions_by_year(new).join(ends, "id_acao", "left"), Observation()
        series = stored(series.observe(seen, F.count_if(F.col("id_primeiro") < F.col("_end")).alias("late")), "sessions").drop("_end")
        overflow = Observation()
        if not seen.get["late"]:
            # All that the state knows of a share comes before its new sessions, those of the same year too.
            after, years, rows = merged_sessions(state, series), None, new
            seeds = closes_before(state.withColumn("nr_ano", F.col("nr_ano") - 1).unionByName(series), series.select("id_acao", "nr_ano"))
        else:
            # The years with new quotes, and the next one of a share whose year now ends otherwise: its first return changes.
            after = stored(merged_sessions(state, series), "state")
            moved = series.alias("n").join(state.alias("s"), ["id_acao", "nr_ano"], "left").filter("s.id_ultimo IS NULL OR n.id_ultimo > s.id_ultimo")
            following = after.withColumnRenamed("nr_ano", "_next").join(moved.select("id_acao", "nr_ano"), "id_acao").filter("_next > nr_ano")
            following = following.groupBy("id_acao", "nr_ano").agg(F.min("_next").alias("_next")).select("id_acao", F.col("_next").alias("nr_ano"))
            touched = stored(series.select("id_acao", "nr_ano").unionByName(following).distinct(), "touched")
            years = [r[0] for r in touched.select("nr_ano").distinct().collect()]  # as many as the calendar has
            held = fact.filter(F.col("nr_ano").isin(years))
            rows = held.unionByName(new, allowMissingColumns=True)
            seeds = closes_before(after, touched)
            largest = after.filter(F.col("nr_ano").isin(years)).groupBy("nr_ano").agg(F.sum("nr_pregoes").alias("n")).agg(F.max("n"))
            count = largest.first()[0]  # one number
        rows = _with_returns(rows, seeds, overflow, 1 + count // ROWS_A_FILE)
        if years is None:
            store.append(rows, "fato_cotacao", gathered=True)
        else:
            store.replace_partitions(rows, "fato_cotacao", gathered=True)
        if overflow.get["lost"]:
            again = new if years is None else held.join(touched, ["id_acao", "nr_ano"], "left_semi").select(new.columns).unionByName(new)
            log_out_of_range(store, again, seeds)
        store.overwrite(after, "estado_cotacao", ["id_acao", "nr_ano"])
        note_changes(store, series.groupBy("id_acao").agg(F.min("id_primeiro").alias("id_de")), [ADJUSTED, INDICATORS], "cotacao")
    return batch.high


def log_out_of_range(store: Store, quotes: DataFrame, seeds: DataFrame) -> None:
    """Put returns that do not fit their column on record; the fact holds NULL for them."""
    both = quotes.unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    both = both.withColumn("_serie", F.col("id_acao").cast("bigint") * 10_000 + F.col("nr_ano"))
    lost = returns_out_of_range(both, key="_serie").filter("_seed IS NULL").select(
        F.lit("LOAD").alias("ds_etapa"),
        F.lit("KAGGLE_COTACAO").alias("ds_fonte"),
        F.lit("with_daily_return").alias("ds_procedure"),
        F.lit("return out of range").alias("ds_erro"),
        F.to_json(F.struct("id_acao", "id_data", F.col("_retorno").alias("retorno"))).alias("ds_dados"),
    )
    log_errors(store, lost)


def _with_returns(quotes: DataFrame, seeds: DataFrame, overflow: Observation, parts: int) -> DataFrame:
    """Amplitude and return of the (share, year) series that have a row in `seeds`, the first session of each measured against
    that; other rows stay as they are. `overflow` counts returns that do not fit.

    One shuffle by year and part of the shares serves the window and the write: the rows come out by year, share and day, and a
    year in as many files as parts.
    """
    both = quotes.unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    for c in ("vl_retorno_diario", "vl_amplitude"):
        if c not in both.columns:
            both = both.withColumn(c, F.lit(None))
    both = both.withColumn("_part", F.pmod(F.hash("id_acao"), F.lit(parts))).repartition("nr_ano", "_part")
    over = W.partitionBy("nr_ano", "_part", "id_acao").orderBy("id_data")  # a seed lies in an earlier year or has no day: it comes first
    both = both.withColumns({"_due": F.first("_seed").over(over), "_change": change_on_previous("vl_fechamento", over)})
    rows = both.filter("_seed IS NULL").withColumn("_fits", F.col("_change").try_cast("decimal(10,6)"))
    rows = rows.observe(overflow, F.count_if(F.col("_due") & F.col("_change").isNotNull() & F.col("_fits").isNull()).alias("lost"))
    amplitude = (F.col("vl_maximo") - F.col("vl_minimo")).cast("decimal(18,4)")
    values = {"vl_retorno_diario": F.when(F.col("_due"), F.col("_fits")).otherwise(F.col("vl_retorno_diario")),
              "vl_amplitude": F.when(F.col("_due"), amplitude).otherwise(F.col("vl_amplitude"))}
    return rows.withColumns(values).drop("_seed", "_part", "_due", "_change", "_fits")


# ---- series, statements and events ----------------------------------------------------------------


def load_series(store: Store, rows: DataFrame, indicator: str, holidays: DataFrame | None = None) -> date | None:
    """New (indicator, day) values; monthly series are repeated for every day of their month. Gives the last day delivered.

    A new day of the policy rate has the indicators of all shares derived again from its month on.
    """
    with store.commit():
        rows = lookup_key(rows, store.read("dim_indicador_macro"), "cd_indicador", "id_indicador")
        batch = arrived(store, rows, "id_indicador", "cd_indicador", f"BCB_{indicator}")
        if batch.low is None:
            return None
        rows, low, high = batch.rows, batch.low, batch.high
        if indicator in MONTHLY_SERIES:
            first = keep_first(rows.withColumn("_month", F.trunc("dt_data", "month")), ["_month"], [F.col("id_staging")])
            rows = expand_monthly(first.drop("_month"), "dt_data")
            low, high = low.replace(day=1), (high.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
        rows = rows.withColumns({"id_data": date_key(F.col("dt_data")), "nr_ano": F.year("dt_data")})
        held = store.read("fato_indicador_macro")
        new = insert_if_absent(held, rows, ["id_indicador", "id_data"], [F.col("id_staging")], bounds=batch.bounds())
        new, count = checked(store, new.withColumns({"dt_carga": F.current_timestamp(), "id_fato": day_key("id_indicador")}), "fato_indicador_macro")
        if count:
            reach_calendar(store, low, high, holidays)
            store.append(new, "fato_indicador_macro", ["id_indicador", "id_data"])
            if indicator == RATE:
                first = new.agg(F.min("id_data").alias("id_de"))
                note_changes(store, first.select(F.lit(None).cast("int").alias("id_acao"), "id_de"), [INDICATORS], "taxa")
    return batch.high


def load_statements(store: Store, rows: DataFrame, family: str = "DFP", whole: bool = False) -> date | None:
    """Filed accounts into the history of versions, and the touched statements, pivoted, into the fact; gives the last date delivered.

    `hist_dem_versao` keeps every version of every account with the day it was delivered; a version that is there already changes
    nothing. The fact holds each account's highest version, whatever the order of delivery: an older version that
    comes late stays in the history. Only the years of touched statements are replaced. With `whole`, values filed in
    thousands (`ds_escala` MIL) are turned into whole currency.
    """
    key = ["id_empresa", "id_data", "ds_tipo_dem"]
    with store.commit():
        batch = arrived(store, lookup_key(rows, store.read("dim_empresa"), "cd_cvm", "id_empresa"), "id_empresa", "cd_cvm", f"CVM_{family}")
        rows = batch.rows
        scale = F.col("ds_escala") if "ds_escala" in rows.columns else F.lit(None).cast("string")
        rows = rows.select(
            "id_empresa",
            date_key(F.col("dt_data")).alias("id_data"),
            F.year("dt_data").alias("nr_ano"),
            statement_period(F.lit(family)).alias("ds_tipo_dem"),
            F.col("ds_tipo_dem").alias("ds_quadro"),
            "cd_conta",
            F.coalesce("nr_versao", F.lit(1)).alias("nr_versao"),
            whole_currency(F.col("vl_conta"), scale, whole).cast("decimal(20,2)").alias("vl_conta"),
            F.to_date("dt_carga").alias("dt_entrega"),
            F.current_timestamp().alias("dt_carga"),
            "id_staging",
        )
        history = store.read("hist_dem_versao")
        new = insert_if_absent(history, rows, [*key, "ds_quadro", "cd_conta", "nr_versao"], [F.col("id_staging")], bounds=batch.bounds())
        new, count = checked(store, new.drop("id_staging"), "hist_dem_versao")
        if not count:
            return batch.high
        touched = stored(new.select(*key, "nr_ano").distinct(), "statements")
        years = [r[0] for r in touched.select("nr_ano").distinct().collect()]  # as many as the calendar has
        store.append(new, "hist_dem_versao", ["id_empresa", "id_data"])
        reach_calendar(store, batch.low, batch.high)
        known = store.read("hist_dem_versao").filter(F.col("nr_ano").isin(years)).join(touched, [*key, "nr_ano"], "left_semi")
        wide = statement_measures(known_versions(known), [*key, "nr_ano"])
        number = F.when(F.col("ds_tipo_dem") == "ANUAL", 1).otherwise(2)
        wide = wide.withColumns({"dt_carga": F.current_timestamp(), "id_fato": day_key("id_empresa", kind=number)})
        rest = store.read("fato_dem_financeira").filter(F.col("nr_ano").isin(years)).join(touched, key, "left_anti")
        store.replace_partitions(rest.unionByName(wide, allowMissingColumns=True), "fato_dem_financeira")
        first = touched.filter("ds_tipo_dem = 'ANUAL'").groupBy("id_empresa").agg(F.min("id_data").alias("id_de"))
        shares = store.read("dim_acao").select("id_acao", "id_empresa")
        note_changes(store, first.join(shares, "id_empresa").select("id_acao", "id_de"), [INDICATORS], "demonstracao")
    return batch.high


def statements_on_hand(store: Store, family: str) -> DataFrame:
    """All accounts of a family that staging holds as passed, typed."""
    staged = store.read("stg_dem_financeira").filter((F.col("fl_processado") == PASSED) & F.col("ds_fonte").startswith(f"CVM_{family}_"))
    return apply_typing(staged.drop("ds_erro", "fl_processado"), TYPINGS["stg_dem_financeira"]).drop("ds_erro", "ds_dados", "fl_processado")


def load_events(store: Store, rows: DataFrame, table: str, columns: list[str]) -> None:
    """Dividends or splits by share. An event changes the share's adjusted prices up to the session after it."""
    with store.commit():
        batch = arrived(store, lookup_key(rows, store.read("dim_acao"), "cd_ticker", "id_acao"), "id_acao", "cd_ticker", table)
        rows = batch.rows.withColumn("id_data", date_key(F.col("dt_data")))
        keys = ["id_acao", "id_data", *columns]
        new = keep_first(rows, keys, [F.col("id_staging")])
        if table in store.snapshot().tables:
            same = F.lit(True)
            for c in keys:
                same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}"))
            new = new.alias("n").join(store.read(table).select(*keys).alias("h"), same, "left_anti")
        new, count = checked(store, new.withColumn("dt_carga", F.current_timestamp()), table)
        if not count:
            return
        reach_calendar(store, batch.low, batch.high)
        notes = new.groupBy("id_acao").agg(F.min("id_data").alias("id_de"))
        if table == "hist_dividendos":
            store.append_numbered(new, table, "id_dividendo")
            note_changes(store, notes, [INDICATORS], "provento")
        else:
            store.append(with_block_keys(new, "id_desdobramento", store.reserve(f"{table}.id_desdobramento", count)), table)
        note_changes(store, notes.select("id_acao", F.lit(0).alias("id_de")), [ADJUSTED], "evento")


def run_all(
    store: Store,
    paths: dict[str, str],
    tickers: DataFrame,
    plan: list[tuple[str, CsvSource]] | None = None,
    sectors: DataFrame | None = None,
    first: str = "2000-01-01",
    last: str = "2024-12-31",
    window: int = 252,
    incremental: bool = False,
    listing: DataFrame | None = None,
    holidays: DataFrame | None = None,
    skip_repeated: bool = False,
) -> DataFrame:
    """Extract, transform and load everything delivered; returns the extract report.

    Each run moves the marks ULTIMA_CARGA_*. With `incremental` only quotes and values later than their mark are
    loaded from files that hold the whole history; corrections of earlier days then wait for a full run.
    Dimensions load before facts, facts before the derived tables, which follow what has changed. Statements of all
    kinds load together. Small folders of the log tables are merged at the end.
    """
    create_tables(store, first, last, holidays)
    report = full_extract(store, paths, plan, skip_repeated)
    loaded = {r["fonte"] for r in report.collect() if r["status"] in ("SUCESSO", "PARCIAL")}

    def take(table: str, source: str) -> DataFrame | None:
        return settle_staging(store, table, source) if source in loaded else None

    def later(rows: DataFrame, mark: str) -> DataFrame:
        return after_mark(rows, "dt_data", read_mark(store, mark)) if incremental else rows

    registry = take("stg_cadastro_empresa", "CVM_CADASTRO")
    if registry is not None:
        load_companies(store, registry, sectors, listing)
    load_shares(store, tickers)
    quotes = take("stg_cotacao", "KAGGLE_COTACAO")
    if quotes is not None:
        move_mark(store, "ULTIMA_CARGA_COTACAO", load_quotes(store, later(quotes, "ULTIMA_CARGA_COTACAO"), holidays))
    series = {s: take("stg_indicadores_macro", s) for s in sorted(s for s in loaded if s.startswith("BCB_"))}
    ends = [load_series(store, later(rows, "ULTIMA_CARGA_MACRO"), source.removeprefix("BCB_"), holidays) for source, rows in series.items()]
    move_mark(store, "ULTIMA_CARGA_MACRO", max((d for d in ends if d), default=None))
    filed = sorted(s for s in loaded if s.startswith("CVM_"))
    for family in ("DFP", "ITR"):
        arrived = [take("stg_dem_financeira", s) for s in filed if s.startswith(f"CVM_{family}_")]
        if arrived:
            accounts = reduce(DataFrame.unionByName, arrived)
            move_mark(store, "ULTIMA_CARGA_DFP", load_statements(store, accounts, family))
    dividends = take("stg_dividendos", "DIVIDENDOS")
    if dividends is not None:
        load_events(store, dividends, "hist_dividendos", ["vl_dividendo", "ds_tipo", "dt_ex", "dt_pagamento"])
    splits = take("stg_desdobramento", "DESDOBRAMENTOS")
    if splits is not None:
        load_events(store, splits, "hist_desdobramento", ["ds_tipo", "vl_fator", "ds_descricao"])
    derive_adjusted(store)
    derive_indicators(store, window)
    store.compact(*LOGS)
    return report
