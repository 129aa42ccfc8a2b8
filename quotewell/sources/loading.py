"""Load control: what was read, when, with what result, and what to do about the rest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import date, datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from quotewell.operators.joins import keep_first
from quotewell.schemas import TABLES, struct
from quotewell.session import stored
from quotewell.sources.csv_files import FULL_LOAD, CsvSource, bad_lines, placed, read_text_columns, staging_columns
from quotewell.sources.store import Store, literal_row

RUNNING, DONE, FAILED, PARTIAL = "EXECUTANDO", "SUCESSO", "ERRO", "PARCIAL"  # fixed values
REPEATED = "REPETIDO"
REPORT = struct(
    "id_carga bigint, fonte string, registros_lidos bigint, registros_carregados bigint, registros_erro bigint, status string"
)
_FAILURE = struct("id_carga bigint, ds_etapa string, ds_fonte string, ds_procedure string, ds_erro string")
_MARK = struct("cd_parametro string, vl_parametro string, dt_atualizacao timestamp")


def as_batch(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Staging rows as a new batch: row ids, load time, state pending.

    Rows that carry `_place` (see `csv_files.placed`) are numbered in file order, others in no given order.
    """
    number = F.col("_place") if "_place" in rows.columns else F.monotonically_increasing_id()
    return rows.select(
        number.alias("id_staging"),
        *[c for c in rows.columns if c != "_place"],
        (F.current_timestamp() if now is None else now).alias("dt_carga"),
        F.lit(0).alias("fl_processado"),
        F.lit(None).cast("string").alias("ds_erro"),
    )


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def log_errors(store: Store, errors: DataFrame, **constants: object) -> None:
    """Append failing rows or job failures, numbered after the highest number given so far.

    Tasks number their rows in ranges of their own; the highest number comes from the write itself.
    """
    for name, value in constants.items():
        errors = errors.withColumn(name, F.lit(value))
    if "dt_erro" not in errors.columns:
        errors = errors.withColumn("dt_erro", F.current_timestamp())
    store.append_numbered(errors, "etl_log_erros", "id_erro")


def load_source(store: Store, source: CsvSource, path: str, skip_repeated: bool = False) -> DataFrame:
    """Land one file or folder in staging. Returns the report row; a failure is recorded and raised."""
    return literal_row(store.spark, REPORT, list(_land(store, source, path, skip_repeated)))


def _land(store: Store, source: CsvSource, path: str, skip_repeated: bool) -> tuple:
    """The load itself; gives the values of the report row.

    Every file's SHA-256 goes to the ledger `etl_arquivos`, and of a single file or, of several, of the set of them to the
    control table. With `skip_repeated` files that an earlier load of the source has recorded are left out, each by itself;
    a delivery of nothing else is REPETIDO. Lines are parsed once: counts come from the write itself. Only when bad lines
    were seen does a second pass move their text to the error log. Control row, ledger and errors are one commit.
    """
    spark = store.spark
    started = _utc_now()
    load_id = store.reserve("etl_controle_carga.id_carga", 1)

    def close(status: str, read: int | None, loaded: int | None, bad: int | None, message: str | None, digest: str | None = None) -> None:
        row = (load_id, source.name, path, source.table, started, _utc_now(), read, loaded, bad, status, message, digest)
        store.append(literal_row(spark, TABLES["etl_controle_carga"], list(row)).coalesce(1), "etl_controle_carga")

    try:
        if not store.is_there(path):
            raise FileNotFoundError(f"no such file: {path}")
        sums = Observation()
        files = file_checksums(spark, path)
        files = stored(files.observe(sums, F.count("*").alias("linhas"), F.min("ds_checksum").alias("um"), *_limbs(F.col("ds_checksum"))), "files")
        number = sums.get["linhas"]
        # A single file's own hash; of several a digest that does not depend on their order.
        digest = sums.get["um"] if number == 1 else hashlib.sha256(":".join(str(sums.get[c] or 0) for c in ("linhas", *_LIMBS)).encode()).hexdigest()
        new = stored(unknown_files(store, files, source), "new-files") if skip_repeated else files
        left_out = skip_repeated and new.count() < number
        with store.commit():
            if left_out and new.isEmpty():
                close(REPEATED, 0, 0, 0, None, digest)
                return load_id, source.name, 0, 0, 0, REPEATED
            lines = read_text_columns(spark, path, source)
            if left_out:
                lines = lines if "_metadata" in lines.columns else lines.select("*", "_metadata")
                lines = lines.join(new.select(F.col("ds_uri").alias("_uri")), F.col("_metadata.file_path") == F.col("_uri"), "left_semi")
            seen, kept = Observation(), Observation()
            counted = placed(lines, files, number).observe(seen, F.count("*").alias("read"), F.count("_bad_line").alias("bad"))
            rows = staging_columns(counted, source).observe(kept, F.count("*").alias("loaded"))
            store.replace_pending(as_batch(rows), source.table, source.name, load_id)
            read, bad, loaded = seen.get["read"], seen.get["bad"], kept.get["loaded"]
            if bad:
                log_errors(
                    store,
                    bad_lines(lines),
                    id_carga=load_id,
                    ds_etapa="EXTRACT",
                    ds_fonte=source.name,
                    ds_procedure="load_source",
                    ds_erro="malformed line",
                )
            ledger = new.withColumns({"id_carga": F.lit(load_id), "ds_fonte": F.lit(source.name), "dt_carga": F.current_timestamp()})
            store.append(ledger.coalesce(1), "etl_arquivos")
            status = PARTIAL if bad else DONE
            close(status, read, loaded, bad, None, digest)
    except Exception as problem:
        message = str(problem).splitlines()[0]
        with store.commit():
            close(FAILED, None, None, None, message)
            failure = literal_row(spark, _FAILURE, [load_id, "EXTRACT", source.name, "load_source", message])
            log_errors(store, failure)
        raise
    return load_id, source.name, read, loaded, bad, status


def full_extract(
    store: Store, paths: dict[str, str], plan: list[tuple[str, CsvSource]] | None = None, skip_repeated: bool = False
) -> DataFrame:
    """All loads in order. A failing stage is recorded and reported, the others still run.

    `paths` gives the file or folder of each stage. With `skip_repeated` files that a load of the same source has
    recorded are not loaded again. The log tables are merged at the end.
    Returns (etapa, fonte, registros_carregados, status).
    """
    report = []
    for stage, source in plan or FULL_LOAD:
        try:
            _, _, _, loaded, _, status = _land(store, source, paths[stage], skip_repeated)
            report.append((stage, source.name, loaded, status))
        except Exception as problem:
            text = f"Falha na etapa: {stage}"
            message = str(problem).splitlines()[0]
            failure = literal_row(store.spark, _FAILURE, [None, "EXTRACT", "ORQUESTRADOR", "full_extract", message])
            log_errors(store, failure.withColumn("ds_dados", F.lit(text)))
            report.append((stage, source.name, 0, FAILED))
    store.compact("etl_controle_carga", "etl_log_erros", "etl_arquivos")
    return store.spark.createDataFrame(report, "etapa string, fonte string, registros_carregados bigint, status string")


# ---- repeated files -------------------------------------------------------------------------------


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(ds_arquivo, ds_uri, nr_bytes, ds_checksum) with the SHA-256 of every file, whatever its size: Spark lists the files, a
    task streams each through the hash. `ds_uri` is the name that rows read from the file carry.

    The one place of this part that runs Python in tasks: no built-in function hashes a file without holding it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([_sha256(n) for n in names], pa.string())], schema=pa.schema([*batch.schema, ("ds_checksum", pa.string())]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select(F.col("path").alias("ds_arquivo"), F.col("_metadata.file_path").alias("ds_uri"), F.col("length").alias("nr_bytes"))
    return files.mapInArrow(run, "ds_arquivo string, ds_uri string, nr_bytes bigint, ds_checksum string")


def _sha256(uri: str) -> str:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    fs, place = pafs.FileSystem.from_uri(quote(uri, safe="/:@%") if "%" not in uri else uri)
    digest = hashlib.sha256()
    with fs.open_input_stream(place, compression=None) as stream:
        while part := stream.read(1 << 20):
            digest.update(part)
    return digest.hexdigest()


def unknown_files(store: Store, files: DataFrame, source: CsvSource) -> DataFrame:
    """The files whose content no load of the source has recorded; of equal files in a delivery the first by name."""
    held = store.read("etl_arquivos").filter(F.col("ds_fonte") == source.name).select("ds_checksum").distinct()
    return keep_first(files, ["ds_checksum"], [F.col("ds_arquivo")]).join(held, "ds_checksum", "left_anti")


_LIMBS = [f"_sum{i}" for i in range(4)]


def _limbs(value: Column) -> list[Column]:
    """All 256 bits of each value's hash summed, in four numbers of 64 bits."""
    parts = [F.conv(F.substring(F.sha2(value, 256), i, 16), 16, 10).cast("decimal(20,0)") for i in (1, 17, 33, 49)]
    return [F.sum(p).alias(name) for p, name in zip(parts, _LIMBS)]


def _digest(lines: DataFrame, *by: str) -> DataFrame:
    """Line count and a digest of the count and the summed line hashes, folded map-side.

    Two deliveries with the same lines in another order are the same.
    """
    sums = lines.groupBy(*by).agg(F.count("*").alias("linhas"), *_limbs(F.col("value")))
    text = F.concat_ws(":", F.col("linhas"), *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in _LIMBS])
    return sums.select(*by, "linhas", F.sha2(text, 256).alias("ds_checksum"))


def delivery_digests(spark: SparkSession, path: str) -> DataFrame:
    """A digest per delivered folder, for files of any size."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return _digest(lines.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("ds_arquivo"), "value"), "ds_arquivo")


def unseen_files(checksums: DataFrame, control: DataFrame) -> DataFrame:
    """Files whose checksum no load that ended has recorded."""
    known = control.filter(F.col("ds_status").isin(DONE, PARTIAL)).filter("ds_checksum IS NOT NULL").select("ds_checksum").distinct()
    return checksums.join(known, "ds_checksum", "left_anti")


# ---- incremental loading --------------------------------------------------------------------------


def after_mark(df: DataFrame, day: str, mark: date | str) -> DataFrame:
    """Only rows later than the high-water mark; 1900-01-01 takes the whole history."""
    return df.filter(F.col(day) > F.lit(str(mark)).cast("date"))


def read_mark(store: Store, parameter: str) -> str:
    row = latest_parameters(store).filter(F.col("cd_parametro") == parameter).first()
    return row["vl_parametro"] if row else "1900-01-01"


def advance_mark(store: Store, parameter: str, loaded: DataFrame, day: str) -> str | None:
    """Move the mark forward to the latest business date loaded."""
    return move_mark(store, parameter, loaded.agg(F.max(day)).first()[0])


def move_mark(store: Store, parameter: str, newest: date | None) -> str | None:
    """Move the mark forward to a day. One row a parameter stays; a mark never moves back."""
    if newest is None:
        return None
    rows = latest_parameters(store)
    held = {r["cd_parametro"]: r["vl_parametro"] for r in rows.select("cd_parametro", "vl_parametro").collect()}  # the settings: a few rows
    mark, now = max(str(newest), held.get(parameter) or ""), _utc_now()
    here = F.col("cd_parametro") == parameter
    if parameter not in held:
        rows = rows.unionByName(literal_row(store.spark, _MARK, [parameter, mark, now]), allowMissingColumns=True)
    moved = rows.withColumns({"vl_parametro": F.when(here, mark).otherwise(F.col("vl_parametro")), "dt_atualizacao": F.when(here, F.lit(now)).otherwise(F.col("dt_atualizacao"))})
    store.swap(moved.coalesce(1), "parametros_sistema")
    return mark


def latest_parameters(store: Store) -> DataFrame:
    return keep_first(store.read("parametros_sistema"), ["cd_parametro"], [F.desc("dt_atualizacao"), F.desc("vl_parametro")])


# ---- retention and reprocessing -------------------------------------------------------------------


def expired_batches(staging: DataFrame, keep: int, batch: str = "id_carga", state: str = "fl_processado") -> DataFrame:
    """Batches of processed rows older than the latest `keep`. Works on one row per batch."""
    batches = staging.filter(F.col(state) == 1).select(batch).distinct()
    return batches.join(batches.orderBy(F.desc(batch)).limit(keep), batch, "left_anti")


def retained(staging: DataFrame, keep: int, batch: str = "id_carga", state: str = "fl_processado") -> DataFrame:
    """Staging without processed rows of expired batches; pending and failed rows always stay."""
    expired = expired_batches(staging, keep, batch, state).withColumn(state, F.lit(1))
    return staging.join(expired, [batch, state], "left_anti")


def drop_expired(store: Store, table: str, source: str, keep: int) -> int:
    """Remove the folders of a source's processed loads older than the latest `keep`; returns how many."""
    staging = store.read(table).filter(F.col("ds_fonte") == source)
    loads = [r[0] for r in expired_batches(staging, keep).collect()]  # one value per load
    for load_id in loads:
        store.drop_folder(table, {"ds_fonte": source, "fl_processado": 1, "id_carga": load_id})
    return len(loads)


def failed_rows(log: DataFrame, columns: list[str], load_id: int | None = None) -> DataFrame:
    """Staging rows rebuilt from the JSON kept in the error log, optionally of one load."""
    rows = log.filter("ds_dados IS NOT NULL")
    if load_id is not None:
        rows = rows.filter(F.col("id_carga") == load_id)
    schema = ", ".join(f"{c} string" for c in columns)
    return rows.select(F.from_json("ds_dados", schema).alias("r")).filter("r IS NOT NULL").select("r.*")


# ---- monitoring views -----------------------------------------------------------------------------


def load_summary(control: DataFrame) -> DataFrame:
    """Loads with their duration in seconds; NULL while running. Order by dt_inicio_carga when showing it."""
    return control.select(
        "ds_fonte",
        "ds_tabela_destino",
        "ds_status",
        "nr_registros_carga",
        "nr_registros_erro",
        "dt_inicio_carga",
        "dt_fim_carga",
        F.timestamp_diff("SECOND", "dt_inicio_carga", "dt_fim_carga").alias("duracao_segundos"),
    )


def errors_with_file(log: DataFrame, control: DataFrame) -> DataFrame:
    """Error rows with the file of their load; errors without a load stay."""
    files = control.select("id_carga", "ds_arquivo")
    return log.join(files, "id_carga", "left").select(
        "id_erro", "ds_etapa", "ds_fonte", "ds_procedure", "ds_erro", "dt_erro", "ds_arquivo"
    )


def recent_errors(log: DataFrame, control: DataFrame, n: int = 100) -> DataFrame:
    """The latest n errors. The limit comes before the join, which keeps one row per error."""
    latest = log.orderBy(F.desc("dt_erro"), F.desc("id_erro")).limit(n)
    return errors_with_file(latest, control)
