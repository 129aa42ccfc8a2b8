"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quotewell.llm import bytepairs, chat, fingerprints, language, merkle, ngram_join, packing, personal, quality, secret_scan, similarity, warc, whitening
from quotewell.llm.oracles import ORACLES
from quotewell.llm.memory import settle
from quotewell.llm.shipping import ship
from quotewell.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
__all__ = ["ORACLES", "QUERIES"]

# The conversation that the chat query adds: its texts are full of what a template might take for its own.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.extracted(table(spark, sf_dir, "documents")))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(~language.held_out()))
    rows = language.predicted(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    settle(spark)
    return ngram_join.groups(docs, k=4, num=85, den=100)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], given.schema)
    return chat.read_back(*chat.prefix_tree(given.unionByName(added)))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), shared_dir(spark, "ledger")
    secret_scan.scan(docs, ledger)
    return secret_scan.digest(secret_scan.found_in(docs, ledger))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), shared_dir(spark, "archives")
    warc.write_archives(warc.with_roles(pages), folder)
    ends = warc.read_chunks(spark, folder, with_data=False).filter("last")
    kind = pages.schema["page_id"].dataType
    page = lambda c: F.expr(f"try_cast({c} AS {kind.simpleString()})")
    return ends.select(
        page("page").alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", page("refers").alias("refers_to")
    )


@query
def op9_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_duplicates(table(spark, sf_dir, "documents"), k=2, num=80, den=100)


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
