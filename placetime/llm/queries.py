"""Registered queries of the operators, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetime.llm import digest, infill, lm, mixing, pieces, pii, quality, shards, simhash, toxicity, variants, warc, wrappers
from placetime.plans.registry import Query, table

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree where there is one."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn
    return register


@query()
def op1_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_pii_votes(spark: SparkSession, folder: str) -> DataFrame:
    return pii.detected(table(spark, folder, "documents"))


@query(quality.SQL)
def op3_quality_limits(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


@query()
def op4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encoded(table(spark, folder, "documents").select("doc_id", "text"), check="lossless", keep_text=False)
    return coded.select("doc_id", "ids", F.size("ids").alias("n_ids"), "lossless")


@query()
def op5_factor_machine(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


@query()
def op7_feature_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.fingerprints(table(spark, folder, "documents"))


@query()
def op8_wrapper_text(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(f"WITH {mixing.sql('documents')} SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, unnest(range(k)) FROM copied)")
def op9_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


@query()
def op10_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query(infill.SQL)
def op11_wavelet_infill(spark: SparkSession, folder: str) -> DataFrame:
    found = infill.transformed(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored("output", "form"), 256).alias("restored_sha256"),
    )


@query(variants.SQL)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op13_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    found = shards.placed(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
