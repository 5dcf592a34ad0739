"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's documents. All but the last keep the columns of documents. Their
decisions take effect: rejected documents and copies go, personal data is replaced in the
texts, and a document stands in the output as often as its source's rate says.

SQL cannot express the fingerprints and the classifier of personal data, so there is no check
SQL; the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetime.llm import mixing, pieces, pii, quality, simhash
from placetime.session import fresh_path

ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source."""
    return quality.passing(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redacted(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rate of their source, shuffled globally."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text and their number, for every document."""
    coded = pieces.encoded(docs.select("doc_id", "lang", "source", "text"), keep_text=False)
    return coded.withColumn("n_ids", F.size("ids"))


STAGES = [
    ("quality rules", good_documents),
    ("SimHash near-dedup", one_of_each_group),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
