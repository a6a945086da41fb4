"""From raw documents to packed sequences: five stages, each on all that the one before has kept.

1. Quality rules: documents that fail policy ``v1`` go.
2. Near duplicates: SimHash fingerprints of three-word shingles link at two bits; of each component the document with the smallest id stays.
3. Benchmark leaks: documents with a copied or edited test item go.
4. Secrets: owner-specific values are cut out of the texts; ``n_chars`` follows.
5. Packing: the last stage returns one row per piece with its place in a sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.leaks import find_leaks
from ledgerwatch.llm.packing import packed_documents
from ledgerwatch.llm.quality import keep_good
from ledgerwatch.llm.secrets import redact
from ledgerwatch.llm.simhash import keep_one_of_each, row_key
from ledgerwatch.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy ``v1`` fails; null and empty texts fail, ids play no part, repeats stay."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; rows are told apart by id and text, so texts that share an id or have none are judged each."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item; decided by id and text, so neither shared nor null ids matter. Null and empty texts stay."""
    keyed = docs.withColumn("_row_key", row_key())
    leaks = find_leaks(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row_key")
    return keyed.join(leaks.select("_row_key").distinct(), "_row_key", "left_anti").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets cut out of their texts; null texts stay null, ids play no part."""
    clean = redact(docs, repository=F.concat_ws("/", "source", "lang"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places; a null text is an empty one, repeats and null ids are packed each."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("packing", packing),
]

#: Fingerprints, alignment and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on the table ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
