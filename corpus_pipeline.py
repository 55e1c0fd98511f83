"""The corpus pipeline: documents through the stages in order, each stage's result written
as Parquet and read again as the next one's input.

toxicity           rows that the model rejects go
exact dedup        of equal texts (A-Z lower-cased) the row with the largest id stays
MinHash near-dedup of documents similar to 0.8 or more (5-word shingles) one stays
mixing             all rows, in the order that gives each source its target weight, with their
                   position in it (files and their splits don't keep an order)
byte-level BPE     doc_id, number of tokens, digests of the ids and of what they decode to, position

Nulls, empty and long texts, repeated rows and empty tables: as each operator defines them.
All stages but the last return the columns of documents, mixing the position too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise.llm import bpe, exact_dedup, minhash_dedup, mixing, toxicity
from slotwise.llm.common import cut, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, position_col="position")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.token_digests(docs, place_col="position")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokenise),
]

#: The stages hold a trained model, components and a tokenizer, which SQL cannot state; they
#: are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
