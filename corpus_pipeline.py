"""The corpus pipeline: documents -> clean, distinct, redacted, mixed, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of ``documents``:

1. toxicity: documents above the cut of their language go;
2. near duplicates: one document of each linked group stays;
3. secrets: spans that look live are replaced by a placeholder, examples stay;
4. mixing: each document appears as often as its source's target asks;
5. packing: pieces of token ids in sequences of at most 1024.

Null texts count as empty and pass every stage; repeated rows are one group in
stage 2; of a group the row of the smallest id stays, of equal ids that of the
smallest text hash, of rows equal in both any one; texts of any length go through
whole; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import jaccard, mixing, packing, secrets, toxicity
from strata.llm.common import stored, table
from strata.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.report(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
