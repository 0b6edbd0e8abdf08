"""Clean and tokenise a corpus: stages applied in turn to ``documents``, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``; the last adds the
tokens. A model that a stage needs is trained on that stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.byte_bpe import decode, encode
from gridloom.llm.common import stage_table, table
from gridloom.llm.decontamination import remove_contaminated
from gridloom.llm.near_duplicates import drop_near_duplicates
from gridloom.llm.pii import redact_personal_data
from gridloom.llm.queries import tokenizer
from gridloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of their shingles or more) stays, that of the smallest doc_id."""
    return drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to their kinds; all documents stay."""
    return redact_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids beside each document, and the text as decoded from them."""
    codec = tokenizer()
    coded = decode(encode(docs, codec), codec)
    return coded.withColumn("n_tokens", F.size("ids").cast("bigint")).withColumn("decoded", F.col("decoded").cast("string"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Trained stages cannot be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
