"""From raw documents to packed training sequences, one operator a stage.

Every stage works on all rows its predecessor kept and returns rows with the columns of ``documents``,
which are written as Parquet and read again for the next; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.exact_dedup import drop_copies
from panelkit.llm.langid import UNDETERMINED, identify
from panelkit.llm.mixing import mixed_rows
from panelkit.llm.ngram_join import keep_one_per_component
from panelkit.llm.packing import pack_sequences
from panelkit.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null texts and texts without a letter go."""
    names = ("__held_out", "__lang_pred", "__score")
    return identify(docs, names=names).filter(F.col(names[1]) != UNDETERMINED).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that differ at most in the case of A-Z the smallest doc_id stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 80 % of their 5-word shingles the smallest doc_id stays."""
    return keep_one_per_component(docs, size=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in weights 3, 1, 2; a document taken twice is two rows, the one at a source's cut ends there."""
    return mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 token ids."""
    return pack_sequences(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: Suffix automata, hash order and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
