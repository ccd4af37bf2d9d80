"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.anchors import remove_repeats
from panelkit.llm.collocations import collocations
from panelkit.llm.common import documents
from panelkit.llm.divergence import source_divergence
from panelkit.llm.exact_dedup import exact_dedup
from panelkit.llm.langid import identify
from panelkit.llm.lm_score import score_texts, score_words
from panelkit.llm.mixing import mix_sources
from panelkit.llm.ngram_join import ngram_components
from panelkit.llm.oracles import ORACLES  # noqa: F401
from panelkit.llm.packing import pack_sequences
from panelkit.llm.secret_scan import scan_secrets, span_text
from panelkit.llm.templates import main_text
from panelkit.llm.tool_calls import TURN_SCHEMAS, exchanges, link_calls
from panelkit.llm.vector_graph import near_duplicate_vectors
from panelkit.sources.io import load_table


def op1_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings (cosine 0.95 and more)."""
    return near_duplicate_vectors(load_table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents cut into sequences of at most 1024 ids of the public 50k byte-level tokenizer."""
    import public_tokenizers
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return pack_sequences(documents(spark, sf_dir), tokenizer=path)


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as tool calls (user and system turns) linked to results (assistant turns)."""
    calls, results = exchanges(load_table(spark, sf_dir, "conversations"))
    return link_calls(calls, results, TURN_SCHEMAS)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole document."""
    return identify(documents(spark, sf_dir).select("doc_id", "text", "lang")).select(
        "doc_id", "held_out", "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text (the largest doc_id)."""
    return exact_dedup(documents(spark, sf_dir), keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 3, 1, 2 to 150 % of all words, at most two epochs each."""
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; generic tokens held by few sources are added."""
    out = scan_secrets(documents(spark, sf_dir))
    spans = F.array_sort(F.concat("base", "added"))

    def n(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", n("assign"), n("access"), n("hex"),
                      F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                      span_text(spans).alias("spans"), "n_live", "n_example")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all documents."""
    return score_texts(documents(spark, sf_dir)).select(
        "doc_id", "n_units", F.round("log_score", 3).alias("log_score"), F.round("mean_score", 6).alias("mean_score"))


def op7_lm_score_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document by its word pairs under the counts of all documents."""
    return score_words(documents(spark, sf_dir)).select(
        "doc_id", "n_units", F.round("log_score", 3).alias("log_score"), F.round("mean_score", 6).alias("mean_score"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 50-word runs that an earlier document holds too, removed from every document."""
    return remove_repeats(documents(spark, sf_dir)).drop("kept")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language from each other, and each source's own terms to rank 200."""
    return source_divergence(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of 2 to 5 words of each language."""
    return collocations(documents(spark, sf_dir))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(load_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_vector_graph": op1_vector_graph,
    "op2_packing": op2_packing,
    "op3_tool_calls": op3_tool_calls,
    "op4_language_id": op4_language_id,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_mixing": op6_mixing,
    "op7_lm_score": op7_lm_score,
    "op7_lm_score_words": op7_lm_score_words,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_secrets": op9_secrets,
    "op10_ngram_join": op10_ngram_join,
    "op11_divergence": op11_divergence,
    "op12_collocations": op12_collocations,
    "op13_html_text": op13_html_text,
}
