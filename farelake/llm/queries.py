"""Registered queries of this subpackage over the given tables, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its own name; settings of the session come first."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(ready(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under a public rank file, decoded again."""
    import public_tokenizers

    from .byte_bpe import bpe_round_trip

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document under thresholds of its language and source."""
    from .quality_rules import adaptive_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return adaptive_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels outside the held-out fold."""
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows outside the held-out fold."""
    from .language_codes import identify_languages

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    from .warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document keeps once repeats of earlier documents are removed."""
    from .substring_dedup import substring_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM and unigram scores of every document, learned from rows outside the held-out fold."""
    from .ppm import ppm_scores

    return ppm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best other vectors of every hundredth vector."""
    from .topk_search import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document once the share of low quality is halved at the same total of tokens."""
    from .mixing import mixing_rates

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing_rates(docs, table(spark, sf_dir, "labels"), relative={0: 0.5}).select("doc_id", "tokens", "rate", "copies")


@query
def op11_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to Huffman-coded files in the order of the ids and read back."""
    import public_tokenizers

    from .token_files import token_file_round_trip

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_file_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every vector."""
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with the label of every seventh vector moved on by one."""
    from .hard_negatives import hard_negatives

    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))
