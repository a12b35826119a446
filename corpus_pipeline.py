"""Corpus pipeline over ``documents``: toxicity, near-duplicates, repeated passages, mixing, byte-level BPE.

Every stage works on all rows that its predecessor kept; stages are written as Parquet into the shared scratch folder
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.byte_bpe import bpe_round_trip
from farelake.llm.common import fresh, quoted, ready, remainder, stored
from farelake.llm.mixing import mix
from farelake.llm.near_copies import near_copies
from farelake.llm.substring_dedup import remove_repeats
from farelake.llm.toxicity import learn_toxicity, score_toxicity


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier (6) scores below 0.5; it learns outside the held-out fold.

    NULL and empty texts have a score like any other and stay; repeated rows stay or go together; further columns stay as
    they are, whatever their names; an empty table stays empty.
    """
    ready(spark)
    labels = _labels(spark, sf_dir).where(remainder(F.col("doc_id"), 5) != 0)
    (score,) = fresh(docs.columns, "toxicity")
    scored = score_toxicity(docs, learn_toxicity(docs, labels), out=score)
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest by id, then by a hash of the text.

    Near copies share 0.8 or more of their five-word shingles (Jaccard), all such pairs link: those that SimHash (2) proposes, and
    by an exact search the ones whose fingerprints lie further apart. Different texts under one id
    are documents of their own; of repeated rows one stays, the same in every run. Rows without id cannot stand for a
    group and stay as they are. Texts without words, NULL ones among them, are copies of each other. Further columns stay as
    they are, whatever their names; an empty table stays empty.
    """
    ready(spark)
    names = docs.columns
    key, of_id, of_key, row = fresh(names, "key", "of_id", "of_key", "row")
    groups = near_copies(docs.select("doc_id", "text").where("doc_id IS NOT NULL"))
    first = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    # written before it is joined: Spark splits a hot key only between plain shuffles
    first = stored(first.select(F.col("first.doc_id").alias(of_id), F.col("first.text_key").alias(of_key)), "group_heads")
    rows = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    rows = rows.join(first, (F.col("doc_id") == F.col(of_id)) & (F.col(key) == F.col(of_key)))
    columns = [quoted(n) for n in names]
    kept = rows.groupBy(of_id, of_key).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row))
    return kept.select(f"{row}.*").unionByName(docs.where("doc_id IS NULL"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that an earlier document holds (3); ``n_chars`` follows the text.

    NULL, empty and short texts stay; rows of one id are not earlier than each other; rows without id come last. Further
    columns stay as they are, whatever their names; an empty table stays empty.
    """
    ready(spark)
    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows by their mixing rate (8): the share of low quality is halved, the total of tokens stays.

    Documents of high quality have a rate of 1 or more and stay; some come twice. NULL and empty texts hold no tokens but have a
    rate like any other; repeated rows have the same rate; further columns stay as they are, whatever their names; an empty
    table stays empty.
    """
    ready(spark)
    return mix(docs, _labels(spark, sf_dir), relative={0: 0.5})


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text (7) with digests of the ids and of the bytes decoded from them.

    One row per input row; NULL and empty texts have no ids; columns other than doc_id and text are left out; an empty table
    gives no rows.
    """
    import public_tokenizers

    ready(spark)
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The stages hold trained models and tokenizers, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    rows = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage_{name}")
    return rows
