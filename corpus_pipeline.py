"""A corpus pipeline in five stages, each over all that the one before it kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of documents; the last returns each document
with its token ids. run() applies them one after another.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlake.llm import bpe, linededup, mixing, ngramjoin, quality

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null texts are among them."""
    judged = quality.judge(docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), F.col("lang").alias("lang")), bpe.read_ranks(PIECES))
    return judged.where("quality.kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out and n_chars follows; a document of which no word is left goes, as all of it stands elsewhere."""
    cut = linededup.dedup(docs)
    whole = F.col("n_removed") == 0
    worded = F.coalesce(F.col("kept_text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    new = {"text": F.col("kept_text"), "n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.length("kept_text").cast("long"))}
    return cut.where(whole | worded).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id."""
    return ngramjoin.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by calibrated probabilities, towards flatter shares of source, language and topic."""
    return mixing.mix(docs).where("drawn").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and whether they decode to it."""
    ranks = bpe.read_ranks(RANKS)
    ids = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


#: Fertility needs a tokeniser, winnowing a window of hashes and BPE merges: SQL can't express them. Tests hold each stage against brute force.
ORACLE_SQL = None
