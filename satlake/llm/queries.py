"""The queries of the training-data operators, over the tables of a folder, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from satlake.llm import ann, bpe, chat, linededup, mixing, ngramjoin, oracles, pii, quality, secrets, sharding
from satlake.llm.common import documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 8


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source", "lang"), keep=["doc_id"])
    return df.select("row.doc_id", "source", "lang", "topic", "n_tokens", "prob", "drawn", "gap")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("assign", "access", "hex")
    df = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("secrets")
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    own = F.filter(spans, lambda s: s["kind"].isin(*base))
    return df.select("doc_id", *[of(k) for k in base], F.sha2(secrets.digest(own), 256).alias("base_sha256"), secrets.digest(spans).alias("spans"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ngramjoin.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return df.select("row.doc_id", F.col("group").alias("class_id"), F.col("key").alias("class_key"), F.col("class").alias("text_id"), F.col("links").alias("n_links"), F.col("others").alias("n_linked_docs"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), SHARDS)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    done = chat.render(chat.fold(chat.log_of(table.unionByName(extra))))
    read = done.select("conv", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quality.judge(documents(spark, sf_dir).select("doc_id", "text", "lang"), bpe.read_ranks(PIECES))
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "token_bits", "band", "reason")
    return df.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in named])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(RANKS)
    both = bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["source"] == "base")
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return df.select("doc_id", *[of(k) for k in pii.KINDS], F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("pii")).alias("spans"))


def op9_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(table.select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = linededup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["first"].cast("string"), s["end"].cast("string"))), ",")
    return df.select("row.doc_id", "n_lines", "n_removed", spans.alias("removed"), F.length("kept_text").cast("long").alias("kept_chars"), F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_secret_scan": op2_secret_scan,
    "op3_ngram_join": op3_ngram_join,
    "op4_shards": op4_shards,
    "op5_chat": op5_chat,
    "op6_fertility": op6_fertility,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_mih": op9_mih,
    "op10_line_dedup": op10_line_dedup,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op2_secret_scan": oracles.secret_scan(),
    "op4_shards": oracles.shards(SHARDS),
    "op5_chat": oracles.chats(),
}
