"""One query per operator over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.llm.blocks import top_k
from chronofeat.llm.bpe import encode_texts
from chronofeat.llm.chat import format_chats, read_back
from chronofeat.llm.digest_index import DigestIndex
from chronofeat.llm.html import extract_text
from chronofeat.llm.lines import line_components
from chronofeat.llm.packing import pack_documents
from chronofeat.llm.resample import resample
from chronofeat.llm.rules import judge, learn
from chronofeat.llm.secrets import BASE_RULES, find_secrets, spans_text
from chronofeat.llm.shards import shard_by_bytes
from chronofeat.llm.simhash import near_duplicates
from chronofeat.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    decoded = encode_texts(docs, path, pattern, with_decoded=True)
    numbers = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    roles = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")),
                              F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), roles.alias("t"))
    added = added.select("conv_id", "t.turn", "t.role", F.lit(text).alias("text"))
    return read_back(format_chats(chats.unionByName(added)))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_by_bytes(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_components(table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in BASE_RULES]
    kinds = F.transform("spans", lambda s: s["kind"])

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(spans_text(of_base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = DigestIndex(spark)
    judged = index.verdicts(docs)
    index.close()
    return judged


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    rows = white.select("vec_id", "n", "deviation", "identity_error", each)
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "c.whitened",
        "c.explained",
        "identity_error",
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_chat_format": op4_chat_format,
    "op5_sharding": op5_sharding,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_whitening": op12_whitening,
    "op13_importance_resampling": op13_importance_resampling,
}
