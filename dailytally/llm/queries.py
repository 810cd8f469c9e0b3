"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dailytally.llm import (
    convrepair, crosstoken, decontaminate, langid, minhash, packing, quality, repeats, secrets, sharding, topk, urlfilter, warc,
)
from dailytally.llm.common import table


#: Words of a shingle in the near-duplicate query.
SHINGLE = 4
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.filter_urls(pages, urlfilter.tagged_urls(pages))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE).drop("node", "tk", "component")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.tree(40))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tk")


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return convrepair.repair_digests(conversations, convrepair.damaged(conversations))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.align_digests(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_secrets": op2_secrets,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_sharding": op9_sharding,
    "op10_decontaminate": op10_decontaminate,
    "op11_top_k": op11_top_k,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}
