"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .bpe import token_digests
from .common import table
from .near_dup import near_duplicates
from .order_minhash import fingerprints
from .packing import pack_documents
from .pii import pii_report
from .prefix_trie import prefix_trie
from .quality import judge_quality
from .quality_rules import apply_rules
from .token_blocks import token_round_trip
from .toxicity import judge_toxicity
from .url_filter import judge_urls
from .variants import variant_groups
from .warc import round_trip


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents"))
