"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import sql
from corpusloom.llm.op01_quality import quality
from corpusloom.llm.op02_topk import top_inner_products
from corpusloom.llm.op03_mix import mix
from corpusloom.llm.op04_jaccard import jaccard_groups
from corpusloom.llm.op05_urls import filter_urls
from corpusloom.llm.op06_licenses import scan_licenses
from corpusloom.llm.op07_substrings import remove_repeats
from corpusloom.llm.op08_pii import find_personal_data
from corpusloom.llm.op09_bpe import default_tokenizer, encode_documents, read_tokenizer
from corpusloom.llm.op10_html import extract_pages
from corpusloom.llm.op11_shards import shard_rows
from corpusloom.llm.op12_whitening import whiten
from corpusloom.llm.op13_repair import repair
from corpusloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *counts, "base_failed", "kept")


def op2_topk_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_mix_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: its copies' id, its group's id and its number of links."""
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list blocks each host whose MD5 digest begins with 0 or 1, an eighth of all hosts."""
    return filter_urls(table(spark, sf_dir, "pages"), F.substring(F.md5(F.col("host").cast("binary")), 1, 1).isin("0", "1"))


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The tokenizer file defaults to the one that the public tokenizers package names."""
    return encode_documents(table(spark, sf_dir, "documents"), read_tokenizer(tokenizer or default_tokenizer()))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op11_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal weight, and where a ninth would take rows."""
    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark, table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark, table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_mcd": op1_quality_mcd,
        "op2_topk_norms": op2_topk_norms,
        "op3_mix_systematic": op3_mix_systematic,
        "op4_jaccard_forest": op4_jaccard_forest,
        "op5_url_cascade": op5_url_cascade,
        "op6_license_digests": op6_license_digests,
        "op7_substrings": op7_substrings,
        "op8_personal_data": op8_personal_data,
        "op9_bpe": op9_bpe,
        "op10_html_text": op10_html_text,
        "op11_rendezvous": op11_rendezvous,
        "op12_whitening": op12_whitening,
        "op13_repair": op13_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_topk_norms": sql.TOP_PRODUCTS,
        "op3_mix_systematic": sql.MIX,
        "op4_jaccard_forest": sql.JACCARD,
        "op5_url_cascade": sql.URLS,
        "op6_license_digests": sql.licenses(),
        "op7_substrings": sql.SUBSTRINGS,
        "op11_rendezvous": sql.shards(),
        "op13_repair": sql.repairs(),
    }
