"""The training corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import word_count
from corpusloom.llm.op01_quality import keep_good
from corpusloom.llm.op03_mix import copies_of
from corpusloom.llm.op04_jaccard import keep_one
from corpusloom.llm.op08_pii import redact_documents
from corpusloom.llm.op09_bpe import default_tokenizer, encode_documents, read_tokenizer
from corpusloom.runtime import checkpoint, scratch_folder, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Copies are broadcast up to this many documents (16 bytes each), and joined by shuffle beyond.
BROADCAST_COPIES = 200_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; rejected ones go.

    Null and blank texts have no words and go; a null language or source is a group of its own; repeated
    rows are judged each and stay or go together; an empty table stays empty; further columns are left out.
    """
    return keep_good(docs.select(*COLUMNS))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the least id.

    Rows without an id stay, and so do null and blank texts, which are like no other; of rows that share an
    id one stays; an empty table stays empty; further columns are left out.
    """
    return keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and secrets replaced by their kinds, and ``n_chars`` of the new text.

    Null texts stay null, with their ``n_chars``; repeated rows stay equal; an empty table stays empty;
    further columns are left out.
    """
    return redact_documents(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or several times.

    Rows are stored with a key and their size first, so that repeated rows and rows without an id are
    documents of their own, each with its own copies.  Texts without words have size 0 and the copies of
    their source's rate; an empty table stays empty; further columns are left out.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_key"), word_count(F.col("text")).alias("_size")))
    sizes = rows.select("_key", "doc_id", "source", F.col("_size").alias("size"))
    copies = checkpoint(copies_of(sizes, ["_key"]).filter("copies > 0").select("_key", "copies"))
    taken = F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies
    joined = rows.join(taken, "_key")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each row's text, with their number and the digests of ids and decoded text.

    A null text is an empty one; each row has its own; an empty table stays empty; other columns are left out.
    """
    return encode_documents(docs, read_tokenizer(default_tokenizer()), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("personal_data", privacy_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: Minimum covariance determinants, belief propagation and byte pair merges are beyond SQL; the stages are
#: tested one by one against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is Parquet in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
