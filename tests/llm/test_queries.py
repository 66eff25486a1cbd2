"""The registered queries of this package: SQL where there is some, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import queries
from corpusloom.runtime import table
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal_to_sql(spark, name):
    same(connect(SF), queries.queries()[name](spark, SF), queries.oracle_sql()[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "bpe":
            assert docs.columns == corpus_pipeline.COLUMNS
    start, good, distinct, private, mixed, encoded = counts
    assert start > good > distinct == private > 0 and mixed == encoded > 0
    masked = spark.read.parquet(str(tmp_path / "personal_data"))
    assert masked.filter(F.col("text").rlike(r"[a-z0-9.]+@[a-z0-9]+\.example")).count() == 0
    assert masked.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert docs.filter(F.length("ids") != 4 * F.col("n_tokens")).count() == 0


SPECIAL = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n ", None, None, None), (None, "a text without an id, of some words that are enough to pass the rules", "en", "a", 9),
    (4, "the same text twice, with a number 4111 1111 1111 1111 and a@b.example in it now", "en", "b", 9), (4, "the same text twice, with a number 4111 1111 1111 1111 and a@b.example in it now", "en", "b", 9),
    (5, "long " + " ".join(f"w{k}" for k in range(20_000)), "fr", "b", None), (6, "two words", "fr", "b", 9),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def special(spark):
    """Nulls, empty and long texts, repeated rows, and columns that bear the stages' own names."""
    names = ("grp", "node", "label", "size", "copies", "_key", "_size", "hash", "kept", "digest")
    return spark.createDataFrame(SPECIAL, DOCS).withColumns({c: F.lit("x") for c in names})


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_take_special_rows_and_empty_tables(spark, name, stage):
    docs = special(spark)
    out = stage(spark, docs, SF)
    rows = out.collect()
    assert stage(spark, docs.limit(0), SF).collect() == []
    if name != "bpe":
        assert out.columns == corpus_pipeline.COLUMNS
    ids = sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    if name == "quality":
        assert set(ids) <= {4, 5} and ids.count(4) in (0, 2)
    elif name == "near_duplicates":
        assert ids == [1, 2, 3, 4, 5, 6] and len(rows) == 7
    elif name == "personal_data":
        assert len(rows) == len(SPECIAL) and [r["text"] for r in rows if r["doc_id"] == 1] == [None]
    elif name == "bpe":
        assert len(rows) == len(SPECIAL) and [r["n_tokens"] for r in rows if r["doc_id"] == 1] == [0]


def test_mixing_stage_copies_equal_the_operator(spark):
    """As many rows of each document as op3 takes, repeated rows included."""
    from collections import Counter

    from corpusloom.llm.op03_mix import mix

    docs = special(spark).unionByName(special(spark).filter("doc_id = 4")).select(*corpus_pipeline.COLUMNS)
    docs = docs.unionByName(table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS))
    got = Counter(r["doc_id"] for r in corpus_pipeline.mixing_stage(spark, docs, SF).collect())
    want = Counter()
    for r in mix(docs).select("doc_id", "copies").collect():
        want[r["doc_id"]] += r["copies"]
    assert got == +want


def test_the_whole_pipeline_runs(spark, tmp_path):
    """All stages in a row over a table and over an empty one."""
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert len(rows) > 20 and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in table(spark, SF, "documents").select("doc_id").collect()}
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
