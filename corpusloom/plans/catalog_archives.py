"""Tables packed into archives by Spark and read back through the sources, each query beside its SQL over the table.

An archive holds ARCHIVE_ROWS documents by id, so that archives grow in number and not in size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.catalog import query
from corpusloom.runtime import scratch_folder, table
from corpusloom.schema import as_samples
from corpusloom.sinks import shards
from corpusloom.sinks.packing import pack
from corpusloom.sources import archives, files, web
from corpusloom.streaming import runner

ARCHIVE_ROWS = 500
#: Bytes of archives of a batch of the streamed query.
BATCH_BYTES = 64 << 20
_BASE = "element_at(split(archive, '/'), -1)"


def _packed(docs: DataFrame, ending: str, name: Column, content: Column, order: list[Column]) -> str:
    """A folder of archives of ``docs``."""
    folder = scratch_folder(docs.sparkSession, "packed")
    number = F.floor(F.col("doc_id") / ARCHIVE_ROWS).cast("long")
    pack(docs, folder, F.concat(F.lit("docs-"), F.lpad(number.cast("string"), 8, "0"), F.lit(ending)), name, content, order)
    return folder


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(F.expr(_BASE).alias("archive"), "ord", "path", F.md5("content").alias("digest"), F.octet_length("content").cast("long").alias("n_bytes"))


def _members_sql(ending: str) -> str:
    return f"""SELECT printf('docs-%08d{ending}', doc_id // {ARCHIVE_ROWS}) AS archive, ord, path, md5(coalesce(text, '')) AS digest, strlen(coalesce(text, ''))::BIGINT AS n_bytes
    FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'skip/' ELSE 'keep/' END || doc_id || '.txt' AS path, row_number() OVER (PARTITION BY doc_id // {ARCHIVE_ROWS} ORDER BY doc_id) - 1 AS ord FROM documents)
    WHERE path LIKE 'keep/%'"""


def _members(ending: str) -> Callable[[SparkSession, str], DataFrame]:
    """Members below ``keep/`` are listed by name, their payloads read last; places count the others as well."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = F.concat(F.when(F.col("doc_id") % 3 == 0, "skip/").otherwise("keep/"), F.col("doc_id"), F.lit(".txt"))
        folder = _packed(table(spark, sf, "documents"), ending, path, F.col("text"), [F.col("doc_id")])
        listed = archives.list_members(spark, f"{folder}/*{ending}", lambda p: p.startswith("keep/"))
        return _digests(archives.with_payloads(listed))

    return run


for _kind in (".zip", ".tar", ".tar.gz", ".tar.zst"):
    query("members" + _kind.replace(".", "_"), _members_sql(_kind))(_members(_kind))


@query(
    "members_zip_in_zip",
    f"""SELECT printf('docs-%08d.zip', doc_id // {ARCHIVE_ROWS}) AS archive, (k::BIGINT << 32) + j AS ord, lang || '.zip/' || doc_id || '.txt' AS path, md5(coalesce(text, '')) AS digest,
    strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM (SELECT *, dense_rank() OVER (PARTITION BY doc_id // {ARCHIVE_ROWS} ORDER BY lang) - 1 AS k,
    row_number() OVER (PARTITION BY doc_id // {ARCHIVE_ROWS}, lang ORDER BY doc_id) - 1 AS j FROM documents)""",
)
def members_zip_in_zip(spark: SparkSession, sf: str) -> DataFrame:
    """A zip for each language inside each zip."""
    path = F.concat(F.col("lang"), F.lit(".zip/"), F.col("doc_id"), F.lit(".txt"))
    folder = _packed(table(spark, sf, "documents"), ".zip", path, F.col("text"), [F.col("lang"), F.col("doc_id")])
    return _digests(archives.with_payloads(archives.list_members(spark, f"{folder}/*.zip", nested=True)))


@query(
    "json_lines_in_archives",
    "SELECT doc_id, lang, n_chars::BIGINT AS n_chars, doc_id % 2 AS line_no FROM documents WHERE doc_id % 5 > 0",
)
def json_lines_in_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Members of JSON lines in zips inside zips; every fifth line is cut short and goes."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    docs = docs.withColumn("line", F.to_json(F.struct("doc_id", "lang", "n_chars"))).withColumn("line", F.when(F.col("doc_id") % 5 == 0, F.expr("left(line, length(line) - 3)")).otherwise(F.col("line")))
    both = docs.groupBy(F.floor(F.col("doc_id") / 2).alias("pair")).agg(F.min("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("doc_id", "line"))).alias("lines"))
    path = F.concat(F.lit("lines.zip/"), F.col("pair"), F.lit(".jsonl"))
    folder = _packed(both, ".zip", path, F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), [F.col("doc_id")])
    rows = web.json_lines(archives.read_members(spark, f"{folder}/*.zip", lambda p: p.endswith(".jsonl"), nested=True))
    value = lambda name, kind: F.variant_get("doc", f"$.{name}", kind)
    return rows.select(value("doc_id", "bigint").alias("doc_id"), value("lang", "string").alias("lang"), value("n_chars", "bigint").alias("n_chars"), F.col("line_no").cast("long").alias("line_no"))


@query(
    "web_records",
    "SELECT printf('%012d', doc_id) AS key, md5(coalesce(text, '')) AS image, lang AS caption FROM documents",
)
def web_records(spark: SparkSession, sf: str) -> DataFrame:
    """Tars of records, a jpg (here the bytes of the text) and a json each, grouped by key and read by their places."""
    docs = table(spark, sf, "documents")
    parts = F.array(F.struct(F.lit("jpg").alias("e"), F.col("text").alias("c")), F.struct(F.lit("json").alias("e"), F.to_json(F.struct(F.col("lang").alias("caption"))).alias("c")))
    members = docs.select("doc_id", F.explode(parts).alias("m"))
    path = F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("."), F.col("m.e"))
    folder = _packed(members, ".tar", path, F.col("m.c"), [F.col("doc_id")])
    rows = files.read_web_records(spark, f"{folder}/*.tar")
    return rows.select("key", F.md5("jpg").alias("image"), F.get_json_object("json", "$.caption").alias("caption"))


@query("streamed_archives", _members_sql(".zip"))
def streamed_archives(spark: SparkSession, sf: str) -> DataFrame:
    """The members of zips as a stream, in batches by bytes of archives."""
    path = F.concat(F.when(F.col("doc_id") % 3 == 0, "skip/").otherwise("keep/"), F.col("doc_id"), F.lit(".txt"))
    folder = _packed(table(spark, sf, "documents"), ".zip", path, F.col("text"), [F.col("doc_id")])
    run = runner.run_folder(spark)
    stream = runner.archive_stream(spark, f"{folder}/*.zip", f"{run}/log", BATCH_BYTES, prefix="keep/")
    runner.drain_by_steps(_digests(stream), runner.overwrite_by_batch(f"{run}/out"), f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/out").drop("batch")


#: Bytes of an Arrow shard and samples of a tar shard in the queries of written shards.
SHARD_BYTES, SHARD_SAMPLES = 64 << 20, 400


def _image_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as samples of one image (the bytes of the text) with a caption, a dataset for each source."""
    docs = table(spark, sf, "documents").withColumn("sample_id", F.col("doc_id"))
    image = F.struct(F.coalesce("text", F.lit("")).cast("binary").alias("bytes"), F.lit("jpeg").alias("format"), F.lit(1).alias("width"), F.lit(1).alias("height"))
    samples = as_samples(docs.withColumn("image", image), "", "image_text", text=F.col("lang"), images=F.array("image"), data=F.create_map(F.lit("source"), F.col("source")))
    return samples.withColumn("dataset_id", F.concat(F.lit("d_"), F.col("data")["source"]))


@query(
    "arrow_shards_written",
    "SELECT 'd_' || source AS dataset_id, doc_id AS sample_id, md5(coalesce(text, '')) AS image, lang AS caption FROM documents",
)
def arrow_shards_written(spark: SparkSession, sf: str) -> DataFrame:
    """Samples through the Arrow sink and back through the reader of Arrow datasets."""
    folder = scratch_folder(spark, "arrow")
    shards.ArrowSink()(_image_samples(spark, sf), folder, target_shard_bytes=SHARD_BYTES, include_caption=True)
    rows = files.read_arrow_dataset(spark, folder, "dataset_id string, sample_id bigint, image struct<bytes:binary,path:string>, caption string")
    return rows.select("dataset_id", "sample_id", F.md5("image.bytes").alias("image"), "caption")


@query(
    "tar_shards_written",
    f"""WITH s AS (SELECT *, printf('d_%s__%08d', source, doc_id) AS key, row_number() OVER (ORDER BY 'd_' || source, doc_id) - 1 AS n FROM documents),
    m AS (SELECT n, 0 AS k, key || '.jpg' AS path, coalesce(text, '') AS body FROM s UNION ALL SELECT n, 1, key || '.txt', lang FROM s)
    SELECT printf('part-%06d.tar', n // {SHARD_SAMPLES}) AS archive, n % {SHARD_SAMPLES} * 2 + k AS ord, path, md5(body) AS digest, strlen(body)::BIGINT AS n_bytes FROM m""",
)
def tar_shards_written(spark: SparkSession, sf: str) -> DataFrame:
    """Samples through the tar sink, SHARD_SAMPLES a file over all datasets, and back by their places."""
    folder = scratch_folder(spark, "tars")
    shards.TarSink()(_image_samples(spark, sf), folder, maxcount=SHARD_SAMPLES)
    return _digests(archives.with_payloads(archives.list_members(spark, f"{folder}/*.tar")))
