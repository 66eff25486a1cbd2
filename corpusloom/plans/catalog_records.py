"""Names, paths, lookups, limits, chunks and state applied to the driver tables, each beside its SQL."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schema
from corpusloom.functions import text, tiles
from corpusloom.operators import dedup, filters, folds, ordinals, verify
from corpusloom.plans.catalog import query
from corpusloom.runtime import scratch_folder, ship, table
from corpusloom.sinks import shards
from corpusloom.state.tables import HashStore, Manifest, Progress
from corpusloom.streaming import runner

#: A path for each document, as members of archives have them: every third one a PNG, in one of two folders.
_PATH = "CASE doc_id % 2 WHEN 0 THEN 'Training' ELSE 'Testing' END || '/' || source || '/' || lang || '_' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpg' ELSE '.txt' END"
_PATH_SPARK = _PATH.replace("doc_id ||", "cast(doc_id AS string) ||")


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "source", F.expr(_PATH_SPARK).alias("path"))


@query(
    "path_names",
    f"""SELECT doc_id, string_split(path, '/')[3] AS base, regexp_replace(string_split(path, '/')[3], '\\.[^.]*$', '') AS stem, string_split(path, '/')[2] AS part,
    len(string_split(path, '/'))::INTEGER AS depth FROM (SELECT doc_id, {_PATH} AS path FROM documents)""",
)
def path_names(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    return _paths(spark, sf).select("doc_id", text.basename(path).alias("base"), text.stem(path).alias("stem"), text.path_part(path, 1).alias("part"), text.path_depth(path).alias("depth"))


@query("extension_filter", f"SELECT doc_id, path FROM (SELECT doc_id, {_PATH} AS path FROM documents) WHERE lower(path) LIKE '%.png' OR lower(path) LIKE '%.jpg'")
def extension_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).filter(text.extension_in(F.col("path"), "png", "jpg")).select("doc_id", "path")


@query("path_shape", f"SELECT doc_id FROM (SELECT doc_id, source, {_PATH} AS path FROM documents) WHERE path LIKE 'Training/%' AND len(string_split(path, '/')) >= 3 AND source IN ('src1', 'src2', 'src5')")
def path_shape(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    fits = path.startswith("Training/") & (text.path_depth(path) >= 3) & text.path_part(path, 1).isin("src1", "src2", "src5")
    return _paths(spark, sf).filter(fits).select("doc_id")


@query("falsy_coalesce", "SELECT doc_id, CASE WHEN doc_id % 4 > 0 AND lang <> 'en' THEN lang WHEN doc_id % 5 > 0 THEN source ELSE '' END AS caption FROM documents")
def falsy_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """The first value that is neither null nor empty, the last one if there is none."""
    first = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    second = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("source"))
    return table(spark, sf, "documents").select("doc_id", text.truthy(first, second).alias("caption"))


@query("composite_keys", "SELECT doc_id, source || '_' || lang AS name, printf('%s__%08d', source || '_' || lang, doc_id) AS key FROM documents")
def composite_keys(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat_ws("_", "source", "lang")
    return table(spark, sf, "documents").select("doc_id", name.alias("name"), text.record_key(name, F.col("doc_id")).alias("key"))


@query(
    "snake_names",
    r"""SELECT p_partkey, name, 'org___' || lower(regexp_replace(regexp_replace(name, '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '([a-z\d])([A-Z])', '\1_\2', 'g')) AS folder
    FROM (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), '') || p_type || 'Text' || p_size || upper(p_brand[1:2]) AS name FROM part)""",
)
def snake_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names in camel case with runs of capitals and digits."""
    name = F.concat(F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), "p_type", F.lit("Text"), F.col("p_size").cast("string"), F.upper(F.substring("p_brand", 1, 2)))
    return table(spark, sf, "part").select("p_partkey", name.alias("name")).select("*", text.snake_cache_name(F.lit("org"), F.col("name")).alias("folder"))


@query(
    "uri_checks",
    """SELECT page_id, starts_with(u, 's3://') AND length(u) > 5 AS bucket, starts_with(u, '/') AS absolute
    FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN replace(replace(url, 'https://', 's3://'), 'http://', 's3://') WHEN 1 THEN '/' || url ELSE url END AS u FROM pages)""",
)
def uri_checks(spark: SparkSession, sf: str) -> DataFrame:
    bucket = F.replace(F.replace("url", F.lit("https://"), F.lit("s3://")), F.lit("http://"), F.lit("s3://"))
    uri = F.when(F.col("page_id") % 3 == 0, bucket).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/"), "url")).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", text.valid_bucket_uri(uri).alias("bucket"), text.valid_absolute_path(uri).alias("absolute"))


@query("json_guard", "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events WHERE event_id % 7 <> 0")
def json_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable lines go, the others are parsed once."""
    line = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), "props")).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", F.try_parse_json(line).alias("doc")).filter("doc IS NOT NULL")
    return rows.select("event_id", F.variant_get("doc", "$.k", "bigint").alias("k"))


@query("array_filter", "SELECT conv_id, list(text ORDER BY turn) FILTER (WHERE role = 'user') AS said FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'user') > 0")
def array_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of a nested row that are of one kind; rows without such a part go."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    said = F.transform(F.filter("t", lambda x: x["role"] == "user"), lambda x: x["text"])
    return rows.select("conv_id", said.alias("said")).filter("size(said) > 0")


@query(
    "filter_chain",
    """SELECT doc_id FROM documents WHERE (doc_id % 3 = 2 OR (n_chars BETWEEN 100 AND 5000)) AND (doc_id % 3 = 2 OR n_chars BETWEEN 10 AND 3000)""",
)
def filter_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Two filters of one kind in a row; samples that are no single image pass both."""
    kind = F.when(F.col("doc_id") % 3 == 0, "image").when(F.col("doc_id") % 3 == 1, "image_text").otherwise("text")
    image = F.array(F.struct(F.lit(None).cast("binary").alias("bytes"), F.lit("png").alias("format"), F.col("n_chars").cast("int").alias("width"), F.lit(1).alias("height")))
    rows = table(spark, sf, "documents").select("doc_id", kind.alias("sample_type"), image.alias("images"))
    chain = filters.match_all([filters.resolution(min_width=100, max_width=5000), filters.resolution(min_width=10, max_width=3000)])
    return rows.transform(chain).select("doc_id")


@query("serialized_samples", "SELECT doc_id AS sample_id, source AS dataset_id, text FROM documents")
def serialized_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples to their stored form and back."""
    rows = table(spark, sf, "documents").withColumnRenamed("doc_id", "sample_id")
    samples = schema.as_samples(rows.select("sample_id", "text", "source"), "", "text", text=F.col("text"), data=F.create_map(F.lit("source"), F.col("source")))
    back = schema.deserialize(schema.serialize(samples))
    return back.select("sample_id", F.col("data")["source"].alias("dataset_id"), "text")


@query(
    "lookup_by_basename",
    f"""WITH m AS (SELECT doc_id, string_split(path, '/')[3] AS name FROM (SELECT doc_id, {_PATH} AS path FROM documents)),
    l AS (SELECT lang || '_' || doc_id || '.jpg' AS name, quality FROM documents JOIN labels USING (doc_id))
    SELECT m.doc_id, l.quality FROM m JOIN l USING (name)""",
)
def lookup_by_basename(spark: SparkSession, sf: str) -> DataFrame:
    """Members of an archive met with a record table by their file names; members without a record go."""
    members = _paths(spark, sf).select("doc_id", text.basename(F.col("path")).alias("name"))
    keys = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("name"))
    records = keys.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").select("name", "quality")
    return members.join(records, "name").select("doc_id", "quality")


@query(
    "lookup_filtered",
    """WITH l AS (SELECT l_partkey, arg_max(l_quantity, l_orderkey * 10 + l_linenumber) AS last_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1)
    SELECT p_partkey, last_quantity FROM part JOIN l ON p_partkey = l_partkey""",
)
def lookup_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Only records of allowed sources make the lookup, and of several the last one in order counts."""
    records = table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    records = records.select("l_partkey", "l_quantity", F.struct("l_orderkey", "l_linenumber").alias("place"))
    lookup = dedup.last_wins(records, "l_partkey", "place", "l_quantity").withColumnRenamed("l_quantity", "last_quantity")
    return table(spark, sf, "part").join(lookup, F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", "last_quantity")


@query("equal_chunks", "SELECT chunk, count(*) AS n, min(doc_id) AS first FROM (SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // ceil((SELECT count(*) FROM documents) / 7.0)::BIGINT)::BIGINT AS chunk FROM documents) GROUP BY chunk")
def equal_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Seven contiguous chunks, the last one short."""
    rows = ordinals.dense_ids(table(spark, sf, "documents").select("doc_id", F.lit(0).alias("d")), ["d"], ["doc_id"])
    size = ordinals.chunk_size(rows.count(), 7)
    return rows.groupBy(ordinals.batch_of(F.col("sample_id"), size).alias("chunk")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query(
    "split_ranges",
    """WITH n AS (SELECT count(*) AS n FROM documents), c AS (SELECT n, ceil(n / 9.0)::BIGINT AS size FROM n)
    SELECT k::BIGINT AS piece, least(k * size, n) AS first, least((k + 1) * size, n) AS stop FROM c, range(9) r(k)""",
)
def split_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The ranges of nine workers over a dataset, clamped at its end."""
    total = table(spark, sf, "documents").count()
    return spark.createDataFrame([(k, *ordinals.chunk_range(total, 9, k)) for k in range(9)], "piece long, first long, stop long")


@query(
    "capped_chunks",
    """WITH RECURSIVE d AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    t AS (SELECT source, sum(n_chars) AS whole FROM d GROUP BY 1),
    f AS (SELECT source, rn, n_chars, 0 AS chunk, n_chars AS held FROM d WHERE rn = 1
      UNION ALL SELECT d.source, d.rn, d.n_chars, CASE WHEN f.held + d.n_chars > 20000 AND f.held > 0 THEN f.chunk + 1 ELSE f.chunk END,
        CASE WHEN f.held + d.n_chars > 20000 AND f.held > 0 THEN d.n_chars ELSE f.held + d.n_chars END
      FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1)
    SELECT f.source, CASE WHEN whole < 20000 THEN 0 ELSE chunk END::BIGINT AS chunk, count(*) AS samples, sum(n_chars)::BIGINT AS bytes FROM f JOIN t USING (source) GROUP BY 1, 2""",
)
def capped_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of a batch (here a source) in chunks under a cap of bytes, filled in order."""
    rows = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    chunks = folds.capped_chunks(rows, ["source"], "doc_id", "n_chars", 20_000)
    return chunks.groupBy("source", "chunk").agg(F.count("*").alias("samples"), F.sum("n_chars").alias("bytes"))


@query(
    "loader_state",
    """SELECT source AS dataset_id, 'data-' || lpad(shard::VARCHAR, 5, '0') || '.arrow' AS filename, n AS shards
    FROM (SELECT source, ceil(count(*) / 10.0)::BIGINT AS n FROM documents GROUP BY 1), LATERAL (SELECT unnest(range(n)) AS shard)""",
)
def loader_state(spark: SparkSession, sf: str) -> DataFrame:
    """The shard files that the loader metadata of each dataset names, in order."""
    counts = table(spark, sf, "documents").groupBy("source").agg(F.ceil(F.count("*") / 10).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for source, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                named = [f"data-{k:05d}.arrow" for k in reversed(range(n))]
                state = json.loads(json.dumps(shards.loader_metadata(named, {"total_bytes": 0, "total_samples": 0}, False)["state.json"]))
                rows += [(source, f["filename"], n) for f in state["_data_files"]]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["dataset_id", "filename", "shards"])

    ship(spark)
    return counts.mapInArrow(run, "dataset_id string, filename string, shards long")


@query("sample_formats", "SELECT doc_id, CASE WHEN lang = 'en' THEN 'jpg' WHEN lang = 'fr' THEN 'png' ELSE lang END AS ext FROM documents")
def sample_formats(spark: SparkSession, sf: str) -> DataFrame:
    """The extension under which a tar holds an image of a format."""
    ship(spark)
    extension = F.udf(shards.file_extension)
    form = F.when(F.col("lang") == "en", "JPEG").when(F.col("lang") == "fr", "").otherwise(F.upper("lang"))
    formats = table(spark, sf, "documents").select(form.alias("form")).distinct().select("form", extension("form").alias("ext"))
    return table(spark, sf, "documents").select("doc_id", form.alias("form")).join(F.broadcast(formats), "form").select("doc_id", "ext")


@query(
    "cache_summary",
    """SELECT dataset, status, count(*) AS n FROM (SELECT 'org/' || lang AS dataset, CASE WHEN doc_id % 11 = 0 THEN 'skipped' WHEN doc_id % 13 = 0 THEN 'error'
      WHEN doc_id % 7 = 0 THEN 'invalid' ELSE 'valid' END AS status FROM documents) GROUP BY 1, 2""",
)
def cache_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The blobs of each cached dataset by what their check says."""
    digest = F.sha2("text", 256)
    name = F.when(F.col("doc_id") % 11 == 0, F.lit("README.md")).when((F.col("doc_id") % 7 == 0) & (F.col("doc_id") % 13 != 0), F.sha2(F.concat("text", F.lit("x")), 256)).otherwise(digest)
    found = F.when((F.col("doc_id") % 13 == 0) & (F.col("doc_id") % 11 != 0), F.lit(None).cast("string")).otherwise(digest)
    dataset = text.dataset_name(text.cache_name(F.concat(F.lit("org/"), "lang")))
    rows = table(spark, sf, "documents").select(dataset.alias("dataset"), verify.blob_status(name, found).alias("status"))
    return rows.groupBy("dataset", "status").agg(F.count("*").alias("n"))


@query("blobs_per_dataset", "SELECT 'org/' || source AS dataset, count(*) AS n FROM documents GROUP BY 1")
def blobs_per_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return verify.blobs_by_dataset(table(spark, sf, "documents").select(F.concat(F.lit("org/"), "source").alias("dataset")))


@query("manifest_state", "SELECT source AS dataset_id, count(*) AS n FROM documents WHERE n_chars >= 64 GROUP BY 1")
def manifest_state(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest written in two runs that overlap."""
    manifest = Manifest(spark, f"{scratch_folder(spark, 'state')}/manifest")
    rows = table(spark, sf, "documents").filter("n_chars >= 64").select(F.col("source").alias("dataset_id"), F.col("doc_id").alias("sample_id"))
    manifest.add(rows.filter("sample_id % 3 < 2"))
    manifest.add(rows)
    return manifest.counts()


@query("progress_state", "SELECT event_type AS dataset_id, max(event_id) AS last_sample_id, max(event_id) % 2 = 0 AS completed FROM events GROUP BY 1")
def progress_state(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the events of each type, the first over half of them; the newest entry of each counts."""
    progress = Progress(spark, f"{scratch_folder(spark, 'state')}/progress")
    events = table(spark, sf, "events").withColumnRenamed("event_type", "dataset_id")
    for rows in (events.filter("event_id % 2 = 1"), events):
        last = rows.groupBy("dataset_id").agg(F.max("event_id").alias("last_sample_id"))
        progress.record(last.withColumn("completed", F.col("last_sample_id") % 2 == 0))
    return progress.current().select("dataset_id", "last_sample_id", "completed")


@query("hash_store", "SELECT md5(text) AS img_hash, min(doc_id) AS sample_id FROM documents GROUP BY 1")
def hash_store(spark: SparkSession, sf: str) -> DataFrame:
    """Owners of hashes, added again without effect."""
    store = HashStore(spark, f"{scratch_folder(spark, 'state')}/hashes")
    rows = table(spark, sf, "documents").select(F.md5("text").alias("img_hash"), F.col("source").alias("dataset_id"), F.col("doc_id").alias("sample_id"))
    first = dedup.first_wins(rows, F.col("img_hash"), "sample_id")
    store.add(first)
    store.add(first)
    return store.read().select("img_hash", "sample_id")


@query("streamed_filter", "SELECT doc_id, n_chars FROM documents WHERE n_chars >= 64")
def streamed_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a stream, committed batch by batch after the sink, equal those of the table."""
    folder = runner.run_folder(spark)
    rows = runner.file_stream(spark, f"{sf.rstrip('/')}/documents.parquet").filter("n_chars >= 64").select("doc_id", "n_chars")
    runner.drain(rows, runner.overwrite_by_batch(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("doc_id", "n_chars")


@query("concat_arrays", "SELECT conv_id, list_concat(list(role ORDER BY turn), list(role ORDER BY turn DESC)) AS roles FROM conversations GROUP BY conv_id")
def concat_arrays(spark: SparkSession, sf: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(turns, lambda x: x["role"]).alias("r"))
    return rows.select("conv_id", F.concat("r", F.reverse("r")).alias("roles"))


@query("tile_files", "SELECT c_custkey, printf('%d_%d_%d.png', 8, c_custkey % 256, c_custkey % 199) AS name FROM customer")
def tile_files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", tiles.tile_file(F.lit(8), F.col("c_custkey") % 256, F.col("c_custkey") % 199).alias("name"))
