"""The operators applied to the driver tables, each beside its SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import imghash, text, tiles
from corpusloom.operators import dedup, filters, folds, ordinals
from corpusloom.plans.catalog import query
from corpusloom.runtime import ship, table


@query("size_range_filter", "SELECT doc_id, source, n_chars FROM documents WHERE n_chars >= 64 AND n_chars <= 8192")
def size_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(filters.within(F.col("n_chars"), 64, 8192)).select("doc_id", "source", "n_chars")


@query(
    "downsample_dims",
    """WITH s AS (SELECT p_partkey, (p_size * 97)::BIGINT AS w, (p_size * 61)::BIGINT AS h FROM part)
    SELECT p_partkey,
      CASE WHEN w * h > 4194304 THEN floor(w * sqrt(4194304.0::DOUBLE / (w * h)))::BIGINT ELSE w END AS width,
      CASE WHEN w * h > 4194304 THEN floor(h * sqrt(4194304.0::DOUBLE / (w * h)))::BIGINT ELSE h END AS height FROM s""",
)
def downsample_dims(spark: SparkSession, sf: str) -> DataFrame:
    sized = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 97).cast("long").alias("w"), (F.col("p_size") * 61).cast("long").alias("h"))
    width, height = filters.scaled(F.col("w"), F.col("h"), 4_194_304)
    return sized.select("p_partkey", width.alias("width"), height.alias("height"))


@query(
    "type_gate",
    """SELECT sample_type, count(*) AS n FROM (
      SELECT CASE WHEN doc_id % 3 = 0 THEN 'image' WHEN doc_id % 3 = 1 THEN 'image_text' ELSE 'text' END AS sample_type FROM documents
      UNION ALL SELECT 'multi_image_text' FROM conversations) WHERE sample_type IN ('image', 'image_text') GROUP BY 1""",
)
def type_gate(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 3 == 0, "image").when(F.col("doc_id") % 3 == 1, "image_text").otherwise("text")
    rows = table(spark, sf, "documents").select(kind.alias("sample_type"))
    rows = rows.unionByName(table(spark, sf, "conversations").select(F.lit("multi_image_text").alias("sample_type")))
    return rows.filter(filters.is_single_image()).groupBy("sample_type").agg(F.count("*").alias("n"))


@query(
    "dedup_first_wins",
    """SELECT doc_id, source, md5(text) AS h FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("h"))
    return dedup.first_wins(rows, F.col("h"), "doc_id")


@query(
    "dedup_incremental",
    """WITH d AS (SELECT doc_id, doc_id % 2 AS part, md5(text) AS h FROM documents),
    s AS (SELECT h, min(doc_id) AS owner FROM d WHERE part = 0 GROUP BY h)
    SELECT d.doc_id, d.h FROM d LEFT JOIN s USING (h) WHERE s.owner IS NULL OR s.owner = d.doc_id""",
)
def dedup_incremental(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    store = rows.filter("doc_id % 2 = 0").groupBy("h").agg(F.min("doc_id").alias("doc_id"))
    return dedup.against_store(rows, store, "h", ["doc_id"]).select("doc_id", "h")


@query("dedup_streaming", "SELECT md5(text) AS h, count(*) AS passed FROM (SELECT DISTINCT text FROM documents) GROUP BY 1")
def dedup_streaming(spark: SparkSession, sf: str) -> DataFrame:
    """What a streaming dedup over the files of ``documents`` lets through, its state in the checkpoint folder."""
    from corpusloom.streaming.runner import distinct_stream

    return distinct_stream(spark, f"{sf.rstrip('/')}/documents.parquet", F.md5("text")).groupBy("h").agg(F.count("*").alias("passed"))


@query(
    "avg_hash_bits",
    """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x::DOUBLE > list_avg(list_transform(embedding, lambda y: y::DOUBLE)) THEN '1' ELSE '0' END), '') AS bits
    FROM embeddings""",
)
def avg_hash_bits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", imghash.average_bits(F.col("embedding")).alias("bits"))


_DIFF_SQL = """SELECT vec_id, label, array_to_string(list_transform(list_filter(range(64), lambda i: i % 8 <> 7),
    lambda i: CASE WHEN embedding[i + 2] > embedding[i + 1] THEN '1' ELSE '0' END), '') AS bits FROM embeddings"""


@query("diff_hash_bits", f"SELECT vec_id, bits FROM ({_DIFF_SQL})")
def diff_hash_bits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", imghash.difference_bits(F.col("embedding")).alias("bits"))


@query(
    "phash_bits",
    """WITH c AS (SELECT vec_id, u, v, sum(4 * cos(pi() * u * (2 * i + 1) / 16) * cos(pi() * v * (2 * j + 1) / 16) * embedding[i * 8 + j + 1]::DOUBLE) AS x
      FROM embeddings, range(8) a(u), range(8) b(v), range(8) c(i), range(8) d(j) GROUP BY 1, 2, 3),
    m AS (SELECT vec_id, median(x) AS m FROM c GROUP BY 1),
    n AS (SELECT vec_id, (u * 8 + v) // 4 AS k, sum(CASE WHEN x > m THEN 8 >> ((u * 8 + v) % 4)::INTEGER ELSE 0 END)::INTEGER AS nibble FROM c JOIN m USING (vec_id) GROUP BY 1, 2)
    SELECT vec_id, string_agg(substr('0123456789abcdef', nibble + 1, 1), '' ORDER BY k) AS bits FROM n GROUP BY 1""",
)
def phash_bits(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine-transform hashes of 8 x 8 grids, in Arrow batches."""
    ship(spark)

    @F.pandas_udf("string")
    def hashed(grids: pd.Series) -> pd.Series:
        return grids.map(lambda g: imghash.phash(np.asarray(g, float).reshape(8, 8)))

    return table(spark, sf, "embeddings").select("vec_id", hashed("embedding").alias("bits"))


@query(
    "hamming_pairs",
    f"""WITH b AS (SELECT * FROM ({_DIFF_SQL}))
    SELECT x.vec_id AS a, y.vec_id AS b, hamming(x.bits, y.bits)::BIGINT AS distance
    FROM b x JOIN b y ON x.label = y.label AND x.vec_id < y.vec_id WHERE hamming(x.bits, y.bits) < 20""",
)
def hamming_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The reference compares the frames of one video; here those of a label, all of them."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label", imghash.difference_bits(F.col("embedding")).alias("bits"))
    return imghash.near_pairs(rows, "label", "vec_id", "bits", 20)


@query(
    "hamming_nearest",
    f"""WITH b AS (SELECT * FROM ({_DIFF_SQL})),
    p AS (SELECT x.vec_id, y.vec_id AS other, hamming(x.bits, y.bits)::BIGINT AS distance FROM b x JOIN b y ON x.label = y.label AND x.vec_id <> y.vec_id WHERE hamming(x.bits, y.bits) < 20)
    SELECT b.vec_id, count(other) AS n_near, min(distance) AS distance, arg_min(other, distance * 1000000000 + other) AS nearest FROM b LEFT JOIN p USING (vec_id) GROUP BY 1""",
)
def hamming_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Of the pairs of ``hamming_pairs``, how many each row has, and its nearest row."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label", imghash.difference_bits(F.col("embedding")).alias("bits"))
    return imghash.near_counts(rows, "label", "vec_id", "bits", 20).withColumnRenamed("key", "vec_id")


_AVG_SQL = """SELECT vec_id, label, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS bits FROM embeddings"""


@query(
    "near_dup_greedy",
    f"""WITH RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM ({_AVG_SQL})),
    f AS (
      SELECT label, rn, vec_id, true AS keep, [bits] AS kept FROM b WHERE rn = 1
      UNION ALL
      SELECT b.label, b.rn, b.vec_id, list_min(list_transform(f.kept, lambda k: hamming(k, b.bits))) >= 20,
        CASE WHEN list_min(list_transform(f.kept, lambda k: hamming(k, b.bits))) >= 20 THEN list_append(f.kept, b.bits) ELSE f.kept END
      FROM f JOIN b ON b.label = f.label AND b.rn = f.rn + 1)
    SELECT vec_id, label FROM f WHERE keep""",
)
def near_dup_greedy(spark: SparkSession, sf: str) -> DataFrame:
    sign = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    ship(spark)
    rows = table(spark, sf, "embeddings").select("vec_id", "label", sign.alias("bits"))
    return folds.gate_frames(rows, "label", "vec_id", bits="bits", tolerance=20).select("vec_id", "label")


@query(
    "frame_stride",
    """WITH RECURSIVE e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    f AS (
      SELECT user_id, rn, event_id, true AS keep, event_id AS last FROM e WHERE rn = 1
      UNION ALL
      SELECT e.user_id, e.rn, e.event_id, NOT (f.last + 600 >= e.event_id), CASE WHEN f.last + 600 >= e.event_id THEN f.last ELSE e.event_id END
      FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT user_id, event_id FROM f WHERE keep""",
)
def frame_stride(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return folds.gate_frames(table(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id", sample_rate=600)


@query(
    "grid_variance",
    """WITH t AS (SELECT vec_id, (i // 16) AS tile, embedding[i + 1]::DOUBLE AS x FROM embeddings, range(64) r(i)),
    v AS (SELECT vec_id, tile, var_pop(x) AS v FROM t GROUP BY 1, 2)
    SELECT vec_id, round(min(v), 6) AS least, round(avg(v), 6) AS mean FROM v GROUP BY 1""",
)
def grid_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Least and mean variance of four tiles of each grid, inside the row: no shuffle."""
    tile = lambda k: F.transform(F.slice("embedding", k * 16 + 1, 16), lambda x: x.cast("double"))

    def variance(a: object) -> object:
        mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / 16
        return F.aggregate(F.transform(a, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda s, x: s + x) / 16

    rows = table(spark, sf, "embeddings").select("vec_id", F.array(*(variance(tile(k)) for k in range(4))).alias("v"))
    mean = F.aggregate("v", F.lit(0.0), lambda s, x: s + x) / 4
    return rows.select("vec_id", F.round(F.array_min("v"), 6).alias("least"), F.round(mean, 6).alias("mean"))


@query(
    "conversation_text",
    "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text, count(*) AS turns FROM conversations GROUP BY conv_id",
)
def conversation_text(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    turns = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    grouped = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"), F.count("*").alias("turns"))
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["line"]), "\n").alias("text"), "turns")


@query(
    "token_numbering",
    r"""WITH p AS (SELECT doc_id, string_split(text, ' the ') AS parts FROM documents),
    b AS (SELECT doc_id, len(parts) - 1 AS found, array_to_string(list_transform(parts, lambda x, i:
      CASE WHEN i = 1 THEN x WHEN i - 1 <= 2 THEN '<|img' || (i - 1) || '|>' || x ELSE ' the ' || x END), '') AS body FROM p)
    SELECT doc_id, CASE WHEN found >= 2 THEN body WHEN found = 1 THEN '<|img2|>' || chr(10) || body ELSE '<|img1|><|img2|>' || chr(10) || body END AS text FROM b""",
)
def token_numbering(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.number_placeholders(F.col("text"), F.lit(2), " the ").alias("text"))


@query(
    "ensure_tokens",
    r"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<|img2|>' || text ELSE text END AS t FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<|img1|><|img3|>' ELSE '<|img1|><|img2|><|img3|>' END || chr(10) || t AS text FROM d""",
)
def ensure_tokens(spark: SparkSession, sf: str) -> DataFrame:
    body = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<|img2|>"), F.col("text"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", text.ensure_tokens(body, F.lit(3)).alias("text"))


@query(
    "caption_template",
    """SELECT c_custkey, 'A chest X-ray (' || n_name || ' view) of a ' || (20 + c_custkey % 60)::VARCHAR || '-year-old ' ||
      CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown gender' END || ' patient showing ' ||
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'no significant pathological findings.' ELSE 'findings of ' || c_mktsegment || ', Mass.' END AS caption
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def caption_template(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    gender = F.when(key % 3 == 0, "M").when(key % 3 == 1, " F ").otherwise("")
    finding = F.when(F.col("c_mktsegment") == "BUILDING", "No Finding").otherwise(F.concat("c_mktsegment", F.lit("|Mass")))
    return rows.select("c_custkey", text.xray_caption(finding, (20 + key % 60).cast("string"), gender, F.col("n_name")).alias("caption"))


_CAPTIONS = {"STANDARD": "A standard part.", "PROMO": "A promoted part.", "ECONOMY": "An economy part."}


@query(
    "class_map_caption",
    """SELECT p_partkey, caption FROM part JOIN (VALUES ('STANDARD', 'A standard part.'), ('PROMO', 'A promoted part.'), ('ECONOMY', 'An economy part.')) v(k, caption)
    ON split_part(p_type, ' ', 1) = k""",
)
def class_map_caption(spark: SparkSession, sf: str) -> DataFrame:
    caption = text.class_caption(F.get(F.split("p_type", " "), F.lit(0)), _CAPTIONS)
    return table(spark, sf, "part").select("p_partkey", caption.alias("caption")).filter("caption IS NOT NULL")


@query(
    "prefix_class",
    """SELECT p_partkey, CASE WHEN starts_with(k, 'Brand#1_') THEN 'Brand#1' WHEN starts_with(k, 'Brand#12_') THEN 'Brand#12' WHEN starts_with(k, 'Brand_') THEN 'Brand' END AS class
    FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Brand#12_' WHEN 1 THEN 'Brand#1_' WHEN 2 THEN 'Brand_' ELSE 'None_' END || p_name AS k FROM part)""",
)
def prefix_class(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.when(F.col("p_partkey") % 4 == 0, "Brand#12_").when(F.col("p_partkey") % 4 == 1, "Brand#1_").when(F.col("p_partkey") % 4 == 2, "Brand_").otherwise("None_")
    name = F.concat(lead, F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", text.prefix_class(name, ["Brand#1", "Brand#12", "Brand"]).alias("class"))


@query(
    "case_text_sections",
    """SELECT d.doc_id, concat_ws(chr(10), 'Title: ' || nullif(d.lang, ''), 'History: ' || CASE WHEN d.source <> 'src0' THEN d.source END,
      'Findings: ' || l.quality::VARCHAR) AS text FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def case_text_sections(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    history = F.when(F.col("source") == "src0", "N/A").otherwise(F.col("source"))
    lines = text.sections(("Title", F.col("lang")), ("History", history), ("Findings", F.col("quality").cast("string")))
    return rows.select("doc_id", lines.alias("text"))


@query(
    "lookup_last_wins",
    """WITH b AS (SELECT doc_id, quality, 0 AS ord FROM labels UNION ALL SELECT doc_id, 1 - quality, 1 FROM labels WHERE doc_id % 2 = 0),
    l AS (SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord DESC) AS rn FROM b) WHERE rn = 1)
    SELECT doc_id, source, quality FROM documents JOIN l USING (doc_id)""",
)
def lookup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality", F.lit(0).alias("ord"))
    later = labels.filter("doc_id % 2 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"), F.lit(1).alias("ord"))
    lookup = dedup.last_wins(labels.unionByName(later), "doc_id", "ord", "quality")
    return table(spark, sf, "documents").join(lookup, "doc_id").select("doc_id", "source", "quality")


@query("lookup_left_default", "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def lookup_left_default(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


@query("lookup_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def lookup_semi(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_semi").select("doc_id", "lang")


@query("allowed_sources", "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src3', 'src5', 'src7', 'src9')")
def allowed_sources(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter(F.col("source").isin("src1", "src3", "src5", "src7", "src9")).select("doc_id", "source")


@query("skip_completed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_completed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query(
    "explode_columns",
    """WITH u AS (SELECT p_partkey, 1 AS k, p_name AS v FROM part UNION ALL SELECT p_partkey, 2, CASE WHEN p_size > 10 THEN p_brand END FROM part UNION ALL SELECT p_partkey, 3, p_type FROM part)
    SELECT (row_number() OVER (ORDER BY p_partkey, k) - 1)::BIGINT AS sample_id, v AS image FROM u WHERE v IS NOT NULL""",
)
def explode_columns(spark: SparkSession, sf: str) -> DataFrame:
    cells = F.array("p_name", F.when(F.col("p_size") > 10, F.col("p_brand")), F.col("p_type"))
    rows = table(spark, sf, "part").select("p_partkey", F.posexplode(cells).alias("k", "image")).filter("image IS NOT NULL")
    return ordinals.dense_ids(rows.withColumn("d", F.lit("scin")), ["d"], ["p_partkey", "k"]).select("sample_id", "image")


@query("explode_json", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def explode_json(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")).filter("k IS NOT NULL")


@query("ids_eligible", "SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT AS sample_id FROM documents WHERE lang = 'en'")
def ids_eligible(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "source")
    return ordinals.dense_ids(rows, ["source"], ["doc_id"])


@query(
    "ids_all",
    "SELECT doc_id, source, sample_id FROM (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT AS sample_id FROM documents) WHERE lang = 'en'",
)
def ids_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return ordinals.dense_ids(rows, ["source"], ["doc_id"]).filter("lang = 'en'").select("doc_id", "source", "sample_id")


@query("skip_take", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100 OFFSET 100")
def skip_take(spark: SparkSession, sf: str) -> DataFrame:
    return ordinals.skip_take(table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"], 100, 100)


_SPEC_SQL = """SELECT c_custkey, lower(c_mktsegment) || CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '[:' || c_custkey || ']' WHEN 2 THEN '[' || c_custkey || ':' || 2 * c_custkey || ']'
      WHEN 3 THEN '[' || c_custkey || ':]' ELSE '[:10%]' END AS s FROM customer"""


@query(
    "parse_split",
    rf"""SELECT c_custkey, s AS spec, CASE WHEN f THEN regexp_extract(s, '^(\w+)(?:\[(\d*):(\d*)\])?$', 1) ELSE s END AS name,
      CASE WHEN f THEN nullif(regexp_extract(s, '^(\w+)(?:\[(\d*):(\d*)\])?$', 2), '')::BIGINT END AS first_row,
      CASE WHEN f THEN nullif(regexp_extract(s, '^(\w+)(?:\[(\d*):(\d*)\])?$', 3), '')::BIGINT END AS end_row
    FROM (SELECT *, regexp_matches(s, '^(\w+)(?:\[(\d*):(\d*)\])?$') AS f FROM ({_SPEC_SQL}))""",
)
def parse_split(spark: SparkSession, sf: str) -> DataFrame:
    """Split specifications of all five forms, from customers' segments and numbers."""
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 5
    rows = F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("[:"), key, F.lit("]"))).when(kind == 2, F.concat(F.lit("["), key, F.lit(":"), (2 * F.col("c_custkey")).cast("string"), F.lit("]")))
    rows = rows.when(kind == 3, F.concat(F.lit("["), key, F.lit(":]"))).otherwise("[:10%]")
    specs = table(spark, sf, "customer").select("c_custkey", F.concat(F.lower("c_mktsegment"), rows).alias("spec"))
    name, first, end = text.split_parts(F.col("spec"))
    return specs.select("c_custkey", "spec", name.alias("name"), first.alias("first_row"), end.alias("end_row"))


@query(
    "batch_chunks",
    "SELECT source, ((rn - 1) // 16)::BIGINT AS batch, count(*) AS n, max(doc_id) AS last_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) GROUP BY 1, 2",
)
def batch_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordinals.dense_ids(table(spark, sf, "documents").select("doc_id", "source"), ["source"], ["doc_id"])
    return rows.groupBy("source", ordinals.batch_of(F.col("sample_id"), 16).alias("batch")).agg(F.count("*").alias("n"), F.max("doc_id").alias("last_id"))


@query(
    "sub_batches",
    """WITH n AS (SELECT greatest(1, count(*) // 7) AS size FROM documents)
    SELECT ((rn - 1) // size)::BIGINT AS piece, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY doc_id) AS rn FROM documents), n GROUP BY 1""",
)
def sub_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.lit("all").alias("d"))
    size = ordinals.sub_batch_size(docs.count(), 7)
    rows = ordinals.dense_ids(docs, ["d"], ["doc_id"])
    return rows.groupBy(ordinals.batch_of(F.col("sample_id"), size).alias("piece")).agg(F.count("*").alias("n"))


@query(
    "shards_by_count",
    """SELECT source, shard, count(*) AS samples, sum(n_chars)::BIGINT AS bytes FROM (
      SELECT source, n_chars, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 12)::BIGINT AS shard FROM documents) GROUP BY 1, 2""",
)
def shards_by_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = ordinals.dense_ids(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), ["source"], ["doc_id"])
    shard = ordinals.batch_of(F.col("sample_id"), 12).alias("shard")
    return rows.groupBy("source", shard).agg(F.count("*").alias("samples"), F.sum("n_chars").alias("bytes"))


@query(
    "shards_by_bytes",
    """WITH RECURSIVE b AS (SELECT batch, sum(n_chars)::BIGINT AS bytes, count(*) AS samples FROM (
        SELECT n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS batch FROM documents) GROUP BY 1),
    f AS (SELECT batch, bytes, samples, 0 AS shard, bytes AS held FROM b WHERE batch = 0
      UNION ALL SELECT b.batch, b.bytes, b.samples, CASE WHEN f.held >= 100000 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.held >= 100000 THEN b.bytes ELSE f.held + b.bytes END
      FROM f JOIN b ON b.batch = f.batch + 1)
    SELECT shard::BIGINT AS shard, count(*) AS batches, sum(samples)::BIGINT AS samples, sum(bytes)::BIGINT AS bytes FROM f GROUP BY 1""",
)
def shards_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", F.lit("all").alias("d"))
    batch = ordinals.batch_of(F.col("sample_id"), 10).alias("batch")
    batches = ordinals.dense_ids(docs, ["d"], ["doc_id"]).groupBy("d", batch).agg(F.sum("n_chars").alias("bytes"), F.count("*").alias("samples"))
    shards = folds.byte_shards(batches, "d", "batch", "bytes", 100_000)
    return shards.groupBy("shard").agg(F.count("*").alias("batches"), F.sum("samples").alias("samples"), F.sum("bytes").alias("bytes"))


@query("record_keys", "SELECT doc_id, printf('%s__%08d', source, doc_id) AS key FROM documents")
def record_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.record_key(F.col("source"), F.col("doc_id")).alias("key"))


@query("manifest_counts", "SELECT source AS dataset_id, count(DISTINCT doc_id) AS n FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1")
def manifest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a second insert adds to a manifest that holds a third of the rows already."""
    rows = table(spark, sf, "documents").select(F.col("source").alias("dataset_id"), F.col("doc_id").alias("sample_id"))
    fresh = dedup.insert_distinct(rows.filter("sample_id % 3 = 0"), rows.unionByName(rows), ["dataset_id", "sample_id"])
    return fresh.groupBy("dataset_id").agg(F.count("*").alias("n"))


@query("checkpoint_upsert", "SELECT event_type AS dataset_id, max(event_id) AS last_sample_id, arg_max(user_id, event_id) AS last_user FROM events GROUP BY 1")
def checkpoint_upsert(spark: SparkSession, sf: str) -> DataFrame:
    last = F.max("event_id").alias("last_sample_id"), F.max_by("user_id", "event_id").alias("last_user")
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("dataset_id")).agg(*last)


@query("union_sources", "SELECT 0 AS adapter_pos, doc_id AS src_ord, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark")
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.lit(0).alias("adapter_pos"), F.col("doc_id").alias("src_ord"), "text")
    return docs.unionByName(table(spark, sf, "benchmark").select(F.lit(1).alias("adapter_pos"), F.col("item_id").alias("src_ord"), "text"))


@query(
    "verify_hashes",
    """SELECT CASE WHEN NOT regexp_full_match(e, '[0-9a-f]{64}') THEN 'skipped' WHEN e = sha256(text) THEN 'valid' ELSE 'invalid' END AS status, count(*) AS n FROM (
      SELECT text, CASE WHEN doc_id % 11 = 0 THEN 'not-a-hash' WHEN doc_id % 7 = 0 THEN sha256(text || 'x') ELSE sha256(text) END AS e FROM documents) GROUP BY 1""",
)
def verify_hashes(spark: SparkSession, sf: str) -> DataFrame:
    from corpusloom.operators.verify import blob_status

    body = F.col("text")
    named = F.when(F.col("doc_id") % 11 == 0, F.lit("not-a-hash")).when(F.col("doc_id") % 7 == 0, F.sha2(F.concat(body, F.lit("x")), 256)).otherwise(F.sha2(body, 256))
    return table(spark, sf, "documents").select(blob_status(named, F.sha2(body, 256)).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


_HUB_NAME_SQL = "CASE c_custkey % 3 WHEN 0 THEN 'org/' || lower(c_name) WHEN 1 THEN lower(c_mktsegment) || '/da--ta' || c_custkey ELSE lower(c_name) END"


@query(
    "cache_names",
    rf"""SELECT c_custkey, name, folder, regexp_replace(regexp_replace(folder, '^datasets--', ''), '^(.*?)--', '\1/') AS restored
    FROM (SELECT *, 'datasets--' || replace(name, '/', '--') AS folder FROM (SELECT c_custkey, {_HUB_NAME_SQL} AS name FROM customer))""",
)
def cache_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names with a namespace, with a double hyphen of their own, and without either."""
    kind, name = F.col("c_custkey") % 3, F.lower("c_name")
    name = F.when(kind == 0, F.concat(F.lit("org/"), name)).when(kind == 1, F.concat(F.lower("c_mktsegment"), F.lit("/da--ta"), F.col("c_custkey").cast("string"))).otherwise(name)
    folder = text.cache_name(F.col("name"))
    return table(spark, sf, "customer").select("c_custkey", name.alias("name")).select("*", folder.alias("folder"), text.dataset_name(folder).alias("restored"))


@query("truncate_preview", "SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS preview FROM documents ORDER BY doc_id LIMIT 3")
def truncate_preview(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").orderBy("doc_id").limit(3).select("doc_id", text.truncated(F.col("text"), 100).alias("preview"))


@query(
    "tile_coords",
    """SELECT c_custkey, floor((lon + 180.0) / 360.0 * 256)::BIGINT AS x, floor((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * 256)::BIGINT AS y
    FROM (SELECT c_custkey, (c_custkey % 360 - 180)::DOUBLE + 0.25 AS lon, (c_custkey % 160 - 80)::DOUBLE + 0.25 AS lat FROM customer)""",
)
def tile_coords(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = (F.col("c_custkey") % 360 - 180).cast("double") + 0.25, (F.col("c_custkey") % 160 - 80).cast("double") + 0.25
    zoom = F.lit(8)
    return table(spark, sf, "customer").select("c_custkey", tiles.tile_x(lon, zoom).alias("x"), tiles.tile_y(lat, zoom).alias("y"))


@query(
    "tile_enumerate",
    """WITH b AS (SELECT s_suppkey, (s_suppkey * 37 % 340 - 170)::DOUBLE AS lon, (s_suppkey * 13 % 120 - 60)::DOUBLE AS lat FROM supplier),
    t AS (SELECT s_suppkey, floor((lon + 180) / 360 * 256)::BIGINT AS x0, floor((lon + 2 + 180) / 360 * 256)::BIGINT AS x1,
      floor((1 - asinh(tan(radians(lat + 3))) / pi()) / 2 * 256)::BIGINT AS y0, floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 256)::BIGINT AS y1 FROM b)
    SELECT s_suppkey, x, y FROM t, LATERAL (SELECT unnest(generate_series(x0, x1)) AS x), LATERAL (SELECT unnest(generate_series(y0, y1)) AS y)""",
)
def tile_enumerate(spark: SparkSession, sf: str) -> DataFrame:
    """All tiles of a box around each supplier."""
    lon, lat = ((F.col("s_suppkey") * a % m - m // 2).cast("double") for a, m in ((37, 340), (13, 120)))
    return tiles.tiles_in(table(spark, sf, "supplier").select("s_suppkey", lon.alias("lon"), lat.alias("lat")), (F.col("lon"), F.col("lat"), F.col("lon") + 2, F.col("lat") + 3)).select("s_suppkey", "x", "y")


@query(
    "tile_sample",
    """WITH t AS (SELECT c_custkey, floor((lon + 180.0) / 360.0 * 256)::BIGINT AS x, floor((1.0 - asinh(tan(radians(lat))) / pi()) / 2.0 * 256)::BIGINT AS y
      FROM (SELECT c_custkey, (c_custkey % 360 - 180)::DOUBLE + 0.25 AS lon, (c_custkey % 160 - 80)::DOUBLE + 0.25 AS lat FROM customer)),
    r AS (SELECT x, y, row_number() OVER (ORDER BY md5(x || '/' || y || '/0'), x, y) AS place, count(*) OVER () AS n FROM t)
    SELECT x, y, count(*) AS n FROM r WHERE place <= floor(n * 0.5) GROUP BY 1, 2""",
)
def tile_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A seeded choice of half the customers' tiles; a tile may be there several times."""
    return tiles.sample_tiles(tile_coords(spark, sf), 0.5).groupBy("x", "y").agg(F.count("*").alias("n"))


_SLICES_SQL = """SELECT s_suppkey, w, s, least(w + 2, w0 + 7) AS e, least(s + 2, s0 + 6) AS n
    FROM (SELECT s_suppkey, s_suppkey % 100 AS w0, s_suppkey % 40 AS s0 FROM supplier), LATERAL (SELECT unnest(range(w0, w0 + 7, 2)) AS w), LATERAL (SELECT unnest(range(s0, s0 + 6, 2)) AS s)"""


@query("slice_grid", f"SELECT *, printf('slice_%d_%d_%d_%d.pbf', w, s, e, n) AS name FROM ({_SLICES_SQL})")
def slice_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The grid cells of a box for each supplier, with their file names."""
    w, s = F.col("s_suppkey") % 100, F.col("s_suppkey") % 40
    return tiles.slices_in(table(spark, sf, "supplier").select("s_suppkey"), (w, s, w + 7, s + 6), 2)


@query("sorted_slices", f"SELECT row_number() OVER (ORDER BY w, s, e, n)::BIGINT AS place, w, s, printf('slice_%d_%d_%d_%d.pbf', w, s, e, n) AS name FROM (SELECT DISTINCT w, s, e, n FROM ({_SLICES_SQL}))")
def sorted_slices(spark: SparkSession, sf: str) -> DataFrame:
    """File names of slices in the order of their bounds as numbers."""
    bound = lambda k, n: F.get(tiles.parsed_slice(F.col("name")), F.lit(k)).alias(n)
    names = slice_grid(spark, sf).select("name").distinct().select("name", F.lit(0).alias("d"), *(bound(k, n) for k, n in enumerate("wsen")))
    rows = ordinals.dense_ids(names, ["d"], ["w", "s", "e", "n"])
    return rows.select((F.col("sample_id") + 1).alias("place"), "w", "s", "name")


@query(
    "dataset_tally",
    "SELECT source AS dataset, count(*) AS total, count(*) FILTER (WHERE quality = 1) AS valid, count(*) FILTER (WHERE quality = 0) AS invalid, count(*) FILTER (WHERE quality IS NULL) AS skipped FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
def dataset_tally(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    counts = [F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("valid"), F.count_if(F.col("quality") == 0).alias("invalid")]
    return rows.groupBy(F.col("source").alias("dataset")).agg(*counts, F.count_if(F.col("quality").isNull()).alias("skipped"))


@query(
    "progress_counters",
    "SELECT source AS dataset_id, count(*) AS processed, count(*) FILTER (WHERE n_chars BETWEEN 64 AND 8192) AS passed, sum(n_chars)::BIGINT AS total_bytes FROM documents GROUP BY 1",
)
def progress_counters(spark: SparkSession, sf: str) -> DataFrame:
    passed = F.count_if(filters.within(F.col("n_chars"), 64, 8192)).alias("passed")
    return table(spark, sf, "documents").groupBy(F.col("source").alias("dataset_id")).agg(F.count("*").alias("processed"), passed, F.sum("n_chars").alias("total_bytes"))


@query("retry_backoff", "SELECT event_id, least(event_id % 8, 5)::INTEGER AS waits, 1.5 * (2 ** least(event_id % 8, 5) - 1) AS seconds FROM events")
def retry_backoff(spark: SparkSession, sf: str) -> DataFrame:
    """How often and how long a request waits that fails as often as its event's number says."""
    waits = text.retry_waits(F.col("event_id") % 8, 1.5)
    return table(spark, sf, "events").select("event_id", F.size(waits).alias("waits"), F.aggregate(waits, F.lit(0.0), lambda a, x: a + x).alias("seconds"))


@query(
    "csv_names",
    "SELECT doc_id, list_filter(list_transform(string_split(lang || ', ,' || source || ' ,', ','), lambda x: trim(x)), lambda x: x <> '') AS names FROM documents",
)
def csv_names(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.concat("lang", F.lit(", ,"), "source", F.lit(" ,"))
    return table(spark, sf, "documents").select("doc_id", text.listed_names(joined).alias("names"))


@query("report_stamps", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def report_stamps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", text.report_stamp(F.col("ts")).alias("stamp"))
