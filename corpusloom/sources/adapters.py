"""Named datasets: each binds a container, predicates, a lookup, a projection and an id rule.

Id rules: *eligible* numbers the members that pass predicates and lookups; *all* numbers every row
of the scan, dropped ones included; *exploded* numbers what remains of exploded cells.  Images that
cannot be decoded are dropped after numbering, except where the scan itself fails.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import imghash, pixels, text
from corpusloom.operators.decoding import as_png
from corpusloom.operators.dedup import last_wins
from corpusloom.operators.folds import gate_frames
from corpusloom.operators.ordinals import dense_ids
from corpusloom.runtime import ship
from corpusloom.schema import as_samples
from corpusloom.sources import files, web
from corpusloom.sources.archives import list_members, open_file, place, read_csv_member, read_members, with_payload_arrays, with_payloads

Adapter = Callable[..., DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def adapter(name: str) -> Callable[[Adapter], Adapter]:
    def add(f: Adapter) -> Adapter:
        ADAPTERS[name] = f
        return f

    return add


def image_of(content: str = "content", form: Column | None = None) -> Column:
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)) if form is None else form
    return F.array(F.struct(F.col(content).alias("bytes"), kind.alias("format"), F.col("width"), F.col("height")))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    return dense_ids(df.withColumn("_d", F.lit(0)), ["_d"], list(order)).drop("_d")


def decoded(df: DataFrame) -> DataFrame:
    return df.filter("width > 0 AND height > 0")


@dataclass(frozen=True)
class ClassMap:
    """Images in an archive whose path names their class."""

    dataset_id: str
    extensions: tuple[str, ...]
    captions: dict[str, str]
    class_part: int = 1
    least_parts: int = 0
    parts: dict[int, tuple[str, ...]] = field(default_factory=dict)
    prefix: str = ""
    by_prefix: bool = False
    archive: str = "zip_path"

    def wants(self, path: str) -> bool:
        parts = path.split("/")
        return (
            path.lower().endswith(tuple("." + e for e in self.extensions))
            and path.startswith(self.prefix)
            and len(parts) >= self.least_parts
            and all(parts[k] in allowed for k, allowed in self.parts.items())
        )

    def read(self, spark: SparkSession, **config: object) -> DataFrame:
        members = list_members(spark, str(config[self.archive]), self.wants)
        key = text.prefix_class(text.stem(F.col("path")), list(self.captions)) if self.by_prefix else text.path_part(F.col("path"), self.class_part)
        rows = members.withColumn("caption", text.class_caption(key, self.captions)).filter("caption IS NOT NULL")
        rows = decoded(with_payloads(numbered(rows, "archive", "ord")))
        data = F.create_map(F.lit("file_path"), F.col("path"))
        return as_samples(rows, str(config.get("dataset_id", self.dataset_id)), "multi_image_text", text=F.concat(F.lit("<|img1|>\n"), F.col("caption")), images=image_of(), data=data)


#: Classes and captions (fixed values).
CLASS_MAPS = {
    "BrainTumorMRI": ClassMap(
        "brain_tumor_mri",
        ("jpg", "jpeg", "png"),
        {
            "glioma": "An MRI scan of the brain showing a glioma tumor.",
            "meningioma": "An MRI scan of the brain showing a meningioma.",
            "notumor": "An MRI scan of the brain showing no tumor.",
            "pituitary": "An MRI scan of the brain showing a pituitary tumor.",
        },
        least_parts=3,
        parts={0: ("Training", "Testing")},
    ),
    "CovidRadiography": ClassMap(
        "covid_radiography",
        ("png",),
        {
            "COVID": "A chest X-ray image showing COVID-19 pneumonia.",
            "Lung_Opacity": "A chest X-ray image showing lung opacity.",
            "Normal": "A normal chest X-ray image showing no significant pulmonary abnormalities.",
            "Viral Pneumonia": "A chest X-ray image showing viral pneumonia.",
        },
        least_parts=4,
        parts={2: ("images",)},
    ),
    "DiabeticRetinopathy": ClassMap(
        "diabetic_retinopathy",
        ("png",),
        {
            "No_DR": "A color fundus photograph of the retina showing no signs of diabetic retinopathy.",
            "Mild": "A color fundus photograph of the retina showing mild diabetic retinopathy.",
            "Moderate": "A color fundus photograph of the retina showing moderate diabetic retinopathy.",
            "Severe": "A color fundus photograph of the retina showing severe non-proliferative diabetic retinopathy.",
            "Proliferate_DR": "A color fundus photograph of the retina showing proliferative diabetic retinopathy.",
        },
        class_part=2,
        least_parts=4,
    ),
    "LiverUltrasound": ClassMap(
        "liver_ultrasound",
        ("jpg", "jpeg", "png"),
        {
            "Benign": "An abdominal ultrasound image of the liver showing a benign lesion.",
            "Malignant": "An abdominal ultrasound image of the liver showing a malignant lesion.",
            "Normal": "An abdominal ultrasound image showing a normal liver.",
        },
        least_parts=5,
        parts={3: ("image",)},
    ),
    "EBHISeg": ClassMap(
        "ebhi_seg",
        ("png",),
        {
            "Adenocarcinoma": "A histopathology image of colorectal tissue showing adenocarcinoma.",
            "High-grade IN": "A histopathology image of colorectal tissue showing high-grade intraepithelial neoplasia.",
            "Low-grade IN": "A histopathology image of colorectal tissue showing low-grade intraepithelial neoplasia.",
            "Normal": "A histopathology image of normal colorectal tissue.",
            "Polyp": "A histopathology image of colorectal tissue showing a polyp.",
            "Serrated adenoma": "A histopathology image of colorectal tissue showing a serrated adenoma.",
        },
        prefix="ds/img/",
        by_prefix=True,
        archive="tar_path",
    ),
}
for _name, _map in CLASS_MAPS.items():
    ADAPTERS[_name] = _map.read

#: Tissue classes (fixed values).
NCT_CAPTIONS = {
    "ADI": "A histopathology image of colorectal tissue showing adipose tissue.",
    "BACK": "A histopathology image showing background in a colorectal biopsy slide.",
    "DEB": "A histopathology image of colorectal tissue showing cellular debris.",
    "LYM": "A histopathology image of colorectal tissue showing lymphocytic infiltrate.",
    "MUC": "A histopathology image of colorectal tissue showing mucus.",
    "MUS": "A histopathology image of colorectal tissue showing smooth muscle.",
    "NORM": "A histopathology image showing normal colorectal mucosa.",
    "STR": "A histopathology image of colorectal tissue showing cancer-associated stroma.",
    "TUM": "A histopathology image of colorectal tissue showing colorectal cancer epithelium.",
}
#: The archives inside the outer one that are read (fixed values).
NCT_INNER = ("NCT-CRC-HE-100K.zip", "CRC-VAL-HE-7K.zip")
#: Sources whose captions are used (fixed values).
TRINITY_SOURCES = ("deeplesion", "brats24", "brats", "pmc_oa", "breast_histo", "brats_24", "NCT-CRC-HE-100K", "adc22", "nih_chest")
#: Subsets and splits in their order (fixed values).
MNIST_SUBSETS = ("pathmnist", "chestmnist", "dermamnist", "pneumoniamnist", "retinamnist", "breastmnist", "bloodmnist")
MNIST_SPLITS = ("train", "val", "test")
PMC_FOLDER = "caption_T060_filtered_top4_sep_v0_subfigures"


def _captioned(rows: DataFrame, dataset_id: str, image_only: bool, data: Column | None = None) -> DataFrame:
    """One image each; with its caption as a text of one image unless ``image_only``."""
    if image_only:
        return as_samples(rows, dataset_id, "image", images=image_of(), data=data)
    return as_samples(rows, dataset_id, "multi_image_text", text=F.concat(F.lit("<|img1|>\n"), F.col("caption")), images=image_of(), data=data)


@adapter("NctCrcHe")
def nct_crc_he(spark: SparkSession, zip_path: str, dataset_id: str = "nct_crc_he", **_: object) -> DataFrame:
    want = lambda p: p.split("/")[-1].lower().endswith((".tif", ".tiff", ".png", ".jpg", ".jpeg")) and any(f"{z}/" in p for z in NCT_INNER)
    rows = list_members(spark, zip_path, want, nested=True)
    rows = rows.withColumn("caption", text.class_caption(F.element_at(F.split("path", "/"), -2), NCT_CAPTIONS)).filter("caption IS NOT NULL")
    return _captioned(decoded(with_payloads(numbered(rows, "path"))), dataset_id, False)


@adapter("NihChestXray")
def nih_chest_xray(spark: SparkSession, zip_path: str, dataset_id: str = "nih_chest_xray", **_: object) -> DataFrame:
    """The record table is a member of the archive; of several records of an image the last one counts."""
    cell = lambda name: F.try_element_at("row", F.lit(name))
    caption = text.xray_caption(*(cell(c) for c in ("Finding Labels", "Patient Age", "Patient Gender", "View Position")))
    records = read_csv_member(spark, zip_path, "Data_Entry_2017.csv").select("n", F.trim(cell("Image Index")).alias("name"), caption.alias("caption"))
    lookup = last_wins(records, "name", "n", "caption")
    rows = list_members(spark, zip_path, lambda p: p.lower().endswith(".png")).withColumn("name", text.basename(F.col("path")))
    return _captioned(decoded(with_payloads(numbered(rows.join(lookup, "name"), "archive", "ord"))), dataset_id, False)


@adapter("MediCaT")
def medicat(spark: SparkSession, tar_path: str, dataset_id: str = "medicat", cache_file: str | None = None, **_: object) -> DataFrame:
    lines = read_members(spark, tar_path, lambda p: p.endswith(".jsonl")).select(F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("n", "line")).filter("line != ''")
    record = F.from_json("line", "pdf_hash string, fig_uri string, s2_caption string, s2orc_caption string")
    fields = lines.select("n", record.alias("r")).select("n", F.concat_ws("_", "r.pdf_hash", "r.fig_uri").alias("name"), text.truthy(F.col("r.s2_caption"), F.col("r.s2orc_caption")).alias("caption"))
    lookup = last_wins(fields, "name", "n", "caption").filter("caption IS NOT NULL AND caption != ''")
    if cache_file:
        lookup = files.materialised(spark, lookup, cache_file)
    rows = list_members(spark, tar_path, lambda p: p.lower().endswith((".png", ".jpg", ".jpeg"))).withColumn("name", text.basename(F.col("path")))
    return _captioned(decoded(with_payloads(numbered(rows.join(lookup, "name"), "archive", "ord"))), dataset_id, False)


@adapter("MedMax")
def medmax(spark: SparkSession, data_dir: str, image_only: bool, cache_file: str | None = None, **_: object) -> DataFrame:
    """Captions of the training file override those of the validation file."""
    fields = ("image_path", "text", "task", "source")
    part = lambda name, k: files.in_file_order(spark.read.json(f"{data_dir}/{name}.jsonl"), exact=False).select(*fields, F.struct(F.lit(k), "_place").alias("ord"))
    lookup = last_wins(part("validation", 0).unionByName(part("train", 1)), "image_path", "ord", "text", "task", "source")
    if cache_file:
        lookup = files.materialised(spark, lookup, cache_file)
    rows = list_members(spark, f"{data_dir}/*tar.gz", lambda p: p.lower().endswith((".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp")))
    rows = numbered(rows.join(lookup.withColumnRenamed("image_path", "path"), "path"), "archive", "ord").withColumn("caption", F.coalesce("text", F.lit("")))
    fields = F.create_map(F.lit("file_path"), F.col("path"), F.lit("task"), F.coalesce("task", F.lit("")), F.lit("source"), F.coalesce("source", F.lit("")))
    return _captioned(decoded(with_payloads(rows)), "medmax", image_only, fields)


@adapter("MedTrinityFull")
def medtrinity_full(spark: SparkSession, data_dir: str, image_only: bool, cache_file: str | None = None, **_: object) -> DataFrame:
    table = files.in_file_order(spark.read.parquet(f"{data_dir}/*.parquet")).filter(F.col("source").isin(*TRINITY_SOURCES))
    lookup = last_wins(table, "file_name", "_place", "caption", "source")
    if cache_file:
        lookup = files.materialised(spark, lookup, cache_file)
    rows = list_members(spark, f"{data_dir}/*.tar.zst").withColumn("file_name", text.basename(F.col("path")))
    rows = decoded(with_payloads(numbered(rows.join(lookup, "file_name").withColumnRenamed("source", "of"), "archive", "ord")))
    return _captioned(rows if image_only else rows.filter("caption IS NOT NULL"), "medtrinity_full", image_only)


@adapter("MedTrinityDemo")
def medtrinity_demo(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    """The first 10,000 rows of a downloaded folder."""
    rows = files.in_file_order(spark.read.parquet(data_dir)).select(F.col("image.bytes").alias("content"), F.col("image.path").alias("path"), "_place")
    rows = files.with_size(numbered(rows.orderBy("_place").limit(10_000), "_place"))
    return as_samples(decoded(rows), "medtrinity_demo", "image", images=image_of())


@adapter("PMCOA")
def pmcoa(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    """Ids are places in the whole listing of the archive."""
    records = files.in_file_order(spark.read.json(f"{data_dir}/pmc_oa.jsonl"), exact=False)
    lookup = last_wins(records.select(F.concat(F.lit(PMC_FOLDER + "/"), "image").alias("path"), "caption", "_place"), "path", "_place", "caption")
    rows = list_members(spark, f"{data_dir}/images.zip").withColumn("sample_id", F.col("ord")).join(lookup, "path")
    return _captioned(decoded(with_payloads(rows)), "pmc_oa", False)


@adapter("OpenPMC18m")
def open_pmc_18m(spark: SparkSession, data_dir: str, image_only: bool = True, **_: object) -> DataFrame:
    rows = files.read_web_records(spark, f"{data_dir}/*.tar", numbered)
    rows = decoded(rows.withColumns({"content": F.col("jpg"), "path": F.concat("key", F.lit(".jpg")), "caption": F.coalesce(F.get_json_object("json", "$.caption"), F.lit(""))}))
    return _captioned(rows, "open_pmc_18m", image_only)


@adapter("LAIONAesthetics")
def laion_aesthetics(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    rows = files.read_web_records(spark, f"{data_dir}/*.tar", numbered)
    rows = decoded(rows.withColumns({"content": F.col("jpg"), "path": F.concat("key", F.lit(".jpg"))}))
    return as_samples(rows, "laion-aesthetics", "image", images=image_of(), data=F.create_map(F.lit("json"), F.col("json")))


def _nested_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """A saved dataset with conversations and modalities, as Parquet or as Arrow streams."""
    schema = "conversations array<struct<role:string,content:string>>, modalities array<struct<type:string,value:struct<bytes:binary>>>"
    return files.in_file_order(spark.read.parquet(data_dir)) if _has_parquet(spark, data_dir) else files.read_arrow_dataset(spark, data_dir, schema)


def _has_parquet(spark: SparkSession, path: str) -> bool:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return not found.select("path").limit(1).isEmpty()


@adapter("Meditron")
def meditron(spark: SparkSession, dataset_id: str, data_dir: str, image_only: bool, **_: object) -> DataFrame:
    rows = numbered(_nested_rows(spark, data_dir), "_place")
    pictures = F.transform(F.filter("modalities", lambda m: m["type"] == "image"), lambda m: m["value"]["bytes"])
    rows = rows.withColumn("pictures", pictures).filter("size(pictures) > 0")
    single = files.with_size(rows.select("sample_id", "conversations", F.posexplode("pictures").alias("k", "content")).withColumn("path", F.lit("")))
    if image_only:
        return as_samples(decoded(single), dataset_id, "image", images=image_of())
    lines = F.array_join(F.transform("conversations", lambda c: F.concat(F.coalesce(c["role"], F.lit("None")), F.lit(": "), F.coalesce(c["content"], F.lit("None")))), "\n")
    picture = F.struct("k", F.struct(F.col("content").alias("bytes"), F.lit("").alias("format"), "width", "height").alias("image"))
    grouped = decoded(single).groupBy("sample_id").agg(F.first("conversations").alias("conversations"), F.array_sort(F.collect_list(picture)).alias("p"))
    images = F.transform("p", lambda p: p["image"])
    return as_samples(grouped, dataset_id, "multi_image_text", text=text.number_placeholders(lines, F.size("p")), images=images)


@adapter("MultiCaRe")
def multicare(spark: SparkSession, data_dir: str, dataset_id: str = "multicare", **_: object) -> DataFrame:
    rows = numbered(files.in_file_order(spark.read.parquet(data_dir)).select("image", "caption", "_place"), "_place")
    rows = rows.filter("image IS NOT NULL AND caption IS NOT NULL AND caption != ''").select("sample_id", "caption", F.col("image.bytes").alias("content"), F.coalesce(F.col("image.path").cast("string"), F.lit("")).alias("path"))
    return _captioned(decoded(files.with_size(rows)), dataset_id, False)


@adapter("SCIN")
def scin(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    """Ids number the images that exist, row by row; a resumed run filters on them."""
    cells = F.posexplode(F.array("image_1_path", "image_2_path", "image_3_path"))
    table = files.in_file_order(spark.read.parquet(data_dir))
    rows = numbered(table.select("_place", cells.alias("k", "image")).filter("image IS NOT NULL"), "_place", "k")
    rows = rows.select("sample_id", F.col("image.bytes").alias("content"), F.coalesce(F.col("image.path").cast("string"), F.lit("")).alias("path"))
    return as_samples(decoded(files.with_size(rows)), "scin", "image", images=image_of())


@adapter("MedMNIST")
def medmnist(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    rows = files.read_npz(spark, [f"{data_dir}/{s}_224.npz" for s in MNIST_SUBSETS], MNIST_SPLITS, ids="sample_id")
    fields = F.create_map(F.lit("subset"), F.regexp_replace("file", "_224.npz$", ""), F.lit("split"), F.col("split"))
    return as_samples(rows, "medmnist", "image", images=image_of(form=F.lit("png")), data=fields)


#: The folder in the archive of the same name, with its table (fixed values).
ISIC_FOLDER = "ISIC_2024_Permissive_Training_Input"


@adapter("ISIC")
def isic(spark: SparkSession, data_dir: str, archive: str = f"{ISIC_FOLDER}.zip", **_: object) -> DataFrame:
    """The table is a member of the archive; ids are its lines."""
    table = read_csv_member(spark, f"{data_dir}/{archive}", "metadata.csv")
    fields = table.select(F.col("n").alias("sample_id"), F.try_element_at("row", F.lit("isic_id")).alias("isic_id"), F.to_json("row").alias("row"))
    images = list_members(spark, f"{data_dir}/{archive}", lambda p: p.lower().endswith(".jpg")).withColumn("isic_id", text.stem(F.col("path")))
    data = F.create_map(F.lit("dataset_id"), F.lit("isic"), F.lit("patient_info"), F.col("row"))
    missing = F.raise_error(F.concat(F.lit("no image of "), F.coalesce("isic_id", F.lit("a line without an id")))).cast("int")
    # No condition may be false for rows without an image before that is found an error: the height gets a stand-in.
    width, height = F.when(F.col("content").isNull(), missing).otherwise(F.col("width")), F.coalesce("height", F.lit(1))
    rows = with_payloads(fields.join(images, "isic_id", "left"), optional=True).withColumns({"width": width, "height": height})
    return as_samples(decoded(rows), "isic", "image", images=image_of(), data=data)


@adapter("UWF")
def uwf(spark: SparkSession, data_dir: str, table: str = "table.csv", **_: object) -> DataFrame:
    """Images of the two sizes in use, brought to 1300 x 1024; another size is an error."""
    records = files.read_table(spark, f"{data_dir}/{table}")
    records = numbered(files.in_file_order(records, exact=False) if table.endswith(".csv") else records.withColumn("_place", F.monotonically_increasing_id()), "_place")
    key = F.concat_ws("/", F.col("Diagnosis"), F.regexp_replace("`Image ID `", r"\.[^.]*$", ""))
    images = files.read_images(spark, [f"{data_dir}/Original UWF Image"], ("jpg", "jpeg", "png"))
    images = images.withColumn("_key", F.concat_ws("/", F.element_at(F.split("path", "/"), -2), text.stem(F.col("path"))))
    joined = records.withColumn("_key", key).join(images, "_key", "left")  # a record without its image has no size, which is an error
    fields = ("Image ID ", "Patient ID", "Eye category", "Age", "Sex", "Diagnosis")
    data = F.create_map(F.lit("dataset_id"), F.lit("uwf"), *(x for c in fields for x in (F.lit(c.strip().lower().replace(" ", "_")), F.col(f"`{c}`").cast("string"))))
    return as_samples(resized(joined, 1300, 1024, ((3900, 3072), (2600, 2048))), "uwf", "image", images=image_of(), data=data)


@adapter("RFMiD2")
def rfmid2(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    rows = files.read_images(spark, [f"{data_dir}/{d}" for d in ("Test_set", "Training_set", "Validation_set")], ("jpg",))
    return as_samples(decoded(numbered(rows, "path")), "rfmid2", "image", images=image_of())


@adapter("SLIDE")
def slide(spark: SparkSession, data_dir: str, **_: object) -> DataFrame:
    """Three archives in the order test, train, val; 2559 x 1957 images brought to 768 x 584."""
    rows = list_members(spark, f"{data_dir}/*.zip", lambda p: p.lower().endswith(".jpg"))
    rows = numbered(rows.filter(F.col("archive").rlike(r"/(test|train|val)\.zip$")), "archive", "ord")
    return as_samples(resized(with_payloads(rows), 768, 584, ((2559, 1957),)), "slide", "image", images=image_of())


def resized(rows: DataFrame, width: int, height: int, allowed: tuple[tuple[int, int], ...]) -> DataFrame:
    """Rows with images brought to the target size, as PNG; sizes other than the allowed ones end the run."""
    ship(rows.sparkSession)

    fits = F.lit(False)
    for w, h in allowed:
        fits = fits | ((F.col("width") == w) & (F.col("height") == h))
    message = F.concat(F.lit("unexpected image size "), F.coalesce(F.concat_ws("x", "width", "height"), F.lit("none")))
    checked = rows.withColumn("width", F.when(fits, F.col("width")).otherwise(F.raise_error(message).cast("int")))

    @F.pandas_udf("binary")
    def small(column: pd.Series) -> pd.Series:
        def shrink(data: bytes | None) -> bytes | None:
            image = pixels.decode_png(data)
            return None if image is None else pixels.encode_png(pixels.resize(image, width, height, "bicubic"))

        return column.map(shrink)

    found = as_png(checked.filter("width > 0"), "content").withColumn("content", small("content"))
    message = F.concat(F.lit("cannot decode "), F.col("path"))
    found = found.withColumn("content", F.coalesce("content", F.raise_error(message).cast("binary")))
    return found.withColumns({"width": F.lit(width), "height": F.lit(height), "path": F.concat("path", F.lit(".png"))})


@adapter("MedPix")
def medpix(spark: SparkSession, dataset_id: str, zip_path: str, **_: object) -> DataFrame:
    topics = _json_member(spark, zip_path, "Case_topic.json", "U_id string, TAC array<string>, MRI array<string>, `Case` map<string,string>, Topic map<string,string>")
    cases = numbered(topics, "_o").withColumn("ids", F.concat(F.coalesce("TAC", F.array()), F.coalesce("MRI", F.array())))
    notes = _json_member(spark, zip_path, "Descriptions.json", "image string, Description map<string,string>")
    notes = last_wins(notes, "image", "_o", "Description")
    images = list_members(spark, zip_path, lambda p: p.lower().endswith((".png", ".jpg", ".jpeg")), nested=True).withColumn("image", text.stem(F.col("path")))
    each = cases.select("sample_id", F.posexplode("ids").alias("k", "image")).join(images, "image").join(notes, "image", "left")
    part = lambda c: F.coalesce(F.try_element_at("Description", F.lit(c)), F.lit(""))
    meta = F.concat_ws(", ", F.nullif(part("Modality"), F.lit("")), F.nullif(part("Plane"), F.lit("")))
    line = F.concat(F.when(meta != "", F.concat(F.lit(" ["), meta, F.lit("]"))).otherwise(F.lit("")), F.when(part("Caption") != "", F.concat(F.lit(" "), part("Caption"))).otherwise(F.lit("")))
    form = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    listed = each.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line"), form.alias("format"), place(images).alias("place")))).alias("listed"))
    listed = listed.withColumn("places", F.transform("listed", lambda p: p["place"])).join(cases, "sample_id")
    read = with_payload_arrays(listed, "places")
    entry = lambda i: F.get("listed", i)
    pictures = F.transform("payloads", lambda x, i: F.struct(entry(i)["line"].alias("line"), F.struct(x["content"].alias("bytes"), entry(i)["format"].alias("format"), x["width"], x["height"]).alias("image")))
    grouped = read.withColumn("p", F.filter(pictures, lambda p: (p["image"]["width"] > 0) & (p["image"]["height"] > 0))).filter("size(p) > 0")
    case, topic = (lambda c: F.try_element_at("Case", F.lit(c))), (lambda c: F.try_element_at("Topic", F.lit(c)))
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), F.nullif(text.truthy(case("Title"), topic("Title")), F.lit(""))),
        F.nullif(
            text.sections(
                ("History", case("History")),
                ("Findings", case("Findings")),
                ("Diagnosis", text.truthy(case("Case Diagnosis"), case("Differential Diagnosis"))),
                ("Discussion", topic("Disease Discussion")),
            ),
            F.lit(""),
        ),
        F.array_join(F.transform("p", lambda p, i: F.concat(text.image_token(i + 1), p["line"])), "\n"),
    )
    return as_samples(grouped, dataset_id, "multi_image_text", text=body, images=F.transform("p", lambda p: p["image"]), data=F.create_map(F.lit("u_id"), F.col("U_id")))


def _json_member(spark: SparkSession, zip_path: str, name: str, fields: str) -> DataFrame:
    """The objects of one JSON array in an archive, with their place ``_o``."""
    member = read_members(spark, zip_path, lambda p: p.split("/")[-1] == name)
    struct = "struct<" + ", ".join(f"{a}:{b}" for a, b in (f.split(" ", 1) for f in fields.split(", "))) + ">"
    return member.select(F.posexplode(F.from_json(F.col("content").cast("string"), f"array<{struct}>")).alias("_o", "o")).select("_o", "o.*")


@adapter("HoloAssist")
def holoassist(
    spark: SparkSession, data_dir: str, min_laplacian_threshold: float, avg_laplacian_threshold: float, imagehash_tolerance: int, sample_rate: int = 12, **_: object
) -> DataFrame:
    """From a table of decoded frames (video, frame_index, pixels as PNG): stride, sharpness, near-duplicates."""
    return _frames(spark, data_dir, "holoassist", sample_rate, min_laplacian_threshold, avg_laplacian_threshold, imagehash_tolerance, "phash")


@adapter("EgoExo4D")
def egoexo4d(
    spark: SparkSession, data_dir: str, laplacian_threshold: float, imagehash_tolerance: int, aria_map_x_path: str | None = None, aria_map_y_path: str | None = None, size: int | None = None, **_: object
) -> DataFrame:
    """From a table of decoded frames, straightened by two maps of places and brought to ``size``, where these are given.

    Videos are those of ``takes.json`` in ``data_dir``, in its order; all of the table where there is none.
    """
    maps = None
    if aria_map_x_path and aria_map_y_path:
        with open_file(aria_map_x_path) as x, open_file(aria_map_y_path) as y:
            maps = np.load(x), np.load(y)

    def prepare(image: np.ndarray) -> np.ndarray:
        if maps is not None:
            image = pixels.remap(image, *maps)
        return image if size is None else pixels.resize(image, size, size)

    return _frames(spark, data_dir, "egoexo4d", None, None, laplacian_threshold, imagehash_tolerance, "dhash", prepare if maps is not None or size else None, _takes(spark, data_dir))


def _takes(spark: SparkSession, data_dir: str) -> DataFrame | None:
    """The video of each take (video, take), None without a list; a take without just one rgb video of its glasses is an error."""
    lists = spark.read.format("binaryFile").option("pathGlobFilter", "takes.json").load(data_dir).select(F.col("content").cast("string").alias("json"))
    if lists.isEmpty():
        return None
    kind = "array<struct<take_name:string,root_dir:string,frame_aligned_videos:map<string,map<string,struct<relative_path:string>>>>>"
    takes = lists.select(F.posexplode(F.from_json("json", kind)).alias("take", "t")).select("take", "t.*")
    worn = F.filter(F.map_entries("frame_aligned_videos"), lambda e: F.lower(e["key"]).contains("aria"))
    rgb = F.try_element_at(F.get(worn, F.lit(0))["value"], F.lit("rgb"))["relative_path"]
    wrong = F.raise_error(F.concat(F.lit("no single rgb video of the glasses in "), F.coalesce("take_name", F.lit("a take")))).cast("string")
    video = F.concat_ws("/", "root_dir", rgb)
    return takes.select("take", F.when((F.size(worn) == 1) & rgb.isNotNull(), video).otherwise(wrong).alias("video"))


def _frames(
    spark: SparkSession,
    data_dir: str,
    dataset_id: str,
    stride: int | None,
    least: float | None,
    mean: float,
    tolerance: int,
    kind: str,
    prepare: Callable[[np.ndarray], np.ndarray] | None = None,
    takes: DataFrame | None = None,
) -> DataFrame:
    ship(spark)

    @F.pandas_udf("sharp boolean, bits string, width int, height int")
    def looked(column: pd.Series) -> pd.DataFrame:
        rows = []
        for data in column:
            rgb = pixels.decode_png(data)
            if rgb is None:
                rows.append((False, "0" * 64, None, None))
                continue
            rgb = rgb if prepare is None else prepare(rgb)
            gray = pixels.to_gray(rgb)
            if kind == "phash":
                low, average = pixels.grid_sharpness(gray)
                code = imghash.phash(pixels.resize(gray, 32, 32))
            else:
                low, average = 0.0, pixels.masked_sharpness(gray, pixels.circle_mask(*gray.shape))
                code = imghash.dhash(pixels.resize(gray, 9, 8))
            sharp = average >= mean and (least is None or low >= least)
            rows.append((sharp, f"{int(code, 16):064b}", rgb.shape[1], rgb.shape[0]))
        return pd.DataFrame(rows, columns=["sharp", "bits", "width", "height"]).astype({"width": "Int32", "height": "Int32"})

    @F.pandas_udf("binary")
    def prepared(column: pd.Series) -> pd.Series:
        return column.map(lambda data: pixels.encode_png(prepare(pixels.decode_png(data))))

    frames = spark.read.option("pathGlobFilter", "*.parquet").parquet(data_dir)
    if takes is not None:
        frames = frames.join(F.broadcast(takes), "video")
    flags = frames.select("video", "frame_index", looked("pixels").alias("l")).select("video", "frame_index", "l.*").filter("width IS NOT NULL")
    kept = gate_frames(flags, "video", "frame_index", stride, "sharp", "bits", tolerance)
    rows = kept.join(frames.withColumnRenamed("pixels", "content"), ["video", "frame_index"])
    rows = numbered(rows, *(["take"] if takes is not None else []), "video", "frame_index")
    if prepare is not None:
        rows = rows.withColumn("content", prepared("content"))
    fields = F.create_map(F.lit("video"), F.col("video"), F.lit("frame_index"), F.col("frame_index").cast("string"))
    return as_samples(rows, dataset_id, "image", images=image_of(form=F.lit("png")), data=fields)


@adapter("MMC4")
def mmc4(spark: SparkSession, data_dir: str = "", enabled: bool = False, in_flight: int = 32, download_timeout: float = web.TIMEOUT, **_: object) -> DataFrame:
    """Images named by documents of JSON lines in zips inside zips, fetched from the web; disabled unless asked for.

    Ids number the addresses, so a fetch that fails leaves a gap.
    """
    if not enabled:
        raise NotImplementedError("MMC4 fetches images from the web and is disabled; set enabled to run it")
    documents = web.json_lines(read_members(spark, f"{data_dir}/mmc4_*.zip", lambda p: p.endswith(".jsonl"), nested=True))
    urls = numbered(web.image_addresses(documents), "archive", "ord", "line_no", "k")
    fetched = files.with_size(web.fetch(urls.select("sample_id", "url"), in_flight=in_flight, timeout=download_timeout))
    return as_samples(decoded(fetched.withColumn("path", F.col("url"))), "mmc4", "image", images=image_of(), data=F.create_map(F.lit("url"), F.col("url")))


def build(spark: SparkSession, config: dict[str, object], position: int = 0) -> DataFrame:
    """The samples of one configuration entry; an unknown id is an error."""
    options = dict(config)
    name = str(options.pop("id"))
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name!r}; known: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name](spark, **options).withColumn("adapter_pos", F.lit(position))
