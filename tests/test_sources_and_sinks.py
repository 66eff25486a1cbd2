"""Archives, adapters, image filters, sinks, state and the configured run, over generated fixtures."""

import io
import json
import tarfile
import warnings
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom import pipeline, schema
from corpusloom.functions.pixels import decode_png, encode_png, image_size
from corpusloom.operators import images
from corpusloom.sinks import shards
from corpusloom.sources import adapters, archives
from corpusloom.state.tables import HashStore, Manifest, Progress


def png(seed: int, w: int = 12, h: int = 10) -> bytes:
    return encode_png(np.random.default_rng(seed).integers(0, 255, (h, w, 3), np.uint8))


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


@pytest.fixture(scope="module")
def mri(tmp_path_factory):
    path = tmp_path_factory.mktemp("mri") / "mri.zip"
    make_zip(
        path,
        [
            ("Training/glioma/a.png", png(1)),
            ("Training/unknown/b.png", png(2)),
            ("Training/glioma/readme.txt", b"no"),
            ("Testing/notumor/c.PNG", b"broken"),
            ("Other/glioma/d.png", png(4)),
            ("Testing/notumor/e.png", png(5)),
            ("Testing/pituitary/f.png", png(1)),
        ],
    )
    return str(path)


def test_png_round_trip_and_header():
    pixels = np.random.default_rng(0).integers(0, 255, (5, 7, 3), np.uint8)
    data = encode_png(pixels)
    assert image_size(data) == (7, 5)
    assert (decode_png(data) == pixels).all()
    assert decode_png(b"nonsense") is None and image_size(None) is None
    assert decode_png(data[:-20]) is None


def test_class_map_adapter_numbers_eligible_members(spark, mri):
    rows = adapters.build(spark, {"id": "BrainTumorMRI", "zip_path": mri}).orderBy("sample_id").collect()
    # c.PNG is eligible and takes id 1, then goes because it cannot be decoded.
    assert [(r["sample_id"], r["data"]["file_path"]) for r in rows] == [(0, "Training/glioma/a.png"), (2, "Testing/notumor/e.png"), (3, "Testing/pituitary/f.png")]
    assert rows[0]["text"] == "<|img1|>\nAn MRI scan of the brain showing a glioma tumor."
    assert rows[0]["images"][0]["width"] == 12


def test_unknown_names_are_errors(spark):
    with pytest.raises(ValueError, match="unknown adapter"):
        adapters.build(spark, {"id": "Nothing"})
    with pytest.raises(ValueError, match="unknown filter"):
        images.build({"id": "Nothing"})
    with pytest.raises(NotImplementedError):
        adapters.build(spark, {"id": "MMC4"})
    assert len(adapters.ADAPTERS) == 26


def test_tar_zst_and_damaged_archives(spark, tmp_path):
    import zstandard

    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as t:
        for name in ("ds/img/High-grade IN_1.png", "ds/img/Normal_2.png", "ds/ann/x.json"):
            info = tarfile.TarInfo(name)
            data = png(3)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "a.tar").write_bytes(plain.getvalue())
    (tmp_path / "b.tar.zst").write_bytes(zstandard.compress(plain.getvalue()))
    rows = adapters.build(spark, {"id": "EBHISeg", "tar_path": str(tmp_path / "a.tar")}).orderBy("sample_id").collect()
    assert [r["text"].splitlines()[1] for r in rows] == [
        "A histopathology image of colorectal tissue showing high-grade intraepithelial neoplasia.",
        "A histopathology image of normal colorectal tissue.",
    ]
    assert archives.read_members(spark, str(tmp_path / "b.tar.zst")).count() == 3
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert list(archives.iter_members(io.BytesIO(b"PKbroken"), "c.zip")) == []


def test_archive_data_source(spark, mri):
    archives.register(spark)
    rows = spark.read.format("archive").option("suffixes", ".png").option("prefix", "Training").load(mri)
    assert [r["path"] for r in rows.orderBy("ord").collect()] == ["Training/glioma/a.png", "Training/unknown/b.png"]


def test_medmax_train_overrides(spark, tmp_path):
    body = io.BytesIO()
    with tarfile.open(fileobj=body, mode="w:gz") as t:
        for name in ("x/1.png", "x/2.png", "x/3.png"):
            info = tarfile.TarInfo(name)
            data = png(7)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    (tmp_path / "im.tar.gz").write_bytes(body.getvalue())
    line = lambda p, c: json.dumps({"image_path": p, "text": c, "task": "t", "source": "s"})
    (tmp_path / "validation.jsonl").write_text(line("x/1.png", "old") + "\n" + line("x/2.png", "two"))
    (tmp_path / "train.jsonl").write_text(line("x/1.png", "new"))
    rows = adapters.build(spark, {"id": "MedMax", "data_dir": str(tmp_path), "image_only": False}).orderBy("sample_id").collect()
    assert [r["text"] for r in rows] == ["<|img1|>\nnew", "<|img1|>\ntwo"]


def test_meditron_numbers_placeholders(spark, tmp_path):
    picture = lambda k: {"type": "image", "value": {"bytes": png(k)}}
    rows = [
        {"conversations": [{"role": "user", "content": "see <|reserved_special_token_0|> and"}, {"role": "assistant", "content": "ok"}], "modalities": [picture(1), picture(2)]},
        {"conversations": [{"role": "user", "content": "none"}], "modalities": []},
        {"conversations": [{"role": "user", "content": "x <|reserved_special_token_0|> y <|reserved_special_token_0|>"}], "modalities": [picture(3)]},
    ]
    table = pa.Table.from_pylist(rows)
    import pyarrow.parquet as pq

    pq.write_table(table, tmp_path / "part.parquet")
    out = adapters.build(spark, {"id": "Meditron", "dataset_id": "m", "data_dir": str(tmp_path), "image_only": False}).orderBy("sample_id").collect()
    assert [(r["sample_id"], len(r["images"])) for r in out] == [(0, 2), (2, 1)]
    assert out[0]["text"] == "<|img2|>\nuser: see <|img1|> and\nassistant: ok"
    assert out[1]["text"] == "user: x <|img1|> y <|reserved_special_token_0|>"
    assert adapters.build(spark, {"id": "Meditron", "dataset_id": "m", "data_dir": str(tmp_path), "image_only": True}).count() == 3


def test_scin_and_multicare(spark, tmp_path):
    image = lambda k: {"bytes": png(k), "path": None}
    import pyarrow.parquet as pq

    pq.write_table(pa.Table.from_pylist([{"image_1_path": image(1), "image_2_path": None, "image_3_path": image(2)}, {"image_1_path": image(3), "image_2_path": image(4), "image_3_path": None}]), tmp_path / "s.parquet")
    assert [r[0] for r in adapters.build(spark, {"id": "SCIN", "data_dir": str(tmp_path / "s.parquet")}).select("sample_id").orderBy("sample_id").collect()] == [0, 1, 2, 3]
    pq.write_table(pa.Table.from_pylist([{"image": image(1), "caption": ""}, {"image": image(2), "caption": "c"}]), tmp_path / "m.parquet")
    rows = adapters.build(spark, {"id": "MultiCaRe", "data_dir": str(tmp_path / "m.parquet")}).collect()
    assert [(r["sample_id"], r["text"]) for r in rows] == [(1, "<|img1|>\nc")]


def test_medpix_text_and_order(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("images/i1.png", png(1))
        z.writestr("images/i2.png", png(2))
    cases = [
        {"U_id": "u", "TAC": ["i2"], "MRI": ["i1", "gone"], "Case": {"Title": "", "History": "N/A", "Findings": "f", "Case Diagnosis": "", "Differential Diagnosis": "dd"}, "Topic": {"Title": "topic", "Disease Discussion": "d"}},
    ]
    notes = [{"image": "i2", "Description": {"Caption": "cap", "Modality": "CT", "Plane": "Axial"}}]
    path = tmp_path / "medpix.zip"
    make_zip(path, [("Case_topic.json", json.dumps(cases)), ("Descriptions.json", json.dumps(notes)), ("images.zip", inner.getvalue())])
    row = adapters.build(spark, {"id": "MedPix", "dataset_id": "p", "zip_path": str(path)}).first()
    assert row["text"] == "Title: topic\nFindings: f\nDiagnosis: dd\nDiscussion: d\n<|img1|> [CT, Axial] cap\n<|img2|>"
    assert len(row["images"]) == 2


def test_medmnist_blocks(spark, tmp_path):
    for k, name in enumerate(adapters.MNIST_SUBSETS):
        np.savez(tmp_path / f"{name}_224.npz", **{f"{s}_images": np.full((1, 4, 4) if k else (1, 4, 4, 3), k, np.uint8) for s in adapters.MNIST_SPLITS})
    rows = adapters.build(spark, {"id": "MedMNIST", "data_dir": str(tmp_path)}).orderBy("sample_id").collect()
    assert [(r["data"]["subset"], r["data"]["split"]) for r in rows] == [(s, p) for s in adapters.MNIST_SUBSETS for p in adapters.MNIST_SPLITS]


def test_frames(spark, tmp_path):
    noise = [np.random.default_rng(k).integers(0, 255, (32, 56, 3), np.uint8) for k in range(3)]
    flat = np.full((32, 56, 3), 9, np.uint8)
    rows = [("v", 0, noise[0]), ("v", 5, noise[1]), ("v", 20, flat), ("v", 21, noise[0]), ("v", 40, noise[2]), ("w", 0, noise[0])]
    spark.createDataFrame([(v, i, bytearray(encode_png(p))) for v, i, p in rows], "video string, frame_index long, pixels binary").write.parquet(str(tmp_path / "f"))
    config = {"id": "HoloAssist", "data_dir": str(tmp_path / "f"), "min_laplacian_threshold": 10, "avg_laplacian_threshold": 1000, "imagehash_tolerance": 8}
    kept = [(r["data"]["video"], r["data"]["frame_index"]) for r in adapters.build(spark, config).orderBy("sample_id").collect()]
    assert kept == [("v", "0"), ("v", "40"), ("w", "0")]
    ego = {"id": "EgoExo4D", "data_dir": str(tmp_path / "f"), "laplacian_threshold": 400, "imagehash_tolerance": 5}
    assert adapters.build(spark, ego).count() == 4


def samples(spark, n, size=12, kind="image"):
    rows = [("d", k, bytearray(png(k % 5, size, size)), size) for k in range(n)]
    df = spark.createDataFrame(rows, "dataset_id string, sample_id long, b binary, s int")
    image = F.array(F.struct(F.col("b").alias("bytes"), F.lit("png").alias("format"), F.col("s").alias("width"), F.col("s").alias("height")))
    return schema.as_samples(df, "d", kind, images=image, text=F.lit("cap"))


def test_filters_gate_by_type_and_size(spark):
    df = samples(spark, 3, 12).unionByName(samples(spark, 2, 70)).unionByName(samples(spark, 2, 12, "multi_image_text"))
    assert df.transform(images.build({"id": "ImageResolution", "min_width": 64, "min_height": 64})).count() == 4
    small = df.transform(images.build({"id": "ImageDownsample", "max_pixels": 100, "pil_resample": 1})).filter("sample_type = 'image'")
    assert {(r["images"][0]["width"], image_size(bytes(r["images"][0]["bytes"]))) for r in small.collect()} == {(10, (10, 10))}


def test_dedup_is_idempotent_with_a_store(spark, tmp_path):
    df = samples(spark, 8)
    kept = df.transform(images.build({"id": "ImageDeduplication", "algorithm": "phash"}))
    assert sorted(r["sample_id"] for r in kept.collect()) == [0, 1, 2, 3, 4]
    store = HashStore(spark, str(tmp_path / "store"))
    store.add(images.with_image_hash(kept, "phash"))
    again = df.transform(images.build({"id": "ImageDeduplication", "algorithm": "phash", "db_path": str(tmp_path / "store")}))
    assert sorted(r["sample_id"] for r in again.collect()) == [0, 1, 2, 3, 4]
    other = samples(spark, 8).withColumn("dataset_id", F.lit("e"))
    assert other.transform(images.build({"id": "ImageDeduplication", "db_path": str(tmp_path / "store")})).count() == 0


def test_arrow_shards(spark, tmp_path):
    df = samples(spark, 10)
    size = len(png(0, 12, 12))
    shards.write_arrow(df, str(tmp_path), target_shard_bytes=3 * size, include_caption=True, batch_size=2)
    names = sorted(p.name for p in (tmp_path / "d").glob("*.arrow"))
    assert names == [f"data-{k:05d}.arrow" for k in range(3)]  # chunks of two: four, four, two samples
    with pa.ipc.open_stream((tmp_path / "d" / names[0]).read_bytes()) as reader:
        table = reader.read_all()
    assert table.column_names == ["dataset_id", "sample_id", "image", "caption"] and table.num_rows == 4
    assert json.loads((tmp_path / "d" / ".stats.json").read_text())["total_samples"] == 10
    shards.write_arrow(df, str(tmp_path), target_shard_bytes=10**9, batch_size=2)
    assert (tmp_path / "d" / "data-00003.arrow").exists()
    assert json.loads((tmp_path / "d" / "dataset_info.json").read_text())["splits"]["train"]["num_examples"] == 20


def test_tar_shards(spark, tmp_path):
    df = samples(spark, 5, kind="multi_image_text")
    shards.write_tars(df, str(tmp_path), maxcount=2)
    assert sorted(p.name for p in tmp_path.glob("*.tar")) == ["part-000000.tar", "part-000001.tar", "part-000002.tar"]
    with tarfile.open(tmp_path / "part-000000.tar") as t:
        assert t.getnames() == ["d__00000000.img1.png", "d__00000000.txt", "d__00000001.img1.png", "d__00000001.txt"]
        assert t.extractfile("d__00000000.txt").read() == b"<|img1|>\ncap"


def test_configured_run_resumes_and_skips(spark, tmp_path, mri):
    config = {
        "adapters": [{"id": "BrainTumorMRI", "zip_path": mri}],
        "filters": [{"id": "ImageResolution", "min_width": 4}],
        "writer": {"type": "webdataset", "output_dir": str(tmp_path / "out"), "maxcount": 2},
        "pipeline": {"log_file": str(tmp_path / "log"), "manifest_db": str(tmp_path / "m"), "checkpoint_db": str(tmp_path / "c"), "num_workers": 2, "batch_size": 2},
    }
    assert pipeline.run(spark, config, debug=True) == {"brain_tumor_mri": {"processed": 2, "passed": 2}}
    assert Progress(spark, str(tmp_path / "c")).get("brain_tumor_mri") == (2, False)
    assert pipeline.run(spark, config) == {"brain_tumor_mri": {"processed": 1, "passed": 1}}
    assert pipeline.run(spark, config) == {}
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert [r["sample_id"] for r in manifest.dataset("brain_tumor_mri").collect()] == [0, 2, 3]
    assert manifest.exists("brain_tumor_mri", 2) and not manifest.exists("brain_tumor_mri", 1)
    with pytest.raises(KeyError):
        pipeline.run(spark, {"adapters": []})


def test_serialized_samples(spark):
    df = samples(spark, 2)
    back = schema.deserialize(schema.serialize(df))
    assert back.drop("images", "data").exceptAll(df.drop("images", "data")).isEmpty() and back.count() == 2
    bad = schema.serialize(df.withColumn("sample_type", F.lit("video")))
    with pytest.raises(Exception, match="unknown sample type"):
        schema.deserialize(bad).collect()


def test_json_lines_in_nested_archives_and_fetching(spark, tmp_path):
    import http.server
    import threading

    from corpusloom.sources import web

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if self.path.startswith("/ok") else 404)
            self.end_headers()
            self.wfile.write(self.path.encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    doc = lambda *urls: json.dumps({"image_info": [{"raw_url": u} for u in urls]})
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("d/a.jsonl", "\n".join([doc(f"{base}/ok1", None, ""), "broken {", doc(f"{base}/gone", f"{base}/ok2", "no://where")]))
    make_zip(tmp_path / "mmc4.zip", [("part.zip", inner.getvalue()), ("bad.zip", b"PKbroken")])
    members = archives.read_members(spark, str(tmp_path / "mmc4.zip"), lambda p: p.endswith(".jsonl"), nested=True)
    urls = web.image_addresses(web.json_lines(members))
    assert [(r["line_no"], r["k"]) for r in urls.orderBy("line_no", "k").collect()] == [(0, 0), (2, 0), (2, 1), (2, 2)]
    assert sorted(bytes(r["content"]) for r in web.fetch(urls, in_flight=2).collect()) == [b"/ok1", b"/ok2"]
    server.shutdown()
