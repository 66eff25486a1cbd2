"""Runs that stop and resume, resampling kernels, gates over frames, and fetched images."""

import http.server
import io
import json
import os
import random
import tarfile
import threading
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom import pipeline
from corpusloom.functions import pixels
from corpusloom.operators import folds
from corpusloom.runtime import discard, stored
from corpusloom.sinks import shards
from corpusloom.sources import adapters
from corpusloom.state import commits
from corpusloom.state.tables import HashStore, Manifest, Progress
from tests.test_sources_and_sinks import make_zip, png


@pytest.mark.parametrize("kind", ["nearest", *pixels.KERNELS])
def test_kernels_keep_what_is_even(kind):
    flat = np.full((37, 53, 3), 91, np.uint8)
    for w, h in ((10, 7), (53, 37), (101, 80), (1, 1)):
        assert (pixels.resize(flat, w, h, kind) == 91).all() and pixels.resize(flat, w, h, kind).shape == (h, w, 3)
    ramp = np.tile(np.arange(0, 240, 3, dtype=np.uint8), (8, 1))
    small = pixels.resize(ramp, 20, 4, kind).astype(int)
    assert (np.diff(small[0]) > 0).all() and abs(small.mean() - ramp.mean()) <= 2


def test_kernels_by_hand():
    gray = np.array([[0, 0, 100, 100, 40, 60, 7, 9]] * 2, np.uint8)
    assert pixels.resize(gray, 4, 1, "box").tolist() == [[0, 100, 50, 8]]
    assert pixels.resize(gray, 4, 1, "nearest").tolist() == [[0, 100, 60, 9]]
    # Bilinear at half size: weights 1, 3, 3, 1 (eighths), cut at the border.
    assert pixels.resize(gray, 4, 1, "bilinear")[0, 1] == int((0 + 3 * 100 + 3 * 100 + 40) / 8 + 0.5)
    # Weights by the cubic and the windowed sinc at the distances of a doubling, by the formulas.
    x = np.array([0.25, 0.75, 1.25, 1.75])
    cubic = [1.5 * v**3 - 2.5 * v**2 + 1 if v < 1 else -0.5 * (v**3 - 5 * v**2 + 8 * v - 4) for v in x]
    assert np.allclose(pixels.KERNELS["bicubic"][1](x), cubic)
    sinc = lambda v: np.sin(np.pi * v) / (np.pi * v)
    assert np.allclose(pixels.KERNELS["lanczos"][1](x), sinc(x) * sinc(x / 3))


def loadable_after(data, at):
    """The size of an image with one byte changed."""
    return pixels.loadable_size(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def test_truncated_images_have_no_size():
    whole = png(3)
    assert pixels.loadable_size(whole) == (12, 10) and pixels.loadable_size(whole[:-12]) is None
    assert loadable_after(whole, 45) is None and loadable_after(whole, 20) is None  # in the pixels, in the header
    head = b"\xff\xd8\xff\xc0\x00\x11\x08\x00\x05\x00\x07\x03" + bytes(20)
    assert pixels.loadable_size(head) is None and pixels.loadable_size(head + b"\xff\xd9") == (7, 5)


#: Where a run dies in its second stretch: after a step has done its work, before the commit, or in the publishing after it.
DEATHS = ["files staged", "manifest staged", "owners staged", "progress staged", "not committed", "committed", "moved 3", "moved all"]


def die(m, step, sink):
    """Let the second stretch die at a step."""
    calls = {"n": 0}

    def after(owner, name, at=2):
        real = getattr(owner, name)

        def call(*args, **kwargs):
            out = real(*args, **kwargs)
            calls["n"] += 1
            if calls["n"] == at:
                raise RuntimeError("lost")
            return out

        m.setattr(owner, name, call)

    if step == "files staged":
        after(type(sink), "stage")
    elif step == "manifest staged":
        after(Manifest, "add")
    elif step == "owners staged":
        after(HashStore, "add")
    elif step == "progress staged":
        after(Progress, "update")
    elif step == "committed":
        after(commits.CommitLog, "commit")
    elif step == "moved all":
        real = commits.put

        def put(spark, path, content):
            calls["n"] += "/commits/" not in path
            if calls["n"] > PUTS[sink]:
                raise RuntimeError("lost")
            real(spark, path, content)

        m.setattr(commits, "put", put)
    elif step == "not committed":
        real_commit, n = commits.CommitLog.commit, {"n": 0}

        def refuse(*args, **kwargs):
            n["n"] += 1
            if n["n"] == 2:
                raise RuntimeError("lost")
            return real_commit(*args, **kwargs)

        m.setattr(commits.CommitLog, "commit", refuse)
    else:
        real_publish, n = commits.CommitLog.publish, {"n": 0}

        def some(self, record):
            n["n"] += 1
            if n["n"] == 2:
                commits.publish(self.spark, record["moves"][: int(step.split()[1])], {})
                raise RuntimeError("lost")
            real_publish(self, record)

        m.setattr(commits.CommitLog, "publish", some)


#: Metadata files that the first stretch puts.
PUTS = {shards.write_tars: 1, shards.write_arrow: 3, shards.write_parquet: 0}


@pytest.mark.parametrize(("writer", "step"), [*(("webdataset", d) for d in DEATHS), ("huggingface", "moved all"), ("parquet", "committed")])
def test_a_run_that_dies_anywhere_leaves_each_sample_once(spark, tmp_path, monkeypatch, step, writer):
    make_zip(tmp_path / "mri.zip", [(f"Training/glioma/{k}.png", png(k)) for k in range(10)])
    entry = {"id": "BrainTumorMRI", "zip_path": str(tmp_path / "mri.zip")}
    options = {"output_dir": str(tmp_path / "out")} | {"webdataset": {"maxcount": 2}, "huggingface": {"target_shard_bytes": 1}, "parquet": {}}[writer]
    config = {
        "adapters": [entry],
        "filters": [{"id": "ImageDeduplication", "db_path": str(tmp_path / "h")}],
        "writer": {"type": writer, **options},
        "pipeline": {"log_file": "", "manifest_db": str(tmp_path / "m"), "checkpoint_db": str(tmp_path / "c"), "num_workers": 2, "batch_size": 2, "commit_batches": 2},
    }

    def as_image(session, options, position):  # the Arrow sink takes single images only
        rows = adapters.build(session, options, position)
        return rows.withColumn("sample_type", F.lit("image_text"))

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        die(m, step, shards.WRITERS[writer])
        pipeline.run(spark, config, source=as_image)
    committed = step in ("committed", "moved 1", "moved 3", "moved all")
    assert len(commits.CommitLog(spark, str(tmp_path / "c")).numbers()) == 1 + committed
    assert pipeline.run(spark, config, source=as_image)["brain_tumor_mri"]["processed"] == (2 if committed else 6)
    assert Progress(spark, str(tmp_path / "c")).get("brain_tumor_mri") == (9, True)
    assert [r["sample_id"] for r in Manifest(spark, str(tmp_path / "m")).dataset("brain_tumor_mri").collect()] == list(range(10))
    assert sorted(r["sample_id"] for r in HashStore(spark, str(tmp_path / "h")).read().collect()) == list(range(10))
    left = [p for p in tmp_path.rglob("*") if p.name.startswith((".pending-", ".staging-", "_files.json"))]
    assert left == []
    out = tmp_path / "out"
    if writer == "webdataset":
        keys = []
        for path in sorted(out.glob("*.tar")):
            keys += [n for n in tarfile.open(path).getnames() if n.endswith(".txt")]
        assert keys == [f"brain_tumor_mri__{k:08d}.txt" for k in range(10)]
        assert json.loads((out / ".stats.json").read_text()) == {"total_samples": 10, "dataset_samples": {"brain_tumor_mri": 10}, "files": 5}
    elif writer == "huggingface":
        state = json.loads((out / "brain_tumor_mri" / "state.json").read_text())
        info = json.loads((out / "brain_tumor_mri" / "dataset_info.json").read_text())
        names = [f["filename"] for f in state["_data_files"]]
        assert info["splits"]["train"]["num_examples"] == 10 and names == sorted(p.name for p in (out / "brain_tumor_mri").glob("*.arrow"))
        ids = [i for n in names for i in pa.ipc.open_stream((out / "brain_tumor_mri" / n).read_bytes()).read_all()["sample_id"].to_pylist()]
        assert ids == list(range(10))
    else:
        assert sorted(r["sample_id"] for r in spark.read.parquet(str(out)).collect()) == list(range(10))


def test_tables_are_folded_and_additions_read_their_buckets_only(spark, tmp_path, monkeypatch):
    from corpusloom.state import tables

    store = HashStore(spark, str(tmp_path / "h"))
    hashes = lambda a, b: spark.createDataFrame([(f"{k:016x}", "d", k) for k in range(a, b)], "img_hash string, dataset_id string, sample_id long")
    for k in range(3):
        store.add(hashes(5 * k, 5 * k + 10))
    want = sorted((f"{k:016x}", k) for k in range(20))
    rows = lambda: sorted((r["img_hash"], r["sample_id"]) for r in store.read().collect())
    assert rows() == want and len(store._runs()[0]) == 3
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        store.compact(2)  # dies after the new folder is shown, before the old ones go
    assert rows() == want and len(store._runs()[0]) == 1 and len(store._runs()[1]) == 3
    store.compact(2)
    assert rows() == want and len(commits.names_in(spark, store.path)) == 1
    store.add(hashes(19, 21))
    assert rows() == [*want, (f"{20:016x}", 20)] and store.read().filter("img_hash IS NULL").count() == 0
    bucket = store.read().first()["bucket"]
    plan = store.read().filter(F.col("bucket").isin([bucket]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan or "PartitionFilters: [bucket" in plan, plan


def test_images_are_shuffled_once_by_a_sink(spark, tmp_path, monkeypatch):
    """The layout reads no image column but its length; what is written passes one exchange."""
    make_zip(tmp_path / "mri.zip", [(f"Training/glioma/{k}.png", png(k)) for k in range(6)])
    rows = stored(adapters.build(spark, {"id": "BrainTumorMRI", "zip_path": str(tmp_path / "mri.zip")}))
    seen = []
    monkeypatch.setattr(shards, "written", lambda placed, keys, order, *rest: seen.append(placed.repartition(*keys).sortWithinPartitions(*keys, *order)) or [])
    shards.tar_files(rows, str(tmp_path / "s"), 2)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    discard(rows)
    assert not rows.inputFiles() or not any(os.path.exists(f.removeprefix("file://")) for f in rows.inputFiles())


def test_gates_equal_a_plain_fold(spark):
    rng = random.Random(4)
    rows = [(f"v{k % 3}" if k % 10 else None, rng.randrange(400), rng.random() < 0.8, "".join(rng.choice("01") for _ in range(16))) for k in range(600)]
    rows = list({(v, i): (v, i, s, b) for v, i, s, b in rows}.values())
    want = []
    for video in {v for v, *_ in rows}:
        last, kept = None, []
        for v, i, sharp, bits in sorted((r for r in rows if r[0] == video), key=lambda r: r[1]):
            if sharp and (last is None or i > last + 3) and all(sum(a != b for a, b in zip(bits, k, strict=True)) >= 4 for k in kept):
                last = i
                kept.append(bits)
                want.append((v, i))
    df = spark.createDataFrame(rows, "v string, i int, sharp boolean, bits string").repartition(5)
    got = folds.gate_frames(df, "v", "i", 3, "sharp", "bits", 4).select("v", "i").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_images_named_by_documents_are_fetched_on_request(spark, tmp_path):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if "ok" in self.path else 404)
            self.end_headers()
            self.wfile.write(png(7) if self.path.endswith("1") else b"no image")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("d/a.jsonl", json.dumps({"image_info": [{"raw_url": f"{base}/{u}"} for u in ("gone", "ok1", "ok2")]}))
    make_zip(tmp_path / "mmc4_0.zip", [("part.zip", inner.getvalue())])
    (row,) = adapters.build(spark, {"id": "MMC4", "data_dir": str(tmp_path), "enabled": True}).collect()
    assert row["sample_id"] == 1 and row["images"][0]["width"] == 12 and row["data"]["url"] == f"{base}/ok1"
    server.shutdown()


def test_frames_are_straightened_in_the_order_of_takes(spark, tmp_path):
    rng = np.random.default_rng(5)
    frames = [(f"takes/{v}/videos/rgb.mp4", k, pixels.encode_png(rng.integers(0, 255, (24, 32, 3), np.uint8))) for v in ("b", "a", "unused") for k in range(2)]
    spark.createDataFrame(frames, "video string, frame_index long, pixels binary").coalesce(1).write.parquet(str(tmp_path / "d"))
    take = lambda v: {"take_name": v, "root_dir": f"takes/{v}", "frame_aligned_videos": {"aria01": {"rgb": {"relative_path": "videos/rgb.mp4"}, "slam": {"relative_path": "x"}}, "cam1": {"0": {"relative_path": "y"}}}}
    (tmp_path / "d" / "takes.json").write_text(json.dumps([take("b"), take("a")]))
    y, x = np.mgrid[0:20, 0:20].astype(np.float32)
    for name, grid in (("x", x + 5), ("y", y + 2)):
        np.save(tmp_path / f"{name}.npy", grid)
    config = {"id": "EgoExo4D", "data_dir": str(tmp_path / "d"), "laplacian_threshold": 1.0, "imagehash_tolerance": 1}
    rows = adapters.build(spark, config | {"aria_map_x_path": str(tmp_path / "x.npy"), "aria_map_y_path": str(tmp_path / "y.npy"), "size": 20}).orderBy("sample_id").collect()
    assert [(r["data"]["video"].split("/")[1], r["data"]["frame_index"]) for r in rows] == [("b", "0"), ("b", "1"), ("a", "0"), ("a", "1")]
    want = {(v, k): pixels.decode_png(p)[2:22, 5:25] for v, k, p in frames}
    assert all((pixels.decode_png(bytes(r["images"][0]["bytes"])) == want[r["data"]["video"], int(r["data"]["frame_index"])]).all() for r in rows)
    (tmp_path / "d" / "takes.json").write_text(json.dumps([take("b") | {"frame_aligned_videos": {"cam1": {}}}]))
    with pytest.raises(Exception, match="no single rgb video"):
        adapters.build(spark, config).collect()
