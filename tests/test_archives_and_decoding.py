"""Archives of any size and kind, tables inside them, and images of formats that the kernels do not read."""

import gzip
import io
import tarfile
import warnings
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.pixels import decode_png, encode_png
from corpusloom.operators import images
from corpusloom.operators.decoding import as_png
from corpusloom.schema import as_samples
from corpusloom.sources import adapters, archives, files
from tests.test_sources_and_sinks import make_zip, png


def jpeg(spark, w: int, h: int, seed: int = 0) -> bytes:
    """A smooth picture as the JVM writes it."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(w, h, 1)
    paint = image.createGraphics()
    for k in range(6):
        paint.setColor(jvm.java.awt.Color((40 * k + 37 * seed) % 256, (90 + 30 * k) % 256, (200 - 25 * k + 61 * seed) % 256))
        paint.fillRect(k * w // 6, (k + seed) % 3 * h // 4, w // 6 + 1, h // 2)
    out = jvm.java.io.ByteArrayOutputStream()
    jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


def test_archives_beyond_two_gigabytes(spark, tmp_path):
    """Sparse files: the members lie behind 2.2 GB of nothing."""
    size = 2_200_000_000
    with open(tmp_path / "big.zip", "wb") as f:
        f.truncate(size)
    with zipfile.ZipFile(tmp_path / "big.zip", "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a/one.png", png(1))
        z.writestr("a/two.png", png(2), zipfile.ZIP_STORED)
        z.writestr("a/three.png", png(3), zipfile.ZIP_BZIP2)
    rows = archives.read_members(spark, str(tmp_path / "big.zip"), lambda p: p.endswith(".png")).orderBy("ord").collect()
    assert [(r["ord"], r["path"], bytes(r["content"])) for r in rows] == [(0, "a/one.png", png(1)), (1, "a/two.png", png(2)), (2, "a/three.png", png(3))]
    header = tarfile.TarInfo("filler")
    header.size = size
    with open(tmp_path / "big.tar", "wb") as f:
        f.write(header.tobuf())
        f.seek(512 + -(-size // 512) * 512)
        small = tarfile.TarInfo("b/one.png")
        small.size = len(png(1))
        f.write(small.tobuf() + png(1) + bytes(-len(png(1)) % 512 + 1024))
    (row,) = archives.read_members(spark, str(tmp_path / "big.tar"), lambda p: p.endswith(".png")).collect()
    assert (row["path"], bytes(row["content"])) == ("b/one.png", png(1))


def test_zips_are_read_in_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "STRETCH", 300)
    make_zip(tmp_path / "a.zip", [(f"p/{k}.png", png(k)) for k in range(40)])
    make_zip(tmp_path / "b.zip", [("p/40.png", png(40)), ("p/x.txt", b"")])
    (tmp_path / "c.zip").write_bytes(b"PK broken")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rows = archives.read_members(spark, f"{tmp_path}/*.zip", lambda p: p.endswith(".png")).orderBy("archive", "ord").collect()
    assert [bytes(r["content"]) for r in rows] == [png(k) for k in range(41)] and [r["ord"] for r in rows] == [*range(40), 0]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_zips_inside_zips(spark, tmp_path, method):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(3):
            z.writestr(f"NORM/{k}.png", png(k))
    with zipfile.ZipFile(tmp_path / "outer.zip", "w", method) as z:
        z.writestr("readme.txt", "x")
        z.writestr("set/NCT-CRC-HE-100K.zip", inner.getvalue())
        z.writestr("set/other.zip", inner.getvalue())
    rows = adapters.build(spark, {"id": "NctCrcHe", "zip_path": str(tmp_path / "outer.zip")}).orderBy("sample_id").collect()
    assert [bytes(r["images"][0]["bytes"]) for r in rows] == [png(k) for k in range(3)]


def test_damaged_streams_give_no_rows(spark, tmp_path):
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as t:
        info = tarfile.TarInfo("a.png")
        info.size = len(png(1))
        t.addfile(info, io.BytesIO(png(1)))
    packed = gzip.compress(plain.getvalue())
    (tmp_path / "a.tar.gz").write_bytes(packed)
    (tmp_path / "b.tar.gz").write_bytes(packed[:40] + b"damage" + packed[46:])
    (tmp_path / "c.tar.gz").write_bytes(b"no gzip")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert archives.read_members(spark, f"{tmp_path}/*.tar.gz").filter(F.col("archive").endswith("a.tar.gz")).count() == 1
        assert archives.read_members(spark, f"{tmp_path}/c.tar.gz").count() == 0


def test_tables_inside_archives(spark, tmp_path):
    table = 'Image Index,Finding Labels,Patient Age,Patient Gender,View Position\n1.png,No Finding,58,M,PA\n1.png,"Mass|Nodule",58,M,AP\n2.png,Mass,30,F,PA\n'
    make_zip(tmp_path / "nih.zip", [("images/1.png", png(1)), ("images/3.png", png(3)), ("images/2.png", png(2)), ("Data_Entry_2017.csv", table.encode())])
    rows = adapters.build(spark, {"id": "NihChestXray", "zip_path": str(tmp_path / "nih.zip")}).orderBy("sample_id").collect()
    assert [r["data"]["file_path"] if r["data"] else None for r in rows] == [None, None] and [r["sample_id"] for r in rows] == [0, 1]
    assert "AP" in rows[0]["text"] or "nodule" in rows[0]["text"].lower()
    folder = adapters.ISIC_FOLDER
    data = 'isic_id,note\nI2,"a, ""quoted""\nline"\nI1,b\n'
    make_zip(tmp_path / f"{folder}.zip", [(f"{folder}/metadata.csv", data.encode()), (f"{folder}/I1.jpg", jpeg(spark, 20, 10)), (f"{folder}/I2.jpg", jpeg(spark, 30, 10))])
    rows = adapters.build(spark, {"id": "ISIC", "data_dir": str(tmp_path)}).orderBy("sample_id").collect()
    assert [(r["sample_id"], r["images"][0]["width"]) for r in rows] == [(0, 30), (1, 20)]
    assert "quoted" in rows[0]["data"]["patient_info"]
    make_zip(tmp_path / "lost.zip", [("x/metadata.csv", b"isic_id\nI9\n"), ("x/I1.jpg", jpeg(spark, 20, 10))])
    with pytest.raises(Exception, match="no image of I9"):
        adapters.build(spark, {"id": "ISIC", "data_dir": str(tmp_path), "archive": "lost.zip"}).collect()


def test_other_formats_as_png(spark):
    good, other = jpeg(spark, 40, 30), jpeg(spark, 40, 30, 1)
    rows = [(1, png(5)), (2, good), (3, good), (4, None), (5, b"\xff\xd8 broken"), (6, other)]
    got = {r["k"]: r["b"] for r in as_png(spark.createDataFrame(rows, "k int, b binary"), "b").collect()}
    assert bytes(got[1]) == png(5) and got[4] is None and got[5] is None and got[2] == got[3] != got[6]
    assert decode_png(bytes(got[2])).shape == (30, 40, 3)


def samples(spark, contents: list[bytes], w: int, h: int):
    rows = spark.createDataFrame([(k, bytes(c), w, h) for k, c in enumerate(contents)], "sample_id long, content binary, width int, height int").withColumn("path", F.lit("x.jpg"))
    return as_samples(rows, "d", "image", images=adapters.image_of()).withColumn("adapter_pos", F.lit(0))


def test_filters_decode_jpeg(spark):
    a, b = jpeg(spark, 64, 48), jpeg(spark, 64, 48, 2)
    df = samples(spark, [a, b, a, b"\xff\xd8 broken"], 64, 48)
    kept = images.deduplication(algorithm="dhash")(df)
    assert sorted(r["sample_id"] for r in kept.collect()) == [0, 1, 3]
    small = {r["sample_id"]: r["images"][0] for r in images.downsample(64 * 12)(df).collect()}
    assert (small[0]["width"], small[0]["height"], small[0]["format"]) == (32, 24, "png")
    assert decode_png(bytes(small[0]["bytes"])).shape == (24, 32, 3)
    assert (small[3]["width"], small[3]["format"], bytes(small[3]["bytes"])) == (64, "jpg", b"\xff\xd8 broken")


def test_resized_adapters_decode_jpeg(spark, tmp_path):
    for name, seed in (("val", 2), ("test", 0), ("train", 1)):
        make_zip(tmp_path / f"{name}.zip", [("s/1.jpg", jpeg(spark, 2559, 1957, seed))])
    rows = adapters.build(spark, {"id": "SLIDE", "data_dir": str(tmp_path)}).orderBy("sample_id").collect()
    assert [(r["images"][0]["width"], r["images"][0]["height"], r["images"][0]["format"]) for r in rows] == [(768, 584, "png")] * 3
    assert all(decode_png(bytes(r["images"][0]["bytes"])).shape == (584, 768, 3) for r in rows)
    folder = tmp_path / "Original UWF Image" / "DR"
    folder.mkdir(parents=True)
    (folder / "7.jpg").write_bytes(jpeg(spark, 2600, 2048))
    (tmp_path / "table.csv").write_text("Image ID ,Patient ID,Eye category,Age,Sex,Diagnosis\n7.jpg,p1,OD,50,F,DR\n")
    (row,) = adapters.build(spark, {"id": "UWF", "data_dir": str(tmp_path)}).collect()
    assert decode_png(bytes(row["images"][0]["bytes"])).shape == (1024, 1300, 3) and row["data"]["patient_id"] == "p1"
    (tmp_path / "table.csv").write_text("Image ID ,Patient ID,Eye category,Age,Sex,Diagnosis\n8.jpg,p1,OD,50,F,DR\n")
    with pytest.raises(Exception, match="unexpected image size"):
        adapters.build(spark, {"id": "UWF", "data_dir": str(tmp_path)}).collect()


def test_last_lookup_wins_by_file_and_line(spark, tmp_path):
    import pandas as pd

    for name, caption in (("b", "late"), ("a", "early")):
        pd.DataFrame({"file_name": ["x.png"] * 3, "caption": [f"{caption}{k}" for k in range(3)], "source": ["brats"] * 3}).to_parquet(tmp_path / f"{name}.parquet")
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as t:
        info = tarfile.TarInfo("img/x.png")
        info.size = len(png(1))
        t.addfile(info, io.BytesIO(png(1)))
    import zstandard

    (tmp_path / "i.tar.zst").write_bytes(zstandard.compress(plain.getvalue()))
    (row,) = adapters.build(spark, {"id": "MedTrinityFull", "data_dir": str(tmp_path), "image_only": False}).collect()
    assert row["text"].endswith("late2")
    assert encode_png(np.zeros((2, 2, 3), np.uint8))[:4] == b"\x89PNG"


def sparse_npz(path, arrays):
    """Stored arrays of zeros but for some rows, of any size, as holes in a file; ``arrays`` has name, shape and rows that are not zero."""
    with open(path, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for name, shape, rows in arrays:
            header = io.BytesIO()
            np.lib.format.write_array_header_1_0(header, {"descr": "|u1", "fortran_order": False, "shape": shape})
            row = int(np.prod(shape[1:]))
            info = zipfile.ZipInfo(f"{name}.npy")
            info.CRC, info.file_size = 0, len(header.getvalue()) + row * shape[0]
            info.compress_size = info.file_size
            info.header_offset = f.tell()
            f.write(info.FileHeader(zip64=True) + header.getvalue())
            start = f.tell()
            for k, value in rows.items():
                f.seek(start + k * row)
                f.write(np.full(row, value, np.uint8).tobytes())
            f.seek(start + row * shape[0])
            z.filelist.append(info)
            z.NameToInfo[info.filename] = info
            z.start_dir = f.tell()
            z._didModify = True


def test_npz_beyond_two_gigabytes_is_read_by_ranges(spark, tmp_path):
    big = (2_300, 1000, 1000)  # 2.3 GB of zeros, a hole
    sparse_npz(tmp_path / "a.npz", [("train_images", big, {0: 7, 2_299: 9}), ("test_images", (2, 5, 5, 3), {1: 4})])
    np.savez_compressed(tmp_path / "b.npz", train_images=np.arange(3 * 4 * 4, dtype=np.uint8).reshape(3, 4, 4), other=np.zeros(3))
    rows = files.read_npz(spark, [str(tmp_path / "a.npz"), str(tmp_path / "b.npz")], ("train", "test"), ids="id")
    ends = rows.filter("block = 0 AND ord IN (0, 2299) OR block > 0").orderBy("id").collect()
    assert [(r["id"], r["file"], r["split"], r["ord"]) for r in ends] == [(0, "a.npz", "train", 0), (2299, "a.npz", "train", 2299), (2300, "a.npz", "test", 0), (2301, "a.npz", "test", 1), *((2302 + k, "b.npz", "train", k) for k in range(3))]
    assert (decode_png(bytes(ends[0]["content"])) == 7).all() and (decode_png(bytes(ends[1]["content"])) == 9).all() and (decode_png(bytes(ends[3]["content"])) == 4).all()
    assert decode_png(bytes(ends[5]["content"]))[0, 0, 0] == 16
    stretches = rows._jdf.queryExecution().toRdd().getNumPartitions()
    assert stretches > 20


def test_blobs_of_any_size_and_depth(spark, tmp_path):
    import hashlib

    from corpusloom.operators import verify

    flat, deep = tmp_path / "hub" / "datasets--o--d" / "blobs", tmp_path / "hub" / "datasets--o--e" / "x" / "y" / "blobs"
    for folder in (flat, deep, tmp_path / "hub" / "datasets--o--e" / "refs"):
        folder.mkdir(parents=True)
    (tmp_path / "hub" / "datasets--o--e" / "refs" / ("0" * 64)).write_bytes(b"no blob")
    (deep / hashlib.sha256(b"deep").hexdigest()).write_bytes(b"deep")
    (deep / hashlib.sha256().hexdigest()).write_bytes(b"")
    (flat / "notes.txt").write_bytes(b"x")
    size, digest = 2_200_000_000, hashlib.sha256()
    for at in range(0, size, 1 << 24):
        digest.update(bytes(min(1 << 24, size - at)))
    with open(flat / digest.hexdigest(), "wb") as f:
        f.truncate(size)
    (flat / ("1" * 64)).write_bytes(b"soon gone")
    (flat / ("2" * 64)).write_bytes(b"changed")
    blobs = verify.cache_blobs(spark, str(tmp_path))
    (flat / ("1" * 64)).unlink()  # listed, and not there any more: an error row, and no dead job
    tally, bad = verify.verify_cache(blobs)
    assert {r["status"]: r["n"] for r in tally.collect()} == {"valid": 3, "skipped": 1, "error": 1, "invalid": 1}
    assert {r["name"]: r["status"] for r in bad.collect()} == {"1" * 64: "error", "2" * 64: "invalid"}
    assert {r["dataset"]: r["n"] for r in verify.blobs_by_dataset(blobs).collect()} == {"o/d": 4, "o/e": 2}
    assert verify.cache_blobs(spark, str(tmp_path), "o/e").count() == 2
    assert verify.cache_blobs(spark, str(tmp_path / "none")).count() == 0


def framed_tar(members: list[tuple[str, bytes]], pack, step: int) -> bytes:
    """A tar in frames of ``step`` bytes, each packed by itself."""
    plain = io.BytesIO()
    with tarfile.open(fileobj=plain, mode="w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    data = plain.getvalue()
    return b"".join(pack(data[k : k + step]) for k in range(0, len(data), step))


@pytest.mark.parametrize("kind", ["tar.zst", "tar.gz", "skippable", "padded"])
def test_compressed_tars_of_many_frames_are_read_by_many_tasks(spark, tmp_path, monkeypatch, kind):
    import zstandard

    monkeypatch.setattr(archives, "STRETCH", 2000)
    rng = np.random.default_rng(5)
    members = [(f"p/{'long' * 40 if k == 7 else ''}{k}.bin", rng.bytes(int(rng.integers(0, 3000)))) for k in range(40)]
    pack = gzip.compress if kind in ("tar.gz", "padded") else zstandard.ZstdCompressor().compress
    data = framed_tar(members, pack, 5000)
    if kind == "skippable":
        data = b"\x50\x2a\x4d\x18\x04\0\0\0note" + data + b"\x5e\x2a\x4d\x18\x00\0\0\0"
    if kind == "padded":
        data = data + bytes(700)
    name = "a.tar.gz" if kind in ("tar.gz", "padded") else "a.tar.zst"
    (tmp_path / name).write_bytes(data)
    (tmp_path / f"one-{name}").write_bytes(framed_tar(members, pack, 1 << 30))
    for file, frames in ((name, True), (f"one-{name}", False)):
        listed = archives.list_members(spark, str(tmp_path / file))
        assert [r["path"] for r in listed.orderBy("ord").collect()] == [n for n, _ in members]
        assert (listed.select("offset").distinct().count() > 5) == frames
        rows = archives.with_payloads(listed).withColumn("task", F.spark_partition_id()).orderBy("ord").collect()
        assert [(r["path"], bytes(r["content"])) for r in rows] == members
        assert (len({r["task"] for r in rows}) > 1) == frames


def test_frames_cut_short_or_damaged_lose_what_lies_behind_only(spark, tmp_path):
    import zstandard

    members = [(f"{k}.bin", bytes([k]) * 2000) for k in range(20)]
    data = framed_tar(members, zstandard.ZstdCompressor(write_checksum=True).compress, 5000)
    (tmp_path / "cut.tar.zst").write_bytes(data[: len(data) // 2])
    (tmp_path / "empty.tar.zst").write_bytes(b"")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rows = archives.with_payloads(archives.list_members(spark, str(tmp_path / "cut.tar.zst"))).orderBy("ord").collect()
        assert 0 < len(rows) < 20 and all((r["path"], bytes(r["content"])) == members[r["ord"]] for r in rows)
        assert archives.list_members(spark, str(tmp_path / "empty.tar.zst")).count() == 0


def test_zeros_grow_in_pieces():
    import zstandard

    for pack, zstd in ((gzip.compress, False), (zstandard.ZstdCompressor().compress, True)):
        source = archives.Frames(io.BytesIO(pack(bytes(50_000_000)) + pack(b"end")), zstd)
        total, last = 0, b""
        while piece := source._more():
            total, last = total + len(piece), piece
        assert total == 50_000_003 and last[-3:] == b"end" and source.began[-1][0] == 50_000_000
