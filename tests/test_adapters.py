"""Adapters over small copies of their containers, and scans that list first and read last."""

import gzip
import io
import json
import re
import tarfile
import warnings
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import adapters, archives
from tests.test_archives_and_decoding import jpeg
from tests.test_sources_and_sinks import make_zip, png


def make_tar(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def built(spark, **config):
    return adapters.build(spark, config).orderBy("sample_id").collect()


def test_covid_radiography(spark, tmp_path):
    make_zip(tmp_path / "a.zip", [("d/COVID/images/1.png", png(1)), ("d/COVID/masks/1.png", png(2)), ("d/Viral Pneumonia/images/2.png", png(3)), ("d/Other/images/3.png", png(4)), ("d/Normal/images/4.jpg", png(5)), ("COVID/images/5.png", png(6))])
    rows = built(spark, id="CovidRadiography", zip_path=str(tmp_path / "a.zip"))
    assert [(r["sample_id"], r["text"].split("\n")[1]) for r in rows] == [(0, "A chest X-ray image showing COVID-19 pneumonia."), (1, "A chest X-ray image showing viral pneumonia.")]
    assert rows[0]["dataset_id"] == "covid_radiography" and bytes(rows[1]["images"][0]["bytes"]) == png(3)


def test_diabetic_retinopathy(spark, tmp_path):
    make_zip(tmp_path / "a.zip", [("a/b/Mild/1.png", png(1)), ("a/b/Nothing/2.png", png(2)), ("a/b/No_DR/3.png", png(3)), ("b/Severe/4.png", png(4))])
    rows = built(spark, id="DiabeticRetinopathy", zip_path=str(tmp_path / "a.zip"))
    assert [(r["sample_id"], "mild" in r["text"], "no signs" in r["text"]) for r in rows] == [(0, True, False), (1, False, True)]


def test_liver_ultrasound(spark, tmp_path):
    make_zip(tmp_path / "a.zip", [("a/Benign/b/image/1.jpg", jpeg(spark, 9, 7)), ("a/Benign/b/mask/1.jpg", png(2)), ("a/Malignant/b/image/2.png", png(3))])
    rows = built(spark, id="LiverUltrasound", zip_path=str(tmp_path / "a.zip"))
    assert [(r["sample_id"], r["images"][0]["format"], r["images"][0]["width"]) for r in rows] == [(0, "jpg", 9), (1, "png", 12)]


def web_tar(path, spark, keys):
    members = []
    for k in keys:
        members += [(f"s/{k}.jpg", jpeg(spark, 10 + k, 8)), (f"s/{k}.json", json.dumps({"caption": f"caption {k}"}).encode()), (f"s/{k}.txt", b"no")]
    make_tar(path, members)


def test_web_records(spark, tmp_path):
    web_tar(tmp_path / "00001.tar", spark, [3, 4])
    web_tar(tmp_path / "00000.tar", spark, [1, 2])
    rows = built(spark, id="LAIONAesthetics", data_dir=str(tmp_path))
    assert [(r["sample_id"], r["images"][0]["width"], json.loads(r["data"]["json"])["caption"]) for r in rows] == [(k - 1, 10 + k, f"caption {k}") for k in (1, 2, 3, 4)]
    rows = built(spark, id="OpenPMC18m", data_dir=str(tmp_path), image_only=False)
    assert [(r["sample_id"], r["text"]) for r in rows] == [(k - 1, f"<|img1|>\ncaption {k}") for k in (1, 2, 3, 4)]
    assert {r["sample_type"] for r in built(spark, id="OpenPMC18m", data_dir=str(tmp_path))} == {"image"}


def test_medicat(spark, tmp_path):
    line = lambda u, a, b: json.dumps({"pdf_hash": "p", "fig_uri": u, "s2_caption": a, "s2orc_caption": b})
    text = "\n".join([line("1.png", "", "second"), line("2.png", "first", "x"), line("3.png", "", ""), line("2.png", "last", None)])
    make_tar(tmp_path / "m.tar.gz", [("r/s2.jsonl", text.encode()), ("r/figures/p_2.png", png(2)), ("r/figures/p_9.png", png(9)), ("r/figures/p_1.png", png(1)), ("r/figures/p_3.png", png(3))], "w:gz")
    rows = built(spark, id="MediCaT", tar_path=str(tmp_path / "m.tar.gz"))
    assert [(r["sample_id"], r["text"], bytes(r["images"][0]["bytes"])) for r in rows] == [(0, "<|img1|>\nlast", png(2)), (1, "<|img1|>\nsecond", png(1))]


def test_medtrinity_demo(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, ks in (("b", [2, 3]), ("a", [0, 1])):
        pq.write_table(pa.Table.from_pylist([{"image": {"bytes": png(k) if k != 1 else b"broken", "path": f"{k}.png"}} for k in ks]), tmp_path / "d" / f"{name}.parquet")
    rows = built(spark, id="MedTrinityDemo", data_dir=str(tmp_path / "d"))
    assert [(r["sample_id"], bytes(r["images"][0]["bytes"])) for r in rows] == [(k, png(k)) for k in (0, 2, 3)]


def test_pmc_oa_numbers_the_whole_listing(spark, tmp_path):
    folder = adapters.PMC_FOLDER
    (tmp_path / "pmc_oa.jsonl").write_text("\n".join(json.dumps({"image": n, "caption": c}) for n, c in (("1.jpg", "one"), ("3.jpg", "old"), ("3.jpg", "three"))))
    make_zip(tmp_path / "images.zip", [(f"{folder}/0.jpg", png(0)), (f"{folder}/1.jpg", png(1)), ("other/3.jpg", png(2)), (f"{folder}/3.jpg", png(3))])
    assert [(r["sample_id"], r["text"]) for r in built(spark, id="PMCOA", data_dir=str(tmp_path))] == [(1, "<|img1|>\none"), (3, "<|img1|>\nthree")]


def test_rfmid2(spark, tmp_path):
    for folder, k in (("Training_set", 2), ("Test_set", 1), ("Validation_set", 3), ("Elsewhere", 4)):
        (tmp_path / folder / "in").mkdir(parents=True)
        (tmp_path / folder / "in" / f"{k}.jpg").write_bytes(jpeg(spark, 10 + k, 9))
        (tmp_path / folder / "in" / "x.txt").write_text("no")
    assert [(r["sample_id"], r["images"][0]["width"]) for r in built(spark, id="RFMiD2", data_dir=str(tmp_path))] == [(0, 11), (1, 12), (2, 13)]


CONTAINERS = {
    "BrainTumorMRI": ("zip_path", "a.zip", [("Training/glioma/1.png", 1), ("Testing/notumor/2.png", 2)]),
    "PMCOA": ("data_dir", "images.zip", [(f"{adapters.PMC_FOLDER}/1.jpg", 1)]),
    "NctCrcHe": ("zip_path", "outer.zip", [("NORM/1.png", 1), ("TUM/2.png", 2)]),
    "NihChestXray": ("zip_path", "nih.zip", [("x/1.png", 1)]),
    "ISIC": ("data_dir", f"{adapters.ISIC_FOLDER}.zip", [("x/I1.jpg", 1)]),
    "LAIONAesthetics": ("data_dir", "0.tar", []),
    "MedPix": ("zip_path", "m.zip", [("i1.png", 1)]),
}


@pytest.mark.parametrize("name", CONTAINERS)
def test_payloads_are_read_last(spark, tmp_path, name):
    """In the plan of every scan of archives, shuffles lie below the step that reads payloads, so no image goes through one."""
    option, file, members = CONTAINERS[name]
    members = [(path, png(k)) for path, k in members]
    (tmp_path / "pmc_oa.jsonl").write_text(json.dumps({"image": "1.jpg", "caption": "c"}))
    if name == "NctCrcHe":
        inner = io.BytesIO()
        with zipfile.ZipFile(inner, "w") as z:
            for path, data in members:
                z.writestr(path, data)
        members = [("NCT-CRC-HE-100K.zip", inner.getvalue())]
    members += {"NihChestXray": [("Data_Entry_2017.csv", b"Image Index,Finding Labels,Patient Age,Patient Gender,View Position\n1.png,Mass,58,M,PA\n")], "ISIC": [("x/metadata.csv", b"isic_id\nI1\n")]}.get(name, [])
    if name == "MedPix":
        members += [("Case_topic.json", json.dumps([{"U_id": "u", "TAC": ["i1"], "MRI": [], "Case": {"Title": "t"}, "Topic": {}}]).encode()), ("Descriptions.json", b"[]")]
    if name == "LAIONAesthetics":
        web_tar(tmp_path / file, spark, [1])
    else:
        make_zip(tmp_path / file, members)
    samples = adapters.build(spark, {"id": name, "dataset_id": "d", option: str(tmp_path / file) if option == "zip_path" else str(tmp_path)} if name in ("MedPix",) else {"id": name, option: str(tmp_path / file) if option == "zip_path" else str(tmp_path)})
    assert samples.count() > 0
    plan = samples._jdf.queryExecution().executedPlan().toString().split("\n")
    reader = next(k for k, line in enumerate(plan) if "MapInArrow" in line)
    assert not [line for line in plan[:reader] if re.search("Exchange|Join|Aggregate|Window", line)], plan
    assert "content" in plan[reader] or "payloads" in plan[reader]


def test_places_lead_to_the_payloads(spark, tmp_path, monkeypatch):
    """All containers: what the place says is what the walk gives; streamed ones go back where rows are out of order."""
    monkeypatch.setattr(archives, "STRETCH", 200)
    members = [(f"p/{k}.png", png(k)) for k in range(12)]
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    make_zip(tmp_path / "a.zip", members)
    for kind, method in (("stored", zipfile.ZIP_STORED), ("packed", zipfile.ZIP_DEFLATED)):
        with zipfile.ZipFile(tmp_path / f"{kind}.zip", "w", method) as z:
            z.writestr("x.png", png(90))
            z.writestr("in.zip", inner.getvalue())
    with zipfile.ZipFile(tmp_path / "bz.zip", "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("p/1.png", png(1))
    make_tar(tmp_path / "b.tar", members)
    (tmp_path / "c.tar.gz").write_bytes(gzip.compress((tmp_path / "b.tar").read_bytes()))
    for pattern, nested, n in (("a.zip", False, 12), ("stored.zip", True, 13), ("packed.zip", True, 13), ("bz.zip", False, 1), ("b.tar", False, 12), ("c.tar.gz", False, 12)):
        listed = archives.list_members(spark, str(tmp_path / pattern), nested=nested)
        assert "content" not in listed.columns
        got = {r["path"]: bytes(r["content"]) for r in archives.with_payloads(listed.withColumn("more", F.lit(1))).collect()}
        want = {r["path"]: bytes(r["content"]) for r in archives.read_members(spark, str(tmp_path / pattern), nested=nested).collect()}
        assert got == want and len(got) == n
        backwards = listed.groupBy("archive").agg(F.reverse(F.array_sort(F.collect_list(F.struct("ord", archives.place(listed).alias("place"))))).alias("p"))
        arrays = archives.with_payload_arrays(backwards.withColumn("places", F.transform("p", lambda p: p["place"])), "places").first()
        assert [bytes(x["content"]) for x in arrays["payloads"]] == [want[p["path"]] for p in arrays["places"]]


def test_members_that_cannot_be_read_go_or_stay_empty(spark, tmp_path):
    make_zip(tmp_path / "a.zip", [("1.png", png(1)), ("2.png", png(2))])
    listed = archives.list_members(spark, str(tmp_path / "a.zip")).withColumn("size", F.when(F.col("ord") == 1, F.col("size") + 10**6).otherwise(F.col("size")))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert [r["path"] for r in archives.with_payloads(listed).collect()] == ["1.png"]
        assert [(r["path"], r["content"] is None) for r in archives.with_payloads(listed, optional=True).orderBy("ord").collect()] == [("1.png", False), ("2.png", True)]
    assert archives.with_payloads(listed.limit(0)).collect() == []
