"""Archives that Spark packs, read back by the standard library and by the sources."""

import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.sinks import packing
from corpusloom.sources import archives


def packed(rows, folder, archive, name=None):
    return packing.pack(rows, str(folder), F.lit(archive) if isinstance(archive, str) else archive, F.col("name") if name is None else name, F.col("text"), [F.col("id")])


def test_zips_and_inner_zips(spark, tmp_path):
    rows = [(k, f"{'ab'[k // 4]}.zip/{k}.txt" if k < 8 else f"plain/{k}.txt", None if k == 3 else "é" * k * 1000) for k in range(12)]
    table = spark.createDataFrame(rows, "id int, name string, text string")
    files = packed(table, tmp_path, F.concat(F.lit("x"), (F.col("id") % 1).cast("string"), F.lit(".zip")))
    assert files == [["", "x0.zip", 12, sum(2000 * k for k in range(12) if k != 3)]]
    with zipfile.ZipFile(tmp_path / "x0.zip") as z:
        assert z.testzip() is None
        assert z.namelist() == ["a.zip", "b.zip", *(f"plain/{k}.txt" for k in range(8, 12))]
        with z.open("b.zip") as inner, zipfile.ZipFile(inner) as b:
            assert b.testzip() is None and b.namelist() == [f"{k}.txt" for k in range(4, 8)]
    listed = archives.list_members(spark, str(tmp_path / "x0.zip"), nested=True)
    assert listed.filter("method >= 0").count() == 12
    got = {r["path"]: bytes(r["content"]).decode() for r in archives.with_payloads(listed).collect()}
    assert got == {n: t or "" for _, n, t in rows}


@pytest.mark.parametrize("ending", [".tar", ".tar.gz", ".tgz", ".tar.zst"])
def test_tars_in_frames(spark, tmp_path, ending):
    table = spark.range(60).select("id", F.concat(F.lit("m/"), "id").alias("name"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 5000).alias("text"))
    packed(table, tmp_path, F.concat(F.lit("t"), (F.col("id") % 2).cast("string"), F.lit(ending)))
    assert sorted(n for n in os.listdir(tmp_path) if n[0] == "t") == [f"t0{ending}", f"t1{ending}"]
    assert not [n for n in os.listdir(tmp_path) if n.startswith(".t")]
    if ending != ".tar.zst":
        with tarfile.open(tmp_path / f"t1{ending}") as t:
            assert t.getnames() == [f"m/{k}" for k in range(1, 60, 2)]
    listed = archives.list_members(spark, f"{tmp_path}/t*{ending}")
    if ending != ".tar":
        assert listed.select("archive", "offset").distinct().count() == 6
    got = archives.with_payloads(listed).select(F.md5("content").alias("d"), "path").join(table.withColumn("path", F.col("name")), "path").filter("d = md5(text)")
    assert got.count() == 60


def test_special_rows(spark, tmp_path):
    kind = "id int, name string, text string"
    assert packed(spark.createDataFrame([], kind), tmp_path / "none", "a.zip") == []
    one = spark.createDataFrame([(1, "n", "t")], kind)
    with pytest.raises(Exception, match="archives end in"):
        packed(one, tmp_path / "bad", "a.rar")
    with pytest.raises(Exception, match="without the name of its member"):
        packed(one, tmp_path / "bad", "a.zip", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="without the name of its archive"):
        packed(one, tmp_path / "bad", F.lit(None).cast("string"))
    twice = spark.createDataFrame([(1, "n", "t")] * 2, kind)
    packed(twice, tmp_path / "twice", "a.tar")
    assert archives.list_members(spark, str(tmp_path / "twice" / "a.tar")).count() == 2
