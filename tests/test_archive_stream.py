"""Streams over folders of archives: places, batches by bytes, restarts."""

import json
import os
import warnings

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import archive_stream, archives
from corpusloom.streaming import runner
from tests.test_adapters import make_tar
from tests.test_archives_and_decoding import framed_tar
from tests.test_sources_and_sinks import make_zip, png


def arrive(folder, name, make):
    """An archive renamed into place, as the stream asks for."""
    make(folder / f".{name}")
    os.rename(folder / f".{name}", folder / name)


def test_steps_end_inside_zips_and_behind_tars():
    zips, tars = [("a.zip", 100), ("b.zip", 50)], [("a.tar", 100), ("b.tar", 30), ("c.tar", 80)]
    assert archive_stream.advance(zips, (0, 0), 60) == (0, 60)
    assert archive_stream.advance(zips, (0, 60), 60) == (1, 20)
    assert archive_stream.advance(zips, (1, 20), 60) == (2, 0)
    assert archive_stream.advance(zips, (2, 0), 60) == (2, 0)
    assert archive_stream.advance(tars, (0, 0), 60) == (1, 0)
    assert archive_stream.advance(tars, (1, 0), 60) == (2, 0)
    assert archive_stream.advance([("empty.tar", 0), *tars], (0, 0), 100) == (2, 0)


def test_log_survives_folding(tmp_path, monkeypatch):
    monkeypatch.setattr(archive_stream, "FOLD", 3)
    log = archive_stream.ArrivalLog(str(tmp_path))
    for k in range(10):
        log.add([(f"{k}.zip", k)], (k, 0))
        again = archive_stream.ArrivalLog(str(tmp_path))
        assert again.archives == [(f"{j}.zip", j) for j in range(k + 1)] and again.admitted == (k, 0)
    assert len(os.listdir(tmp_path)) <= 4
    (tmp_path / "000000000099.json.new").write_text("half an ent")
    assert len(archive_stream.ArrivalLog(str(tmp_path)).archives) == 10


def test_reader_repeats_a_place_until_it_is_planned(tmp_path):
    make_zip(tmp_path / "a.zip", [(f"{k}.png", png(k)) for k in range(8)])
    options = {"path": f"{tmp_path}/*.zip", "log": f"{tmp_path}/log", "maxBytesPerTrigger": "300"}
    reader = archive_stream.ArchiveStream(options)
    first = reader.latestOffset()
    assert first == reader.latestOffset() == {"archive": 0, "place": 300}
    reader.partitions(reader.initialOffset(), first)
    second = reader.latestOffset()
    assert second["place"] == 600
    restarted = archive_stream.ArchiveStream(options)
    assert restarted.latestOffset()["place"] == 900
    idle = archive_stream.ArchiveStream({**options, "path": f"{tmp_path}/no*", "log": f"{tmp_path}/other"})
    assert idle.latestOffset() == {"archive": 0, "place": 0}
    idle.pattern = f"{tmp_path}/*.zip"
    assert idle.latestOffset()["place"] == 300
    assert [p.value for p in restarted.partitions(first, second)] == [(f"{tmp_path}/a.zip", (300, 600))]
    assert restarted.partitions(second, second) == []
    for missing in ({"path": "x"}, {**options, "maxBytesPerTrigger": "0"}):
        with pytest.raises(ValueError):
            archive_stream.ArchiveStream(missing)


def test_stream_over_a_growing_folder_takes_each_member_once(spark, tmp_path, monkeypatch):
    """Zips, tars and framed tars; a batch whose sink dies; a restart; late archives with earlier names; a damaged one."""
    source = tmp_path / "in"
    source.mkdir()
    out, check, log = (str(tmp_path / d) for d in ("out", "check", "log"))
    arrive(source, "m.zip", lambda p: make_zip(p, [(f"m/{k}.png", png(k)) for k in range(30)]))
    arrive(source, "n.tar", lambda p: make_tar(p, [(f"n/{k}.png", png(k)) for k in range(9)] + [("n/x.txt", b"x")]))
    size = os.path.getsize(source / "m.zip")
    stream = lambda: runner.archive_stream(spark, f"{source}/*", log, batch_bytes=size // 3, suffixes=".png")
    write, batches = runner.overwrite_by_batch(out), []

    def dies(batch, batch_id):
        batches.append(batch_id)
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("the sink dies after its write")

    with pytest.raises(Exception, match="the sink dies"):
        runner.drain_by_steps(stream(), dies, check)
    assert batches[0] == 0 and batches[-1] == 1
    arrive(source, "a.zip", lambda p: make_zip(p, [(f"a/{k}.png", png(k)) for k in range(5)]))
    runner.drain_by_steps(stream(), write, check)
    import gzip

    arrive(source, "b.tar.gz", lambda p: p.write_bytes(framed_tar([(f"b/{k}.png", png(k)) for k in range(6)], gzip.compress, 700)))
    arrive(source, "bad.zip", lambda p: p.write_bytes(b"PK no zip"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        runner.drain_by_steps(stream(), write, check)
        runner.drain_by_steps(stream(), write, check)
    rows = spark.read.parquet(out).withColumn("file", F.element_at(F.split("archive", "/"), -1)).collect()
    got = sorted((r["file"], r["ord"], r["path"], bytes(r["content"])) for r in rows)
    want = [(f, k, f"{f[0]}/{k}.png", png(k)) for f, n in (("a.zip", 5), ("b.tar.gz", 6), ("m.zip", 30), ("n.tar", 9)) for k in range(n)]
    assert got == sorted(want)
    assert len({r["batch"] for r in rows if r["file"] == "m.zip"}) >= 3
    entries = [json.loads((tmp_path / "log" / n).read_text()) for n in sorted(os.listdir(log)) if n.endswith(".json")]
    assert sum(len(e["archives"]) for e in entries) == 5


def test_scan_of_zips_goes_in_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "STRETCH", 500)
    make_zip(tmp_path / "a.zip", [(f"p/{k}.png", png(k)) for k in range(30)])
    size = os.path.getsize(tmp_path / "a.zip")
    parts = archives.ArchiveSource({"path": str(tmp_path / "a.zip")}).reader(None).partitions()
    assert len(parts) == -(-size // 500)
    reader = archives.ArchiveSource({"path": str(tmp_path / "a.zip")}).reader(None)
    paths = [p for part in parts for batch in reader.read(part) for p in batch.column(2).to_pylist()]
    assert paths == [f"p/{k}.png" for k in range(30)]
