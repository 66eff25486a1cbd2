"""Functions against values taken from their definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import imghash, pixels, text, tiles
from corpusloom.operators import dedup, folds, ordinals, resets, verify
from corpusloom.streaming import runner


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "spec, want",
    [("train", ("train", None, None)), ("train[:100]", ("train", None, 100)), ("train[100:200]", ("train", 100, 200)), ("train[100:]", ("train", 100, None)), ("train[:10%]", ("train[:10%]", None, None))],
)
def test_split_parts(spark, spec, want):
    parts = [p.alias(f"c{k}") for k, p in enumerate(text.split_parts(F.lit(spec)))]
    assert tuple(spark.range(1).select(*parts).first()) == want


def test_near_index_equals_comparing_all():
    rng = random.Random(2)
    for below in (0, 1, 3, 8, 20, 70):
        index, held = folds.NearIndex(below), []
        for _ in range(400):
            h = rng.getrandbits(64) if not held or rng.random() < 0.5 else rng.choice(held) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 9)))
            h &= (1 << 64) - 1
            assert index.near(h) == any((h ^ o).bit_count() < below for o in held)
            index.add(h)
            held.append(h)
    index = folds.NearIndex(4)
    for _ in range(3000):
        h = rng.getrandbits(64)
        index.near(h)
        index.add(h)
    assert index.compared < 3000 * 3000 / 2 / 1000


def test_near_counts_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(imghash, "BLOCK_ROWS", 20)
    rng = random.Random(6)
    base = [rng.getrandbits(40) for _ in range(12)]
    rows = [(k, "a" if k % 3 else "b", f"{rng.choice(base) ^ (1 << rng.randrange(40)):040b}") for k in range(150)] + [(150, None, "0" * 40), (151, "a", None)]
    got = {r["key"]: (r["n_near"], r["distance"], r["nearest"]) for r in imghash.near_counts(spark.createDataFrame(rows, "k long, l string, b string"), "l", "k", "b", 5).collect()}
    for k, label, bits in rows:
        near = sorted((sum(a != b for a, b in zip(bits, o, strict=True)), j) for j, m, o in rows if label and m == label and bits and o and j != k)
        near = [n for n in near if n[0] < 5]
        assert got[k] == ((len(near), *near[0]) if near else (0, None, None))


def test_exact_samples(spark, monkeypatch):
    """Any number of rows, ties and one draw that half the rows share included; equal to a sort."""
    from corpusloom.operators import sampling

    rng = random.Random(8)
    rows = [(rng.randrange(200), k) for k in range(2000)] + [(5, 7)] * 1000
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    import hashlib

    ordered = sorted(rows, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[1]))
    draw = F.md5(F.col("a").cast("string").cast("binary"))
    for cell_rows in (100_000, 40):
        monkeypatch.setattr(sampling, "CELL_ROWS", cell_rows)
        for n in (0, 1, 700, 1500, 2999, 3000, 5000):
            assert sorted(map(tuple, sampling.exact_sample(df, draw, ["b"], n=n).collect())) == sorted(ordered[:n])
    assert sampling.exact_sample(df, draw, ["b"], ratio=0.25).count() == 750
    assert sampling.exact_sample(df.limit(0), draw, ["b"], ratio=0.5).collect() == []
    with pytest.raises(ValueError):
        sampling.exact_sample(df, draw, ["b"])


def test_paths_and_names(spark):
    assert value(spark, text.stem(F.lit("a/b.c/d.e.png"))) == "d.e"
    assert value(spark, text.prefix_class(F.lit("ab_c_1"), ["ab", "ab_c", "a"])) == "ab_c"
    assert value(spark, text.prefix_class(F.lit("zz"), ["ab"])) is None
    assert value(spark, text.dataset_name(text.cache_name(F.lit("o/d--x")))) == "o/d--x"
    assert value(spark, text.snake_cache_name(F.lit("ns"), F.lit("MyHTMLData2Set"))) == "ns___my_html_data2_set"
    assert value(spark, text.listed_names(F.lit(" a, ,b ,"))) == ["a", "b"]
    assert value(spark, text.valid_bucket_uri(F.lit("s3://b"))) and not value(spark, text.valid_absolute_path(F.lit("x")))
    assert text.retry_delays(1.0, 3) == [1, 2, 4] and len(text.retry_delays(1.0, 9)) == 5


def test_tokens(spark):
    t = text.SOURCE_TOKEN
    assert value(spark, text.number_placeholders(F.lit(f"a {t} b {t}"), F.lit(1))) == f"a <|img1|> b {t}"
    assert value(spark, text.number_placeholders(F.lit("a"), F.lit(2))) == "<|img1|><|img2|>\na"
    assert value(spark, text.ensure_tokens(F.lit("x <|img1|>"), F.lit(2))) == "<|img2|>\nx <|img1|>"
    assert value(spark, text.ensure_tokens(F.lit("x"), F.lit(0))) == "x"
    caption = text.xray_caption(F.lit(" A|B "), F.lit("7"), F.lit("M"), F.lit("PA"))
    assert value(spark, caption) == "A chest X-ray (PA view) of a 7-year-old male patient showing findings of A, B."


def test_hashes():
    ramp = np.tile(np.arange(9), (8, 1))
    assert imghash.dhash(ramp) == "f" * 16 and imghash.dhash(ramp[:, ::-1]) == "0" * 16
    half = np.repeat([[0] * 4 + [255] * 4], 8, 0)
    assert imghash.ahash(half) == "0f" * 8
    noise = np.random.default_rng(0).integers(0, 255, (32, 32))
    assert imghash.hex_distance(imghash.phash(noise), imghash.phash(noise + 3)) <= 1
    assert imghash.hex_distance("0f", "f0") == 8


def test_pixels():
    flat = np.full((9, 9), 7, np.uint8)
    assert pixels.laplacian(flat).any() == False and pixels.grid_sharpness(flat) == (0.0, 0.0)  # noqa: E712
    assert pixels.circle_mask(10, 10, 0.8).sum() < 100
    assert pixels.resize(np.arange(16, dtype=np.uint8).reshape(4, 4), 2, 2).shape == (2, 2)
    y, x = np.mgrid[:4, :4].astype(float)
    image = np.arange(16, dtype=np.uint8).reshape(4, 4)
    assert (pixels.remap(image, x, y) == image).all()


def test_tiles(spark):
    assert value(spark, tiles.tile_x(F.lit(-180.0), F.lit(3))) == 0 and value(spark, tiles.tile_y(F.lit(0.0), F.lit(1))) == 1
    every = tiles.tiles_of(spark, zoom=10)
    n = every.count()
    half = tiles.sample_tiles(every, 0.5).collect()
    assert len(half) == int(n * 0.5) and half == tiles.sample_tiles(every, 0.5).collect() and half == sorted(half, key=lambda r: (r["x"], r["y"]))
    assert value(spark, tiles.parsed_slice(F.lit("slice_1_-2_3_4.pbf"))) == [1, -2, 3, 4]


def test_ordinals(spark):
    assert [ordinals.sub_batch_size(10, 3), ordinals.sub_batch_size(2, 9), ordinals.chunk_size(10, 3)] == [3, 1, 4]
    assert [ordinals.chunk_range(10, 3, k) for k in range(3)] == [(0, 4), (4, 8), (8, 10)]
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (-F.col("id")).alias("k"))
    ids = ordinals.dense_ids(df, ["g"], ["k"])
    for g, rows in enumerate([[r for r in ids.collect() if r["g"] == g] for g in range(3)]):
        assert [r["k"] for r in sorted(rows, key=lambda r: r["sample_id"])] == sorted(-k for k in range(1000) if k % 3 == g)
        assert sorted(r["sample_id"] for r in rows) == list(range(len(rows)))
    letters = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "v string, o int")
    assert [r["v"] for r in ordinals.skip_take(letters, ["o"], 2).collect()] == ["c", "d"]


def test_dedup_and_store(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, None), (5, "y")], "i int, h string")
    assert sorted(r["i"] for r in dedup.first_wins(df, F.col("h"), "i").collect()) == [1, 3, 4, 5]
    store = spark.createDataFrame([("x", 2), ("y", 9)], "h string, i int")
    assert sorted(r["i"] for r in dedup.against_store(df, store, "h", ["i"]).collect()) == [2, 3, 4]


def plain_shards(sizes, limit, rule):
    """Shards of one group by one pass."""
    shard, held, out = 0, 0, []
    for n in sizes:
        if rule == resets.BEFORE and held and held + n > limit:
            shard, held = shard + 1, 0
        out.append(shard)
        held += n
        if rule == resets.REACHING and held >= limit:
            shard, held = shard + 1, 0
    return out, held


@pytest.mark.parametrize("rule", [resets.REACHING, resets.BEFORE])
def test_sums_with_reset_compose(rule):
    """A group cut anywhere: the pieces' functions, one after another, lead where a single pass does."""
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 2, 3, 5, 30]) for _ in range(rng.randint(1, 40))]
        limit = rng.choice([1, 4, 9, 40])
        want, end = plain_shards(sizes, limit, rule)
        cuts = sorted(rng.sample(range(len(sizes) + 1), min(3, len(sizes))))
        held, shard, got = 0, 0, []
        for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
            if a == b:
                continue
            piece = np.array(sizes[a:b])
            opens = resets.openings(piece, held, limit, rule)
            got += [shard + sum(o <= k for o in opens) for k in range(b - a)]
            state = resets.exit_state(piece, held, limit, rule)
            assert state == resets.apply_transfer(resets.transfer(piece, limit, rule), int(piece.sum()), b - a, held, limit, rule)
            shard, held = shard + state[0], state[1]
        assert got == want and held == end
    assert plain_shards([5, 7, 2, 20, 1], 12, resets.BEFORE)[0] == [0, 0, 1, 2, 3]


def test_one_dataset_over_many_tasks(spark):
    rng = random.Random(4)
    rows = [(g, k, rng.choice([None, 0, 1, 7, 50]) if g else 3) for g, n in (("a", 2000), (None, 300), ("b", 5)) for k in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, k int, n int").repartition(7).withColumn("extra", F.lit("x"))
        for rule, limit in ((resets.REACHING, 60), (resets.BEFORE, 60), (resets.REACHING, 10**6), (resets.BEFORE, 4)):
            got = resets.reset_sums(df, ["g"], ["k"], "n", limit, rule, "s")
            assert got.columns == ["g", "k", "n", "extra", "s"]
            found = {(r["g"], r["k"]): r["s"] for r in got.collect()}
            for group in ("a", "b", None):
                own = sorted((k, n or 0) for g, k, n in rows if g == group)
                assert [found[group, k] for k, _ in own] == plain_shards([n for _, n in own], limit, rule)[0]
        assert resets.reset_sums(df.limit(0), ["g"], ["k"], "n", 5).collect() == []
        assert len(resets._entries(df.repartitionByRange("g", "k").sortWithinPartitions("g", "k").withColumn("_part", F.spark_partition_id()), ["g"], "n", 60, resets.REACHING)) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with pytest.raises(ValueError):
        resets.reset_sums(df, ["g"], ["k"], "n", 5, "sometimes")


def test_cache_verification(spark, tmp_path):
    import hashlib

    blobs = tmp_path / "hub" / "datasets--o--d" / "blobs"
    blobs.mkdir(parents=True)
    for data, name in ((b"one", hashlib.sha256(b"one").hexdigest()), (b"two", "0" * 64), (b"", hashlib.sha256(b"").hexdigest()), (b"x", "notes.txt")):
        (blobs / name).write_bytes(data)
    rows = verify.cache_blobs(spark, str(tmp_path))
    tally, bad = verify.verify_cache(rows)
    assert {r["status"]: r["n"] for r in tally.collect()} == {"valid": 2, "invalid": 1, "skipped": 1} and bad.count() == 1
    assert [tuple(r) for r in verify.blobs_by_dataset(rows).collect()] == [("o/d", 4)]
    assert verify.describe_dataset(rows.select("name"))["rows"] == 4
    assert verify.failure_report(verify.run_isolated({"a": lambda: None, "b": lambda: 1 / 0})) == "b: ZeroDivisionError: division by zero\n"


def test_stream_resumes_without_doubles(spark, tmp_path):
    source, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))
    spark.range(10).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("id long").parquet(source)
    runner.drain(stream(), runner.overwrite_by_batch(out), check)
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(source)
    runner.drain(stream(), runner.overwrite_by_batch(out), check)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(15))


def test_size_of_tiff():
    import struct

    from corpusloom.functions.pixels import image_size

    for order, magic in (("<", b"II*\0"), (">", b"MM\0*")):
        entries = struct.pack(order + "HHIHH", 256, 3, 1, 224, 0) + struct.pack(order + "HHII", 257, 4, 1, 100_000)
        data = magic + struct.pack(order + "I", 12) + b"data" + struct.pack(order + "H", 2) + entries
        assert image_size(data) == (224, 100_000)
        assert image_size(data[:20]) is None
