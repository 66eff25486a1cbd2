"""Operators 11 to 13 against brute force, on tables with nulls, empty texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import op13_repair
from corpusloom.llm.op11_shards import shard_rows, shards_of, key_text, write_shards
from corpusloom.llm.op12_whitening import components_of, one_sided_jacobi, pivoted_cholesky, whiten
from corpusloom.llm.op13_repair import repair

CLASHING = ["shard", "slot", "key", "size", "draw", "part", "y", "n", "conv", "kind", "copies", "fault", "head", "digest", "tag", "step"]


def clash(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# 11


def winner(key, weights):
    """The shard with the highest draw, in plain Python."""
    name = "~" if key is None else f"={key}"
    draws = []
    for k, w in enumerate(weights):
        u = (int(hashlib.md5(f"{name}:{k}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        draws.append((-w / math.log(u), -k))
    return -max(draws)[1]


DOCS = [(k, f"text {k % 7}") for k in range(300)] + [(None, "no id"), (None, "no id"), (None, None), (7, None), (8, ""), (9, "é" * 50_000), (5, "text 5"), (5, "text 5")]


def test_shards_equal_brute_force(spark):
    rows = clash(spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5))
    got = [r.asDict() for r in shard_rows(rows).collect()]
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), winner(k, [1] * 8), winner(k, [1] * 9)) for k, t in DOCS)
    assert Counter((r["key"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    by_shard = defaultdict(list)
    for r in got:
        assert r["grown_shard"] in (r["shard"], 8)
        by_shard[r["shard"]].append((r["slot"], r["key"] is not None, r["key"] or 0, r["size"], r["text_crc32"]))
    for rows_of in by_shard.values():
        rows_of.sort()
        assert [r[0] for r in rows_of] == list(range(len(rows_of))) and [r[1:] for r in rows_of] == sorted(r[1:] for r in rows_of)
    assert shard_rows(rows.limit(0)).collect() == []


def test_a_hot_key_does_not_make_a_hot_task(spark):
    """Two thirds of all rows have one id: its numbering is spread over tasks and has no gaps."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("doc_id"), F.lit("a b").alias("text"))
    got = shard_rows(rows)
    hot = got.filter("key = -1").select("shard", "slot").collect()
    assert len(hot) == 4000 and len({r["shard"] for r in hot}) == 1
    slots = sorted(r["slot"] for r in hot)
    assert slots == list(range(slots[0], slots[0] + 4000))


def test_weights_share_keys_and_few_move(spark):
    keys = spark.range(20_000).withColumn("k", key_text(F.col("id")))
    before, after, fewer = (1.0, 2.0, 0.0, 1.0), (1.0, 2.0, 0.0, 1.0, 4.0), (1.0, 0.0, 0.0, 1.0)
    rows = keys.select(*(c.alias(n) for c, n in zip(shards_of(F.col("k"), before, after, fewer), "abc", strict=True))).collect()
    count = Counter(r["a"] for r in rows)
    assert 2 not in count and abs(count[1] / 20_000 - 0.5) < 0.02 and abs(count[0] / 20_000 - 0.25) < 0.02
    assert all(r["b"] in (r["a"], 4) for r in rows) and abs(sum(r["b"] == 4 for r in rows) / 20_000 - 0.5) < 0.02
    assert all(r["c"] == r["a"] for r in rows if r["a"] != 1)
    with pytest.raises(ValueError):
        shards_of(F.col("k"), (0.0,))


def test_written_shards_hold_each_row_once(spark, tmp_path):
    rows = spark.createDataFrame(DOCS, "doc_id long, text string")
    write_shards(rows, str(tmp_path / "out"), pieces=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(DOCS)
    assert all(r["shard"] == winner(r["doc_id"], [1] * 8) for r in back.collect())
    assert all(len(list(p.glob("*.parquet"))) <= 2 for p in (tmp_path / "out").glob("shard=*"))


# 12


def vectors(seed=3, n=400, d=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.2
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(base)]
    rows += [(n + k, rows[0][1]) for k in range(200)] + [(1, rows[1][1]), (None, rows[2][1])]
    rows += [(900, None), (901, [math.nan] * d), (902, [math.inf] + [0.0] * (d - 1)), (903, [None] + [0.0] * (d - 1)), (904, []), (905, [1.0]), (906, [1e30] * d)]
    return rows


def whitened_by_eigh(rows, d):
    usable = [(k, v) for k, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) and abs(x) < 1e14 for x in v)]
    ints = [tuple(math.floor(64 * x) + 1_000_000 for x in v) for _, v in usable]
    fit = sorted(set(ints))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = lambda x: np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
    m = np.array([centred(x) for x in fit])
    values, axes = np.linalg.eigh(m.T @ m / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = defaultdict(list)
    for (k, _), x in zip(usable, ints, strict=True):
        out[k].append((sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), centred(x) @ axes / np.sqrt(values)))
    return n, values, out


def test_whitening_equals_a_symmetric_eigensolver(spark):
    rows = vectors()
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    got = whiten(spark, df, components=5).collect()
    n, values, want = whitened_by_eigh(rows, 12)
    assert {r["vec_id"] for r in got} == set(want) and len(got) == 5 * sum(map(len, want.values()))
    signs = {}
    for r in got:
        k = r["component"] - 1
        deviation, axis = want[r["vec_id"]][0]
        assert r["n"] == n and r["deviation"] == deviation
        signs.setdefault(k, math.copysign(1, r["whitened"] * axis[k]) if abs(axis[k]) > 1e-6 else None)
        if signs[k] is None:
            del signs[k]
            continue
        assert abs(r["whitened"] - signs[k] * axis[k]) < 1e-9
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-10 and r["identity_error"] < 1e-10


def test_whitening_of_few_and_equal_vectors(spark):
    kind = "vec_id long, embedding array<double>"
    assert whiten(spark, spark.createDataFrame([], kind)).collect() == []
    assert whiten(spark, spark.createDataFrame([(1, None)], kind)).collect() == []
    assert whiten(spark, spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], kind)).collect() == []
    line = whiten(spark, spark.createDataFrame([(k, [k / 64, 2 * k / 64, 0.0]) for k in range(5)], kind)).collect()
    assert [r["component"] for r in line] == [1] * 5 and abs(line[0]["explained"] - 1) < 1e-12
    assert sorted(round(abs(r["whitened"]), 9) for r in line) == sorted(round(abs(k - 2) / math.sqrt(2), 9) for k in range(5))


def test_factor_and_rotations():
    rng = np.random.default_rng(0)
    b = rng.normal(size=(30, 9)) * np.logspace(0, -4, 9)
    a = b.T @ b
    factor, order = pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-12) and np.allclose(factor, np.tril(factor))
    rotated = one_sided_jacobi(factor)
    gram = rotated.T @ rotated
    assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-14 * np.abs(gram).max()
    values, axes = components_of(a)
    assert np.allclose(values, np.linalg.svd(b)[1] ** 2, rtol=1e-9) and np.allclose(a @ axes, axes * values, atol=1e-12)
    assert components_of(np.zeros((3, 3)))[0].size == 0


def test_sums_of_large_entries_are_exact(spark):
    rows = [(k, [float(2**46 + k), -float(2**46)]) for k in range(3)]
    got = whiten(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(r["deviation"] for r in got) == [0, (3 * 64) ** 2, (3 * 64) ** 2]


# 13


def fallen(rows):
    """Conversations after damage, each in its order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        out[conv] += [row] * (2 if fault == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows):
    """Faults, and the least (cost, letters, text) by trying all edits from the last row to the first, up to two insertions in a place."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {q: (0, "", ()) if q in ("", "a") else None for q in ("", "s", "u", "a")}

    def insert(best):
        for _ in range(2):
            new = dict(best)
            for q in best:
                for role in ("user", "assistant"):
                    to = STEPS.get((q, role[0]))
                    if to is not None and best[to] is not None:
                        cost, letters, items = best[to]
                        new[q] = min(filter(None, (new[q], (cost + 2, "I" + letters, (role + ":", *items)))))
            best = new
        return best

    best = insert(best)
    for (_, role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        new = {}
        for q in best:
            ways = []
            if best[q] is not None:
                ways.append((best[q][0] + 3, "D" + best[q][1], best[q][2]))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for letter, cost, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    to = STEPS.get((q, name[:1]))
                    if to is not None and best[to] is not None:
                        ways.append((best[to][0] + cost + extra, letter + best[to][1], (f"{name}:{text}", *best[to][2])))
            new[q] = min(ways, default=None)
        best = insert(new)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, letters, items = best[""]
    counts = Counter(faults)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters, hashlib.sha256("\n".join(items).encode()).hexdigest()


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def compared(spark, rows, **options):
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair(spark, clash(spark.createDataFrame(rows, CONVERSATIONS)), **options).collect()}
    want = {conv: plain_repair(found) for conv, found in fallen(rows).items()}
    assert got == want
    return got


def talk(rng, conv, n, roles=("user", "assistant"), odd=0.2):
    rows = []
    for k in range(n):
        role = rng.choice(["system", "user", "assistant", "tool", "", "s", "User", None]) if rng.random() < odd else roles[k % 2]
        text = rng.choice(["", " \n", None, "yes", "no.", "what?"]) if rng.random() < odd else f"word {conv} {k}" + rng.choice([".", "!", "", " .\n"])
        rows.append((conv, None if rng.random() < odd / 8 else k if rng.random() > odd / 4 else k - 1, role, text))
    return rows


def test_repairs_equal_trying_all_edits(spark):
    rng = random.Random(11)
    rows = [r for conv in range(150) for r in talk(rng, conv, rng.randint(1, 14), odd=rng.choice([0.05, 0.3, 0.9]))]
    rows += talk(rng, None, 12) + [(None, None, None, None)] * 3 + [(500, 3, "user", "same.")] * 5 + [(501, -(2**62), "user", "a."), (501, 2**62, "assistant", "b.")]
    rows += [(502, k, "system", "s.") for k in range(4)] + [(503, 1, "user", "long " * 40_000)]
    dropped = [c for c in range(1000, 1400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    rows += [(c, 0, "user", "gone.") for c in dropped]
    got = compared(spark, rows)
    assert got[dropped[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_conversation_over_many_ranges_and_blocks(spark):
    """One conversation of thousands of rows: cut by ranges, decided in blocks, equal to the whole."""
    rng = random.Random(12)
    rows = talk(rng, 1, 3000, odd=0.4) + talk(rng, 2, 40) + [(3, k, "user", "again and again") for k in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        light = op13_repair.light_rows(op13_repair.damaged(spark.createDataFrame(rows, CONVERSATIONS)))
        assert light.filter("conv = 1").select("part").distinct().count() > 2
        assert len(op13_repair.border_states(light.select(*op13_repair.KEYS, "copies", "blank", "truncated", "again", "part"))) > 2
        compared(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_blocks_do_not_matter(monkeypatch):
    rng = random.Random(13)
    for _ in range(60):
        n = rng.randint(1, 40)
        kinds = [rng.randrange(op13_repair.N_KINDS) for _ in range(n)]
        times = [rng.randint(1, 3) if k == op13_repair.MUST_GO else 1 for k in kinds]
        found = []
        for block in (1, 3, 64):
            monkeypatch.setattr(op13_repair, "BLOCK", block)
            found.append(op13_repair.least_edits(kinds, times, op13_repair.ends_of(op13_repair.ENDS), op13_repair.START, True))
        assert found[0] == found[1] == found[2]


def test_repair_of_nothing_and_without_damage(spark):
    assert repair(spark, spark.createDataFrame([], CONVERSATIONS)).collect() == []
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "c.")]
    (got,) = repair(spark, spark.createDataFrame(rows, CONVERSATIONS), damage=False).collect()
    assert (got["audit"], got["cost"], got["truncated"]) == plain_audit(rows)


def plain_audit(rows):
    found = plain_repair([r[1:] for r in rows])
    return found[6], found[5], found[3]
