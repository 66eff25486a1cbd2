"""The MinHash forest: matched prefixes by node against plain dictionaries, and recall against all pairs."""

import random
import struct
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import op04_jaccard
from tests.llm import brute


def keyed_classes(rng: random.Random, n: int, depth: int) -> list[tuple[bytes, int, bytes]]:
    """Classes with keys from few values, so that nodes of all sizes and depths are there; some tries are crowded."""
    rows = []
    for k in range(n):
        words = []
        for tree in range(op04_jaccard.TREES):
            few = 1 if tree == 0 and k % 3 else 2 + tree % 5
            words += [rng.randrange(few) * 0x01010101 for _ in range(depth)]
        rows.append((b"%08d" % k, 10, struct.pack(f">{len(words)}I", *words)))
    return rows


def plain_nodes(rows, depth: int) -> dict[tuple[int, tuple], set[bytes]]:
    """The classes of each trie node that several share, and that is the shortest sparse one, or the longest."""
    out = {}
    for tree in range(op04_jaccard.TREES):
        keys = {node: struct.unpack(f">{depth}I", sig[4 * depth * tree : 4 * depth * (tree + 1)]) for node, _, sig in rows}
        sizes = Counter(key[:d] for key in keys.values() for d in range(1, depth + 1))
        found = defaultdict(set)
        for node, key in keys.items():
            length = next((d for d in range(1, depth) if sizes[key[:d]] <= op04_jaccard.SPARSE), depth)
            found[tree, key[:length]].add(node)
        out |= {k: v for k, v in found.items() if len(v) > 1}
    return out


@pytest.mark.parametrize("ranges", ["1", "23"])
def test_prefixes_are_shortened_node_by_node(spark, ranges):
    """Prefixes of different lengths in one trie; nodes that many ranges share are one."""
    rng, depth = random.Random(1), 5
    rows = keyed_classes(rng, 400, depth)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes = spark.createDataFrame(rows, "node binary, n long, sig binary")
        got = defaultdict(set)
        for r in op04_jaccard.memberships(nodes, depth).collect():
            got[r["tree"], r["key"]].add(bytes(r["node"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = plain_nodes(rows, depth)
    assert sorted((t, sorted(v)) for (t, _), v in got.items()) == sorted((t, sorted(v)) for (t, _), v in want.items())
    assert {len(p) for t, p in want if t == 3} >= {4, 5} and any(len(v) > 100 for v in want.values())


def test_recall_against_all_pairs(spark):
    """Queries are the ids divisible by 50, against all; pairs lie at similarities from 0.8 up, amid a crowd with one opening."""
    rng = random.Random(2)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    opening, rows = words(30), []
    for k in range(0, 1500, 50):
        base = words(100)
        rows.append((k, " ".join(base)))
        for j in range(1, 12):
            other = list(base)
            for at in rng.sample(range(100), rng.randint(1, 3)):
                other[at] = f"x{k}-{j}-{at}"
            rows.append((k + j, " ".join(other)))
        rows += [(k + j, " ".join(opening + words(60))) for j in range(12, 30)]
    _, counts = brute.links(rows)
    got = {r["doc_id"]: r["n_links"] for r in op04_jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    true = {k: n for (k, _), n in zip(rows, counts, strict=True)}
    queries = [k for k, _ in rows if k % 50 == 0]
    assert sum(got[k] for k in queries) >= 0.99 * sum(true[k] for k in queries) > 0
    assert all(got[k] <= true[k] for k, _ in rows)


@pytest.mark.parametrize("block", [256, 5])
def test_sets_are_sent_for_pairs_to_be_counted_only(spark, monkeypatch, block):
    """Of nodes that hold classes of many sizes, in several tries, each pair that can be linked keeps its first node, and nothing else goes on."""
    monkeypatch.setattr(op04_jaccard, "BLOCK_CLASSES", block)
    rng = random.Random(3)
    n = {b"%04d" % k: rng.choice((50, 60, 90, 140, 1000 + 900 * k)) for k in range(90)}
    found, together = [], defaultdict(list)
    for tree in range(4):
        for node in n:
            if rng.random() < 0.7:
                key = tree * 100 + rng.randrange(6)
                found.append((node, n[node], tree, key))
                together[key].append(node)
    found = spark.createDataFrame(found, "node binary, n long, tree int, key long")
    shared = op04_jaccard.trie_nodes(found)
    members = op04_jaccard.with_keys(found.join(shared, "key").select("node", "n", "key", "first", "blocks"), found)
    got = {(r["key"], r["i"], r["j"], bytes(r["node"])): r["block"] for r in op04_jaccard.partnered(members, 0.8).collect()}
    first, want = {}, set()
    for key in sorted(together):
        for a in together[key]:
            for b in together[key]:
                if a < b and 5 * min(n[a], n[b]) >= 4 * max(n[a], n[b]):
                    first.setdefault((a, b), key)
    at = {(key, node): b for (key, _, _, node), b in got.items()}
    for (a, b), key in first.items():
        i, j = sorted((at[key, a], at[key, b]))
        want |= {(key, i, j, a), (key, i, j, b)}
    assert set(got) == want
    assert len(want) < sum(map(len, together.values())) or block == 5
    assert block == 256 or max(j for _, _, j, _ in want) > 0
