"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

The join links documents whose sets of five-word shingles have a Jaccard similarity of at least the
threshold.  Documents with equal sets form one class first, so copies are never compared.

The forest has ``TREES`` tries.  A class's key in a trie is a row of minimum hashes, of which any prefix can be
taken; classes that share a matched prefix in any trie are candidates, those below one node of the trie.
The keys of each trie are sorted, by ranges, so that the classes below a node stand together and the number below each of
its prefixes is the length of a run; runs that cross a border of ranges are summed over it.  The longest prefix looked at
is the longest that reaches the target recall for pairs at the threshold itself.  From there a matched prefix is
shortened, node by node, as long as the node above holds no more than ``SPARSE`` classes: crowded nodes stay at the length
that the target needs, and elsewhere pairs meet under shorter prefixes, which few others share, well above the target.

Candidates are verified inside trie nodes, never beyond them.  Nodes of different tries with the same
classes are one.  The classes of a node are dealt into blocks of bounded size, and two blocks meet in a task.
They meet without their shingles first: a class goes on only with a partner there whose size can reach the threshold and
whose key it shares in no earlier trie, so that sets are sent for pairs that are to be counted, and for no others.  Then
intersections of shingle sets are counted by matrix products there, and a pair counts in the first trie that
shares its prefix only, so that each is counted once.  The task returns for each class its number of links and
one edge to its part of the block, never the pairs.  Verified edges alone are closed to groups.

Results for special rows: null and blank texts have no shingles, are linked to nothing and stand
alone; a text under five words has one shingle of all its words; repeated rows are copies, each
with its own row; a null id is nobody's class id while its class has another; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.graphs import components
from corpusloom.llm.op07_substrings import chunks
from corpusloom.llm.texthash import U64, Words, mix
from corpusloom.runtime import checkpoint, release, ship

SHINGLE = 5
#: Tries, and the most minimum hashes of a key.
TREES, DEPTH = 18, 8
THRESHOLD, RECALL = 0.8, 0.999
#: A prefix is shortened while the node above holds no more classes than this.
SPARSE = 4
#: A block of a trie node holds at most about this many classes and shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 750_000
#: Shingles of at most so many classes are counted pair by pair, others by matrix products.
RARE = 12
#: Ids are broadcast up to this many (8 bytes each), and joined by shuffle beyond.
BROADCAST_IDS = 200_000

_SEEDS = (mix(np.arange(1, TREES * DEPTH + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)).reshape(TREES, DEPTH)


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    runs, whole, fits = words.runs(size), words.whole(), words.fits(size)
    out = []
    for k in range(len(words.counts)):
        low, high = words.first[k], words.first[k + 1]
        if high - low >= size:
            out.append(np.unique(runs[low:high][fits[low:high]]))
        else:
            out.append(whole[k : k + 1] if high > low else np.zeros(0, U64))
    return out


def signature(shingles: np.ndarray, depth: int = DEPTH) -> bytes:
    """``TREES * depth`` minimum hashes of 32 bits, big-endian, the keys of the tries one after another."""
    seeds = _SEEDS[:, :depth].ravel()
    least = np.full(len(seeds), 0xFFFFFFFF, U64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 512):
            most = (shingles[start : start + 512, None] * seeds).max(axis=0)
            least = np.minimum(least, U64(0xFFFFFFFF) - (most >> U64(32)))
    return least.astype(">u4").tobytes()


def _features(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets = shingle_sets(Words(batch.column(1)))
        columns = [map(_node, sets), map(len, sets), (signature(s, depth) if len(s) else None for s in sets)]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "node", "n", "sig"])


def _node(shingles: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; None for an empty one."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        pair = np.array([mix(shingles).sum(dtype=U64), mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)], U64)
    return pair.astype(">u8").tobytes()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets = shingle_sets(Words(batch.column(1)))
        arrays = [pa.array(map(_node, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles"])


def found_share(similarity: float, depth: int, trees: int = TREES) -> float:
    """The chance that a pair of this similarity shares a prefix of ``depth`` in some trie."""
    return 1 - (1 - similarity**depth) ** trees


def least_depth(threshold: float, recall: float) -> int:
    """The longest prefix that reaches the recall for pairs at the threshold."""
    return max([d for d in range(1, DEPTH + 1) if found_share(threshold, d) >= recall], default=1)


def sorted_tries(nodes: DataFrame, depth: int) -> DataFrame:
    """tree, key (``depth`` words), node and n of each class in each trie, sorted in ranges of tree and key."""
    key = F.expr(f"substring(sig, tree * {4 * depth} + 1, {4 * depth})")
    each = nodes.select("node", "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select("tree", key.alias("key"), "node", "n")
    return checkpoint(each.repartitionByRange("tree", "key").sortWithinPartitions("tree", "key"))


class _Range:
    """The sorted keys of one range, and the runs of equal prefixes in it."""

    def __init__(self, batches: Iterator[pa.RecordBatch], depth: int):
        kept = [b for b in batches if b.num_rows]
        self.rows = pa.Table.from_batches(kept) if kept else None
        self.depth = depth
        if self.rows is None:
            return
        self.tree = self.rows.column("tree").to_numpy()
        keys = self.rows.column("key").combine_chunks()
        self.words = np.frombuffer(b"".join(keys.to_pylist()), ">u4").reshape(-1, depth)

    def runs(self) -> Iterator[np.ndarray]:
        """The first row of each run, for prefixes of one word, of two, and so on."""
        new = np.concatenate([[True], self.tree[1:] != self.tree[:-1]])
        for d in range(self.depth):
            new = new | np.concatenate([[True], self.words[1:, d] != self.words[:-1, d]])
            yield np.flatnonzero(new)

    def prefix(self, row: int, d: int) -> tuple[int, bytes]:
        return int(self.tree[row]), self.words[row, :d].tobytes()


def _borders(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """For each length of prefix the first and the last run of a range, with their numbers of classes."""
    found = _Range(batches, depth)
    if found.rows is None:
        return
    rows, n = [], found.rows.num_rows
    for d, starts in enumerate(found.runs(), 1):
        sizes = np.diff(np.append(starts, n))
        for k in {0, len(starts) - 1}:
            rows.append((*found.prefix(starts[k], d), int(sizes[k])))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.int64()), strict=True)], ["tree", "prefix", "n"])


def _matched(batches: Iterator[pa.RecordBatch], depth: int, crossing: dict[tuple[int, bytes], int]) -> Iterator[pa.RecordBatch]:
    """node, n, tree and matched prefix of the classes that share theirs with others."""
    found = _Range(batches, depth)
    if found.rows is None:
        return
    n = found.rows.num_rows
    below = np.zeros((depth, n), np.int64)
    for d, starts in enumerate(found.runs(), 1):
        sizes = np.diff(np.append(starts, n))
        for k in {0, len(starts) - 1}:
            sizes[k] = crossing.get(found.prefix(starts[k], d), sizes[k])
        below[d - 1] = np.repeat(sizes, np.diff(np.append(starts, n)))
    # Sizes fall with the length: the shortest prefix that is sparse, else the longest of all.
    length = np.minimum((below > SPARSE).sum(axis=0) + 1, depth)
    shared = np.flatnonzero(below[length - 1, np.arange(n)] > 1)
    prefixes = [found.words[k, : length[k]].tobytes() for k in shared.tolist()]
    part = found.rows.take(pa.array(shared)).combine_chunks()
    columns = [part.column(c).combine_chunks() for c in ("node", "n", "tree")]
    for start in range(0, len(shared), 10_000):
        yield pa.RecordBatch.from_arrays([*(c.slice(start, 10_000) for c in columns), pa.array(prefixes[start : start + 10_000], pa.binary())], ["node", "n", "tree", "prefix"])


def memberships(nodes: DataFrame, depth: int) -> DataFrame:
    """node, n, tree and key (of the trie node) for each class in each trie where it shares its matched prefix.

    Runs that cross a border of ranges come to the driver, two a range and length at most.
    """
    tries = sorted_tries(nodes, depth)
    runs = tries.mapInArrow(lambda batches: _borders(batches, depth), "tree int, prefix binary, n long")
    spread = runs.groupBy("tree", "prefix").agg(F.sum("n").alias("n"), F.count("*").alias("ranges")).filter("ranges > 1").collect()
    crossing = {(r["tree"], bytes(r["prefix"])): r["n"] for r in spread}
    matched = tries.mapInArrow(lambda batches: _matched(batches, depth, crossing), "node binary, n long, tree int, prefix binary")
    return checkpoint(matched.select("node", "n", "tree", F.xxhash64("tree", "prefix").alias("key")))


def with_keys(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` with ``keys``, the trie node of the class in each trie; a number of its own where it shares none."""
    at = found.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("tree", "key"))).alias("at"))
    own = lambda t: F.coalesce(F.try_element_at("at", t), F.xxhash64("node", t))
    return members.join(at.select("node", F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), own).alias("keys")), "node")


def trie_nodes(found: DataFrame) -> DataFrame:
    """The trie nodes of several classes: key, tree and number of blocks; of nodes with the same classes, that of the first trie."""
    who = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"who{k}") for k in range(2)]
    every = found.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"), F.min("tree").alias("tree"), *who).filter("classes > 1")
    first = every.groupBy("who0", "who1", "classes").agg(F.min_by(F.struct("key", "tree", "shingles"), "tree").alias("f")).select("classes", "f.*")
    blocks = F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    return checkpoint(first.select("key", F.col("tree").alias("first"), blocks.alias("blocks")))


def _unmet(keys: np.ndarray, left: np.ndarray, right: np.ndarray, tree: int) -> np.ndarray:
    """For each class of ``left`` and of ``right`` whether they share no key in a trie before ``tree``."""
    out = np.ones((len(left), len(right)), bool)
    for earlier in range(tree):
        out &= keys[left, earlier][:, None] != keys[right, earlier][None, :]
    if left is right:
        np.fill_diagonal(out, False)
    return out


def _partnered(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """The rows of two blocks (or one) with a partner that can reach the threshold by size and is met in no earlier trie."""
    ratio = Fraction(threshold).limit_denominator(10_000)

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, sizes = table.column("block").to_numpy(), table.column("n").to_numpy()
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, TREES)
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        # At most the smaller set is shared, so the larger one is at most so many times as large.
        least = np.minimum(sizes[left][:, None], sizes[right][None, :])
        most = np.maximum(sizes[left][:, None], sizes[right][None, :])
        pairs = _unmet(keys, left, right, table.column("first")[0].as_py()) & (least * ratio.denominator >= most * ratio.numerator)
        needed = np.zeros(table.num_rows, bool)
        needed[left[pairs.any(axis=1)]] = True
        needed[right[pairs.any(axis=0)]] = True
        out = table.drop_columns(["n"]).filter(pa.array(needed))
        at = out.column_names.index("keys")
        return out.set_column(at, "keys", out.column("keys").cast(pa.list_(pa.int64())))

    return run


def partnered(members: DataFrame, threshold: float) -> DataFrame:
    """node, key, first, keys, block and blocks that meet (i, j) for each class of ``members`` that verification needs there."""
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = members.select("node", "n", "key", "first", "keys", "block", other)
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    shape = "node binary, key long, first int, keys array<long>, block int, i int, j int"
    return checkpoint(met.groupBy("key", "i", "j").applyInArrow(_partnered(threshold), shape))


def _intersections(rows: np.ndarray, shingles: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each class of ``left`` and of ``right`` the number of shingles they share.

    ``rows`` names the class of each entry of ``shingles``.
    """
    order = np.lexsort((rows, shingles))
    rows, shingles = rows[order], shingles[order]
    new = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    df = np.diff(np.concatenate([new, [len(shingles)]]))
    total = max(left.max(), right.max()) + 1
    counts = np.zeros((total, total), np.int64)
    for f in range(2, RARE + 1):
        starts = new[df == f]
        if len(starts):
            members = rows[starts[:, None] + np.arange(f)]
            for a in range(f):
                for b in range(a + 1, f):
                    np.add.at(counts, (members[:, a], members[:, b]), 1)
    counts += counts.T
    common = new[df > RARE]
    sizes = df[df > RARE]
    for start in range(0, len(common), 4096):
        first, width = common[start : start + 4096], sizes[start : start + 4096]
        column = np.repeat(np.arange(len(first)), width)
        entry = np.repeat(first - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        dense = np.zeros((total, len(first)), np.float32)
        dense[rows[entry], column] = 1
        counts += (dense @ dense.T).astype(np.int64) if left is right else 0
        if left is not right:
            counts[np.ix_(left, right)] += (dense[left] @ dense[right].T).astype(np.int64)
    return counts[np.ix_(left, right)]


def _verifier(threshold: float) -> Callable[[pa.Table], pa.Table]:
    ratio = Fraction(threshold).limit_denominator(10_000)

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        nodes = table.column("node").to_pylist()
        block = table.column("block").to_numpy()
        tree = table.column("first")[0].as_py()
        keys = np.array(table.column("keys").to_pylist(), np.int64)
        copies = table.column("m").to_numpy()
        sets = [np.frombuffer(s, U64) for s in table.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        links = np.zeros(len(nodes), np.int64)
        root = list(range(len(nodes)))

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        if len(left) and len(right):
            shared = _intersections(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), left, right)
            p, q = ratio.numerator, ratio.denominator
            linked = shared * (p + q) >= p * (sizes[left][:, None] + sizes[right][None, :])
            linked &= _unmet(keys, left, right, tree)
            if left is right:
                links[left] = linked @ copies[left]
            else:
                links[left] = linked @ copies[right]
                links[right] = linked.T @ copies[left]
            for a, row in zip(left.tolist(), linked, strict=True):
                for b in right[row].tolist():
                    x, y = top(a), top(b)
                    if x != y:
                        root[max(x, y, key=lambda k: nodes[k])] = min(x, y, key=lambda k: nodes[k])
        tops = [nodes[top(k)] for k in range(len(nodes))]
        touched = np.flatnonzero(links)
        take = lambda values: [values[k] for k in touched.tolist()]
        return pa.table({"node": pa.array(take(nodes), pa.binary()), "links": pa.array(links[touched], pa.int64()), "top": pa.array(take(tops), pa.binary())})

    return run


def _sets_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """node and shingles of ``members`` (node, cls), from the texts of their class ids.

    Classes without an id take theirs from the rows without one, each class once.
    """
    shape = "node binary, shingles binary"
    ids = members.filter("cls IS NOT NULL").select(F.col("cls").alias("doc_id"))
    ids = F.broadcast(ids) if members.count() <= BROADCAST_IDS else ids
    texts = rows.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_sets, shape)
    bare = members.filter("cls IS NULL").select("node")
    n_bare = bare.count()
    if n_bare:
        bare = F.broadcast(bare) if n_bare <= BROADCAST_IDS else bare
        lost = rows.filter("doc_id IS NULL").select("doc_id", "text").mapInArrow(_sets, shape)
        sets = sets.unionByName(lost.join(bare, "node", "left_semi").dropDuplicates(["node"]))
    return sets.join(members.select("node"), "node", "left_semi").dropDuplicates(["node"])


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, copy_id, class_id, n_links for each row.

    ``copy_id`` is the least id with the same shingles, ``class_id`` the least id of the connected
    group, ``n_links`` the number of other rows of at least the threshold's similarity.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    depth = least_depth(threshold, recall)
    features = checkpoint(rows.mapInArrow(lambda batches: _features(batches, depth), "doc_id long, node binary, n long, sig binary"))
    nodes = features.filter("node IS NOT NULL").groupBy("node")
    nodes = checkpoint(nodes.agg(F.count("*").alias("m"), F.min("doc_id").alias("cls"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    release(spark)
    found = memberships(nodes, depth)
    release(spark)
    shared = trie_nodes(found)
    # A node of a later trie with the same classes shares its key with none that was kept.
    members = found.join(shared, "key").select("node", "n", "key", "first", "blocks")
    members = checkpoint(with_keys(members, found).select("node", "n", "keys", "key", "first", "blocks"))
    del found, shared
    release(spark)
    members = partnered(members, threshold)
    release(spark)
    classes = checkpoint(members.select("node").distinct().join(nodes.select("node", "m", "cls"), "node"))
    sets = _sets_of(rows, classes.select("node", "cls")).join(classes.select("node", "m"), "node")
    paired = members.join(sets, "node").select("key", "first", "keys", "node", "m", "shingles", "block", "i", "j")
    verified = paired.groupBy("key", "i", "j").applyInArrow(_verifier(threshold), "node binary, links long, top binary")
    verified = checkpoint(verified)
    release(spark)
    groups = components(verified.select(F.col("node").alias("a"), F.col("top").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "m", "cls").join(links, "node", "left").join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = checkpoint(known.groupBy("label").agg(F.min("cls").alias("class_id")))
    known = checkpoint(known.join(least, "label").select("node", "m", "cls", "class_id", F.coalesce("links", F.lit(0)).alias("links")))
    out = features.select("doc_id", "node").join(known, "node", "left")
    return out.select(
        "doc_id",
        F.coalesce("cls", "doc_id").alias("copy_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("links") + F.col("m") - 1, F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the least id, and one only of rows that share it.

    Rows with a null id are kept.  The ids of dropped rows are broadcast up to BROADCAST_IDS.
    """
    groups = checkpoint(jaccard_groups(docs, doc_id, text))
    dropped = checkpoint(groups.filter("doc_id != class_id").select("doc_id").distinct())
    kept = groups.filter("doc_id = class_id").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    gone = dropped.withColumnRenamed("doc_id", doc_id)
    gone = F.broadcast(gone) if dropped.count() <= BROADCAST_IDS else gone
    out = docs.join(gone, doc_id, "left_anti")
    if kept["n"] == kept["d"]:
        return out
    known = F.col(f"`{doc_id}`").isNotNull()
    return out.filter(known).dropDuplicates([doc_id]).unionByName(out.filter(~known))
