"""Substring dedup: winnowed anchors, extension both ways, repeats over a length.

A window of ``WINDOW`` words is removed from a document if its words also start somewhere in a
document with a smaller id.  Three passes over the texts find these windows without ever pairing
documents:

1. Seeds.  Of every window's five-word runs the one with the least hash is its anchor (winnowing):
   equal windows have equal anchors, about one word in five starts one.  Anchors go to hash buckets,
   which answer to each document which of its anchors another document has too.
2. Extension.  Around each shared anchor the document's windows that it anchors, up to eight words
   to either side, are compared in full (96 bits of two independent hashes) in hash buckets, which
   answer to each document which of its windows a smaller id has.
3. Maximal repeats.  Runs of found windows are joined, and their words removed.

What repeats within a chunk of texts is settled there, and a chunk sends each anchor or window once
for its smallest id.  A passage that a third of all documents share is therefore one entry for each
chunk, not for each document.  Documents whose words are a copy of a smaller id's are settled in the
first pass, and send no windows.  Buckets are as many as the input's splits need.

Results for special rows: null and blank texts have no words; texts under 13 words lose nothing;
rows that share an id never remove each other's words; a row with a null id is left whole and
removes nothing; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.texthash import U64, Words, mix
from corpusloom.runtime import checkpoint, release, ship

WINDOW, GRAM = 13, 5
#: Texts are worked on in chunks of about this many bytes.
CHUNK_BYTES = 2 << 20
BUCKETS_PER_SPLIT = 4
#: Payloads of one kind each: anchors, whole texts, windows.
ANCHORS, WHOLES, WINDOWS = 0, 1, 2
SENT = "bucket int, kind int, doc_id long, payload binary"
ANSWER = "doc_id long, kind int, payload binary"


def chunks(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about CHUNK_BYTES of text, one row at least."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for k, n in enumerate(lengths.tolist()):
            size += n
            if size >= CHUNK_BYTES:
                waiting.append(batch.slice(start, k + 1 - start))
                yield _joined(waiting)
                waiting, size, start = [], 0, k + 1
        if start < batch.num_rows:
            waiting.append(batch.slice(start))
    if waiting:
        yield _joined(waiting)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(0)
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known


def _anchored(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words at which windows start, and the hash of each window's anchor."""
    at = np.flatnonzero(words.fits(WINDOW))
    grams = words.runs(GRAM)
    best = grams[at]
    for k in range(1, WINDOW - GRAM + 1):
        best = np.minimum(best, grams[at + k])
    return at, best


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(c.tobytes() for c in columns)


def _unpack(payload: bytes, kind: int) -> tuple[np.ndarray, ...]:
    """Hashes, ids, and for windows and whole texts the second hashes."""
    width = 16 if kind == ANCHORS else 20
    n = len(payload) // width
    first, ids = np.frombuffer(payload, U64, n), np.frombuffer(payload, np.int64, n, 8 * n)
    return first, ids, (np.zeros(n, np.uint32) if kind == ANCHORS else np.frombuffer(payload, np.uint32, n, 16 * n))


def _grouped(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows in the order of hashes and ids, and the place at which each row's group starts."""
    order = np.lexsort((ids, second, first))
    first, second, ids = first[order], second[order], ids[order]
    if not len(ids):
        return first, second, ids, np.zeros(0, np.int64)
    new = np.ones(len(ids), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    fresh = new.copy()
    fresh[1:] |= ids[1:] != ids[:-1]
    first, second, ids, new = first[fresh], second[fresh], ids[fresh], new[fresh]
    return first, second, ids, np.flatnonzero(new)[np.cumsum(new) - 1]


def _answers(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Ids, and the hashes of each as one payload."""
    order = np.argsort(ids, kind="stable")
    ids, hashes = ids[order], hashes[order]
    cuts = np.flatnonzero(np.diff(ids)) + 1 if len(ids) else np.zeros(0, np.int64)
    return ids[np.concatenate([[0], cuts])] if len(ids) else ids, [h.tobytes() for h in np.split(hashes, cuts)] if len(ids) else []


class _Out:
    """Rows of SENT."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.rows: list[tuple[int, int, int | None, bytes]] = []

    def send(self, kind: int, first: np.ndarray, ids: np.ndarray, second: np.ndarray | None) -> None:
        bucket = (mix(first) % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            columns = [first[part], ids[part], *([] if second is None else [second[part]])]
            self.rows.append((int(bucket[part[0]]), kind, None, _pack(*columns)))

    def answer(self, kind: int, ids: np.ndarray, hashes: np.ndarray) -> None:
        for doc, payload in zip(*_answers(ids, hashes), strict=True):
            self.rows.append((int(doc) % self.buckets, kind, int(doc), payload))

    def batch(self) -> pa.RecordBatch:
        bucket, kind, ids, payload = zip(*self.rows, strict=True) if self.rows else ((), (), (), ())
        arrays = [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(ids, pa.int64()), pa.array(payload, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["bucket", "kind", "doc_id", "payload"])


def _settle(out: _Out, kind: int, first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> None:
    """Answer what a chunk itself shows, and send each hash once for its smallest id."""
    first, second, ids, start = _grouped(first, second, ids)
    if not len(ids):
        return
    at = np.arange(len(ids))
    later = at > start
    if kind == ANCHORS:
        sizes = np.bincount(start, minlength=len(ids))
        told = sizes[start] > 1
    else:
        told = later
    out.answer(kind, ids[told], first[told])
    out.send(kind, first[~later], ids[~later], None if kind == ANCHORS else second[~later])


def _bucket(rows: pa.Table) -> pa.Table:
    """Answers of one bucket: shared anchors to all their documents, the rest to all but the smallest id."""
    ids, kinds, payloads = rows.column("doc_id").to_pylist(), rows.column("kind").to_pylist(), rows.column("payload").to_pylist()
    out: list[tuple[int, int, bytes]] = [(d, k, p) for d, k, p in zip(ids, kinds, payloads, strict=True) if d is not None]
    for kind in (ANCHORS, WHOLES, WINDOWS):
        sent = [_unpack(p, kind) for d, k, p in zip(ids, kinds, payloads, strict=True) if d is None and k == kind]
        if not sent:
            continue
        first, docs, second = (np.concatenate(c) for c in zip(*sent, strict=True))
        first, second, docs, start = _grouped(first, second, docs)
        told = np.bincount(start, minlength=len(docs))[start] > 1 if kind == ANCHORS else np.arange(len(docs)) > start
        out += [(int(d), kind, p) for d, p in zip(*_answers(docs[told], first[told]), strict=True)]
    doc, kind_, payload = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "kind": pa.array(kind_, pa.int32()), "payload": pa.array(payload, pa.binary())})


def _seeds(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, known = _ids(batch)
            words, out = Words(batch.column(1), second=True), _Out(buckets)
            long = known & (words.counts >= WINDOW)
            _settle(out, WHOLES, words.whole()[long], words.whole(1)[long].astype(np.uint32), ids[long])
            at, anchors = _anchored(words)
            text_of = words.text_of[at]
            changed = np.ones(len(at), bool)  # windows of a text in a row mostly have one anchor
            changed[1:] = (anchors[1:] != anchors[:-1]) | (text_of[1:] != text_of[:-1])
            changed &= known[text_of]
            _settle(out, ANCHORS, anchors[changed], np.zeros(changed.sum(), np.uint32), ids[text_of[changed]])
            yield out.batch()

    return run


def _told(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """All hashes of a column of lists of payloads, each mixed with the number of its row."""
    parts = []
    for row, lists in enumerate(batch.column(column).to_pylist()):
        if lists:
            parts.append(_in_row(np.frombuffer(b"".join(lists), U64), row))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, U64)


def _in_row(hashes: np.ndarray, row: int | np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes + np.asarray(row).astype(U64) * U64(0x9E3779B97F4A7C15))


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _extensions(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, _ = _ids(batch)
            words, out = Words(batch.column(1), second=True), _Out(buckets)
            at, anchors = _anchored(words)
            found = at[_member(_in_row(anchors, words.text_of[at]), _told(batch, 2))]
            _settle(out, WINDOWS, words.runs(WINDOW)[found], words.runs(WINDOW, 1)[found].astype(np.uint32), ids[words.text_of[found]])
            yield out.batch()

    return run


def _runs_of(starts: np.ndarray) -> list[dict[str, int]]:
    """The maximal repeats that windows at these words make: runs of windows one word apart, as ranges of words."""
    if not len(starts):
        return []
    parts = np.split(starts, np.flatnonzero(np.diff(starts) != 1) + 1)
    return [{"start": int(p[0]), "end": int(p[-1]) + WINDOW} for p in parts]


def _removals(spans: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column(1))
            copies = batch.column(3).to_pylist()
            at = np.flatnonzero(words.fits(WINDOW))
            gone = at[_member(_in_row(words.runs(WINDOW)[at], words.text_of[at]), _told(batch, 2))]
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, gone, 1)
            np.add.at(edges, gone + WINDOW, -1)
            kept = np.cumsum(edges[:-1]) == 0
            rows = []
            wholes = words.whole()
            for k in range(batch.num_rows):
                low, high = words.first[k], words.first[k + 1]
                own = kept[low:high]
                repeats = _runs_of(gone[np.searchsorted(gone, low) : np.searchsorted(gone, high)] - low) if spans else []
                if copies[k] and wholes[k] in np.frombuffer(b"".join(copies[k]), U64):
                    own, repeats = np.zeros(high - low, bool), [{"start": 0, "end": int(high - low)}]
                left = words.text(k, None if own.all() else own)
                rows.append((int(high - low), int(high - low - own.sum()), hashlib.sha256(left).hexdigest(), *([left.decode("utf-8"), repeats] if spans else [])))
            columns = list(zip(*rows, strict=True)) if rows else [()] * (3 + 2 * spans)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "repeats"][: 1 + len(arrays)])

    return run


def _of_kind(answers: DataFrame, kind: int, name: str) -> DataFrame:
    return answers.filter(F.col("kind") == kind).groupBy("doc_id").agg(F.collect_list("payload").alias(name))


def _answered(sent: DataFrame) -> DataFrame:
    return sent.groupBy("bucket").applyInArrow(_bucket, ANSWER)


def _repeated_windows(rows: DataFrame, seeds: DataFrame, buckets: int) -> DataFrame:
    """The second pass: each document's windows that a smaller id has, as a checkpointed table."""
    copies = _of_kind(seeds, WHOLES, "copies")
    open_ = checkpoint(_of_kind(seeds, ANCHORS, "anchors").join(copies, "doc_id", "left_anti"))
    candidates = rows.join(open_, "doc_id").select("doc_id", "text", "anchors")
    windows = _of_kind(_answered(candidates.mapInArrow(_extensions(buckets), SENT)), WINDOWS, "windows")
    return checkpoint(windows.join(copies, "doc_id", "full"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row; with ``kept_text`` and ``repeats``, its maximal repeats as ranges of words, if asked.

    Between the passes nothing refers to their plans any more, so Spark drops their shuffle files.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    buckets = BUCKETS_PER_SPLIT * max(1, rows.rdd.getNumPartitions())
    seeds = checkpoint(_answered(rows.mapInArrow(_seeds(buckets), SENT)))
    release(spark, wait=True)
    told = _repeated_windows(rows, seeds, buckets)
    release(spark, wait=True)
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string, repeats array<struct<start:bigint,end:bigint>>" * with_text
    return rows.join(told, "doc_id", "left").select("doc_id", "text", "windows", "copies").mapInArrow(_removals(with_text), out)
