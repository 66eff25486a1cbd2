"""BPE encoding and decoding with forced-boundary splitting.

A byte-level BPE vocabulary says which two bytes ever stand side by side inside a token.  Where a
text has two neighbouring bytes that no token holds side by side, no merge can cross, so the text is
certainly cut there; the fragments between such cuts are encoded independently and concatenated.
Cuts are made inside the pieces of the tokenizer's own splitting pattern, whose boundaries are cuts
as well, so the ids are those of the whole.  Fragments are merged with a heap of candidate pairs, in
O(n log n) of their length, however long; pieces seen before come from a bounded table.

The vocabulary file is read by the driver and shipped to executors, where one codec is built per
worker process.  Its size is that of one tokenizer, independent of the data.

Results for special rows: a null text is encoded as an empty one; empty texts have no ids and decode
to an empty text; rows are independent, so repeated rows and clashing further columns (which are not
read) change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corpusloom.runtime import ship

#: The splitting pattern of byte-level BPE tokenizers (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces remembered by a worker process; then the table starts anew.
REMEMBERED = 300_000
#: Room for an id in the low bits of a merge's number, and the number of no merge.
ID_BITS = 32
ID_MASK, NO_MERGE = (1 << ID_BITS) - 1, 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def check_tokenizer(spec: dict[str, Any]) -> None:
    """Raise if a tokenizer file asks for steps that this codec does not take, and whose ids would be others."""
    model, before, after = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("post_processor")
    wrong = [f"model.{k}" for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE":
        wrong.append("model.type")
    if spec.get("normalizer") is not None:
        wrong.append("normalizer")
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        wrong.append("pre_tokenizer")
    if after is not None and after.get("type") != "ByteLevel":
        wrong.append("post_processor")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        wrong.append("decoder")
    wrong += [f"added token {t['content']!r}" for t in spec.get("added_tokens", ()) if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if wrong:
        raise ValueError(f"this tokenizer file needs more than byte-level BPE: {', '.join(wrong)}")


class _Pieces(dict):
    """Ids, as little-endian 32-bit bytes, by piece of text; filled on demand."""

    def __init__(self, codec: ByteBpe):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[piece] = self.codec.encode_piece(piece.encode("utf-8"))
        return found


class ByteBpe:
    """A byte-level BPE codec read from a tokenizer file's contents."""

    def __init__(self, contents: bytes):
        spec = json.loads(contents)
        check_tokenizer(spec)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        raw = {token: bytes(map(alphabet.__getitem__, token)) for token in vocab if all(c in alphabet for c in token)}
        self.token_bytes: dict[int, bytes] = {i: raw.get(t, t.encode()) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.byte_ids = [0] * 256
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        #: By pair of ids, the rank of their merge and its id in one number, so that lists of them compare fast.
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = rank << ID_BITS | vocab[left + right]
        #: Pairs of bytes that stand side by side inside some token.
        self.inside = {pair for t in raw.values() for pair in zip(t, t[1:], strict=False)}
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = _Pieces(self)

    def fragments(self, piece: bytes) -> list[bytes]:
        """``piece`` cut at each pair of bytes that no token holds side by side."""
        known = list(map(self.inside.__contains__, zip(piece, piece[1:], strict=False)))
        if all(known):
            return [piece]
        cuts = [0, *(k for k, inside in enumerate(known, 1) if not inside), len(piece)]
        return [piece[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_piece(self, piece: bytes) -> bytes:
        ids = array("I")
        for fragment in self.fragments(piece):
            ids.extend(self.merge(fragment) if len(fragment) <= 48 else self.merge_long(fragment))
        return ids.tobytes()

    def merge(self, fragment: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left; for short fragments."""
        ids, of = list(map(self.byte_ids.__getitem__, fragment)), self.merges.get
        ranks = [of(pair, NO_MERGE) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != NO_MERGE:
            at = ranks.index(best)
            ids[at : at + 2] = [best & ID_MASK]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = of((ids[at], ids[at + 1]), NO_MERGE)
            if at:
                ranks[at - 1] = of((ids[at - 1], ids[at]), NO_MERGE)
        return ids

    def merge_long(self, fragment: bytes) -> list[int]:
        """The same with a heap and links between neighbours."""
        ids: list[int | None] = [self.byte_ids[b] for b in fragment]
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        heap = [(found, k) for k, pair in enumerate(zip(ids, ids[1:], strict=False)) if (found := self.merges.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            best, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] is None or right < 0 or self.merges.get((ids[k], ids[right])) != best:
                continue
            ids[k], ids[right], after[k] = best & ID_MASK, None, after[right]
            if after[k] >= 0:
                before[after[k]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] >= 0 and (found := self.merges.get((ids[a], ids[after[a]]))) is not None:
                    heapq.heappush(heap, (found, a))
        return [i for i in ids if i is not None]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.special.split(text) if self.special else [text]
        of, find, out = self.pieces.__getitem__, self.pattern.findall, []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(array("I", [self.added[part]]).tobytes())
            elif part:
                out.append(b"".join(map(of, find(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.token_bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


_codecs: dict[int, ByteBpe] = {}


def _codec(shipped: Any) -> ByteBpe:
    contents = shipped.value
    key = hash(contents)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteBpe(contents)
    return _codecs[key]


def _digest(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def encode_documents(docs: DataFrame, contents: bytes, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document; with its ``ids`` if asked.

    ``contents`` is the tokenizer file; one that needs other steps than byte-level BPE is an error.  Ids are one binary value, little-endian unsigned 32-bit.
    """
    check_tokenizer(json.loads(contents))
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(contents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                ids = codec.encode(value.as_py() or "")
                rows.append((len(ids) // 4, _digest(ids), _digest(codec.decode(ids).encode("utf-8")), *([ids] if with_ids else [])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (3 + with_ids)
            types = [pa.int64(), pa.string(), pa.string(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 1 + len(arrays)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *arrays], names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select(docs[f"`{doc_id}`"].cast("long"), docs[f"`{text}`"]).mapInArrow(run, schema)


def default_tokenizer() -> str:
    """The place of the 50k byte-level BPE file in the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_tokenizer(path: str) -> bytes:
    """The contents of a tokenizer file on the driver."""
    with open(path, "rb") as f:
        return f.read()
