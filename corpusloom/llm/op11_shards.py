"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key, made from the digest of both, and the highest draw gets the record.  A
shard of weight w draws ``-w / ln(u)`` with u uniform in (0, 1), so it wins a share of w over all weights.
The draws of the old shards do not change when a shard is added: a record either stays or moves to the new
one, and when a shard goes only its own records move.  Every placement is an expression over one row.

Records of a shard are numbered without gaps (``slot``).  The light rows of the placement, without texts, are
dealt by ranges of shard, key, size and checksum, with a row number last, so that neither a large shard nor a
key that holds a third of all rows is one task's; a slot is the place inside the range plus the shard's rows in
earlier ranges, of which there are no more than ranges and shards together.

Results for special rows: a null key is a key of its own and goes where its draws send it; a null text has
size 1 and checksum 0, as an empty one has; repeated rows share their shard and have slots of their own, next to
each other; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import let
from corpusloom.runtime import checkpoint

#: Shards and their weights in production.
WEIGHTS = (1.0,) * 8
#: Hexadecimal digits of a digest that make a draw: 52 bits, which a double holds.
DIGITS = 13
_NUMBER_BITS = 33  # of a row inside its partition, in monotonically_increasing_id


def draw(key: Column, shard: int, weight: float) -> Column:
    """The draw of a shard for a key given as text; never null for a key that is not."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))
    return F.lit(-float(weight)) / F.ln(u)


def key_text(key: Column) -> Column:
    """A key as text, in which null differs from every value."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("~"))


def shards_of(key: Column, *layouts: tuple[float, ...]) -> list[Column]:
    """The shard of ``key`` under each layout, a tuple of weights by shard; a shard without weight takes nothing.

    Layouts share the draws of the shards that they have in common.
    """
    found: dict[tuple[int, float], Column] = {}
    out = []
    for weights in layouts:
        entries = [(k, float(w)) for k, w in enumerate(weights) if w > 0]
        if not entries:
            raise ValueError("no shard has a weight")
        for k, w in entries:
            found.setdefault((k, w), F.struct(draw(key, k, w).alias("draw"), F.lit(-k).alias("shard")))
        drawn = [found[e] for e in entries]
        best = drawn[0] if len(drawn) == 1 else F.greatest(*drawn)
        out.append((-best["shard"]).cast("int"))
    return out


def numbered(rows: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """``rows`` with a number without gaps from 0 inside each shard, along ``order``."""
    names = rows.columns
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(shard, *order, "_salt").sortWithinPartitions(shard, *order, "_salt")
    placed = checkpoint(dealt.select(*names, F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", _NUMBER_BITS)
    runs = placed.groupBy(part.alias("_part"), shard).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = placed.withColumn("_part", part).join(F.broadcast(runs), ["_part", shard])
    return joined.select(*names, (F.col("_at") - F.col("_from") + F.col("_ahead")).alias(slot))


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: tuple[float, ...] = WEIGHTS, added: float = 1.0) -> DataFrame:
    """For each document: key, size, text_crc32, shard, slot, and the shard it would have with one more of weight ``added``."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    now, grown = shards_of(F.col("_key"), weights, (*weights, added))
    rows = rows.withColumn("_key", key_text(F.col("key"))).withColumns({"shard": now, "grown_shard": grown}).drop("_key")
    return numbered(checkpoint(rows), "shard", ["key", "size", "text_crc32"])


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, pieces: int = 1) -> None:
    """All columns of ``docs`` as Parquet, a folder ``shard=k`` for each shard, in at most ``pieces`` files each.

    A piece is chosen by a digest of key and row, so that copies of one key do not make one file; ``docs`` may not
    have a column ``shard``.
    """
    shard = let(key_text(F.col(key)), lambda k: shards_of(k, weights)[0])
    piece = F.pmod(F.xxhash64(*(F.col(c) for c in docs.columns)), F.lit(pieces)).cast("int")
    dealt = docs.withColumn("shard", shard).withColumn("_piece", piece)
    dealt = dealt.repartition(len(weights) * pieces, "shard", "_piece").drop("_piece")
    dealt.write.partitionBy("shard").parquet(path)
