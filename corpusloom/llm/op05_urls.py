"""URL filters: rules by host and path, and a Bloom filter cascade for the listed hosts.

The cascade encodes which of the corpus's hosts are listed.  Level 1 is a Bloom filter of the
listed hosts; level 2 one of the unlisted hosts that level 1 lets through; level 3 one of the listed
hosts that level 2 lets through; and so on until a level lets no wrong host through.  The first
level that misses a host decides: an odd level means unlisted, an even one listed.  Since the levels
were built over the complete universe of the corpus's hosts, the answer is exact for each of them,
and no row is joined with the list.

Filters are built by Spark (``bitmap_construct_agg``) and tested by expressions over literals.  A
level holds ``BITS_PER_KEY`` bits for each key it encodes.  Hosts are dealt by a hash into as many groups
as keep the bitmaps of one within ``max_filter_bytes``; each group has a cascade of its own, which its
pages are tested by, and whose result is written before the next group's cascade is built.  So neither
the driver nor a task ever holds more than one group's bitmaps, however many hosts there are, and the
method is the same at every size.

Results for special rows: a null url, or one without ``://``, has an empty host and path, which no
rule fits; empty hosts are looked up like any other; repeated rows are judged each; an empty table
gives an empty result; urls are read whole, whatever their length; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint

#: Verdict, host and path of the default rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BITS_PER_KEY = 10
HASHES = 4
#: bitmap_construct_agg makes pieces of this many bits.
PIECE = 32768
#: Share of other keys that a level lets through, at most about.
PASSED = 0.02
MAX_FILTER_BYTES = 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict), null if none fits."""
    out = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    # The level is hashed before the key: keys that share positions in one level part in the next.
    return [F.pmod(F.xxhash64(F.lit(f"{level}/{k}"), key), F.lit(bits)).cast("long") for k in range(HASHES)]


def _contains(bitmap: bytes, level: int, key: Column) -> Column:
    """Whether the filter lets ``key`` through."""
    literal = F.lit(bytearray(bitmap))

    def bit(position: Column) -> Column:
        byte = F.conv(F.hex(F.substring(literal, (F.shiftright(position, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
        return byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (position % 8 + 1).cast("int"))) != 0

    found = [bit(p) for p in _positions(key, level, 8 * len(bitmap))]
    out = found[0]
    for x in found[1:]:
        out = out & x
    return out


def bloom(keys: DataFrame, level: int, n: int) -> bytes:
    """The Bloom filter of the ``n`` keys in column ``host``; its size is fixed by ``n``."""
    pieces = max(1, -(-n * BITS_PER_KEY // PIECE))
    bits = keys.select(F.explode(F.array(*_positions(F.col("host"), level, pieces * PIECE))).alias("p"))
    rows = bits.groupBy(F.floor(F.col("p") / PIECE).alias("piece")).agg(F.bitmap_construct_agg(F.col("p") % PIECE).alias("b")).collect()
    out = bytearray(pieces * PIECE // 8)
    for row in rows:
        out[row["piece"] * PIECE // 8 : (row["piece"] + 1) * PIECE // 8] = row["b"]
    return bytes(out)


def build_cascade(universe: DataFrame) -> list[bytes]:
    """The levels for a table of distinct hosts (``host``, ``listed``)."""
    levels: list[bytes] = []
    inside, outside = universe.filter("listed").select("host"), universe.filter("NOT listed").select("host")
    n = inside.count()
    while n:
        level = len(levels) + 1
        levels.append(bloom(inside, level, n))
        inside, outside = outside.filter(_contains(levels[-1], level, F.col("host"))), inside
        n = inside.count()
    return levels


def groups_of(universe: DataFrame, max_filter_bytes: int) -> int:
    """Into how many groups the hosts are dealt, so that the bitmaps of each keep within the bound."""
    sizes = universe.agg(F.count("*").alias("all"), F.count_if("listed").alias("listed")).first()
    keys = sizes["listed"] + PASSED * sizes["all"]
    return max(1, -int(-keys * BITS_PER_KEY // (8 * max_filter_bytes)))


def listed(levels: list[bytes], key: Column) -> Column:
    """Exact membership of a key of the universe: the first level that misses it decides."""
    out = F.lit(len(levels) % 2 == 1)
    for level in range(len(levels), 0, -1):
        out = F.when(~_contains(levels[level - 1], level, key), F.lit(level % 2 == 0)).otherwise(out)
    return out


def filter_urls(
    pages: DataFrame,
    is_listed: Column,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """page_id, host, path, rule and verdict for each page.

    ``is_listed`` is a condition on the column ``host`` that names the blocked hosts; with a published
    list it is membership in that list, evaluated once for each distinct host.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    universe = checkpoint(rows.select("host").distinct().withColumn("listed", F.coalesce(is_listed, F.lit(False))))
    groups = groups_of(universe, max_filter_bytes)
    results = []
    for k in range(groups):
        part = (F.pmod(F.xxhash64(F.lit("group"), "host"), F.lit(groups)) == k) if groups > 1 else F.lit(True)
        blocked = listed(build_cascade(universe.filter(part)), F.col("host"))
        by_list = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
        judged = rows.filter(part).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
        judged = judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), by_list).alias("verdict"))
        results.append(checkpoint(judged) if groups > 1 else judged)
    return reduce(DataFrame.unionByName, results)
