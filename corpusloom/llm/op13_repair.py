"""Repair of damaged conversations: the cheapest edits that give the role order, by integers alone.

A conversation's rows stand by turn (nulls first), rows of one turn by role, then by the first characters of their
text, then by its MD5.  Each row is kept, given another role or deleted, and rows are inserted, so that the initials of
the roles match ``(s?(ua)+)?``.  The states of that expression and the rows make a directed acyclic graph.  A path's
weight is one integer: its high digits are the cost, its low digits the letters of its edits, three bits each from
the highest place down, with zeros behind the last letter.  Adding an edge before a path moves the letters down one
place and adds a constant; the least integer is the cheapest repair and of those the one whose letters come
first.  There are no other ties: a state has one role that it can take next, so letters decide the path.

No path inserts twice in a row (dropping such a pair, or a system row that stands alone with it, is cheaper) or
before a row that must go (the insertion is less behind it), so an insertion stands before a row that stays or at the end.

The integers are as wide as a block of ``BLOCK`` rows, not as a conversation: costs from each row to the end are
plain integers, and a block's paths end in them.  Two paths through a block hold its rows' letters, the last of them
at the end of both, so neither is a beginning of the other and comparing blocks in turn compares the whole.

How it runs: light rows (keys, a digest, flags and a count; equal rows are merged before the shuffle) are dealt by
ranges and sorted.  Conversations that lie in one range, nearly all, are decided there.  Of those that cross a border
of ranges, of which there are fewer than ranges, each piece first gives its costs and then its last state for each
first one; these few numbers are joined on the driver, and every piece is decided by itself.  Texts are shuffled once, to
meet the decisions in order of the conversation, and pass through the digest as a stream.

Results for special rows: nulls in any column are one space, also in the key of the damage, but null turns sort first
and have no part in gaps, and conversations with a null id are one, with a null id in the result; equal rows are rows of their
own (and, but for the first, duplicates); a role's initial is its first character, so an empty role has none; an
empty table gives an empty result; gaps beyond a long are its largest value; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.common import SPACES, let
from corpusloom.runtime import checkpoint, ship

#: Edits by their digit, in the order of ASCII; 0 is the end.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
DIGIT_BITS = 3
BLOCK = 64
#: States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that the one insertable role leads to, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF_STATE = (None, None, "user", "assistant")
#: Cost of an end in each state, one insertion or none; None is no end.
ENDS = (0, None, INSERT_COST, 0)
#: Kinds of rows: one that must go, or its initial's place in "sua" (3: another) and whether it is truncated.
MUST_GO = 0
N_KINDS = 9
LONGEST = 2**63 - 1
_HEAD = 32
_INFINITE = 1 << 60

Costs = tuple[int | None, ...]


def kind_of(initial: str | None, truncated: bool, goes: bool) -> int:
    if goes:
        return MUST_GO
    at = "sua".find(initial) if initial else -1
    return 1 + 2 * (at if at >= 0 else 3) + truncated


def _edges_of(kind: int) -> tuple[tuple[tuple[int, int, int], ...], ...]:
    """For each state (letter, cost, next state) of a row's own edits."""
    out = []
    for state in range(4):
        edges = [(DELETE, DELETE_COST, state)]
        if kind != MUST_GO:
            initial, extra = (kind - 1) // 2, TRUNCATED_COST * ((kind - 1) % 2)
            stays = {0: SYSTEM if state == START else None, 1: USER if state != USER else None, 2: ASSISTANT if state == USER else None}.get(initial)
            if stays is not None:
                edges.append((KEEP, extra, stays))
            edges.append((REROLE, REROLE_COST + extra, NEXT[state]))
        out.append(tuple(edges))
    return tuple(out)


EDGES = tuple(_edges_of(k) for k in range(N_KINDS))


def costs_before(kind: int, times: int, after: list[int]) -> list[int]:
    """The least cost from each state before a row (``times`` rows that must go count once each) to the end."""
    if kind == MUST_GO:
        return [x + DELETE_COST * times for x in after]
    own = [min(cost + after[to] for _, cost, to in edges) for edges in EDGES[kind]]
    return [min(own[q], INSERT_COST + own[NEXT[q]]) for q in range(4)]


def ends_of(costs: Costs) -> list[int]:
    return [_INFINITE if c is None else c for c in costs]


def least_edits(kinds: list[int], times: list[int], ends: list[int], state: int, at_end: bool) -> tuple[list[int], int]:
    """Digits of the least edits of a piece from ``state``, given the costs behind it, and the state that they lead to.

    A run of rows that must go is one digit here.  ``at_end`` adds the insertion that an end after a user row needs.
    """
    n = len(kinds)
    ahead = [ends]  # costs at borders of blocks, the last first
    costs = ends
    for i in range(n - 1, -1, -1):
        costs = costs_before(kinds[i], times[i], costs)
        if i % BLOCK == 0:
            ahead.append(costs)
    ahead.reverse()
    digits: list[int] = []
    for block, begin in enumerate(range(0, n, BLOCK)):
        rows = range(begin, min(n, begin + BLOCK))
        width = 2 * len(rows) * DIGIT_BITS
        mask, top = (1 << width) - 1, width - DIGIT_BITS
        value = [c << width for c in ahead[block + 1]]
        insertion = (INSERT_COST << width) + (INSERT << top)
        for i in reversed(rows):
            moved = [v - (v & mask) + ((v & mask) >> DIGIT_BITS) for v in value]
            many = times[i] if kinds[i] == MUST_GO else 1
            own = [min(moved[to] + (cost * many << width) + (letter << top) for letter, cost, to in edges) for edges in EDGES[kinds[i]]]
            if kinds[i] == MUST_GO:
                value = own
                continue
            moved = [v - (v & mask) + ((v & mask) >> DIGIT_BITS) for v in own]
            value = [min(own[q], insertion + moved[NEXT[q]]) for q in range(4)]
        low, place, row = value[state] & mask, top, begin
        while place >= 0 and (digit := (low >> place) & ((1 << DIGIT_BITS) - 1)):
            digits.append(digit)
            state, row = _after(digit, kinds[row] if digit != INSERT else MUST_GO, state, row)
            place -= DIGIT_BITS
    if at_end and state == USER:
        digits.append(INSERT)
        state = ASSISTANT
    return digits, state


def _after(digit: int, kind: int, state: int, row: int) -> tuple[int, int]:
    """State and row after an edit."""
    if digit == INSERT:
        return NEXT[state], row
    if digit == DELETE:
        return state, row + 1
    if digit == REROLE:
        return NEXT[state], row + 1
    return (SYSTEM, USER, ASSISTANT)[(kind - 1) // 2], row + 1


# Damage and faults, as expressions.


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text after damage and the number of copies (1 or 2); dropped rows are left out."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown(conv_id), F.lit(":"), shown(turn)).cast("binary")) % 20
    hurt = rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), shown(role).alias("role"), shown(text).alias("text"), fault.alias("fault"))
    hurt = hurt.filter("fault != 0")
    body = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hurt.select(
        "conv",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        body.alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def last_character(text: Column) -> Column:
    """The last character that is no space of the six, null without one."""
    return let(F.rtrim(text, F.lit(SPACES)), lambda t: F.nullif(F.substring(t, -1, 1), F.lit("")))


KEYS = ["conv", "turn", "role", "head", "digest"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.substring("text", 1, _HEAD), "digest": F.md5(F.col("text").cast("binary"))})


def light_rows(rows: DataFrame) -> DataFrame:
    """One row for equal ones, in ranges of their order: keys, copies, blank, truncated, and whether one came before."""
    last = last_character(F.col("text"))
    marked = _keyed(rows).select(*KEYS, "copies", last.isNull().alias("blank"), F.coalesce(~last.isin(".", "!", "?"), F.lit(False)).alias("truncated"))
    merged = checkpoint(marked.groupBy(*KEYS).agg(F.sum("copies").alias("copies"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated")))
    same = ["conv", "role", "head", "digest"]
    seen = merged.filter("NOT blank").groupBy(*same).agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("at_null"), F.count("*").alias("places"))
    seen = seen.filter("places > 1").select(*same, F.when(~F.col("at_null"), F.col("least")).alias("least"))
    a, b = merged.alias("a"), seen.alias("b")
    found = F.lit(True)
    for c in same:
        found = found & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    later = F.col("b.role").isNotNull() & ~F.col("a.turn").eqNullSafe(F.col("b.least"))
    joined = a.join(b, found, "left").select("a.*", (later & ~F.col("a.blank")).alias("again"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head", "digest"]
    return checkpoint(joined.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("part", F.spark_partition_id())


# Pieces: the rows of one conversation in one range.


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, list]]:
    """Conversation and its rows of the task, as tuples in the columns' order."""
    conv, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and not _same(row[0], conv):
                yield conv, held
                held = []
            conv = row[0]
            held.append(row)
    if held:
        yield conv, held


def _same(a: Any, b: Any) -> bool:
    return a is b or a == b or (a is None and b is None)


def _symbols(rows: list) -> tuple[list[int], list[int], list[int]]:
    """Kinds, how often, and the light row of each; copies after the first are one run of rows that must go."""
    kinds, times, at = [], [], []
    for k, row in enumerate(rows):
        role, copies, blank, truncated, again = row[2], row[5], row[6], row[7], row[8]
        goes = blank or again
        if goes:
            kinds.append(MUST_GO)
            times.append(copies)
            at.append(k)
            continue
        kinds.append(kind_of(role[:1], truncated, False))
        times.append(1)
        at.append(k)
        if copies > 1:
            kinds.append(MUST_GO)
            times.append(copies - 1)
            at.append(k)
    return kinds, times, at


Borders = dict[tuple[Any, int], Any]


def _costs_through(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each piece and end state the costs from each first state."""
    for conv, rows in _pieces(batches):
        kinds, times, _ = _symbols(rows)
        out = []
        for end in range(4):
            costs = [0 if q == end else _INFINITE for q in range(4)]
            for kind, many in zip(reversed(kinds), reversed(times), strict=True):
                costs = [min(c, _INFINITE) for c in costs_before(kind, many, costs)]
            out.append(costs)
        yield _batch([(conv, rows[0][9], [c for costs in out for c in costs])], schema)


def _ends_through(batches: Iterator[pa.RecordBatch], schema: pa.Schema, behind: Borders) -> Iterator[pa.RecordBatch]:
    """For each piece the last state that the least edits from each first state lead to."""
    for conv, rows in _pieces(batches):
        kinds, times, _ = _symbols(rows)
        ends = behind[conv, rows[0][9]]
        yield _batch([(conv, rows[0][9], [least_edits(kinds, times, ends, q, False)[1] for q in range(4)])], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _schema(rows: DataFrame, **fields: pa.DataType) -> pa.Schema:
    """A schema of a conversation's id and, where it is among the fields, its turn, typed as in ``rows``."""
    own = {c: to_arrow_type(rows.schema[c].dataType) for c in ("conv", "turn") if c in rows.columns}
    return pa.schema([("conv", own["conv"]), *((n, own.get(n, t)) for n, t in fields.items())])


def border_states(rows: DataFrame) -> Borders:
    """First state and costs behind each piece of the conversations that lie in more than one range.

    A range has at most two such pieces, its first and its last, so what comes to the driver is bounded by the number of ranges.
    """
    kind = dict(rows.dtypes)["conv"]
    spans = rows.groupBy("conv").agg(F.min("part").alias("first"), F.max("part").alias("last")).filter("first < last").select("conv")
    cut = rows.alias("r").join(F.broadcast(spans).alias("s"), F.col("r.conv").eqNullSafe(F.col("s.conv")), "left_semi").select("r.*")
    cut = checkpoint(cut)
    through: dict[Any, list] = defaultdict(list)
    schema = _schema(rows, part=pa.int32(), costs=pa.list_(pa.int64()))
    for r in cut.mapInArrow(partial(_costs_through, schema=schema), f"conv {kind}, part int, costs array<long>").collect():
        through[r["conv"]].append((r["part"], r["costs"]))
    if not through:
        return {}
    behind: Borders = {}
    for conv, pieces in through.items():
        after = ends_of(ENDS)
        for part, costs in sorted(pieces, reverse=True):
            behind[conv, part] = after
            after = [min(min(costs[4 * e + q] + after[e] for e in range(4)), _INFINITE) for q in range(4)]
    leads: dict[Any, list] = defaultdict(list)
    schema = _schema(rows, part=pa.int32(), ends=pa.list_(pa.int32()))
    for r in cut.mapInArrow(partial(_ends_through, schema=schema, behind=behind), f"conv {kind}, part int, ends array<int>").collect():
        leads[r["conv"]].append((r["part"], r["ends"]))
    known: Borders = {}
    for conv, pieces in leads.items():
        state = START
        pieces.sort()
        for k, (part, ends) in enumerate(pieces):
            known[conv, part] = (state, behind[conv, part], k == len(pieces) - 1)
            state = ends[state]
    return known


#: What a task gives of a piece: decisions by light row, and one row of sums.
_STATS = ["least", "most", "turns", "blank", "duplicate", "truncated", "illegal", "cost"]
LEGAL = ("su", "ua", "au")


def _decide(batches: Iterator[pa.RecordBatch], schema: pa.Schema, known: Borders) -> Iterator[pa.RecordBatch]:
    """Decisions and sums of each piece; ``known`` has the first state and the costs behind of those that are cut."""
    out: list[tuple] = []
    for conv, rows in _pieces(batches):
        state, ends, last = known.get((conv, rows[0][9]), (START, ends_of(ENDS), True))
        out += _decided(conv, rows, state, ends, last)
        if len(out) >= 20_000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _decided(conv: Any, rows: list, state: int, ends: list[int], last: bool) -> list[tuple]:
    kinds, times, at = _symbols(rows)
    digits, _ = least_edits(kinds, times, ends, state, last)
    part = rows[0][9]
    out, audit, cost, k, before = [], [], 0, 0, []
    made: dict[int, tuple[str, list[str]]] = {}
    for digit in digits:
        if digit == INSERT:
            cost += INSERT_COST
            audit.append("I")
            state = NEXT[state]
            before.append(ROLE_OF_STATE[state])
            continue
        if digit == DELETE:
            cost += DELETE_COST * times[k]
            audit.append("D" * times[k])
        else:
            role = rows[at[k]][2] if digit == KEEP else ROLE_OF_STATE[NEXT[state]]
            cost += (REROLE_COST if digit == REROLE else 0) + TRUNCATED_COST * ((kinds[k] - 1) % 2)
            audit.append(LETTERS[digit])
            state, _ = _after(digit, kinds[k], state, k)
            made[at[k]] = (role, before)
            before = []
        k += 1
    for j, (role, inserted) in made.items():
        out.append((conv, 2, None, *rows[j][1:5], role, inserted, None, None, None))
    if before:
        out.append((conv, 3, part, None, None, None, None, None, None, before, None, None))
    turns = [r[1] for r in rows if r[1] is not None]
    blank = sum(r[5] for r in rows if r[6])
    twice = sum(r[5] if r[8] else r[5] - 1 for r in rows if not r[6])
    short = sum(1 for r in rows if r[7] and not r[6] and not r[8])
    names = [r[2][:1] for r in rows]
    illegal = sum(r[5] - 1 for r in rows) + sum(a + b not in LEGAL for a, b in zip(names, names[1:], strict=False))
    stats = [min(turns, default=None), max(turns, default=None), len(set(turns)), blank, twice, short, illegal, cost]
    out.append((conv, 1, part, None, names[0], names[-1], None, None, None, None, stats, "".join(audit)))
    return out


# The digest, as a stream over decisions and texts in order.


def _results(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    conv, begun, found = None, False, _Conversation()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "step", *KEYS[1:], "tag", "role_to", "before", "after", "stats", "audit", "text")]
        for row in zip(*columns, strict=True):
            if begun and not _same(row[0], conv):
                out.append((conv, *found.result()))
                found = _Conversation()
                if len(out) >= 20_000:
                    yield _batch(out, schema)
                    out = []
            conv, begun = row[0], True
            found.add(*row[1:])
    if begun:
        out.append((conv, *found.result()))
    if out:
        yield _batch(out, schema)


class _Conversation:
    """Sums over the pieces of a conversation, then its digest, item by item."""

    def __init__(self) -> None:
        self.digest, self.items, self.wanted = hashlib.sha256(), 0, None
        self.audit: list[str] = []
        self.sums = [0] * (len(_STATS) - 3)
        self.least = self.most = self.initial = None
        self.turns = 0

    def add(self, step, turn, role, head, digest, tag, role_to, before, after, stats, audit, text) -> None:
        if step == 1:
            self._piece(role, head, stats, audit)
        elif step == 2 and tag == 0:
            for r in before:
                self._item(f"{r}:")
            self.wanted = ((turn, role, digest), role_to)
        elif step == 2 and self.wanted is not None and self.wanted[0] == (turn, role, digest):
            self._item(f"{self.wanted[1]}:{text}")
            self.wanted = None
        elif step == 3:
            for r in after:
                self._item(f"{r}:")

    def _piece(self, first: str, last: str, stats: list, audit: str) -> None:
        least, most, turns = stats[:3]
        if least is not None:
            self.turns += turns - (self.most is not None and self.most == least)
            self.least = least if self.least is None else self.least
            self.most = most
        for k, x in enumerate(stats[3:]):
            self.sums[k] += x
        if self.initial is not None and self.initial + first not in LEGAL:
            self.sums[_STATS.index("illegal") - 3] += 1
        self.initial = last
        self.audit.append(audit)

    def _item(self, item: str) -> None:
        if self.items:
            self.digest.update(b"\n")
        self.digest.update(item.encode("utf-8", "surrogatepass"))
        self.items += 1

    def result(self) -> tuple:
        gaps = 0 if self.least is None else min(int(self.most) - int(self.least) + 1 - self.turns, LONGEST)
        return (gaps, *self.sums, "".join(self.audit), self.digest.hexdigest())


def repair(spark: SparkSession, rows: DataFrame, damage: bool = True, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """For each conversation its faults, and the cost, letters and digest of its repair."""
    ship(spark)
    if damage:
        hurt = damaged(rows, conv_id, turn, role, text)
    else:
        shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        hurt = rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), shown(role).alias("role"), shown(text).alias("text"), F.lit(1).cast("long").alias("copies"))
    light = light_rows(hurt).select(*KEYS, "copies", "blank", "truncated", "again", "part")
    types = dict(light.dtypes)
    known = border_states(light)
    strings = dict.fromkeys(("role", "head", "digest", "role_to"), pa.string())
    lists = {"before": pa.list_(pa.string()), "after": pa.list_(pa.string()), "stats": pa.list_(pa.int64())}
    schema = _schema(light, step=pa.int32(), part=pa.int32(), turn=pa.int64(), **strings, **lists, audit=pa.string())
    plan = f"conv {types['conv']}, step int, part int, turn {types['turn']}, role string, head string, digest string, role_to string, before array<string>, after array<string>, stats array<long>, audit string"
    decided = light.mapInArrow(partial(_decide, schema=schema, known=known), plan).withColumns({"tag": F.lit(0), "text": F.lit(None).cast("string")})
    texts = _keyed(hurt).select("conv", F.lit(2).alias("step"), F.lit(None).cast("int").alias("part"), *KEYS[1:], F.lit(1).alias("tag"), "text")
    ids = rows.select(F.col(conv_id).alias("conv")).distinct().select("conv", F.lit(0).alias("step"), F.lit(0).alias("tag"))
    stream = decided.unionByName(texts, allowMissingColumns=True).unionByName(ids, allowMissingColumns=True)
    stream = stream.repartition("conv").sortWithinPartitions("conv", "step", "part", F.col("turn").asc_nulls_first(), "role", "head", "digest", "tag")
    counts = ("gaps", *_STATS[3:])
    schema = _schema(light, **dict.fromkeys(counts, pa.int64()), audit=pa.string(), repaired_sha256=pa.string())
    named = ", ".join(f"{c} long" for c in counts)
    out = stream.mapInArrow(partial(_results, schema=schema), f"conv {types['conv']}, {named}, audit string, repaired_sha256 string")
    return out.withColumnRenamed("conv", conv_id)
