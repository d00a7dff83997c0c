"""Cheapest repair of the turn structure of conversations.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  Its
rows, by turn, are edited one after the other: Keep costs 0, Rerole (to user
or assistant) 1, Delete 2, Insert (an empty user or assistant row, anywhere) 5;
a blank or repeated row must be deleted, a truncated one that stays adds 5.
Of the cheapest edits those whose initials are ASCII-least are taken.

Four states say what has been read: nothing, a system row, a user row, or an
assistant row.  A row is a table of costs from state to state, and so is any
run of rows.  The edits are found by Hirschberg's divide and conquer: the
forward costs from one end and the backward costs from the other meet in the
middle, the cheapest crossing state there splits the problem in two, and so
on, in linear space.  Insertions belong to the row that follows, so the edits
that lead to different states begin differently and none is the beginning of
another: forward costs carry the order of their edits, and the crossing whose
edits come first is the audit-least one, whatever follows.

Conversations of any length are spread the same way.  Equal rows are counted
first.  All rows are sorted by range, so a long conversation lies in several
partitions, and cut into segments of at most ``SEGMENT`` distinct rows.  Each
segment gives its table of costs; the segments of a conversation are crossed
like rows, which fixes the states between them; then every segment finds its
own edits.  Texts meet the edits at the end.

Defined results: null roles and texts count as one space; rows are taken by
turn, null first, rows of one turn by role and then by the digest of the text;
a row whose role begins with another letter, or is empty, cannot be kept with
it; a null ``conv_id`` is a conversation; repeated rows are repeats; an empty
table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from kiln.session import materialize

#: Distinct rows of a segment.
SEGMENT = 1 << 16
SPACES = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What a role initial leads to from each state.
READ = {("s", NOTHING): SYSTEM, ("u", NOTHING): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
#: The state after an inserted or changed row, and its role.
NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: Insertions that make a state a good end.
TAIL = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Conditions of a row.
FINE, CUT, GO = range(3)

#: A table of costs: for each state the states reached, with cost and order.
Table = Sequence[Sequence[tuple[int, int, object]]]


def _row_table(initial: str, condition: int) -> list[list[tuple[int, int, str]]]:
    """A row's table; the order is the edits themselves."""
    table = []
    for begin in range(4):
        best: dict[int, tuple[int, str]] = {}

        def offer(state: int, cost: int, edits: str) -> None:
            best[state] = min(best.get(state, (cost, edits)), (cost, edits))

        state, cost, edits = begin, 0, ""
        for _ in range(3):  # a third insertion leads back to where the first led
            offer(state, cost + DELETE, edits + "D")
            if condition != GO:
                stays = cost + TRUNCATED * (condition == CUT)
                if (initial, state) in READ:
                    offer(READ[initial, state], stays, edits + "K")
                offer(NEXT[state][0], stays + REROLE, edits + "R")
            state, cost, edits = NEXT[state][0], cost + INSERT, edits + "I"
        table.append([(state, cost, edits) for state, (cost, edits) in sorted(best.items())])
    return table


#: By kind: the initial's place in ``INITIALS`` and four times the condition.
INITIALS = "sua?"
ROWS = [_row_table(INITIALS[kind % 4], kind // 4) for kind in range(12)]
_GONE = ROWS[4 * GO]


def _run_table(times: int) -> Table:
    """The table of ``times`` rows that must go, one after the other."""
    return [[(q, cost + DELETE * (times - 1), edits) for q, cost, edits in reached] for reached in _GONE]


def forward(tables: Sequence[Table], begin: int) -> dict[int, tuple[int, int]]:
    """Cost of each state after the tables, from ``begin``, and the place of
    its cheapest, least edits among those of the other states."""
    found = {begin: (0, 0)}
    for table in tables:
        best: dict[int, tuple] = {}
        for p, (cost, place) in found.items():
            for q, step, order in table[p]:
                way = (cost + step, place, order)
                if q not in best or way < best[q]:
                    best[q] = way
        places = {q: i for i, q in enumerate(sorted(best, key=lambda q: best[q][1:]))}
        found = {q: (way[0], places[q]) for q, way in best.items()}
    return found


def backward(tables: Sequence[Table], end: int) -> dict[int, int]:
    """Cost from each state before the tables to ``end``."""
    found = {end: 0}
    for table in reversed(tables):
        found = {p: min(costs) for p in range(4) if (costs := [step + found[q] for q, step, _ in table[p] if q in found])}
    return found


def crossings(tables: Sequence[Table], begin: int, end: int) -> list[int]:
    """The states between the tables, ``begin`` first and ``end`` last, of the
    cheapest edits, the least of them."""
    states = [begin] * len(tables) + [end]
    open_ = [(0, len(tables))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo > 1:
            mid = (lo + hi) // 2
            ahead, back = forward(tables[lo:mid], states[lo]), backward(tables[mid:hi], states[hi])
            states[mid] = min((ahead[s][0] + back[s], ahead[s][1], s) for s in ahead if s in back)[2]
            open_ += [(lo, mid), (mid, hi)]
    return states


def finish(found: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """The best last state and the whole cost."""
    cost, _, state = min((cost + INSERT * TAIL[s], place, s) for s, (cost, place) in found.items())
    return state, cost


def _tables(kinds: bytes, copies: Sequence[int]) -> tuple[list[Table], list[int]]:
    """The tables of rows, a second one for the copies of each, and the row of each."""
    tables: list[Table] = []
    rows: list[int] = []
    for i, (kind, n) in enumerate(zip(kinds, copies)):
        tables.append(ROWS[kind])
        rows.append(i)
        if n > 1:
            tables.append(_run_table(n - 1))
            rows.append(i)
    return tables, rows


@lru_cache(maxsize=50_000)
def _short_steps(kinds: bytes, copies: tuple[int, ...]) -> list[int]:
    tables, _ = _tables(kinds, copies)
    return [x for p in range(4) for q, (cost, place) in sorted(forward(tables, p).items()) for x in (p, q, cost, place)]


@lru_cache(maxsize=50_000)
def _short_crossings(kinds: bytes, copies: tuple[int, ...], begin: int, end: int) -> list[int]:
    return crossings(_tables(kinds, copies)[0], begin, end)


def _steps(kinds: bytes, copies: tuple[int, ...]) -> list[int]:
    """A segment's table as numbers: from, to, cost, order."""
    return (_short_steps if len(kinds) <= 32 else _short_steps.__wrapped__)(kinds, copies)


def _states(kinds: bytes, copies: tuple[int, ...], begin: int, end: int) -> list[int]:
    return (_short_crossings if len(kinds) <= 32 else _short_crossings.__wrapped__)(kinds, copies, begin, end)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """The rows of sorted batches by runs of equal ``key``."""
    return groupby((row for batch in batches for lo in range(0, batch.num_rows, 1024) for row in batch.slice(lo, 1024).to_pylist()), lambda row: row[key])


# --------------------------------------------------------------------------
# Rows, segments, crossings, edits
# --------------------------------------------------------------------------

def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _turns(rows: DataFrame) -> DataFrame:
    """The rows with the digests ``body`` (of the text), ``key`` (equal rows of
    a conversation) and ``said`` (equal role and text in it)."""
    given = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    body = F.sha2("text", 256)
    said = F.concat(_text(F.col("conv_id")), F.lit(":"), F.col("body"), F.lit(":"), F.col("role"))
    return given.withColumn("body", body).select(
        "conv_id", "turn", "role", "text", F.unhex("body").alias("body"), F.unhex(F.sha2(F.concat(_text(F.col("turn")), F.lit(":"), said), 256)).alias("key"), F.unhex(F.sha2(said, 256)).alias("said"))


def _marked(turns: DataFrame) -> DataFrame:
    """Each distinct row with its copies, condition and whether its role and
    text come here first."""
    bare = F.rtrim("text", F.lit(SPACES))
    blank, cut = bare == "", ~F.substring(bare, -1, 1).isin(".", "!", "?")
    distinct = (turns.select("key", "said", "body", "conv_id", "turn", "role", blank.alias("blank"), cut.alias("cut"))
                .groupBy("key", "said", "body", "conv_id", "turn", "role", "blank", "cut").agg(F.count("*").alias("copies")))
    # of rows with equal role and text the first turn's; each key is once on either side of the join
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn", "key")
    first = distinct.groupBy("said").agg(F.min(place).alias("first")).select(F.col("first.key").alias("key"), F.lit(True).alias("first"))
    return distinct.join(first, "key", "left").select("conv_id", "turn", "role", "body", "key", "blank", "cut", "copies", F.coalesce("first", F.lit(False)).alias("first"))


_SEGMENT = ("segment long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, first_initial string, "
            "last_initial string, steps array<long>, kinds binary, copies array<long>, keys array<binary>")


def _packed(segment: int, conv_id, rows: list[dict]) -> dict:
    kinds, initials, turns = bytearray(), [], []
    out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for row in rows:
        initial, n = row["role"][:1], row["copies"]
        out["blank"] += n * row["blank"]
        out["duplicate"] += 0 if row["blank"] else n - row["first"]
        cut = row["first"] and not row["blank"] and row["cut"]
        out["truncated"] += cut
        # two copies side by side are never a good pair
        out["illegal"] += n - 1 + (bool(initials) and initials[-1] + initial not in ("su", "ua", "au"))
        initials.append(initial)
        if row["turn"] is not None and (not turns or turns[-1] != row["turn"]):
            turns.append(row["turn"])
        kinds.append(("sua".find(initial) if initial in ("s", "u", "a") else 3) + 4 * (GO if row["blank"] or not row["first"] else CUT if cut else FINE))
    copies = tuple(row["copies"] for row in rows)
    return out | {"conv_id": conv_id, "segment": segment, "turns": len(turns), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                  "first_initial": initials[0], "last_initial": initials[-1], "steps": _steps(bytes(kinds), copies), "kinds": bytes(kinds),
                  "copies": list(copies), "keys": [row["key"] for row in rows]}


def _batched(rows: Iterator[dict], schema: pa.Schema, n: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(kind: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(kind)


def _segments(turns: DataFrame, size: int) -> DataFrame:
    """A row for each conversation's share of a partition, in pieces; the
    numbers (``segment``) go up with the rows' order."""
    marked = _marked(turns)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("body").asc()]
    kind = StructType([turns.schema["conv_id"], *StructType.fromDDL(_SEGMENT).fields])
    schema = _arrow(kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments():
            at = TaskContext.get().partitionId() << 40
            for conv_id, rows in _runs(batches, "conv_id"):
                held: list[dict] = []
                for row in rows:
                    if len(held) == size:
                        yield _packed(at, conv_id, held)
                        at, held = at + 1, []
                    held.append(row)
                yield _packed(at, conv_id, held)
                at += 1
        yield from _batched(segments(), schema, 256)

    return materialize(marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, kind), "conversation-segments")


_CROSSED = ("conversation long, segment long, begin int, end int, tail int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def _crossed(segments: DataFrame) -> DataFrame:
    """For each segment its conversation (the number of its first segment) and
    the states at its ends; the first one has the conversation's figures."""
    kind = StructType([segments.schema["conv_id"], *StructType.fromDDL(_CROSSED).fields])
    schema = _arrow(kind)

    def figures(rows: list[dict]) -> dict:
        out = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        spans = [(r["first_turn"], r["last_turn"]) for r in rows if r["turns"]]
        distinct = out.pop("turns") - sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        out["illegal"] += sum(a["last_initial"] + b["first_initial"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        return out | {"gaps": spans[-1][1] - spans[0][0] + 1 - distinct if spans else 0}

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def crossed():
            for conv_id, run in _runs(batches, "conv_id"):
                rows = list(run)
                tables = []
                for row in rows:
                    table: list[list[tuple]] = [[], [], [], []]
                    for p, q, cost, place in zip(*[iter(row["steps"])] * 4):
                        table[p].append((q, cost, place))
                    tables.append(table)
                end, cost = finish(forward(tables, NOTHING))
                states = crossings(tables, NOTHING, end)
                for i, row in enumerate(rows):
                    own = figures(rows) | {"cost": cost} if i == 0 else {}
                    yield own | {"conv_id": conv_id, "conversation": rows[0]["segment"], "segment": row["segment"], "begin": states[i], "end": states[i + 1],
                                 "tail": TAIL[end] if i == len(rows) - 1 else 0}
        yield from _batched(crossed(), schema, 1024)

    few = segments.drop("kinds", "copies", "keys")
    return materialize(few.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(cross, kind), "conversation-crossings")


_EDIT = "conversation long, segment long, place long, edit string, times long, key binary, role string, audit string"


def _edits(segments: DataFrame, crossed: DataFrame) -> DataFrame:
    """A row for each edit, in the order of ``segment, place``: ``times`` of
    equal deletions, the row's ``key``, the new ``role`` of a changed or
    inserted row, and with the first edit of a segment all its initials."""
    given = segments.select("segment", "kinds", "copies", "keys").join(crossed.select("segment", "conversation", "begin", "end", "tail"), "segment")
    kind = StructType.fromDDL(_EDIT)
    schema = _arrow(kind)

    def edits_of(row: dict) -> list[dict]:
        tables, at = _tables(row["kinds"], row["copies"])
        states = _states(row["kinds"], tuple(row["copies"]), row["begin"], row["end"])
        out: list[dict] = []

        def add(edit: str, **more) -> None:
            out.append({"conversation": row["conversation"], "segment": row["segment"], "place": len(out), "edit": edit, "times": 1} | more)

        for n, (table, i) in enumerate(zip(tables, at)):
            state, copies = states[n], row["copies"][i] - 1 if n and at[n - 1] == i else 1
            edits = next(edits for q, _, edits in table[state] if q == states[n + 1])
            if copies > 1:
                add("D", times=copies - 1, key=row["keys"][i])
            for edit in edits:
                role = NEXT[state][1] if edit in "IR" else None
                add(edit, key=None if edit == "I" else row["keys"][i], role=role)
                if edit in "IR":
                    state = NEXT[state][0]
        state = states[-1]
        for _ in range(row["tail"]):
            add("I", role=NEXT[state][1])
            state = NEXT[state][0]
        out[0]["audit"] = "".join(e["edit"] * e["times"] for e in out)
        return out

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (e for batch in batches for lo in range(0, batch.num_rows, 64) for row in batch.slice(lo, 64).to_pylist() for e in edits_of(row))
        yield from _batched(rows, schema, 4096)

    return materialize(given.mapInArrow(edit, kind), "conversation-edits")


class Repairs(NamedTuple):
    #: conversation (a number), conv_id, gaps, blank, duplicate, truncated, illegal, cost
    figures: DataFrame
    #: conversation, segment, place, edit, times, key, role, audit
    edits: DataFrame
    #: conversation, segment, place, role, text: the rows of the result
    turns: DataFrame


def repair(rows: DataFrame, segment: int = SEGMENT) -> Repairs:
    """The repairs of ``conv_id, turn, role, text``."""
    turns = _turns(rows)
    segments = _segments(turns, segment)
    crossed = _crossed(segments)
    edits = _edits(segments, crossed)
    texts = turns.groupBy("key").agg(F.any_value(F.struct("role", "text")).alias("given"))
    kept = edits.filter("edit IN ('K', 'R')").join(texts, "key").select(
        "conversation", "segment", "place", F.coalesce("role", "given.role").alias("role"), F.col("given.text").alias("text"))
    inserted = edits.filter("edit = 'I'").select("conversation", "segment", "place", "role", F.lit("").alias("text"))
    figures = crossed.filter("segment = conversation").drop("segment", "begin", "end", "tail")
    return Repairs(figures, edits, kept.unionByName(inserted))


def repair_digests(conversations: DataFrame, rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """For every ``conv_id`` of ``conversations`` the figures of the repair of
    its ``rows``, the initials of its edits (``audit``) and the digest of the
    repaired ``role:text`` lines, read in order without holding them."""
    found = repair(rows, segment)
    audits = found.edits.filter("audit IS NOT NULL").groupBy("conversation").agg(F.array_sort(F.collect_list(F.struct("segment", "audit"))).alias("parts"))
    audits = audits.select("conversation", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            for conversation, run in _runs(batches, "conversation"):
                sha = hashlib.sha256()
                for i, row in enumerate(run):
                    sha.update(f"{chr(10) if i else ''}{row['role']}:{row['text']}".encode())
                yield {"conversation": conversation, "repaired_sha256": sha.hexdigest()}
        yield from _batched(digests(), pa.schema([("conversation", pa.int64()), ("repaired_sha256", pa.string())]), 4096)

    lines = found.turns.repartition("conversation").sortWithinPartitions("conversation", "segment", "place")
    digests = lines.mapInArrow(digest, "conversation long, repaired_sha256 string")
    whole = found.figures.join(audits, "conversation").join(digests, "conversation", "left").withColumnRenamed("conv_id", "own_id")
    ids = conversations.select("conv_id").distinct()
    out = ids.join(whole, ids["conv_id"].eqNullSafe(whole["own_id"]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, chosen by the crc32
    of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    ``.!?`` out of it, 3 repeats the row, 4 makes its role user.  Nulls (of the
    two ids in that key too) count as one space; the ids stay null."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    role = F.when(F.col("fault") == 4, "user").otherwise(space("role"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return (conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).filter("fault != 0")
            .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)).alias("time")).drop("time"))
