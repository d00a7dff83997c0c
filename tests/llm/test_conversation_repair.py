"""Conversation repair against an enumeration of all edits."""

import hashlib
import random
import re
import zlib

import pytest

from kiln.llm import conversation_repair as C, queries

GOOD = re.compile(r"(s?(ua)+)?\Z")
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """blank, duplicate, truncated or None of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_edit(rows):
    """The least (cost, audit, lines) of all edits with up to two insertions
    at a place."""
    marks = faults(rows)
    inserts = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    best = None

    def go(i, cost, audit, initials, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for more in inserts:
            now, told, said = cost + 5 * len(more), audit + "I" * len(more), initials + "".join(more)
            out = lines + [f"{NAMES[m]}:" for m in more]
            if i == len(rows):
                if GOOD.match(said):
                    best = min(best, (now, told, out)) if best else (now, told, out)
                continue
            if not re.match(r"s?(ua)*u?\Z", said):
                continue
            role, text = rows[i]
            go(i + 1, now + 2, told + "D", said, out)
            if marks[i] in (None, "truncated"):
                stays = now + 5 * (marks[i] == "truncated")
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, stays, told + "K", said + role[:1], out + [f"{role}:{text}"])
                for m in "ua":
                    go(i + 1, stays + 1, told + "R", said + m, out + [f"{NAMES[m]}:{text}"])

    go(0, 0, "", "", [])
    return best


def expected(conversations, rows):
    space = lambda x: " " if x is None else x
    out = {}
    for conv in {c for c, *_ in conversations}:
        own = sorted(((t is not None, t or 0, space(r), hashlib.sha256(space(x).encode()).digest(), t, space(x)) for c, t, r, x in rows if c == conv), key=lambda r: r[:4])
        said = [(r[2], r[5]) for r in own]
        turns = {r[4] for r in own} - {None}
        marks = faults(said)
        cost, audit, lines = every_edit(said)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(spark, conversations, rows, **more):
    schema = "conv_id long, turn long, role string, text string, copies int, segment int"
    frames = [spark.createDataFrame([(*r, 1, 2) for r in x], schema) for x in (conversations, rows)]
    found = C.repair_digests(*frames, **more)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = found.collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r[0]: tuple(r[1:]) for r in out}


def random_rows(rng, n_conversations, most):
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "ua", None])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(["Yes.", "no", "So! \n", " ", "", None, "Ok?", "é. ", f"t{turn}."])))
    return rows


@pytest.mark.parametrize("segment", [1, 2, C.SEGMENT])
def test_random_conversations(spark, segment):
    rng = random.Random(11)
    rows = random_rows(rng, 60, 5) + [(None, 1, "user", "A."), (None, None, "assistant", "B.")]
    given = rows + [(999, 1, "user", "dropped")]
    assert repaired(spark, given, rows, segment=segment) == expected(given, rows)


def test_tables_cross_as_rows_do():
    """Rows, runs of rows and their halves give the same edits."""
    rng = random.Random(12)
    for _ in range(300):
        kinds = bytes(rng.randrange(12) for _ in range(rng.randint(1, 9)))
        copies = tuple(rng.choice([1, 1, 1, 2, 4]) for _ in kinds)
        tables, _ = C._tables(kinds, copies)
        ways = {C.NOTHING: (0, "")}
        for table in tables:  # the edits held as strings
            new = {}
            for p, (cost, edits) in ways.items():
                for q, step, order in table[p]:
                    new[q] = min(new.get(q, (cost + step, edits + order)), (cost + step, edits + order))
            ways = new
        end, cost = C.finish(C.forward(tables, C.NOTHING))
        assert (cost, ways[end][1]) == min((c + C.INSERT * C.TAIL[q], e) for q, (c, e) in ways.items())
        states = C.crossings(tables, C.NOTHING, end)
        assert "".join(next(e for q, _, e in t[states[i]] if q == states[i + 1]) for i, t in enumerate(tables)) == ways[end][1]


def test_a_long_conversation_and_a_row_repeated_very_often(spark):
    n = 400
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"row {t}.") for t in range(n)] + [(7, 50, "assistant", "again.")] * 5000 + [(8, 1, "system", "rules.")]
    found = repaired(spark, rows, rows, segment=16)
    gaps, blank, duplicate, truncated, illegal, cost, audit, sha = found[7]
    assert (gaps, blank, duplicate, truncated) == (0, 0, 4999, 0)
    assert cost == 2 * 5000 and audit.count("D") == 5000 and audit.count("K") == n
    # of the two assistant rows side by side the first goes, as D comes before K
    lines = "\n".join(f"{r}:{'again.' if t == 49 else x}" for _, t, r, x in rows[:n])
    assert sha == hashlib.sha256(lines.encode()).hexdigest()
    assert found[8] == (0, 0, 0, 0, 0, 2, "D", hashlib.sha256(b"").hexdigest())


def test_empty(spark):
    assert repaired(spark, [], []) == {}
    assert repaired(spark, [(1, 1, "user", "x")], []) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(20), None) for t in (0, 1, None) for r, x in (("assistant", "Well. Yes! No?"), (None, None))]
    expect = []
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if fault:
            x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
            expect += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    given = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, fault int")
    found = C.damage(given)
    assert found.columns == ["conv_id", "turn", "role", "text"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expect, key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    columns = ["conv_id", "turn", "role", "text"]
    given = [tuple(r) for r in conversations.select(*columns).collect()]
    rows = [tuple(r) for r in C.damage(conversations).collect()]
    found = {r[0]: tuple(r[1:]) for r in queries.QUERIES["op11_conversation_repair"](spark, sf).collect()}
    assert found == expected(given, rows)
