"""Repair of conversations against exhaustion: every row's ways to every state, in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from basketflow.llm import conversation_repair as repair

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {2: "user", 3: "assistant"}
WS = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        mark = zlib.crc32(key.encode()) % 20
        if mark == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(mark, text)
        out += [(conv, turn, "user" if mark == 4 else role, text)] * (2 if mark == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by the cheapest way to each state."""
    def inserted(ways):
        out = dict(ways)
        for state, (cost, audit, lines) in ways.items():
            for _ in range(2):
                state = NEXT[state]
                cost, audit, lines = cost + 3, audit + "I", (*lines, NAMES[state] + ":")
                out[state] = min(out.get(state, (cost, audit, lines)), (cost, audit, lines))
        return out

    ways = {0: (0, "", ())}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            moves = [("D", 4, state, ())]
            if fault not in ("blank", "duplicate"):
                cut = 3 if fault == "truncated" else 0
                if (state, role[:1]) in KEEP:
                    moves.append(("K", cut, KEEP[state, role[:1]], (f"{role}:{text}",)))
                moves.append(("R", cut + 3, NEXT[state], (f"{NAMES[NEXT[state]]}:{text}",)))
            for edit, price, to, line in moves:
                way = (cost + price, audit + edit, (*lines, *line))
                after[to] = min(after.get(to, way), way)
        ways = after
    return min(w for s, w in inserted(ways).items() if s in (0, 3))


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in brute_damage(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, marked = set(), []
        for _, _, role, text in mine:
            last = text.rstrip(WS)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {r[1] for r in mine if r[1] is not None}
        faults = [f for _, _, f in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        cost, audit, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, conv string, tie string, gone string, audit string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"wxyz") for r in rows], SCHEMA).repartition(4)


def found(df):
    audits, faulty = repair.repair(repair.damage(df))
    digests = {r.conv: r.repaired_sha256 for r in repair.repaired_digests(faulty, audits).collect()}
    rows = [(*r, digests[r.conv]) for r in audits.collect()]
    lines = {}
    for r in sorted(repair.repaired_rows(faulty, audits).collect(), key=lambda r: (str(r.conv), r.place)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, digest in digests.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest
    return rows


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_odd_rows(spark):
    long = "word " * 200_000 + "end."
    rows = [
        (None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None),
        (1, 0, None, "No role."), (1, 1, "user", None), (1, 2, "", "Empty role!"),
        (2, 5, "user", long), (2, 6, "assistant", long + " \t\n"), (2, 6, "assistant", long), (2, 9, "tool", "Out?"),
        (3, 0, "user", " \t\x0b"), (3, 0, "user", ""), (4, 3, "assistant", "\xa0"),
        *[(5, t, "user", "Same.") for t in range(6)], *[(6, 0, "user", "Same turn.")] * 5,
        (7, -2, "system", "Be kind."), (7, 0, "system", "Again."), (7, 1, "user", "So"), (7, 2, "assistant", "Ok."),
    ]
    same(found(frame(spark, rows)), brute(rows))


def test_rows_of_one_turn_are_taken_by_role_and_text(spark):
    rng = random.Random(6)
    rows = [
        (conv, rng.choice([None, 0, 1]), rng.choice(["user", "assistant"]), rng.choice(["b.", "a.", "ä!", "B?", "z", ""]))
        for conv in range(60)
        for _ in range(rng.randrange(1, 9))
    ]
    same(found(frame(spark, rows)), brute(rows))


def test_conversations_without_rows(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    rows = [(8, gone, "user", "Dropped.")]
    empty = hashlib.sha256(b"").hexdigest()
    assert found(frame(spark, rows)) == [(8, 0, 0, 0, 0, 0, 0, "", empty)]
    assert found(frame(spark, [])) == []


def test_many_conversations_and_a_long_one(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(700 if conv == 0 else rng.randrange(1, 12)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.8 else rng.choice(["system", "user", "assistant", "x"])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, f"t{rng.randrange(60)}" + rng.choice([".", "!", "", " "])))
    unique = {(r[0], r[1]): r for r in rows}
    rows = list(unique.values())
    same(found(frame(spark, rows)), brute(rows))


@pytest.mark.parametrize("length", [0, 1, 2, 3, 7, 15, 16, 17, 33, 90])
def test_search_is_exact(length):
    rng = random.Random(length)
    for _ in range(150):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool"]), str(i), rng.choice(["", "", "blank", "truncated"]))
            for i in range(length)
        ]
        numbers = {"": repair.SOUND, "blank": repair.BLANK, "truncated": repair.TRUNCATED}
        codes = "".join(repair.row_code(role[:1], numbers[fault]) for role, _, fault in rows)
        cost, audit, lines = cheapest(rows)
        assert repair.Search(codes).cheapest() == (cost, audit)
        assert tuple(f"{r}:{t}" for r, t in repair.replay(audit, iter([r[:2] for r in rows]))) == lines


def test_search_grows_with_the_length():
    search = repair.Search("ua" * 5000 + "u" * 3000)
    cost, audit = search.cheapest()
    assert cost == 3 * 3000 - 3 * 1500 and len(audit) >= 13_000
