"""Operator 13 against a plain search over all edits, whole and cut into segments."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib

import pytest

from ripplecast.llm import conversations
from ripplecast.llm.tables import importable

SCHEMA = "conv_id long, turn long, role string, text string, seg long, alive boolean, audit string, place int"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, False, "x", 2) for r in rows], SCHEMA).repartition(5)


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def expected(rows):
    """One conversation's damaged rows, by plain recursion over (cost, letters, lines)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        faults.append(kind)
        seen.add((role, text))

    @functools.cache
    def least(i, done, room):
        """Least (cost, letters, lines) after the initials `done` (its last pair tells all), with `room` inserts."""
        ways = []
        shape = done[-1:] if done[-1:] in ("u", "a") else done
        if i == len(rows) and shape in ("", "a"):
            ways.append((0, "", ()))
        wanted = {"": "su", "s": "u", "u": "a", "a": "u"}[shape]

        def add(cost, letter, line, initial, j, left):
            rest = least(j, done + initial if initial else done, left) if len(done) < 3 or not initial else None
            if rest is None and initial:
                rest = least(j, initial, left)
            if rest is not None:
                ways.append((cost + rest[0], letter + rest[1], ((line,) if line else ()) + rest[2]))

        if i < len(rows):
            _, _, role, text = rows[i]
            add(2, "D", None, "", i + 1, 2)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if role[:1] and role[0] in wanted:
                    add(more, "K", f"{role}:{text}", role[0], i + 1, 2)
                for new in ("user", "assistant"):
                    if new[0] in wanted:
                        add(1 + more, "R", f"{new}:{text}", new[0], i + 1, 2)
        if room:
            for new in ("user", "assistant"):
                if new[0] in wanted:
                    add(5, "I", f"{new}:", new[0], i, room - 1)
        return min(ways) if ways else None

    cost, audit, lines = least(0, "", 2)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), "repaired": "\n".join(lines),
    }


def made_up():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "why", "ok?", "", "  ", None, "So. ", "été\n", "a:b."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for c in [*range(60), None]:
        n = rng.randint(1, 9)
        for t in range(n):
            rows.append((c, rng.choice([t, t, t, None, 3 * t, 7]), rng.choice(roles), f"{rng.choice(texts) or ''}" if t % 2 else rng.choice(texts)))
    rows += [(100, t, ("user", "assistant")[t % 2], f"line {t % 50}.") for t in range(300)]  # one large conversation
    rows += [(101, 1, "user", "same words.")] * 120  # whole rows repeated
    rows += [(102, -(2**63), "user", "a."), (102, 2**63 - 1, "assistant", "b.")]
    rows += [(103, 0, "system", "s."), (103, 1, "user", "x" * 300_000 + "."), (103, 2, "assistant", "y.")]
    return rows


ROWS = made_up()


def check(got, want):
    assert set(got) == set(want)
    for c, w in want.items():
        assert {k: got[c][k] for k in w} == w, c


@pytest.mark.parametrize("segment", [512, 4])
def test_repair_equals_plain_search(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment)
    rows = damage(ROWS)
    want = {c: expected([r for r in rows if r[0] == c]) for c in {r[0] for r in ROWS}}
    for w in want.values():
        w["gaps"] = min(w["gaps"], 2**63 - 1)
    turns = conversations.damaged(frame(spark, ROWS))
    check({r["conv_id"]: r.asDict() for r in conversations.repair_conversations(turns, alive="alive").collect()}, want)


def test_without_damage_every_row_counts(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "assistant", "cut")]
    got = {r["conv_id"]: r.asDict() for r in conversations.repair_conversations(frame(spark, rows)).collect()}
    assert (got[1]["cost"], got[1]["audit"], got[1]["repaired"]) == (0, "KK", "user:a.\nassistant:b.")
    assert (got[2]["cost"], got[2]["audit"], got[2]["repaired"]) == (2, "D", "")


def test_integer_ways_choose_the_ascii_least(monkeypatch):
    # u a u: deleting either user message or adding an answer; D.. < K..
    assert conversations.least_ways(["u", "a", "u"], [2, 2, 2], (0, 3))[0] == (2, b"KKD")
    assert conversations.least_ways(["u", "u", "a"], [2, 2, 2], (0, 3))[0] == (2, b"DKK")
    assert conversations.least_ways([], [], (0, 3)) == {0: (0, b""), 1: (10, b"II"), 2: (5, b"I"), 3: (0, b"")}


def test_dropped_and_empty_conversations(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    turns = conversations.damaged(frame(spark, [(gone, 0, "user", "x.")]))
    r = conversations.repair_conversations(turns, alive="alive").collect()[0]
    empty = hashlib.sha256(b"").hexdigest()
    assert (r["conv_id"], r["gaps"], r["cost"], r["audit"], r["repaired_sha256"]) == (gone, 0, 0, "", empty)
    turns = conversations.damaged(frame(spark, ROWS).limit(0))
    assert conversations.repair_conversations(turns, alive="alive").collect() == []
