"""Conversation repair against plain dynamic programming over all (cost, audit) pairs."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from railyard.llm import op12_conversations as op12

COLUMNS = "conv_id long, turn long, role string, text string, grp string, place long, code int"
INFINITE = (10**9, "", ())


def plain(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of one conversation's rows (turn, role, text)."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        inner = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not inner else "duplicate" if (role, text) in seen else "" if inner[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    def insert(states):
        for s in (0, 1, 3):
            c, a, r = states.get(s, INFINITE)
            states[2] = min(states.get(2, INFINITE), (c + 2, a + "I", (*r, "user:")))
        c, a, r = states[2]
        states[3] = min(states.get(3, INFINITE), (c + 2, a + "I", (*r, "assistant:")))
        return states

    states = insert({0: (0, "", ())})
    for (_, role, text), fault, initial in zip(rows, faults, initials):
        new = {}
        extra = fault == "truncated"

        def put(state, cost, audit, kept):
            new[state] = min(new.get(state, INFINITE), (cost, audit, kept))

        for s, (c, a, r) in states.items():
            put(s, c + 3, a + "D", r)
            if fault not in ("blank", "duplicate"):
                if initial in op12.NEXT[s]:
                    put(op12.NEXT[s][initial], c + extra, a + "K", (*r, f"{role}:{text}"))
                put(op12.forward(s), c + 2 + extra, a + "R", (*r, f"{op12.ROLES[op12.WANTED[s]]}:{text}"))
        states = insert(new)
    cost, audit, kept = min(states[s] for s in (0, 3) if s in states)
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def conversation(rng, n, roles):
    texts = ["Hello there.", "And then", "why?", " ", "", None, "so!\n", "é…", "x. y"]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice([*texts, *(f"text {rng.random()}." for _ in range(8))])) for _ in range(n)]


@pytest.mark.parametrize("chunk", [3, 7, 1024])
def test_repairs_equal_plain_dynamic_programming(spark, chunk):
    rng = random.Random(chunk)
    kinds = (["user", "assistant"] * 4 + ["system", "tool", None, ""], ["user"], ["assistant"], ["user", "assistant"], ["system", "user"])
    made = {None: conversation(rng, 9, kinds[0])}
    for k in range(60):
        made[k] = conversation(rng, rng.choice([1, 2, 3, 5, 8, 13, 40]), rng.choice(kinds))
    made[100] = [(i, "assistant" if i % 2 else "user", f"turn {i}.") for i in range(300)]
    made[101] = [(i, "user", "again and again.") for i in range(200)] + [(200, "assistant", "yes.")]  # all but two must go
    made[102] = [(i, "user", f"turn {i}") for i in range(120)]
    made[103] = [(7, "user", "same turn, same text.")] * 50
    rows = [(conv, *row, "g", 5, 6) for conv, found in made.items() for row in found]
    rng.shuffle(rows)
    found = op12.repair(spark.createDataFrame(rows, COLUMNS).repartition(4), chunk)
    digests = {r.grp: r.digest for r in found.digests().collect()}
    counts = {r.grp: r for r in found.conversations.collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(counts) == len(made)
    for conv, wanted in made.items():
        grp = "0" if conv is None else f"1{conv}"
        r = counts[grp]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests.get(grp, nothing)) == plain(wanted), conv
        assert re.fullmatch("[DIKR]*", r.audit)


def test_no_rows(spark):
    found = op12.repair(spark.createDataFrame([], COLUMNS))
    assert found.conversations.count() == 0 and found.digests().count() == 0


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, None, "a. b!", "", 0, 0) for c in range(40) for t in (None, *range(5))], COLUMNS)
    found = op12.damaged(rows).collect()
    assert {r.text for r in found} == {"", "a. b!", "a b"} and {r.role for r in found} == {" ", "user"}
    assert 0 < len(found) < 300


def test_a_restart_stops_where_vectors_agree(spark):
    rng = random.Random(3)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3]) | rng.choice([0, op12.TRUNCATED]) | rng.choice([op12.LIVE] * 3 + [0]) for _ in range(30))
        right = op12.vectors(codes[20:], op12.END)[0]
        start = op12.vectors(codes[:20], op12.END)[0]
        assert op12.restarted(codes[:20], op12.END, start, right) == op12.vectors(codes, op12.END)[0]
