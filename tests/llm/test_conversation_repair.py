"""Repair of conversations: search against all edits, plans and digests against a plain walk."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from curbflow.llm import conversation_repair as cr
from curbflow.llm.queries import QUERIES

SHAPE = re.compile(r"(s?(ua)+)?\Z")


def all_edits(rows, most):
    """(cost, audit, initials) of every edit sequence of cost up to ``most``, by trying each."""
    found = []

    def go(i, cost, audit, initials):
        if cost > most:
            return
        if i == len(rows):
            found.append((cost, audit, initials))
        for role in "ua":
            go(i, cost + 2, audit + "I", initials + role)
        if i < len(rows):
            initial, cut, gone = rows[i]
            go(i + 1, cost + 3, audit + "D", initials)
            if not gone:
                go(i + 1, cost + cut, audit + "K", initials + (initial or "?"))
                for role in "ua":
                    go(i + 1, cost + 2 + cut, audit + "R", initials + role)

    go(0, 0, "", "")
    return [(c, a, r) for c, a, r in found if SHAPE.match(r)]


def best_by_table(rows):
    """(cost, audit) by a table over (rows left, what stands before), from the end."""
    after = {"s": "s", "u": "u", "a": "a"}
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    ends = {"": (0, ""), "a": (0, ""), "s": (4, "II"), "u": (2, "I")}
    for initial, cut, gone in reversed(rows):
        new = {}
        for state in allowed:
            options = [(ends[state][0] + 3, "D" + ends[state][1])]
            if not gone:
                if initial and initial in allowed[state]:
                    rest = ends[after[initial]]
                    options.append((rest[0] + cut, "K" + rest[1]))
                role = "a" if state == "u" else "u"
                options.append((ends[role][0] + 2 + cut, "R" + ends[role][1]))
            new[state] = min(options)
        for _ in range(3):  # inserts lead from state to state
            for state in allowed:
                role = "a" if state == "u" else "u"
                new[state] = min(new[state], (new[role][0] + 2, "I" + new[role][1]))
        ends = new
    return ends[""]


def shapes(rows):
    return bytes(cr.shape(*row) for row in rows)


def test_search_equals_trying_all_edits():
    rng = random.Random(3)
    for _ in range(250):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.random() < 0.3, rng.random() < 0.2) for _ in range(rng.randrange(5))]
        cost, audit = cr.repair_shapes(shapes(rows))
        assert (cost, audit) == min((c, a) for c, a, _ in all_edits(rows, cost)), rows
        assert best_by_table(rows) == (cost, audit)


@pytest.mark.parametrize("odds", [(0.1, 0.1), (0.5, 0.4), (0.0, 0.0)])
def test_long_conversations_equal_a_table_however_they_are_cut(odds):
    rng = random.Random(7)
    for n in (1, 30, 63, 64, 65, 200, 900):
        rows = [(rng.choice("suauat"), rng.random() < odds[0], rng.random() < odds[1]) for _ in range(n)]
        want = best_by_table(rows)
        assert cr.repair_shapes(shapes(rows)) == want
        steps = cr.Repair()
        for at in range(0, n, 17):
            steps.pass_over(shapes(rows[at : at + 17]))
        assert steps.finish() == want


def plain(rows):
    """The result columns of one conversation's rows (turn, role, text), in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    seen, coded = set(), []
    for turn, role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        coded.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
    counts["illegal"] = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(coded))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = best_by_table(coded)
    out, state, left = [], "", iter(rows)
    for edit in audit:
        given = "assistant" if state == "u" else "user"
        if edit == "I":
            out.append((given, ""))
        else:
            _, role, text = next(left)
            if edit == "D":
                continue
            out.append((given if edit == "R" else role, text))
        state = out[-1][0][:1]
    assert SHAPE.match("".join(r[:1] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts.values(), cost, audit, digest), out


def brute(rows, damage=True):
    """All result rows of (conv, turn, role, text) rows."""
    kept = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20 if damage else 9
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 and text is not None else text
        role = "user" if fault == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, " " if r[1] is None else r[1], hashlib.md5((" " if r[2] is None else r[2]).encode()).digest())
    return {conv: plain(sorted(own, key=key))[0] for conv, own in kept.items()}


def random_rows(n_convs, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(-1, n_convs)]:
        for i in range(rng.randrange(1, longest)):
            turn = None if rng.random() < 0.1 else rng.choice([i, i, i, i + 3, 0])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "é\n", " ", "", None, "a b", "a b.  ", "done? \t\x0b", "\x1c", "word " * 300 + "."] + [f"t{i}."] * 8)
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def collected(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("convs,longest,parts", [(60, 8, 200_000), (60, 8, 5), (2, 900, 40), (0, 600, 10)])
def test_repairs_equal_a_plain_walk(spark, monkeypatch, convs, longest, parts):
    monkeypatch.setattr(cr.repair_plans, "__defaults__", ("conv_id", "turn", "role", "text", parts))
    rows = random_rows(convs, longest, convs + parts)
    frame = spark.createDataFrame([(*r, "k", 7) for r in rows], "conv_id long, turn long, role string, text string, key string, n int").repartition(5)
    assert collected(cr.repair_conversations(frame, cr.damage_conversations(frame))) == brute(rows)


def test_repaired_turns_are_returned_in_full(spark):
    rows = random_rows(30, 9, 4)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = {}
    for r in cr.repaired_turns(frame, cr.repair_plans(frame)).orderBy("key", "place").collect():
        turns.setdefault(r.key, []).append((r.place, r.role, r.text))
    want = brute(rows, damage=False)
    for conv, result in want.items():
        own = turns.get("" if conv is None else f"c{conv}", [])
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in own).encode()).hexdigest() == result[-1]


def test_a_row_repeated_very_often_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hi.")] * 3000 + [(1, 1, "assistant", "Yes.")] * 2 + [(2, 5, "user", " ")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert collected(cr.repair_conversations(frame, frame)) == brute(rows, damage=False)
    empty = frame.where("conv_id = 9")
    assert cr.repair_conversations(empty, empty).collect() == []
    assert collected(cr.repair_conversations(frame, empty))[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_the_query_equals_a_plain_walk(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op13_conversation_repair"](spark, sf_dir)) == brute(rows)
