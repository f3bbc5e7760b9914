"""Conversation repair against a plain version that knows nothing of checkpoints."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slicecheck.llm import turn_repair
from slicecheck.llm.queries import QUERIES
from slicecheck.llm.turn_repair import AT_END, KEPT, NEXT, STATES, before, crossing, walk
from tests.llm.fixtures import bag

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
PATTERN = re.compile(r"(s?(ua)+)?\Z")
SPACES = " \t\n\x0b\x0c\r"


def best_audit(letters: str) -> tuple[int, str]:
    """Costs and audits of all suffixes of the rows, as whole strings, from the end."""
    ends = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for letter in reversed(letters):
        mend = 3 if letter.isupper() else 0
        base = {}
        for s in range(4):
            ways = [(ends[s][0] + 4, "D" + ends[s][1])]
            if letter != "x":
                to = NEXT[s]
                ways.append((ends[to][0] + 3 + mend, "R" + ends[to][1]))
                kept = KEPT.get(letter.lower(), (-1,) * 4)[s]
                if kept >= 0:
                    ways.append((ends[kept][0] + mend, "K" + ends[kept][1]))
            base[s] = min(ways)
        ends = {}
        for s in range(4):
            one, two = NEXT[s], NEXT[NEXT[s]]
            ends[s] = min(base[s], (base[one][0] + 3, "I" + base[one][1]), (base[two][0] + 6, "II" + base[two][1]))
    return ends[0]


def plain(rows: list[tuple]) -> dict:
    """conv_id to its record; rows are (conv_id, turn, role, text)."""
    convs: dict = {}
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, letters, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in held:
            end = text.strip(SPACES)[-1:]
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not end:
                counts["blank"] += 1
                letter = "x"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                letter = "x"
            elif end not in ".!?":
                counts["truncated"] += 1
                letter = letter.upper()
            seen.add((role, text))
            letters += letter
        cost, audit = best_audit(letters)
        lines, todo = [], list(held)
        for edit in audit:
            role, text = (None, "") if edit == "I" else todo.pop(0)[1:]
            if edit in "IR":
                role = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{text}")
        assert not todo and PATTERN.match("".join(x[0] for x in lines))
        roles = [r[1][:1] for r in held]
        turns = {r[0] for r in held} - {None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *counts.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def odd_rows() -> list[tuple]:
    """Null and empty values, ties, repeated rows, strange roles, one very long conversation."""
    chance = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sage", "user", "assistant"]
    texts = [None, "", " \t", "Yes.", "No", "Yes. \n", "é!", "?", "x" * 3000, "a.b", "İ."]
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(chance.randint(1, 12)):
            turn = chance.choice([None, *range(8), 10**12, -3])
            rows.append((conv, turn, chance.choice(roles), chance.choice(texts)))
    rows += rows[:40]
    for turn in range(2500):
        rows.append((99, turn // 2, chance.choice(roles), chance.choice([*texts[:-3], f"t{turn % 700}."])))
    rows += [(98, 1, "user", "same.")] * 300
    rows += [(97, turn, "", "") for turn in range(3)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv int, `row` int, letter string, kind int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", 3) for r in rows], SCHEMA).repartition(6)


@pytest.mark.parametrize("bits", [12, 4])
def test_awkward_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", bits)
    monkeypatch.setattr(turn_repair, "SEGMENT_ROWS", 1 << bits)
    rows = odd_rows()
    found = turn_repair.query(frame(spark, rows))
    assert found.columns == ["conv_id", *COLUMNS]
    expected = plain(rows)
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got.keys() == expected.keys() and found.count() == len(expected)
    assert {k: v for k, v in got.items() if v != expected[k]} == {}
    assert turn_repair.query(frame(spark, rows).limit(0)).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_turn_repair"](spark, SF_DIR)
    assert bag(found.collect()) == bag((k, *v) for k, v in plain(rows).items())


def test_rows_without_damage(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 3, "assistant", "Yes?"), (2, 0, "user", "cut")], "conv_id long, turn long, role string, text string")
    found = {r.conv: r for r in turn_repair.repair(turn_repair.undamaged(rows)).collect()}
    assert (found[1].audit, found[1].cost, found[1].gaps) == ("KKK", 0, 1)
    assert found[1].repaired_sha256 == hashlib.sha256(b"system:Be kind.\nuser:Hi!\nassistant:Yes?").hexdigest()
    # Leaving it out costs 4, mending it and adding an answer 6.
    assert (found[2].audit, found[2].cost, found[2].truncated) == ("D", 4, 1)


@settings(max_examples=300, deadline=None)
@given(st.text("suaoxSUAO", max_size=40))
def test_walk_is_the_ascii_least_of_the_cheapest(letters):
    edits, state = walk(letters, AT_END, 0)
    audit = "".join(edits) + {0: "", 1: "II", 2: "I", 3: ""}[state]
    cost = AT_END
    for letter in reversed(letters):
        cost = before(letter, cost)
    assert (cost[0], audit) == best_audit(letters)


@settings(max_examples=200, deadline=None)
@given(st.text("suaoxSUAO", max_size=20), st.text("suaoxSUAO", max_size=20))
def test_segments_chain_to_the_whole(first, second):
    end = AT_END
    for letter in reversed(second):
        end = before(letter, end)
    whole = end
    for letter in reversed(first):
        whole = before(letter, whole)
    table = crossing(first)
    assert whole == tuple(min(table[t][s] + end[t] for t in STATES) for s in STATES)
    head, state = walk(first, end, 0)
    tail, last = walk(second, AT_END, state)
    assert (head + tail, last) == walk(first + second, AT_END, 0)
