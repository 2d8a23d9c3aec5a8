"""Conversation repair against brute force over all edits, and the query against a plain version over whole rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import repair
from tidewater.llm.queries import llm_queries

SMALL = "/root/testdata/sf0.001"
GOAL = re.compile(r"(s?(ua)+)?\Z")
ROWS = "conv_id long, turn long, role string, text string"


def every_repair(turns):
    """(cost, audit, roles) of every way to edit the turns with at most two inserts at a place."""
    def inserts(i):
        for n in range(3):
            for roles in itertools.product("ua", repeat=n):
                yield 5 * n, "I" * n, "".join(roles)

    def edits(t):
        yield 2, "D", ""
        if t != "x":
            broken = 5 * t.isupper()
            yield broken, "K", t.lower()
            yield from ((1 + broken, "R", r) for r in "ua")

    def rest(i):
        for c, a, r in inserts(i):
            if i == len(turns):
                yield c, a, r
                continue
            for c2, a2, r2 in edits(turns[i]):
                for c3, a3, r3 in rest(i + 1):
                    yield c + c2 + c3, a + a2 + a3, r + r2 + r3

    return rest(0)


@given(st.text("suaoSUAOxuaua", max_size=3), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_lightest_against_all_edits(turns, cut):
    want = min((c, a) for c, a, roles in every_repair(turns) if GOAL.match(roles))
    parts = [repair.block_table(p) for p in (turns[:cut], turns[cut:]) if p]
    assert repair.answer(parts) == want
    assert repair.answer([repair.combined(parts)]) == want if parts else want == (0, "")


def dynamic(turns):
    """The same by a plain table over (turn, state), for longer conversations."""
    states = {0: (0, "")}

    def close(table):
        for _ in range(3):
            for s, v in list(table.items()):
                for r in "ua":
                    if (t := repair.STEP.get((s, r))) is not None:
                        table[t] = min(table.get(t, (10**9, "")), (v[0] + 5, v[1] + "I"))
        return table

    close(states)
    for turn in turns:
        after = {}
        for s, (c, a) in states.items():
            ways = [(s, 2, "D")]
            if turn != "x":
                broken = 5 * turn.isupper()
                ways += [(repair.STEP.get((s, turn.lower())), broken, "K")]
                ways += [(repair.STEP.get((s, r)), 1 + broken, "R") for r in "ua"]
            for t, more, letter in ways:
                if t is not None:
                    after[t] = min(after.get(t, (10**9, "")), (c + more, a + letter))
        states = close(after)
    return min(states[s] for s in (0, 3) if s in states)


@given(st.lists(st.text("suaoSUAOxuaua", min_size=1, max_size=12), max_size=12))
@settings(max_examples=60, deadline=None)
def test_blocks_of_long_conversations(blocks):
    tables = [repair.block_table(b) for b in blocks]
    assert repair.answer(tables) == dynamic("".join(blocks))
    if len(tables) > 3:
        assert repair.answer([repair.combined(tables[:2]), repair.combined(tables[2:])]) == dynamic("".join(blocks))


def plain(rows):
    """The query's rows from (conv_id, turn, role, text), row by row."""
    text_of = lambda x: " " if x is None else str(x)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        convs[conv]
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).digest()))
        seen, letters, n = set(), "", Counter()
        for _, role, text in turns:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            n[fault] += 1
            letters += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(turns, turns[1:])]
        numbers = [t for t, _, _ in turns if t is not None]
        cost, audit = dynamic(letters)
        out, state, k = [], 0, 0
        for letter in audit:
            turn = None if letter == "I" else turns[k]
            k += letter != "I"
            if letter != "D":
                role = turn[1] if letter == "K" else "assistant" if state == 2 else "user"
                state = repair.STEP[state, role[:1]]
                out.append(f"{role}:{'' if letter == 'I' else turn[2]}")
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        yield (conv, gaps, n["blank"], n["duplicate"], n["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
               hashlib.sha256("\n".join(out).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture(scope="module")
def odd_rows():
    roles = ["user", "assistant", "system", None, "", "tool", "unknown"]
    texts = ["Yes.", "No", None, "", " \n", "Why? \t", "long " * 5_000 + ".", "Ünï.", "a "]
    rows = [(10_000 + i // 9, i % 9, roles[i * 5 % 7], texts[i * 7 % 9]) for i in range(300)]
    rows += [(20_000, None, "user", "a."), (20_000, None, "user", "b"), (20_000, 5, "assistant", "c."), (20_000, 5, "assistant", "c."),
             (None, 1, "user", "hi."), (None, None, None, None), (None, 3, "assistant", "x.")]
    rows += [(20_001, t, "user", f"{t}.") for t in (7, 3, 900)] + [(20_002, 1, "user", "x.")] * 40
    dropped = next(c for c in range(30_000, 31_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "gone.")]


def test_query_against_plain_rows(spark, tmp_path, odd_rows):
    every = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    every += odd_rows + [(40_000, i, "user" if i % 3 else "assistant", f"turn {i}{'.' if i % 5 else ''}") for i in range(1_500)]
    df = spark.createDataFrame(every, ROWS).selectExpr("*", "'x' as digest", "1 as place", "'y' as audit")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = llm_queries()["op11_turn_repair"](spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(every), key=repr)


def test_levels_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 4)
    monkeypatch.setattr(repair, "FAN", 3)
    rows = [(c, i, "user" if (i + c) % 3 else "assistant", f"turn {i}{'.' if i % 7 else ''}") for c in range(3) for i in range(40 * c + 2)]
    found = repair.repair(spark.createDataFrame(rows, ROWS))
    letters = {c: "".join((r[0] if i % 7 else r[0].upper()) for k, i, r, _ in rows if k == c) for c in range(3)}
    assert {(r.conv_id, r.cost, r.audit) for r in found.conversations.collect()} == {(c, *dynamic(x)) for c, x in letters.items()}
    repaired = defaultdict(list)
    for r in found.turns.collect():
        repaired[r.conv_id].append((r.position, r.role[0]))
    for turns in repaired.values():
        assert GOAL.match("".join(r for _, r in sorted(turns)))


def test_no_conversations(spark):
    found = repair.repair(repair.damaged(spark.createDataFrame([], ROWS)))
    assert found.conversations.collect() == [] and repair.digests(found.turns).collect() == []
