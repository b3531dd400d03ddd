import hashlib
import itertools
import random
import re

import pytest
from llm_oracle import same

from strataforge.llm import repair
from strataforge.llm.queries import op12_conversation_repair, oracle_sql

LEGAL = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip("\t\n\v\f\r ")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def exhaustive(rows):
    """All edits of a short conversation, with up to two inserts at each place."""
    faults, best = faults_of(rows), None
    for places in itertools.product(range(3), repeat=len(rows) + 1):
        for ops in itertools.product("DKR", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and o != "D" for f, o in zip(faults, ops, strict=True)):
                continue
            shape = [x for k, o, (role, _) in zip(places, ops, rows, strict=False) for x in [*["?"] * k, *([] if o == "D" else [role[0] if o == "K" else "?"])]] + ["?"] * places[-1]
            cost = 3 * sum(places) + sum({"D": 4, "K": 0, "R": 3}[o] + (3 if f == "truncated" and o != "D" else 0) for o, f in zip(ops, faults, strict=True))
            audit = "".join("I" * k + o for k, o in zip(places, ops, strict=False)) + "I" * places[-1]
            if best and (cost, audit) >= best:
                continue
            if any(LEGAL.fullmatch("".join(c)) for c in itertools.product(*("ua" if x == "?" else x for x in shape))):
                best = cost, audit
    return best


def by_turns(rows):
    """The recursion turn by turn, over the initials written so far."""
    state = {"": (0, "")}
    role_after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def closed(state):
        for _ in range(2):
            for s, (cost, audit) in list(state.items()):
                n, found = role_after[s], (cost + 3, audit + "I")
                state[n] = min(state.get(n, found), found)
        return state

    for (role, _), fault in zip(rows, faults_of(rows), strict=True):
        after = {}
        for s, (cost, audit) in closed(state).items():
            edits = [(s, 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                edits.append((role_after[s], 3 + more, "R"))
                if role[:1] == role_after[s] or (role[:1] == "s" and s == ""):
                    edits.append((role[0], more, "K"))
            for t, c, letter in edits:
                found = cost + c, audit + letter
                after[t] = min(after.get(t, found), found)
        state = after
    return min(v for s, v in closed(state).items() if s in ("", "a"))


def expected(conv, rows):
    """rows: (turn, role, text) in order."""
    plain = [(" " if r is None else r, " " if t is None else t) for _, r, t in rows]
    numbers = [n for n, _, _ in rows if n is not None]
    faults = faults_of(plain)
    cost, audit = by_turns(plain)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:], strict=False))
    out, at = [], 0
    for edit in audit:
        last = out[-1][0][0] if out else ""
        other = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((other, ""))
            continue
        role, text = plain[at]
        at += 1
        if edit != "D":
            out.append((other if edit == "R" else role, text))
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    return (conv, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def in_order(rows):
    """rows of one conversation in the operator's order."""
    filled = [(n, " " if r is None else r, " " if t is None else t) for n, r, t in rows]
    return sorted(filled, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))


def random_rows(rnd, most):
    texts = ["One.", "Two!", "Cut off", "  ", "", "Three? \n", "Yes.", "No.", "Maybe."]
    return [(k // 2 if rnd.random() < 0.1 else k, rnd.choice(["user", "assistant", "system", "tool", "user", "assistant"]), rnd.choice(texts) if rnd.random() < 0.5 else f"Text {k} {rnd.random()}.") for k in range(rnd.randrange(1, most))]


def test_turn_by_turn_equals_all_edits():
    rnd = random.Random(1)
    for _ in range(120):
        rows = [(r, t) for _, r, t in random_rows(rnd, 5)]
        assert by_turns(rows) == exhaustive(rows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql_on_whole_tables(spark, sf):
    same(op12_conversation_repair(spark, sf), oracle_sql()["op12_conversation_repair"], sf)


def test_stretches_and_parts_fold_to_the_same(spark, monkeypatch):
    """Conversations over many stretches and sorted parts, one of them with most of the rows."""
    monkeypatch.setattr(repair, "SEGMENT", 3)
    monkeypatch.setattr(repair, "BATCH", 10)
    rnd = random.Random(2)
    made = {f"c{i}": random_rows(rnd, 30) for i in range(40)} | {"hot": random_rows(rnd, 2) + [(k, "user" if k % 2 else "assistant", f"{k}.") for k in range(2, 900) if k % 7] + random_rows(rnd, 60)}
    df = spark.createDataFrame([(c, *r) for c, rows in made.items() for r in rows], "conv_id string, turn int, role string, text string").repartition(5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {tuple(r) for r in repair.repaired_digests(df).collect()}
        assert repair._placed(df).filter("conv_id = 'hot'").selectExpr("shiftright(seq, 33)").distinct().count() > 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {expected(c, in_order(rows)) for c, rows in made.items()}


def test_edge_cases(spark):
    made = {
        None: [(0, "user", "No id."), (1, "assistant", "Yes.")],
        1: [(None, "user", "Null turn."), (None, "user", "Null turn."), (2, None, None)],
        2: [(None, "user", "a.")],
        3: [(5, "", "No role."), (5, "", "No role.")],
        4: [(0, "user", "x" * 300_000), (1, "assistant", " " * 300_000), (2, "assistant", "a. ")],
        5: [(0, "system", "Only.")],
        6: [(3, "assistant", "Late."), (9, "user", "Gaps?")],
        7: [(0, "user", "Same."), (0, "user", "Same."), (0, "user", "Same.")],
    }
    df = spark.createDataFrame([(c, *r) for c, rows in made.items() for r in rows], "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seq", "'x' AS audit", "2 AS run", "3 AS digest")
    extra = spark.createDataFrame([(6,), (99,), (99,), (None,)], "conv_id long")
    want = {expected(c, in_order(rows)) for c, rows in made.items()} | {(99, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert sorted(map(repr, map(tuple, repair.repaired_digests(df, extra).collect()))) == sorted(map(repr, want))
    turns = {}
    for r in repair.repaired_turns(df).orderBy("conv_id", "position").collect():
        turns.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    assert turns[5] == [("R", "user", "Only."), ("I", "assistant", "")] or turns[5] == [("D", None, None)]
    assert "".join(e for e, _, _ in turns[7]) == expected(7, in_order(made[7]))[7]
    assert repair.repaired_digests(df.limit(0)).count() == 0
    assert [tuple(r)[1:] for r in repair.repaired_digests(df.limit(0), extra.filter("conv_id = 6")).collect()] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = sorted(map(repr, map(tuple, repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())))
    want = []
    for c, t, role, text in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text)
        want += [row] * (0 if f == 0 else 2 if f == 3 else 1)
    assert got == sorted(map(repr, want))
