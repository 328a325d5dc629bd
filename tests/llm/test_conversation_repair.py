"""Conversation repair against plain searches, and against DuckDB over awkward conversations."""

import hashlib
import itertools
import random
import re

import pytest

from retailflow.llm import conversation_repair
from retailflow.llm.conversation_repair import (
    BEGIN,
    OK,
    TRUNCATED,
    apply_edits,
    best_edits,
    cheapest,
    cut_edits,
    damage,
    digests,
    joined_edits,
    repair,
)
from retailflow.llm.conversation_repair import _Counts, _read

from .conftest import by_id


def plain_best(turns):
    """The least (cost, audit) over every choice of edits, with up to two inserts at each place."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(turns) + 1):
        if sum(inserts) > 2:
            continue
        for edits in itertools.product("DKR", repeat=len(turns)):
            if any(e != "D" and f in (1, 2) for e, (_, f) in zip(edits, turns, strict=True)):
                continue
            audit, cost = "", 0
            slots = []
            for i in range(len(turns) + 1):
                audit += "I" * inserts[i]
                slots += ["?"] * inserts[i]
                cost += 5 * inserts[i]
                if i < len(turns):
                    initial, fault = turns[i]
                    audit += edits[i]
                    cost += {"D": 2, "K": 0, "R": 1}[edits[i]] + (5 if fault == 3 and edits[i] != "D" else 0)
                    slots += [] if edits[i] == "D" else [initial if edits[i] == "K" else "?"]
            fits = [w for w in ("", "ua" * (len(slots) // 2 + 1), "s" + "ua" * (len(slots) // 2 + 1))
                    if all(x == y or (x == "?" and y != "s") for x, y in zip(slots, w, strict=False)) and len(slots) <= len(w)
                    and re.fullmatch("(s?(ua)+)?", w[:len(slots)])]
            if fits and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def some_turns(rng, n):
    return [(rng.choice("suuaat"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_best_edits_are_those_of_a_plain_search():
    rng = random.Random(2)
    for k in range(120):
        turns = some_turns(rng, k % 5)
        assert best_edits(turns) == plain_best(turns), turns


def test_pieces_give_the_same_edits():
    rng = random.Random(3)
    for k in range(60):
        turns = some_turns(rng, rng.randrange(1, 40))
        cuts = sorted({0, len(turns), *(rng.randrange(len(turns) + 1) for _ in range(k % 5))})
        pieces = []
        for lo, hi in itertools.pairwise(cuts):
            paths = []
            for begin in range(4):
                nodes, width = cheapest(turns[lo:hi], begin)
                paths += [[begin, end, i, *_read(w, width)] for (end, i), w in nodes.items()]
            pieces.append(paths)
        want = best_edits(turns)
        assert joined_edits(pieces) == want
        parts = cut_edits(want[1], [hi - lo for lo, hi in itertools.pairwise(cuts)])
        assert "".join(parts) == want[1]
        assert [sum(c != "I" for c in p) for p in parts] == [hi - lo for lo, hi in itertools.pairwise(cuts)]


def test_dear_deletes_make_inserts(monkeypatch):
    monkeypatch.setattr(conversation_repair, "DELETE", 50)
    assert best_edits([("u", OK), ("a", OK), ("u", OK)]) == (5, "KKKI")
    assert best_edits([("a", OK)]) == (5, "IK")
    assert apply_edits("IK", [("assistant", "x")]) == [("I", "user", ""), ("K", "assistant", "x")]
    assert best_edits([("s", OK)]) == (6, "IR")
    assert cheapest([("u", TRUNCATED)], BEGIN)[0]


def test_counts_add_up():
    rng = random.Random(4)
    rows = sorted(((rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", ""]), rng.randrange(4))
                   for _ in range(30)), key=lambda r: (r[0] is not None, r[0] or 0))
    whole = _Counts()
    for r in rows:
        whole.turn(*r)
    for cut in range(31):
        left, right = _Counts(), _Counts()
        for r in rows[:cut]:
            left.turn(*r)
        for r in rows[cut:]:
            right.turn(*r)
        left.add(right)
        assert left.totals() == whole.totals()
    turns = [t for t, _, _ in rows if t is not None]
    assert whole.totals()[0] == max(turns) - min(turns) + 1 - len(set(turns))
    assert _Counts().totals() == (0, 0, 0, 0, 0)


@pytest.fixture(scope="module")
def talks(spark):
    """Nulls, blanks, ties, repeated rows, odd roles, one long conversation, clashing extra columns."""
    rng = random.Random(5)
    rows = [(1, 0, "system", "Hi."), (1, 1, "user", "a?"), (1, 1, "user", "a?"), (1, 1, "assistant", "b!"), (1, 5, None, None),
            (2, None, "user", "x."), (2, None, "assistant", "y."), (2, 3, "", "z."), (None, 1, "user", "é."), (None, 2, "assistant", "\t"),
            (3, 0, "user", "same."), (3, 4, "user", "same."), (3, 4, "tool", "w. \n"), (4, 0, "user", " "), (5, 1, "user", "one.")]
    rows += [(7, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", f"{t}!", f"{t}.", " "])) for t in range(900)]
    rows += [(8, 2, "user", "again.")] * 300
    rows += [(c, t, ["user", "assistant"][t % 2], f"{c} {t}?") for c in range(20, 80) for t in range(c % 7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS piece", "'K' AS edit", "2 AS cost", "'x' AS audit", "0 AS copies")


def plain(rows):
    """Totals, audit and digest by the plain functions, conversation by conversation."""
    talks = {}
    for r in rows:
        talks.setdefault(r.conv_id, []).append((r.turn, r.role if r.role is not None else " ", r.text if r.text is not None else " "))
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, codes, counts = set(), [], _Counts()
        for turn, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append((role[:1], fault))
            counts.turn(turn, role, fault)
        cost, audit = best_edits(codes)
        lines = apply_edits(audit, [(r, t) for _, r, t in turns])
        text = "\n".join(f"{r}:{t}" for _, r, t in lines)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in lines))
        out.append((conv, *counts.totals(), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return by_id(out)


@pytest.mark.parametrize("piece", [1_024, 64])
def test_conversations(talks, monkeypatch, piece):
    monkeypatch.setattr(conversation_repair, "PIECE", piece)
    for rows in (talks, damage(talks)):
        fixed = repair(rows).cache()
        totals = {r.conv_id: r for r in fixed.where("audit is not null").collect()}
        sums = {r.conv_id: r.sha256 for r in digests(fixed).collect()}
        got = [(c, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sums[c]) for c, r in totals.items()]
        assert by_id(got) == plain(rows.collect())
        fixed.unpersist()


def test_query_and_sql_agree_on_awkward_conversations(spark, talks, tmp_path):
    import duckdb

    from retailflow.llm.oracle import SQL
    from retailflow.llm.queries import QUERIES

    for name, df in (("all", talks), ("none", talks.where("false"))):
        path = f"{tmp_path}/{name}/conversations.parquet"
        df.drop("piece", "edit").coalesce(1).write.parquet(path)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
        want = con.execute(SQL["op11_conversation_repair"]).fetchall()
        got = QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/{name}").collect()
        assert by_id(got) == by_id(want)
        assert len(got) == df.select("conv_id").distinct().count()
