"""Conversation repair against a search over prefixes, all split points, and odd rows."""

import hashlib
import itertools

import numpy as np
import oracle
import pytest

from sievemark.llm import conversations as C
from sievemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


def slow_best(codes):
    """The least (cost, audit) by trying every edit from left to right, one state at a time."""
    best = {0: (0, "")}

    def insertions(best):
        for _ in range(2):
            for p, (cost, audit) in list(best.items()):
                q = 3 if p == 2 else 2
                best[q] = min(best.get(q, (9**9, "")), (cost + 3, audit + "I"))
        return best

    best = insertions(best)
    for c in codes:
        after = {}
        late = 3 if c.isupper() else 0
        for p, (cost, audit) in best.items():
            options = [(p, cost + 4, "D")]
            if c != "x":
                for initial, froms, to in (("s", (0,), 1), ("u", (0, 1, 3), 2), ("a", (2,), 3)):
                    if p in froms and initial == c.lower():
                        options.append((to, cost + late, "K"))
                    elif p in froms and initial in "ua":
                        options.append((to, cost + late + 3, "R"))
            for q, cost_q, edit in options:
                after[q] = min(after.get(q, (9**9, "")), (cost_q, audit + edit))
        best = insertions(after)
    return min(best[q] for q in (0, 3) if q in best)


def test_cells_hold_the_cheapest_repair():
    for n in range(5):
        for codes in itertools.product("suaUox", repeat=n):
            assert C.best_repair(C.parse("".join(codes))) == slow_best(codes), codes
    random = np.random.default_rng(4)
    for _ in range(60):
        codes = "".join(random.choice(list("suaSUAox"), int(random.integers(5, 60))))
        assert C.best_repair(C.parse(codes)) == slow_best(codes), codes


def test_every_split_of_a_span_gives_its_cell():
    """The table over all spans with all splits, which the pairing of neighbours leaves out."""
    codes = "uUsaxoaAuus"
    cells = {(i, i + 1): C.parse(codes[i]) for i in range(len(codes))}
    for n in range(2, len(codes) + 1):
        for i in range(len(codes) - n + 1):
            found = {C.joined(cells[i, k], cells[k, i + n]) for k in range(i + 1, i + n)}
            assert len(found) == 1
            cells[i, i + n] = found.pop()
    assert cells[0, len(codes)] == C.parse(codes)


def slow_repair(rows):
    """Counts, cost, audit and digest of one conversation, rows as (turn, role, text) in any order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        known = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else known.upper() if fault else known
    cost, audit = slow_best(codes)
    out, at, state = [], 0, ""
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        wanted = "assistant" if state == "u" else "user"
        role, text = (wanted, "") if edit == "I" else rows[at][1:] if edit == "K" else (wanted, rows[at][2])
        at += edit != "I"
        state = role[0]
        out.append(f"{role}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return {"gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit}, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("block", [2, 8, 4096])
def test_repair_against_the_definition(spark, monkeypatch, block):
    """Long conversations over several blocks, nulls everywhere, repeated rows, clashing columns."""
    monkeypatch.setattr(C, "BLOCK_TURNS", block)
    random = np.random.default_rng(block)
    texts = ["Good.", "Why?", "no end", "", " \t\n", None, "Yes!  ", "x", "ünï… 漢."]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for conv in [None, *range(12)]:
        for _ in range(int(random.integers(1, 40))):
            role = roles[int(random.choice(7, p=[0.4, 0.35, 0.1, 0.05, 0.04, 0.03, 0.03]))]
            turn = None if random.random() < 0.1 else int(random.integers(-3, 30))
            text = texts[int(random.integers(len(texts)))]
            rows.append((conv, turn, role, (text + str(random.integers(9)) + ".") if text and random.random() < 0.7 else text))
    rows += rows[:5]
    frame = spark.createDataFrame([(*r, "own", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, pos long")
    repair = C.repair_conversations(frame)
    got = {r.conv_id: r.asDict() for r in repair.conversations.collect()}
    digests = {r.conv: r.sha256 for r in C.repaired_digests(repair.turns).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        want, sha = slow_repair([r[1:] for r in rows if r[0] == conv])
        assert {k: got[conv][k] for k in want} == want, conv
        assert digests.get(conv, hashlib.sha256(b"").hexdigest()) == sha


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    repair = C.repair_conversations(none)
    assert repair.conversations.count() == 0 and repair.turns.count() == 0 and C.repaired_digests(repair.turns).count() == 0


def test_query_names_every_conversation(spark, tmp_path):
    rows = [(1, None, "user", None), (None, 0, None, "x"), (7, 0, "user", "a"), (7, 0, "user", "a"), (8, 3, "assistant", "Fine.")]
    rows += [(100 + i, 0, "system", "Alone.") for i in range(60)]  # some lose their only turn
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = oracle.spark_rows(queries.op11_conversation_repair(spark, str(tmp_path)))
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = oracle.duck_rows(con, queries.ORACLES["op11_conversation_repair"])
    assert len(got[1]) == 64 and oracle.difference(got, want) is None
