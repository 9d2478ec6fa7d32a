"""Conversation repair against the cheapest path over all edits, with chunks cut everywhere."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import queries, turns

SCHEMA = "conv_id long, turn long, role string, text string, key string, order int, audit string, chunk long"
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ADDED = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}


def cheapest(rows, faults):
    """Least (cost, letters) and the turns written, all edits tried turn by turn."""
    def inserts(best):
        todo = list(best)
        while todo:
            s = todo.pop()
            cost, letters, out = best[s]
            n = ADDED[s]
            if n not in best or (cost + 2, letters + "I") < best[n][:2]:
                best[n] = cost + 2, letters + "I", [*out, f"{NAMES[n]}:"]
                todo.append(n)
        return best

    best = inserts({0: (0, "", [])})
    for (role, text), fault in zip(rows, faults):
        found, late = {}, fault == 3

        def offer(state, *path):
            if state not in found or path[:2] < found[state][:2]:
                found[state] = path

        for s, (cost, letters, out) in best.items():
            offer(s, cost + 3, letters + "D", out)
            if fault in (0, 3):
                if role[:1] in NEXT[s]:
                    offer(NEXT[s][role[:1]], cost + late, letters + "K", [*out, f"{role}:{text}"])
                offer(ADDED[s], cost + 2 + late, letters + "R", [*out, f"{NAMES[ADDED[s]]}:{text}"])
        best = inserts(found)
    return min((best[s] for s in (0, 3) if s in best), key=lambda p: p[:2])


def report(rows):
    """Report of one conversation's (turn, role, text), sorted."""
    seen, faults = set(), []
    for _, role, text in rows:
        left = text.rstrip(" \t\n\v\f\r")
        faults.append(1 if not left else 2 if (role, text) in seen else 0 if left[-1] in ".!?" else 3)
        seen.add((role, text))
    cost, letters, out = cheapest([r[1:] for r in rows], faults)
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    first = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
    return (gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(rows, damage):
    blank = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = blank(role), blank(text)
        code = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20 if damage else 9
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0)) for c, own in out.items()}


def rows():
    draw = random.Random(8)
    out = []
    for conv in range(60):
        for turn in range(draw.choice([1, 2, 3, 5, 9, 14])):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "Well", "", " \n", None, "So? ", f"T{draw.randrange(9)}.", "é\x0b"])
            out.append((conv if conv else None, turn * draw.choice([1, 1, 2]) if draw.random() < 0.95 else None, role, text))
    distinct = {(c, t): (c, t, r, x) for c, t, r, x in out}
    long_one = [(77, t, ("user", "assistant", "user", "system")[draw.randrange(4)], f"word {t % 400}" + "." * (t % 3 > 0)) for t in range(3000)]
    return [*distinct.values(), *long_one, *long_one[:7], (78, 1, "user", "x " * 300_000 + "end."), (79, 5, "assistant", "It is.")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "k", 1, "a", 2) for r in rows()], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("block", [1, 3, 4])
def test_tables_give_the_cheapest_edits(block):
    made, draw = turns.Tables(block), random.Random(block)
    words = [bytes(w) for n in range(4) for w in itertools.product(range(turns.SYMBOLS), repeat=n)]
    words += [bytes(draw.randrange(turns.SYMBOLS) for _ in range(draw.randrange(5, 40))) for _ in range(400)]
    for word in words:
        pairs = [("sua?"[(s - 1) // 2 if s else 0] + "x", "t") for s in word]
        cost, letters, _ = cheapest(pairs, [2 if s == 0 else 3 if (s - 1) % 2 else 0 for s in word])
        _, front, total = made.behind_blocks(word, 0)
        found, state = made.trace(word, 0, 0)
        assert (made.vectors[front][0] + total, found + {1: "II", 2: "I"}.get(state, "")) == (cost, letters)


@pytest.mark.parametrize("chunk", [{}, {"chunk_turns": 3}, {"chunk_chars": 40, "block": 2}])
def test_reports_equal_brute_force(spark, table, chunk):
    want = {c: report(own) for c, own in conversations(rows(), False).items()}
    found = turns.repair(table, **chunk)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want)
    assert {r[0]: r[1:] for r in got} == want


def test_query_equals_brute_force_on_damaged_nulls_and_repeats(spark, table, tmp_path):
    table.select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversations(spark, str(tmp_path)).collect()}
    assert got == {c: report(own) for c, own in conversations(rows(), True).items()}


def test_repaired_turns_are_those_of_the_hash(table):
    reports = {r["conv_id"]: r for r in turns.repair(table, chunk_turns=50).collect()}
    written = {}
    for r in turns.repair(table, turns=True, chunk_turns=50).orderBy("place").collect():
        own = written.setdefault(r["conv_id"], [])
        assert r["place"] == len(own)
        own.append(r)
    for conv, found in reports.items():
        own = written.get(conv, [])
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == found["repaired_sha256"]
        assert "".join(r["edit"] for r in own) == found["audit"].replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in own))


def test_dropped_and_missing_rows(spark, table):
    gone = turns.repair(table, present=F.lit(False)).collect()
    assert len(gone) == table.select("conv_id").distinct().count()
    assert {tuple(r)[1:] for r in gone} == {(0,) * 6 + ("", hashlib.sha256(b"").hexdigest())}
    assert turns.repair(table.limit(0)).count() == turns.repair(table.limit(0), turns=True).count() == 0
