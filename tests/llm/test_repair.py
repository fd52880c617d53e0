"""Repair of conversations against a plain dynamic program that keeps whole audits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.llm import queries, repair
from barloom.llm.repair import cheapest, conversation_digests, distances, repair_conversations

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(turns):
    """Cost and audit of (initial, truncated, usable) turns, from the last one to the first.

    A suffix's least audit is right whatever comes before it, so whole strings are kept.
    """
    best = None
    for i in range(len(turns), -1, -1):
        now = {q: (0, "") if i == len(turns) and q in ("", "a") else (10**9, "") for q in ("", "s", "u", "a")}
        if i < len(turns):
            initial, cut, usable = turns[i]
            for q in now:
                ways = [(4 + best[q][0], "D" + best[q][1])]
                for edit, role in (("K", initial), ("R", "u"), ("R", "a")):
                    if usable and (q, role) in NEXT:
                        cost, rest = best[NEXT[q, role]]
                        ways.append((cost + 3 * (edit == "R") + 3 * cut, edit + rest))
                now[q] = min(ways)
        for _ in range(6):  # insertions, until none is cheaper
            for q in now:
                for role in "ua":
                    if (q, role) in NEXT:
                        cost, rest = now[NEXT[q, role]]
                        now[q] = min(now[q], (cost + 3, "I" + rest))
        best = now
    return best[""]


def random_kinds(rng, n):
    usual = "ua" * n
    return "".join(
        usual[i] if rng.random() < 0.6 else rng.choice(repair.SOUND + repair.CUT + repair.GONE) for i in range(n)
    )


@pytest.mark.parametrize("seed", range(5))
def test_search_equals_a_plain_dynamic_program(seed):
    rng = random.Random(seed)
    for _ in range(400):
        kinds = random_kinds(rng, rng.randint(0, 12))
        turns = [(t[0], t[1] > 0, t[2]) for t in map(repair.TURN.get, kinds)]
        assert cheapest(kinds)[:2] == plain_repair(turns), kinds


def test_every_audit_of_least_cost_is_compared():
    """All audits of short conversations, listed without any search."""
    rng = random.Random(9)

    def every(kinds, state=0, cost=0, audit="", room=3):
        if not kinds and state in repair.FINAL:
            yield cost, audit
        if kinds:
            initial, more, usable = repair.TURN[kinds[0]]
            yield from every(kinds[1:], state, cost + 4, audit + "D", room)
            if usable and initial in repair.KEPT[state]:
                yield from every(kinds[1:], repair.KEPT[state][initial], cost + more, audit + "K", room)
            if usable:
                yield from every(kinds[1:], repair.MADE[state], cost + 3 + more, audit + "R", room)
        if room:
            yield from every(kinds, repair.MADE[state], cost + 3, audit + "I", room - 1)

    for _ in range(150):
        kinds = random_kinds(rng, rng.randint(0, 5))
        assert cheapest(kinds)[:2] == min(every(kinds)), kinds


def test_blocks_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(60):
        kinds = random_kinds(rng, rng.randint(4, 30))
        cut = sorted(rng.sample(range(1, len(kinds)), 3))
        parts = [kinds[a:b] for a, b in zip([0, *cut], [*cut, len(kinds)], strict=True)]
        rests = [[repair.FINAL.get(q, repair.NOWHERE) for q in range(4)]]
        for i in range(len(parts) - 1, 0, -1):
            ways = [distances(parts[i], q, i == len(parts) - 1) for q in range(4)]
            rests.insert(0, [min(w[b] + rests[0][b] for b in range(4)) for w in ways])
        state, audit = 0, ""
        for i, part in enumerate(parts):
            _, more, state = cheapest(part, state, dict(enumerate(rests[i])), i == len(parts) - 1)
            audit += more
        assert audit == cheapest(kinds)[1]


def plain_rows(turns):
    """The contract's columns of one conversation's turns, in order."""
    seen, faults = set(), []
    for _, role, text in turns:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = (
            "blank" if not words else "duplicate" if (role, text) in seen
            else "truncated" if words[-1] not in ".!?" else None
        )
        seen.add((role, text))
        faults.append(fault)
    kinds = [(role[:1], f == "truncated", f in (None, "truncated")) for (_, role, _), f in zip(turns, faults, strict=True)]
    cost, audit = plain_repair(kinds)
    out, at, last = [], 0, ""
    for edit in audit:
        if edit != "D":
            role = turns[at][1] if edit == "K" else "assistant" if last == "u" else "user"
            out.append(f"{role}:{'' if edit == 'I' else turns[at][2]}")
            last = role[:1]
        at += edit != "I"
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:], strict=False)]
    return (
        gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain_query(rows):
    found = {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        kept = found.setdefault(conv, [])
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub(r"[.!?]", "", text)
        if code == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return Counter((conv, *plain_rows(sorted(turns, key=order))) for conv, turns in found.items())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["yes.", "no!", "why?", "so", "", " \n", "été", None, "a longer one. ", "end.\t"]
    roles = ["user", "assistant", "system", "tool", "", None]
    found = []
    for conv in range(300):
        turns = rng.sample(range(12), rng.randint(1, 8))
        for turn in sorted(turns):
            usual = ["user", "assistant"][turn % 2]
            found.append((conv, turn, rng.choice([usual] * 6 + roles), rng.choice(words)))
    # Repeated and null turns, a null id with a third of the rows, one turn.
    found += [(1000, 1, "user", "one."), (1000, 1, "user", "one."), (1000, 1, "assistant", "two.")]
    found += [(1001, None, "user", "one."), (1001, None, "assistant", "two."), (1001, 3, "user", "x.")]
    found += [(None, rng.choice([None, *range(200)]), rng.choice(roles), f"{rng.choice(words)}{i % 50}.") for i in range(900)]
    found += [(None, 7, "user", "the same.")] * 200
    return found


DDL = "conv_id long, turn long, role string, text string, key string, part int, parts int, `time` int, there string, turns int, cost int"


def written(spark, rows, folder):
    table = spark.createDataFrame([(*r, "k", 1, 2, 3, "t", 4, 5) for r in rows], DDL)
    table.repartition(4).write.parquet(f"{folder}/conversations.parquet")


def test_query_equals_brute_force(spark, rows, folder):
    written(spark, rows, folder)
    found = queries.op11_conversation_repair(spark, folder).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in found) == plain_query(rows)


def test_long_conversations_in_blocks(spark, rows, folder, monkeypatch):
    """With small blocks nearly every conversation is cut; results stay the same."""
    written(spark, rows, folder)
    monkeypatch.setattr(repair, "LONG_TURNS", 5)
    found = queries.op11_conversation_repair(spark, folder).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in found) == plain_query(rows)


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(repair, "LONG_BYTES", 40)
    rows = [(1, t, ["user", "assistant"][t % 2], f"{'word ' * 4}{t}.") for t in range(30)]
    parts = repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = parts.collect()
    assert len(found) == 30 and {r.parts for r in found} == {30}
    [whole] = conversation_digests(parts).collect()
    assert (whole.audit, whole.cost) == ("K" * 30, 0)


def test_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = queries.op11_conversation_repair(spark, sf_dir).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in found) == plain_query([tuple(r) for r in table.collect()])


def test_empty_tables_and_absent_turns(spark):
    table = spark.createDataFrame([(1, 1, "user", "hi."), (2, 1, "user", "hi.")], "conv_id long, turn long, role string, text string")
    assert repair_conversations(table.where("false")).isEmpty()
    [none] = repair_conversations(table, present=F.lit(None).cast("boolean")).where("conv_id = 2").collect()
    assert (none.audit, none.cost, none.turns, none.gaps) == ("", 0, [], 0)
    [one] = repair_conversations(table, present=F.col("conv_id") == 1).where("conv_id = 1").collect()
    assert (one.audit, one.cost, [tuple(t) for t in one.turns]) == ("KI", 3, [("user", "hi."), ("assistant", "")])
