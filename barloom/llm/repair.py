"""Repair of conversations: the cheapest edits that make their turns alternate.

The edit lattice of a conversation has a node for each number of turns consumed and each
state of the wanted form ``(s?(ua)+)?`` of role initials. Edges keep a turn, give it
another role, delete it, or insert an empty one. Two Dijkstra searches meet in it, one
from the start, one from the ends; they go on until every crossing of the least cost is
found. The least audit, the string of edits' initials, is then walked from the start over
edges of least cost only. (Comparing audits while they grow would be wrong: one may be
the beginning of another, and what follows decides.)

Conversations of up to ``LONG_TURNS`` turns and ``LONG_BYTES`` bytes are searched whole,
in one task each. A longer one, which may hold much of the table, is ordered by a range
partitioning and cut into blocks, wherever it lies: each block's distances between its
two ends are found, these are joined from the last block to the first (a row of sixteen
numbers for each block), and each block is then searched between its known ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored

#: Beyond either, a conversation is cut into blocks of at most this.
LONG_TURNS, LONG_BYTES = 4096, 16 << 20
#: Turns up to which searches are remembered by a worker, and how many are.
KNOWN_TURNS, KNOWN = 64, 100_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant.
STATES = 4
FINAL = {0: 0, 3: 0}
#: The state after a kept turn, by state and role initial, and after a turn made to fit.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
MADE = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
INITIALS = "suao"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: One character for a turn: small for a sound one, capital for a truncated one, a digit
#: for one that must go; by its role initial, "o" for any other.
SOUND, CUT, GONE = "suao", "SUAO", "1234"
NOWHERE = 1 << 60

SPACES = " \t\n\x0b\x0c\r"
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = "array<struct<role: string, text: string>>"
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_ARROW = {
    "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()), TURNS: pa.list_(_TURN),
}


def _turn(kind: str) -> tuple[str, int, bool]:
    """Role initial, cost of leaving it in, and whether that is allowed."""
    for kinds, cost, usable in ((SOUND, 0, True), (CUT, TRUNCATED, True), (GONE, 0, False)):
        if kind in kinds:
            return INITIALS[kinds.index(kind)], cost, usable
    raise ValueError(kind)


TURN = {kind: _turn(kind) for kind in SOUND + CUT + GONE}
MADE_FROM = {state: [p for p in range(STATES) if MADE[p] == state] for state in range(STATES)}
KEPT_FROM = {
    (state, initial): [p for p in range(STATES) if KEPT[p].get(initial) == state]
    for state in range(STATES)
    for initial in INITIALS
}


def _edges(kinds: str, node: int, last: bool) -> list[tuple[str, int, int]]:
    """Edges out of a node: initial, cost and target, in order of the initials.

    Insertions at the end of a block that is not the last belong to the next block.
    """
    at, state = divmod(node, STATES)
    found = []
    if at < len(kinds):
        initial, more, usable = TURN[kinds[at]]
        ahead = (at + 1) * STATES
        found.append(("D", DELETE, ahead + state))
        found.append(("I", INSERT, at * STATES + MADE[state]))
        if usable:
            if initial in KEPT[state]:
                found.append(("K", KEEP + more, ahead + KEPT[state][initial]))
            found.append(("R", REROLE + more, ahead + MADE[state]))
    elif last:
        found.append(("I", INSERT, at * STATES + MADE[state]))
    return found


def _edges_into(kinds: str, node: int, last: bool) -> list[tuple[int, int]]:
    """Cost and origin of the edges into a node."""
    at, state = divmod(node, STATES)
    found = []
    if at < len(kinds) or last:
        found += [(INSERT, at * STATES + p) for p in MADE_FROM[state]]
    if at:
        initial, more, usable = TURN[kinds[at - 1]]
        before = (at - 1) * STATES
        found.append((DELETE, before + state))
        if usable:
            found += [(KEEP + more, before + p) for p in KEPT_FROM[state, initial]]
            found += [(REROLE + more, before + p) for p in MADE_FROM[state]]
    return found


def cheapest(
    kinds: str, entry: int = 0, exits: dict[int, int] | None = None, last: bool = True
) -> tuple[int, str, int]:
    """The least cost from ``entry`` to an exit, its least audit, and the exit's state.

    ``exits`` has the cost that follows each state in which the turns may end.
    """
    exits = FINAL if exits is None else exits
    end = len(kinds) * STATES
    ahead, back = {entry: 0}, {end + state: cost for state, cost in exits.items()}
    first, second = [(0, entry)], sorted((cost, node) for node, cost in back.items())
    gone, come = set(), set()
    best = NOWHERE
    while first and second and first[0][0] + second[0][0] <= best:
        if first[0][0] <= second[0][0]:
            cost, node = heappop(first)
            if node in gone:
                continue
            gone.add(node)
            best = min(best, cost + back.get(node, NOWHERE))
            for _, more, target in _edges(kinds, node, last):
                if cost + more < ahead.get(target, NOWHERE):
                    ahead[target] = cost + more
                    heappush(first, (cost + more, target))
        else:
            cost, node = heappop(second)
            if node in come:
                continue
            come.add(node)
            best = min(best, cost + ahead.get(node, NOWHERE))
            for more, origin in _edges_into(kinds, node, last):
                if cost + more < back.get(origin, NOWHERE):
                    back[origin] = cost + more
                    heappush(second, (cost + more, origin))

    # What is left to pay: known behind the meeting, and before it from every crossing.
    rest = {node: back[node] for node in come}
    rest |= {end + q: back[end + q] for q in exits if end + q not in rest}
    crossed = [
        node
        for node in gone
        if ahead[node] + rest.get(node, NOWHERE) == best
        or any(
            ahead[node] + more + rest.get(target, NOWHERE) == best
            for _, more, target in _edges(kinds, node, last)
        )
    ]
    while crossed:
        node = crossed.pop()
        if ahead[node] + rest.get(node, NOWHERE) != best:
            rest[node] = best - ahead[node]
        for more, origin in _edges_into(kinds, node, last):
            if origin in gone and origin not in rest and ahead[origin] + more == ahead[node]:
                rest[origin] = best - ahead[origin]
                crossed.append(origin)
    audit, node = [], entry
    while not (node >= end and exits.get(node - end) == rest[node]):
        for initial, more, target in _edges(kinds, node, last):
            if rest.get(target, NOWHERE) + more == rest[node]:
                audit.append(initial)
                node = target
                break
        else:
            raise AssertionError("no way on")
    return best, "".join(audit), node - end


@lru_cache(maxsize=KNOWN)
def _known(kinds: str) -> tuple[int, str]:
    return cheapest(kinds)[:2]


def search(kinds: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return _known(kinds) if len(kinds) <= KNOWN_TURNS else cheapest(kinds)[:2]


def distances(kinds: str, entry: int, last: bool) -> list[int]:
    """The least cost from ``entry`` to each state at the end of a block."""
    cost_of, heap, done = {entry: 0}, [(0, entry)], set()
    while heap:
        cost, node = heappop(heap)
        if node in done:
            continue
        done.add(node)
        for _, more, target in _edges(kinds, node, last):
            if cost + more < cost_of.get(target, NOWHERE):
                cost_of[target] = cost + more
                heappush(heap, (cost + more, target))
    end = len(kinds) * STATES
    return [cost_of.get(end + state, NOWHERE) for state in range(STATES)]


def edited(audit: str, turns: list[tuple[str, str]], state: int = 0) -> list[dict]:
    """The turns after the edits."""
    out, at = [], 0
    for edit in audit:
        if edit == "K":
            role, text = turns[at]
            state = KEPT[state][role[0]]
        elif edit != "D":
            state = MADE[state]
            role, text = ROLES[state], turns[at][1] if edit == "R" else ""
        if edit != "D":
            out.append({"role": role, "text": text})
        at += edit != "I"
    return out


def initials(kinds: str) -> str:
    return "".join(TURN[kind][0] for kind in kinds)


def illegal(kinds: str) -> int:
    """Neighbours whose role initials are not in turn."""
    return sum(pair not in LEGAL for pair in pairwise(initials(kinds)))


def _prepared(turns: DataFrame, columns: tuple[str, ...], present: Column | None) -> DataFrame:
    """Turns in the operator's own names. ``key`` is a struct, so null ids are equal, too."""
    conv, turn, role, text = columns
    slim = turns.select(
        F.struct(F.col(conv).alias("id")).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    initial = F.left("role", F.lit(1))
    known = F.when(initial.isin(*"sua"), initial).otherwise("o")
    stop = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    state = F.when(stop == "", "blank").when(stop.isin(*".!?"), "sound").otherwise("cut")
    return slim.withColumns({"initial": known, "state": state})


# Turns of one number are in order of their role, then of their text's first characters.
ORDER = ["turn", "role", "lead", "mark"]


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"lead": F.left("text", F.lit(64)), "mark": F.xxhash64("text")})


def _kind(initial: str, state: str, again: bool) -> str:
    kinds = GONE if again or state == "blank" else SOUND if state == "sound" else CUT
    return kinds[INITIALS.index(initial)]


def _short(rows: DataFrame) -> DataFrame:
    """Conversations that are searched whole, each in the task its turns are brought to."""

    def mended(key, turns: list[tuple]) -> dict:
        seen, kinds, kept, numbers = set(), [], [], set()
        blank = duplicate = truncated = 0
        for turn, role, text, initial, state in turns:
            again = state != "blank" and (role, text) in seen
            seen.add((role, text))
            kinds.append(_kind(initial, state, again))
            blank += state == "blank"
            duplicate += again
            truncated += state == "cut" and not again
            kept.append((role, text))
            if turn is not None:
                numbers.add(turn)
        line = "".join(kinds)
        cost, audit = search(line)
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        return {
            "key": key, "part": 0, "parts": 1, "gaps": gaps, "blank": blank, "duplicate": duplicate,
            "truncated": truncated, "illegal": illegal(line), "cost": cost, "audit": audit,
            "turns": edited(audit, kept),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, out, held, any_yet = None, [], [], 0, False
        schema = None
        for batch in batches:
            if schema is None:
                schema = _arrow_schema(batch.schema.field("key").type)
            columns = (batch[c].to_pylist() for c in ("key", "turn", "role", "text", "initial", "state", "present"))
            for key, turn, role, text, initial, state, present in zip(*columns, strict=True):
                if not any_yet or key != now:
                    if any_yet:
                        out.append(mended(now, turns))
                    now, turns, any_yet = key, [], True
                if present:
                    turns.append((turn, role, text, initial, state))
                    held += len(text)
                if held > LONG_BYTES and out:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if any_yet:
            out.append(mended(now, turns))
            yield pa.RecordBatch.from_pylist(out, schema)

    slim = _ordered(rows).withColumn("text", F.when(F.col("present"), F.col("text")).otherwise(""))
    placed = slim.repartition("key").sortWithinPartitions("key", *ORDER)
    columns = placed.select("key", "turn", "role", "text", "initial", "state", "present")
    return columns.mapInArrow(run, _schema(rows))


def _schema(rows: DataFrame) -> str:
    key = rows.schema["key"].dataType.simpleString()
    return f"key {key}, part long, parts long, {', '.join(f'{f} long' for f in FACTS)}, audit string, turns {TURNS}"


def _arrow_schema(key: pa.DataType) -> pa.Schema:
    numbers = [(name, pa.int64()) for name in ("part", "parts", *FACTS)]
    return pa.schema([("key", key), *numbers, ("audit", pa.string()), ("turns", _ARROW[TURNS])])


def _lists(frame: DataFrame, function, **kinds: str) -> DataFrame:
    """Per row of ``frame``, a key and bounded lists, the rows that ``function`` gives."""
    key = frame.schema["key"].dataType.simpleString()
    names = [c for c in frame.columns if c != "key"]
    columns = ", ".join(f"{name} {kind}" for name, kind in kinds.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                found = function(*(row[c].to_pylist()[0] for c in names))
                keys = row["key"].take(pa.array([0] * len(found), pa.int32()))
                fields = [pa.array([r[c] for r in found], _ARROW[kind]) for c, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays([keys, *fields], ["key", *kinds])

    return frame.mapInArrow(run, f"key {key}, {columns}")


def _numbered(rows: DataFrame) -> DataFrame:
    """Turns of long conversations, in order, in blocks bounded in turns and bytes.

    Equal turns become one row with a number of ``copies``, so a turn that comes very
    often is as small as any other.
    """
    known = ["key", "turn", "role", "text", "initial", "state"]
    counted = _ordered(rows.groupBy(*known).agg(F.count(F.lit(1)).alias("copies")))
    steps = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(LONG_TURNS))).alias("chunk")
    pieces = counted.select("*", steps)
    pieces = pieces.withColumn("copies", F.least(F.col("copies") - F.col("chunk"), F.lit(LONG_TURNS)))
    order = ["key", *ORDER, "chunk"]
    placed = pieces.repartitionByRange(*order).sortWithinPartitions(*order).drop("lead", "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, any_yet, block, turns, held, place = None, False, 0, 0, 0, 0
        for batch in batches:
            blocks, places = [], []
            columns = (batch["key"], batch["copies"], batch["size"])
            for key, copies, size in zip(*(c.to_pylist() for c in columns), strict=True):
                full = turns and (turns + copies > LONG_TURNS or held + size > LONG_BYTES)
                if (any_yet and key != now) or full:
                    block, turns, held, place = block + 1, 0, 0, 0
                now, any_yet = key, True
                blocks.append(block)
                places.append(place)
                turns, held, place = turns + copies, held + size, place + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks), pa.array(places)],
                [*batch.schema.names, "block", "place"],
            )

    sized = placed.withColumn("size", F.octet_length("text").cast("long"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sized.schema)
    numbered = sized.mapInArrow(run, f"{kinds}, block long, place long")
    numbered = numbered.withColumns(
        {"task": F.spark_partition_id(), "said": F.sha2(F.concat_ws("\0", "role", "text"), 256)}
    )
    return stored(numbered, "long-turns")


def _block_kinds(turns: list[dict]) -> str:
    line = []
    for t in turns:
        line.append(_kind(t["initial"], t["state"], not t["first"]))
        line.append(_kind(t["initial"], "blank", True) * (t["copies"] - 1))
    return "".join(line)


def _long(rows: DataFrame) -> DataFrame:
    """The parts of conversations that are cut into blocks; ``rows`` are present turns."""
    turns = _numbered(rows)
    block = ["key", "task", "block"]
    # A turn is the first to say what it says if no other has an earlier place.
    said = turns.where("state <> 'blank'").groupBy("key", "said")
    first = said.agg(F.min(F.struct("task", "block", "place")).alias("at")).select(
        "key", "at.*", F.lit(True).alias("first")
    )
    marked = turns.join(first, [*block, "place"], "left").withColumn(
        "first", F.coalesce("first", F.lit(False))
    )
    marked = stored(marked.drop("said", "size"), "marked-turns")
    turn = F.struct("place", "initial", "state", "first", "copies")

    def measured(task, number, members, last):
        line = _block_kinds(members)
        sound = sum(1 for m in members if m["first"])
        blank = sum(m["copies"] for m in members if m["state"] == "blank")
        return [
            {
                "task": task, "block": number, "last": last, "kinds": line, "blank": blank,
                "duplicate": len(line) - blank - sound,
                "truncated": sum(1 for m in members if m["first"] and m["state"] == "cut"),
                "illegal": illegal(line),
                "ways": [cost for entry in range(STATES) for cost in distances(line, entry, last)],
            }
        ]

    members = marked.groupBy(*block).agg(F.sort_array(F.collect_list(turn)).alias("members"))
    end = marked.groupBy("key").agg(F.max(F.struct("task", "block")).alias("at"))
    end = end.select("key", "at.*", F.lit(True).alias("last"))
    members = members.join(end, block, "left").withColumn("last", F.coalesce("last", F.lit(False)))
    blocks = stored(
        _lists(
            members.select(*block, "members", "last"),
            measured,
            task="int", block="long", last="boolean", kinds="string", blank="long",
            duplicate="long", truncated="long", illegal="long", ways="array<long>",
        ),
        "long-blocks",
    )

    def joined(found):
        """From the last block back: what follows each state at each block's end."""
        rest = [FINAL.get(state, NOWHERE) for state in range(STATES)]
        out = []
        for i in range(len(found) - 1, -1, -1):
            ways = found[i]["ways"]
            out.append({"task": found[i]["task"], "block": found[i]["block"], "rest": rest})
            rest = [
                min(NOWHERE, *(ways[a * STATES + b] + rest[b] for b in range(STATES)))
                for a in range(STATES)
            ]
        meet = pairwise(f["edge"] for f in found)
        between = sum((a[1], b[0]) not in LEGAL for a, b in meet)
        return [r | {"total": rest[0], "between": between} for r in out]

    edge = F.concat(F.left("kinds", F.lit(1)), F.right("kinds", F.lit(1)))
    edge = F.translate(edge, CUT + GONE, SOUND + SOUND)
    listed = F.sort_array(F.collect_list(F.struct("task", "block", "ways", edge.alias("edge"))))
    ends = _lists(
        blocks.groupBy("key").agg(listed.alias("found")),
        joined,
        task="int", block="long", rest="array<long>", total="long", between="long",
    )
    ends = stored(ends, "block-ends")

    def walked(task, number, last, kinds, rest):
        exits = {state: cost for state, cost in enumerate(rest) if cost < NOWHERE}
        ways = [cheapest(kinds, entry, exits, last) for entry in range(STATES)]
        return [
            {"task": task, "block": number, "audits": [w[1] for w in ways], "leads": [w[2] for w in ways]}
        ]

    searched = blocks.select(*block, "last", "kinds").join(ends.select(*block, "rest"), block)
    walks = stored(
        _lists(
            searched.select("key", "task", "block", "last", "kinds", "rest"),
            walked,
            task="int", block="long", audits="array<string>", leads="array<int>",
        ),
        "block-walks",
    )

    def entered(found):
        out, state = [], 0
        for number, f in enumerate(found):
            out.append({"task": f["task"], "block": f["block"], "part": number, "entry": state})
            state = f["leads"][state]
        return [r | {"parts": len(found)} for r in out]

    listed = F.sort_array(F.collect_list(F.struct("task", "block", "leads")))
    entries = _lists(
        walks.groupBy("key").agg(listed.alias("found")),
        entered,
        task="int", block="long", part="long", entry="int", parts="long",
    )
    audits = walks.join(entries, block).select(
        *block, "part", "parts", "entry", F.get("audits", F.col("entry")).alias("audit")
    )

    def applied(part, parts, entry, audit, members):
        said = []
        for m in members:
            said += [(m["role"], m["text"])] * m["copies"]
        return [{"part": part, "parts": parts, "audit": audit, "turns": edited(audit, said, entry)}]

    turn = F.struct("place", "role", "text", "copies")
    texts = marked.groupBy(*block).agg(F.sort_array(F.collect_list(turn)).alias("members"))
    repaired = _lists(
        audits.join(texts, block).select("key", "part", "parts", "entry", "audit", "members"),
        applied,
        part="long", parts="long", audit="string", turns=TURNS,
    )
    counts = blocks.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
    totals = ends.groupBy("key").agg(F.max("total").alias("cost"), F.max("between").alias("between"))
    numbers = turns.select("key", "turn").distinct().groupBy("key")
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    numbers = numbers.agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    facts = counts.join(totals, "key").join(numbers, "key")
    facts = facts.withColumn("illegal", F.col("illegal") + F.col("between")).select("key", *FACTS)
    return repaired.join(facts, "key").select("key", "part", "parts", *FACTS, "audit", "turns")


def repair_conversations(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """Every conversation's faults, its cheapest edits and its turns after them.

    Columns: ``conv_col``, ``part``, ``parts``, the faults ``gaps``, ``blank``,
    ``duplicate``, ``truncated`` and ``illegal``, ``cost``, ``audit`` and ``turns`` (array
    of ``role``, ``text``). A conversation is one row; a very long one has several parts,
    in order, whose faults and cost are the whole conversation's, and whose audit and
    turns are the part's own.

    Rows for which ``present`` is false or null are no turns, but their conversation is
    returned: without any turn it has zeros, an empty audit and no turns. A null role or
    text is one space; a null id is an id; turns without a number come first and count for
    no gap. Turns of one number are in order of role, then of the text's first 64
    characters, then of its hash; equal ones stand together. Other columns are ignored
    whatever their names, and an empty table gives no rows.
    """
    rows = _prepared(turns, (conv_col, turn_col, role_col, text_col), present)
    sizes = rows.where("present").groupBy("key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("text")).alias("_bytes")
    )
    long = sizes.where((F.col("_n") > LONG_TURNS) | (F.col("_bytes") > LONG_BYTES)).select("key")
    long = stored(long, "long-conversations")
    if long.isEmpty():
        parts = _short(rows)
    else:
        short = _short(rows.join(long, "key", "left_anti"))
        parts = short.unionByName(_long(rows.where("present").join(long, "key", "left_semi")))
    return parts.select(F.col("key.id").alias(conv_col), *(c for c in parts.columns if c != "key"))


def conversation_digests(parts: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its faults, whole ``audit`` and ``repaired_sha256``.

    The digest is of the turns, ``role:text``, one per line. A hash has to be fed in
    order, so the parts of one very long conversation pass through one task, one at a
    time; nothing of them is held but their audits.
    """
    said = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    whole = parts.where("parts = 1").select(
        conv_col, *FACTS, "audit", F.sha2(said, 256).alias("repaired_sha256")
    )
    cut = parts.where("parts > 1").select(
        F.struct(F.col(conv_col).alias("id")).alias("key"),
        "part", *FACTS, "audit", said.alias("said"), (F.size("turns") > 0).alias("any"),
    )
    key = cut.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def close() -> pa.RecordBatch:
            row, audits, digest, _ = now
            columns = [row["key"], *(row[f] for f in FACTS)]
            columns += [pa.array(["".join(audits)]), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["key", *FACTS, "audit", "repaired_sha256"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if now is None or not now[0]["key"].equals(row["key"]):
                    if now is not None:
                        yield close()
                    now = [row, [], hashlib.sha256(), False]
                now[1].append(row["audit"][0].as_py())
                if row["any"][0].as_py():
                    now[2].update((b"\n" if now[3] else b"") + row["said"][0].as_py().encode())
                    now[3] = True
        if now is not None:
            yield close()

    facts = ", ".join(f"{f} long" for f in FACTS)
    placed = cut.repartition("key").sortWithinPartitions("key", "part")
    joined = placed.mapInArrow(run, f"key {key}, {facts}, audit string, repaired_sha256 string")
    joined = joined.select(F.col("key.id").alias(conv_col), *FACTS, "audit", "repaired_sha256")
    return whole.unionByName(joined)
