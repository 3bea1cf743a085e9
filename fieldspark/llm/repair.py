"""Repair of conversations whose turns break the pattern system?, (user, assistant)+.

Each row has one of three faults at most, the first that holds: it is blank, repeats role and text of an
earlier row, or its text is truncated. A cheapest series of edits (keep, rerole, delete, insert) makes
the initials of the roles follow the pattern; among the cheapest, the one with the ASCII-least audit,
the edits' initials in order, is taken.

The edits form a lattice with a node for each place between rows and each state of the pattern.
``cheapest`` searches it from both ends: a forward and a reverse Dijkstra heap go on until no pair of open
nodes can cost as little as the best crossing, so all crossings of equal cost are known, and the least
concatenation of a forward and a reverse audit wins. Of equally cheap ways between two nodes no audit
is the beginning of another, so that the least parts make the least whole.

No conversation is gathered: rows are placed across tasks in order, and a few thousand at a time
become one string with a letter a row. A conversation in several such pieces is solved piece by piece: the
costs between the states at both ends of each piece, a backward sum of those over the pieces, then each
piece once more with the costs that follow it, and a forward walk over the states. Insertions between two
pieces belong to the latter one. Texts travel once more, as the rows of ``repaired_turns``.

Defined cases: a NULL role or text reads as one space. A NULL turn comes first. Rows of one turn follow
role and text. A NULL conv_id is a conversation of its own. An empty table has no conversations. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.llm.common import over_batches
from fieldspark.llm.turns import placed
from fieldspark.session import stored

# Rows of a piece, as a power of two.
PIECE_BITS = 10

REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
# States of the pattern: nothing yet, after system, after user, after assistant.
START, DONE = 0, (0, 3)
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
ROLES = {2: "user", 3: "assistant"}
LEGAL = {"su", "ua", "au"}
INFINITE = 1 << 60

# One letter a row: the role's initial (x: another one) for sound rows, truncated rows, and rows to delete.
SOUND, TRUNCATED, DOOMED = "suax", "SUAX", "0123"
INITIALS = {code: initial for codes in (SOUND, TRUNCATED, DOOMED) for code, initial in zip(codes, SOUND, strict=True)}

SPACES = " \t\n\x0b\x0c\r"


def as_turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the CRC-32 of conversation and turn modulo 20."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    turns = as_turns(conversations)
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    return turns.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


def _steps(code: str, state: int) -> list[tuple[int, int, str]]:
    """Ways (cost, next state, letter) over a row in a state of the pattern."""
    ways = [(DELETE, state, "D")]
    if code not in DOOMED:
        more = CUT_SHORT if code in TRUNCATED else 0
        kept = KEEPS.get((INITIALS[code], state))
        if kept is not None:
            ways.append((more, kept, "K"))
        ways.append((REROLE + more, NEXT[state], "R"))
    return ways


FORWARD = {(code, state): _steps(code, state) for code in SOUND + TRUNCATED + DOOMED for state in range(4)}
REVERSE = {
    (code, after): [(cost, before, letter) for before in range(4) for cost, to, letter in FORWARD[code, before] if to == after]
    for code in SOUND + TRUNCATED + DOOMED for after in range(4)
}
BEFORE = {after: [state for state, to in NEXT.items() if to == after] for after in range(4)}


def cheapest(codes: str, start: int, ends: dict[int, int], closing: bool = True) -> tuple[int, str]:
    """Least cost and, for it, least audit from ``start`` over all rows to one of ``ends`` (state: cost beyond).

    Insertions after the last row take part if ``closing``. Without any way the cost is ``INFINITE``.
    """
    m = len(codes)
    # Labels (cost, audit) of nodes (place, state). Ways without cost lead to the next place, so that by
    # (cost, place) all labels of a node are known when it leaves its heap.
    ahead: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    behind = {(m, state): (cost, "") for state, cost in ends.items() if cost < INFINITE}
    heap_f = [(0, 0, start)]
    heap_r = [(label[0], 0, state) for (_, state), label in behind.items()]
    heapq.heapify(heap_r)
    best = min((cost for node, (cost, _) in behind.items() if node in ahead), default=INFINITE)
    left, right = set(), set()

    def reach(labels, others, heap, node, label, rank):
        nonlocal best
        known = labels.get(node)
        if known is None or label < known:
            labels[node] = label
            if known is None or label[0] < known[0]:
                heapq.heappush(heap, (label[0], rank, node[1]))
            if node in others:
                best = min(best, label[0] + others[node][0])

    while heap_f and heap_r and heap_f[0][0] + heap_r[0][0] <= best:
        if heap_f[0][0] <= heap_r[0][0]:
            cost, place, state = heapq.heappop(heap_f)
            if (place, state) in left:
                continue
            left.add((place, state))
            audit = ahead[place, state][1]
            if closing or place < m:
                reach(ahead, behind, heap_f, (place, NEXT[state]), (cost + INSERT, audit + "I"), place)
            if place < m:
                for more, to, letter in FORWARD[codes[place], state]:
                    reach(ahead, behind, heap_f, (place + 1, to), (cost + more, audit + letter), place + 1)
        else:
            cost, rank, state = heapq.heappop(heap_r)
            place = m - rank
            if (place, state) in right:
                continue
            right.add((place, state))
            audit = behind[place, state][1]
            if closing or place < m:
                for before in BEFORE[state]:
                    reach(behind, ahead, heap_r, (place, before), (cost + INSERT, "I" + audit), rank)
            if place:
                for more, before, letter in REVERSE[codes[place - 1], state]:
                    reach(behind, ahead, heap_r, (place - 1, before), (cost + more, letter + audit), rank + 1)
    if best >= INFINITE:
        return INFINITE, ""
    crossings = (label[1] + behind[node][1] for node, label in ahead.items() if node in behind and label[0] + behind[node][0] == best)
    return best, min(crossings)


def state_after(codes: str, start: int, audit: str) -> int:
    """The state of the pattern an audit leads to."""
    state, place = start, 0
    for letter in audit:
        if letter in "IR":
            state = NEXT[state]
        elif letter == "K":
            state = KEEPS[INITIALS[codes[place]], state]
        place += letter != "I"
    return state


def _illegal(codes: str, before: str | None) -> int:
    initials = [INITIALS[c] for c in (before or "") + codes]
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def find_faults(rows: DataFrame) -> DataFrame:
    """Rows (place, conv_id, turn, fault, code) of turns, in their order by ``place``; stored."""
    text = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    light = placed(rows, [
        "conv_id", "turn", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("said"),
        (text == "").alias("blank"), (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("open"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
    ], "repair-places")
    # A row that is not the first to say something is found by its place, a key that never repeats.
    first = light.where("not blank").groupBy("conv_id", "said").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    code = F.when(fault == "truncated", F.upper("initial")).when(fault.isNotNull(), F.translate("initial", SOUND, DOOMED)).otherwise(F.col("initial"))
    return stored(light.join(first, "place", "left").select("place", "conv_id", "turn", fault.alias("fault"), code.alias("code")), "repair-faults")


def _pieces(faults: DataFrame) -> DataFrame:
    """Rows (conv_id, first, codes, before, n_pieces): runs of a conversation's rows as strings; stored."""
    coded = faults.groupBy("conv_id", F.shiftright("place", PIECE_BITS).alias("piece")).agg(
        F.min("place").alias("first"), F.array_sort(F.collect_list(F.struct("place", "code"))).alias("coded")
    ).select("conv_id", "first", F.array_join("coded.code", "").alias("codes"))
    along = W.partitionBy("conv_id").orderBy("first")
    return stored(coded.select(
        "*", F.lag(F.right("codes", F.lit(1))).over(along).alias("before"),
        F.count("*").over(W.partitionBy("conv_id")).alias("n_pieces"), (F.lead("first").over(along).isNull()).alias("closing"),
    ), "repair-pieces")


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def repair_plans(faults: DataFrame) -> DataFrame:
    """Rows (conv_id, illegal, cost, audit), one per conversation that has rows."""
    pieces = _pieces(faults)

    def solve():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            illegal, costs, audits = [], [], []
            known: dict[str, tuple[int, str]] = {}
            for codes in batch.column("codes").to_pylist():
                if codes not in known:
                    known[codes] = cheapest(codes, START, dict.fromkeys(DONE, 0))
                cost, audit = known[codes]
                illegal.append(_illegal(codes, None))
                costs.append(cost)
                audits.append(audit)
            return _batch({
                "conv_id": (batch.column("conv_id"), pa.int64()), "illegal": (illegal, pa.int64()),
                "cost": (costs, pa.int64()), "audit": (audits, pa.string()),
            })
        return step

    schema = "conv_id long, illegal long, cost long, audit string"
    short = over_batches(pieces.where("n_pieces = 1").select("conv_id", "codes"), schema, solve)
    return short.unionByName(_long_plans(pieces.where("n_pieces > 1")))


def _long_plans(pieces: DataFrame) -> DataFrame:
    """Plans of conversations in several pieces."""
    def measure():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            costs, illegal = [], []
            rows = batch.select(["codes", "before", "closing"]).to_pylist()
            for row in rows:
                costs.append([
                    cheapest(row["codes"], a, {b: 0}, row["closing"])[0] for a in range(4) for b in range(4)
                ])
                illegal.append(_illegal(row["codes"], row["before"]))
            return _batch({
                "conv_id": (batch.column("conv_id"), pa.int64()), "first": (batch.column("first"), pa.int64()),
                "illegal": (illegal, pa.int64()), "costs": (costs, pa.list_(pa.int64())),
            })
        return step

    def follow(group: pa.Table) -> pa.Table:
        """What the rest after each piece costs from each state: one small row a piece."""
        group = group.sort_by([("first", "descending")])
        ends, rest = [], [0 if state in DONE else INFINITE for state in range(4)]
        for costs in group.column("costs").to_pylist():
            ends.append(rest)
            rest = [min(INFINITE, *(costs[4 * a + b] + rest[b] for b in range(4))) for a in range(4)]
        total = pa.array([rest[START]] * group.num_rows, pa.int64())
        return group.select(["first", "conv_id", "illegal"]).append_column("ends", pa.array(ends, pa.list_(pa.int64()))).append_column("cost", total)

    measured = over_batches(pieces, "conv_id long, first long, illegal long, costs array<long>", measure)
    followed = stored(measured.groupBy("conv_id").applyInArrow(
        follow, "first long, conv_id long, illegal long, ends array<long>, cost long"
    ), "repair-follow")

    def solve():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            audits, states = [], []
            for row in batch.select(["codes", "closing", "ends"]).to_pylist():
                found = [cheapest(row["codes"], a, dict(enumerate(row["ends"])), row["closing"]) for a in range(4)]
                audits.append([audit for _, audit in found])
                states.append([state_after(row["codes"], a, audit) if cost < INFINITE else None for a, (cost, audit) in enumerate(found)])
            return _batch({
                "conv_id": (batch.column("conv_id"), pa.int64()), "first": (batch.column("first"), pa.int64()),
                "audits": (audits, pa.list_(pa.string())), "states": (states, pa.list_(pa.int32())),
            })
        return step

    def walk(group: pa.Table) -> pa.Table:
        """The state before each piece, from the first one on."""
        group = group.sort_by("first")
        entered, state = [], START
        for states in group.column("states").to_pylist():
            entered.append(state)
            state = states[state]
        return group.select(["first"]).append_column("state", pa.array(entered, pa.int32()))

    # ``first`` is a row's place, which no two pieces share.
    solved = stored(over_batches(
        pieces.select("first", "codes", "closing").join(followed.select("first", "conv_id", "ends"), "first"),
        "conv_id long, first long, audits array<string>, states array<int>", solve,
    ), "repair-pieces-solved")
    entered = solved.select("conv_id", "first", "states").groupBy("conv_id").applyInArrow(walk, "first long, state int")
    chosen = solved.join(entered, "first").select("conv_id", "first", F.expr("audits[state]").alias("audit"))
    audits = chosen.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first", "audit"))).alias("parts")).select(
        "conv_id", F.array_join("parts.audit", "").alias("audit")
    )
    sums = followed.groupBy(F.col("conv_id").alias("of")).agg(F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"))
    return audits.join(sums, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "illegal", "cost", "audit")


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows (conv_id, line, role, text) of all conversations after their edits.

    The turns of a conversation follow each other in the same partition, in order.
    """
    none, order = F.lit(None), ["conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "text"]
    both = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text").union(
        plans.select("conv_id", F.lit(0), none.cast("long"), none.cast("string"), "audit")
    )

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, line = None, "", 0, START, 0
        for batch in batches:
            out: list[list] = [[], [], [], []]

            def say(role, text):
                nonlocal line
                for column, value in zip(out, (conv, line, role, text), strict=True):
                    column.append(value)
                line += 1

            def insert():
                nonlocal at, state
                while at < len(audit) and audit[at] == "I":
                    state = NEXT[state]
                    say(ROLES[state], "")
                    at += 1

            kinds, convs, roles = (batch.column(c).to_pylist() for c in ("kind", "conv_id", "role"))
            for kind, conv_id, role, text in zip(kinds, convs, roles, batch.column("text"), strict=True):
                if kind == 0:  # a plan comes before its rows; the one before it ends here
                    insert()
                    conv, audit, at, state, line = conv_id, text.as_py(), 0, START, 0
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = KEEPS[role[:1], state]
                    say(role, text.as_py())
                elif letter == "R":
                    state = NEXT[state]
                    say(ROLES[state], text.as_py())
            yield _turn_batch(out)
        # What is inserted after the last row of the partition.
        rest = []
        while at < len(audit):
            state, at = NEXT[state], at + 1
            rest.append((conv, line + len(rest), ROLES[state], ""))
        yield _turn_batch([list(column) for column in zip(*rest, strict=True)] if rest else [[], [], [], []])

    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(edit, "conv_id long, line long, role string, text string")


def _turn_batch(columns: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], ["conv_id", "line", "role", "text"])


def turn_digests(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, repaired_sha256) of repaired turns as they come: role:text, joined by newlines."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None

        def done(found):
            return _batch({"conv_id": ([c for c, _ in found], pa.int64()), "repaired_sha256": ([d for _, d in found], pa.string())})

        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "line", "role")), batch.column("text"), strict=True)
            for conv_id, line, role, text in rows:
                if line == 0:
                    if running:
                        found.append((conv, running.hexdigest()))
                    conv, running = conv_id, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text.as_py()}".encode())
            yield done(found)
        if running:
            yield done([(conv, running.hexdigest())])

    return turns.mapInArrow(digests, "conv_id long, repaired_sha256 string")


def fault_counts(faults: DataFrame) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated)."""
    by_turn = faults.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")]
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(kind).alias(kind) for kind in ("blank", "duplicate", "truncated")]
    )


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` about its ``rows``: faults, cheapest edits, digest of the result."""
    faults = find_faults(rows)
    plans = stored(repair_plans(faults), "repair-plans")
    parts = [fault_counts(faults), plans, turn_digests(repaired_turns(rows, plans))]
    report = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in parts:
        report = report.join(part.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")

    def filled(name, default) -> Column:
        return F.coalesce(name, F.lit(default)).alias(name)

    counts = [filled(name, 0) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return report.select("conv_id", *counts, filled("audit", ""), filled("repaired_sha256", hashlib.sha256(b"").hexdigest()))
