"""Conversation repair and the prefix trie against SQL and brute force on awkward tables."""

import hashlib
import itertools
import random
import zlib

import compare
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import prefix_trie, repair, turns
from fieldspark.llm.oracles import oracle_sql
from fieldspark.llm.queries import registered

SCHEMA = "conv_id long, turn long, role string, text string, kept string, place string, fault string, audit string, n string"
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sage"]
TEXTS = ["Fine.", "Cut off", "Why?", "", " \t", None, "Ends !\n", "Énd…", "done.", "a.b", "one:two\nthree."]


def rows_of(seed, conversations=60):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(conversations):
        for turn in range(rng.randrange(1, 14)):
            number = None if rng.random() < 0.05 else rng.choice([turn, turn, turn, turn // 2, turn + 3])
            rows.append((conv_id, number, rng.choice(ROLES), rng.choice(TEXTS)))
    # Copies of one conversation, a very long text, negative ids, rows without a conversation's id, gaps between ids.
    for conv_id in (100, 101, 103, 107, -3, -8):
        rows += [(conv_id, t, ROLES[1 + t % 2], f"Said {t % 3}.") for t in range(20)]
    rows += [(200, 0, "user", "long " * 40_000 + "."), (200, 1, "assistant", "x"), (200, 1, "assistant", "x")]
    return rows + [(None, 0, "user", "Nobody?"), (None, None, "assistant", "No."), (204, None, None, None)]


@pytest.fixture(scope="module", params=["awkward", "empty"])
def folder(spark, tmp_path_factory, request):
    path = str(tmp_path_factory.mktemp(request.param))
    rows = rows_of(1) if request.param == "awkward" else []
    frame = spark.createDataFrame([(*row, *["clash"] * 5) for row in rows], SCHEMA)
    frame.repartition(3).write.parquet(f"{path}/parts")
    spark.read.parquet(f"{path}/parts").coalesce(1).write.parquet(f"{path}/one")
    import glob
    import shutil
    shutil.copy(glob.glob(f"{path}/one/part-*.parquet")[0], f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op13_prefix_trie"])
def test_awkward_tables_equal_sql(spark, folder, name):
    assert compare.difference(registered()[name](spark, folder), compare.duck(folder), oracle_sql()[name]) is None


def brute_plan(codes, start=0, ends=(0, 3), closing=True):
    """All edit series with up to two insertions between rows: least (cost, audit)."""
    best = None
    step = {0: 2, 1: 2, 2: 3, 3: 2}

    def go(place, state, cost, audit, inserted):
        nonlocal best
        if place == len(codes) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserted < 2 and (closing or place < len(codes)):
            go(place, step[state], cost + 3, audit + "I", inserted + 1)
        if place < len(codes):
            code = codes[place]
            go(place + 1, state, cost + 4, audit + "D", 0)
            if not code.isdigit():
                late = 3 if code.isupper() else 0
                low = code.lower()
                if (low == "s" and state == 0) or (low == "u" and state != 2) or (low == "a" and state == 2):
                    go(place + 1, 1 if low == "s" else step[state], cost + late, audit + "K", 0)
                go(place + 1, step[state], cost + 3 + late, audit + "R", 0)

    go(0, start, 0, "", 0)
    return best


def test_bidirectional_search_equals_all_series():
    everything = repair.SOUND + repair.TRUNCATED + repair.DOOMED[:1]
    rng = random.Random(3)
    short = ["".join(c) for n in range(3) for c in itertools.product(everything, repeat=n)]
    longer = ["".join(rng.choices(everything, k=rng.randrange(3, 6))) for _ in range(150)]
    for codes in short + longer:
        assert repair.cheapest(codes, 0, {0: 0, 3: 0}) == brute_plan(codes), codes
    for codes in longer[:60]:
        for start in range(4):
            for end in range(4):
                got = repair.cheapest(codes, start, {end: 0}, closing=False)
                expected = brute_plan(codes, start, (end,), closing=False)
                assert got == (expected or (repair.INFINITE, "")), (codes, start, end)


def test_repair_in_pieces_equals_repair_as_a_whole(spark, monkeypatch):
    """A conversation in many pieces, one of them hot, has the plan it has as a whole."""
    rng = random.Random(5)
    rows = [
        (c, t, rng.choice(["system", "user", "assistant", "user", "assistant"]), rng.choice(["Yes.", "No", f"{c} {t}.", f"{t}?"]))
        for c in range(5) for t in range(40 if c else 300)
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: r for r in repair.repair_report(table, table).collect()}
    monkeypatch.setattr(repair, "PIECE_BITS", 2)
    pieces = {r.conv_id: r for r in repair.repair_report(table, table).collect()}
    assert whole == pieces and len(whole) == 5


def test_repaired_turns_follow_the_pattern(spark):
    table = repair.as_turns(spark.createDataFrame(rows_of(7, 30), "conv_id long, turn long, role string, text string"))
    plans = repair.repair_plans(repair.find_faults(table))
    found = {}
    for row in repair.repaired_turns(table, plans).collect():
        found.setdefault(row.conv_id, []).append(row)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.turn_digests(repair.repaired_turns(table, plans)).collect()}
    assert set(digests) == set(found)
    for conv_id, rows in found.items():
        assert [r.line for r in rows] == list(range(len(rows)))
        initials = "".join(r.role[:1] for r in rows)
        body = initials.removeprefix("s")
        assert body and body == "ua" * (len(body) // 2)
        assert digests[conv_id] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in rows).encode()).hexdigest()


def test_positions_of_a_conversation_over_many_partitions(spark):
    rows = [(7, t, "user", f"{t}") for t in range(3000)] + [(c, t, "user", "") for c in range(50) for t in range(2) if c != 7]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # would join these few rows to one partition
    spark.conf.set(coalesce, "false")
    try:
        placed = turns.placed(frame, ["conv_id", "turn"], "test-places")
    finally:
        spark.conf.set(coalesce, "true")
    assert placed.where("conv_id = 7").select(turns.partition_of()).distinct().count() > 1
    got = turns.with_positions(placed).where("conv_id = 7").orderBy("pos").select("pos", "turn").collect()
    assert [(r.pos, r.turn) for r in got] == [(t + 1, t) for t in range(3000)]


def test_long_conversations_continue_in_further_blocks(spark, monkeypatch):
    """Sums and parents over many blocks and slices, against a trie built turn by turn."""
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rng = random.Random(11)
    texts = {}
    for conv_id in range(40):
        base = texts[rng.randrange(conv_id)] if conv_id and rng.random() < 0.7 else []
        texts[conv_id] = base[: rng.randrange(len(base) + 1)] + [rng.choice("xyz") * rng.randrange(1, 4) for _ in range(rng.randrange(70))]
    rows = [(c, t, "user", text) for c, said in texts.items() for t, text in enumerate(said)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv_ids = spark.createDataFrame([(c,) for c in texts], "conv_id long")
    got = sorted(map(tuple, prefix_trie.prefix_trie(prefix_trie.turns_of(frame), conv_ids).collect()), key=str)

    members = {}
    for c, said in texts.items():
        for depth in range(len(said) + 1):
            members.setdefault(tuple(said[:depth]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    expected = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in inside if len(texts[c]) == len(node))
        expected.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children.get(node, [])),
            sum(n not in children for n in below), sum((len(members[n]) - 1) * len(n[-1]) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    assert got == sorted(expected, key=str)


def test_a_hot_parent_keeps_all_its_children(spark):
    """More children than a thousandth of all nodes go by broadcast, the others by a join."""
    rows = [(c, t, "user", f"{c}" if t else "hello") for c in range(3000) for t in range(2)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes = prefix_trie.prefix_trie(prefix_trie.turns_of(frame), frame.select("conv_id").distinct()).where("depth = 2")
    assert nodes.where("parent_conv_id = 0").count() == 3000


def test_crc_of_shared_heads(spark):
    frame = spark.createDataFrame([(c, t, "user", f"{c} {t}") for c in (5, 6) for t in range(10)], "conv_id long, turn long, role string, text string")
    own = prefix_trie.turns_of(frame)
    shared = prefix_trie.with_shared_heads(own)
    heads = shared.join(own.where("conv_id = 5").select("pos", "turn_id"), ["pos", "turn_id"]).where("conv_id = 6").count()
    assert heads == zlib.crc32(b"6") % 9
    assert sorted(map(tuple, shared.groupBy("conv_id").agg(F.count("*"), F.max("pos")).collect())) == [(5, 10, 10), (6, 10, 10)]
