"""Conversation repair against a search over all edits, in one pass and in chunks."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from stockweave.llm import conversation_repair
from stockweave.llm.role_grammar import Repair

ROWS = "conv_id bigint, turn bigint, role string, text string"
# What may follow: state and initial to state, 0 nothing yet, 1 system, 2 user, 3 whole pairs.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(turns):
    """(cost, edits, [(initial, turn)]) by a search in order of cost, then edits."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, edits, at, state, out = heapq.heappop(heap)
        if at == len(turns) and state in (0, 3):
            return cost, edits, list(out)
        if (at, state) in done:
            continue
        done.add((at, state))
        ways = [(3, "I", at, x, ((x, -1),)) for x in "ua"]
        if at < len(turns):
            initial, must_go, cut = turns[at]
            ways.append((4, "D", at + 1, None, ()))
            if not must_go:
                ways.append((3 * cut, "K", at + 1, initial, ((initial, at),)))
                ways += [(3 + 3 * cut, "R", at + 1, x, ((x, at),)) for x in "ua"]
        for price, edit, then, symbol, told in ways:
            after = state if symbol is None else NEXT.get((state, symbol))
            if after is not None:
                heapq.heappush(heap, (cost + price, edits + edit, then, after, out + told))


def random_turns(generator, n, roles="suat"):
    return [(generator.choice(roles), generator.random() < 0.2, generator.random() < 0.3) for _ in range(n)]


def test_parser_finds_cheapest_edits():
    generator, repair = random.Random(5), Repair()
    for n in range(3000):
        turns = random_turns(generator, n % 11)
        form, cost, ways = repair.run(0, turns)
        more, _, node, tail = repair.ends(form)
        edits = repair.edits(ways, node) + tail
        told = [((new or turns[at][0])[0], at) for new, at in repair.spoken(0, edits, turns)[0]]
        assert (cost + more, edits, told) == cheapest(turns)


def test_forms_are_few():
    repair = Repair()
    for seed in range(40):
        repair.run(0, random_turns(random.Random(seed), 5_000))
    assert len(repair.after) < 15_000


def damaged(rows):
    out, names = [], set()
    for conv, turn, role, text in rows:
        names.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out, names


def expected(rows, order=lambda row: 0):
    """By conversation; ``order`` tells rows of one turn apart."""
    rows, names = damaged(rows)
    result = {}
    for conv in names:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, order(r)))
        seen, turns, faults = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            last = re.sub("[ \t-\r]+$", "", text)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            turns.append((role[:1], fault < 2, fault == 2))
        cost, edits, told = cheapest(turns)
        numbers = [t for _, t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        lines = []
        for (initial, at), edit in zip(told, edits.replace("D", ""), strict=True):
            role = own[at][2] if edit == "K" else {"u": "user", "a": "assistant"}[initial]
            lines.append(f"{role}:{own[at][3] if at >= 0 else ''}")
        checksum = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result[conv] = (gaps, *faults, illegal, cost, edits, checksum)
    return result


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize(("chunk_turns", "partitions"), [(4096, 3), (2, 7), (1, 2)])
def test_corpus(spark, chunk_turns, partitions):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = found(conversation_repair.digest(rows, chunk_turns))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == expected([tuple(r) for r in rows.collect()])


def talk(n=700):
    """A long conversation with copies far apart, a system turn at its start, in its middle, and short ones."""
    generator = random.Random(3)
    texts = ["yes.", "no", " \t", "", "What then?", "é…", *[f"text {i}." for i in range(n // 2)]]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", None]
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Well?")]
    rows += [(1, 3 * i // 2 + 2, generator.choice(roles), generator.choice(texts)) for i in range(n)]
    rows += [(c, t, generator.choice(roles), generator.choice(texts)) for c in range(2, 40) for t in range(c % 6)]
    return rows


def one_per_turn(rows):
    return list({(conv, turn): (conv, turn, role, text) for conv, turn, role, text in rows}.values())


@pytest.mark.parametrize("chunk_turns", [4096, 50, 3])
def test_long_conversation(spark, chunk_turns):
    rows = one_per_turn(talk())
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert found(conversation_repair.digest(df, chunk_turns)) == expected(rows)


def test_long_texts_make_chunks(spark):
    rows = one_per_turn(talk(60)) + [(90, i, "user" if i % 2 else "assistant", "x" * 300_000 + ".") for i in range(8)]
    df = spark.createDataFrame(rows, ROWS)
    assert found(conversation_repair.digest(df, chunk_chars=500_000)) == expected(rows)


def test_defined_cases(spark):
    rows = [
        (None, None, None, None), (None, 4, "user", "Yes."), (7, None, "user", "Hm."), (7, None, "user", "Hm."),
        (7, None, "user", "Hm."), (7, 3, None, "x."), (7, 3, None, "x."), (8, 1, "", "a."), (8, 9, "assistant", None),
    ]
    dropped = next(c for c in range(100, 999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((dropped, 1, "user", "gone"))
    df = spark.createDataFrame([(*r, "own", 1, "x") for r in rows], ROWS + ", audit string, chunk int, key string")
    want = expected(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert want[dropped] == (0, 0, 0, 0, 0, 0, "", empty)
    for chunk_turns in (4096, 1):
        assert found(conversation_repair.digest(df, chunk_turns)) == want
    assert conversation_repair.digest(df.limit(0)).count() == 0


def test_order_of_rows_does_not_matter(spark):
    rows = [(1, 5, role, text) for role in ("user", "assistant", "system") for text in ("a.", "b", "c!")]
    df = spark.createDataFrame(rows, ROWS)
    hashes = {r[:4]: r[4] for r in df.selectExpr("*", "xxhash64(role, text)").collect()}
    one = found(conversation_repair.digest(df.repartition(3)))
    assert one == found(conversation_repair.digest(spark.createDataFrame(rows[::-1], ROWS), 2))
    assert one == expected(rows, lambda row: hashes[row])


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "So?")]
    row = conversation_repair.repair(spark.createDataFrame([(*r, 1) for r in rows], ROWS + ", more int")).collect()[0]
    assert (row.audit, row.cost) == cheapest([("a", False, False), ("u", False, False), ("u", False, False)])[1::-1]
    assert row.roles == ["user", "assistant", "user", "assistant"][: len(row.roles)]
