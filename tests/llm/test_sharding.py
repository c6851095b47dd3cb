"""Differencing against its law, balance and slots, and defined cases."""

from __future__ import annotations

import zlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from stockweave.llm import sharding

DOCS = "doc_id bigint, text string, shard string"


@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60), st.integers(2, 8))
def test_difference_adds_up(weights, width):
    nodes = [[w] + [0] * (width - 1) for w in weights]
    parts, turns = sharding.difference(nodes)
    sums = [0] * width
    for node, turn in zip(nodes, turns, strict=True):
        assert sorted(turn) == list(range(width))
        for value, to in zip(node, turn, strict=True):
            sums[to] += value
    assert sums == parts and parts == sorted(parts, reverse=True)


def test_difference_known():
    # 8, 7, 6, 5, 4 in two parts: differencing gives 16 and 14.
    assert sharding.difference([[w, 0] for w in (8, 7, 6, 5, 4)])[0] == [16, 14]


def check(rows, texts):
    expected = sorted(str((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for d, t in texts)
    assert sorted(str(tuple(r[:3])) for r in rows) == expected
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [size[i] for i in range(8)]


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = sharding.shard_documents(docs).collect()
    sizes = check(rows, texts)
    assert max(sizes) - min(sizes) <= 0.0001 * sum(sizes)
    where = defaultdict(set)
    for r in rows:
        where[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_rounds_and_ranges(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 97) + str(i), "own") for i in range(500)], DOCS)
    assigned = sharding.materialise(sharding.assign(docs, fan_in=16))
    rows = sharding.with_slots(assigned, slot_rows=20).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    sizes = check(rows, [(i, "x" * (i % 97) + str(i)) for i in range(500)])
    assert max(sizes) - min(sizes) < 100


def test_hot_group_is_dealt_out(spark):
    texts = [(i, "copy " * 50 if i % 3 else f"own text {i} " * 20) for i in range(1200)]
    rows = sharding.shard_documents(spark.createDataFrame([(*t, "own") for t in texts], DOCS)).collect()
    sizes = check(rows, texts)
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes)


def test_defined_cases(spark):
    texts = [(1, None), (2, ""), (2, ""), (None, "é"), (None, None)]
    docs = spark.createDataFrame([(*t, "own") for t in texts], DOCS)
    check(sharding.shard_documents(docs).collect(), texts)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_group_below_a_fair_shard_stays_whole(spark):
    texts = [(i, "copy " * 50 if i % 10 == 0 else f"own text {i} " * 18) for i in range(1200)]
    rows = sharding.shard_documents(spark.createDataFrame([(*t, "own") for t in texts], DOCS)).collect()
    sizes = check(rows, texts)
    copies = [r for r in rows if r.doc_id % 10 == 0]
    assert sum(sizes) / 16 < sum(r.size for r in copies) < sum(sizes) / 8
    assert len({r.shard for r in copies}) == 1
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes)
