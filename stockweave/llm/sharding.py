"""Sharding by bytes: Karmarkar-Karp differencing over groups of equal texts.

A group of equal texts is one item with the bytes of all its rows. Differencing starts with
one partial partition per item (its bytes in one part, nothing in the others) and repeatedly
combines the two with the largest spread, the largest part of one with the smallest of the
other. It runs in rounds: nodes of bounded number are combined per task, each task's result is
one node of the next round, and one node is left at the end. Walking back down the rounds tells
every group its shard.

A group heavier than ``whole_share`` of a fair shard cannot stay whole without unbalancing the
shards; it is dealt out as several items, by hash of the document, and no row is lost.

Defined results: a NULL text counts one byte and is its own group, apart from the empty text;
repeated rows count and are placed one by one; other columns are not carried.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialise

SHARDS = 8
FAN_IN = 8_192
WHOLE_SHARE = 1.0
SLOT_ROWS = 20_000
LAW = "bytes"
_NODE = "node bigint, parent bigint, parts array<bigint>, turn array<int>"


def difference(nodes: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine sorted parts (largest first) of many nodes into one node.

    Returns its parts and, per node, which part of the result each of its parts went to.
    """
    width = len(nodes[0])
    tree: list[tuple[list[int], tuple | None]] = [(parts, None) for parts in nodes]
    heap = [(parts[-1] - parts[0], i) for i, parts in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, left = heapq.heappop(heap)
        _, right = heapq.heappop(heap)
        a, b = tree[left][0], tree[right][0]
        sums = [a[i] + b[width - 1 - i] for i in range(width)]
        order = sorted(range(width), key=sums.__getitem__, reverse=True)
        place = [0] * width
        for rank, i in enumerate(order):
            place[i] = rank
        tree.append(([sums[i] for i in order], (left, right, place)))
        heapq.heappush(heap, (tree[-1][0][-1] - tree[-1][0][0], len(tree) - 1))
    turns: list[list[int] | None] = [None] * len(tree)
    turns[heap[0][1]] = list(range(width))
    for i in range(len(tree) - 1, -1, -1):
        if tree[i][1]:
            left, right, place = tree[i][1]
            turns[left] = [turns[i][place[k]] for k in range(width)]
            turns[right] = [turns[i][place[width - 1 - k]] for k in range(width)]
    return tree[heap[0][1]][0], turns[: len(nodes)]


def _round(nodes: DataFrame, count: int, fan_in: int) -> tuple[DataFrame, int]:
    """(nodes with the parent they went into and how, number of parents).

    The parent's own parts ride on a row of its own, with no ``turn``.
    """
    parents = max(1, -(-count // fan_in))

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "node"], ascending=[False, True])
        parts, turns = difference([list(map(int, p)) for p in group["parts"]])
        parent = int(group["parent"].iloc[0])
        own = pd.DataFrame({"node": group["node"], "parent": parent, "parts": None, "turn": turns})
        result = pd.DataFrame({"node": [parent], "parent": [-1], "parts": [parts], "turn": [None]})
        return pd.concat([own, result])

    keyed = nodes.withColumns(
        {"parent": F.pmod(F.xxhash64("node"), F.lit(parents)), "weight": F.col("parts")[0]}
    )
    return materialise(keyed.groupBy("parent").applyInPandas(combine, _NODE), "differencing"), parents


def partition(items: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN) -> DataFrame:
    """(node, shard) for stored ``items`` (node bigint, bytes bigint)."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), shards - 1)
    nodes = items.select("node", F.concat(F.array("bytes"), zeros).alias("parts"))
    count, rounds = nodes.count(), []
    while not rounds or count > 1:
        done, count = _round(nodes, count, fan_in)
        rounds.append(done.where("turn IS NOT NULL").select("node", "parent", "turn"))
        nodes = done.where("turn IS NULL").select("node", "parts")
    # From the last node down: ``way`` is the shard each part of a node ends in.
    way = nodes.select(F.col("node").alias("parent"), F.sequence(F.lit(0), F.lit(shards - 1)).alias("way"))
    for done in reversed(rounds):
        way = done.join(way, "parent").select(
            F.col("node").alias("parent"), F.transform("turn", lambda part: F.get("way", part)).alias("way")
        )
    return way.select(F.col("parent").alias("node"), F.col("way")[0].alias("shard"))


def assign(docs: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN, whole_share: float = WHOLE_SHARE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard. Stores intermediate tables, so it runs jobs."""
    rows = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("null")).alias("text_hash"),
    )
    rows = materialise(rows, "sizes")
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    # Pieces of a heavy group weigh a 16th of the limit or less on average; they are few, as
    # there are at most shards / whole_share heavy groups.
    limit = max(1, int(total / shards * whole_share))
    heavy = groups.where(F.col("bytes") > limit).select(
        "text_hash", F.least(F.col("n"), F.lit(16) * F.ceil(F.col("bytes") / limit)).alias("split")
    )
    split = {r.text_hash: r.split for r in heavy.collect()}
    pieces = F.lit(1).cast("bigint")
    for text_hash, n in split.items():
        pieces = F.when(F.col("text_hash") == text_hash, F.lit(n)).otherwise(pieces)
    rows = rows.withColumn("node", F.xxhash64("text_hash", F.pmod(F.xxhash64("doc_id"), pieces)))
    items = materialise(rows.groupBy("node").agg(F.sum("size").alias("bytes")), "items")
    placed = rows.join(partition(items, shards, fan_in), "node")
    return placed.select("doc_id", "size", "text_crc32", "shard")


def with_slots(assigned: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Adds ``slot``, gapless from 0 in every shard.

    Rows of a shard are numbered in hashed ranges of about ``slot_rows`` rows, each shifted by
    the rows of the ranges before it: no task orders a whole shard. ``assigned`` must be stored.
    """
    ranges = max(1, -(-assigned.count() // slot_rows))
    columns = list(assigned.columns)
    rows = assigned.withColumn("range", F.pmod(F.xxhash64(*columns), F.lit(ranges)).cast("int"))
    counts = rows.groupBy("shard", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    order = Window.partitionBy("shard", "range").orderBy(*columns)
    numbered = rows.withColumn("place", F.row_number().over(order))
    return numbered.join(shifts, ["shard", "range"]).select(
        *columns, (F.col("shift") + F.col("place") - 1).cast("bigint").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its shard and slot."""
    rows = with_slots(materialise(assign(docs, shards), "shards"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

