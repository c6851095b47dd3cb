"""Repair of the structure of conversations by generalised LR parsing with priced edits.

Turns are dealt out by ranges of (conversation, turn), so that a conversation of any length lies
in as many tasks as it needs. A task parses each conversation that lies within it in one pass. A
conversation that reaches the border of a task, or has more than ``chunk_turns`` turns, becomes chunks:
a chunk is parsed from every stack that can stand before it, which gives a small table of costs
and ranks of edits; the tables of a conversation are joined in order; and the chunks then write
the edits on the cheapest way. Both give the same result. Copies within a conversation in chunks
are found by counting over the whole table, not in one task.

Defined results: a NULL in role or text is one space; a turn number of NULL comes first; NULL
``conv_id`` is one conversation; turns with equal number are taken in order of a hash of role and
text, so the order of the rows does not matter; repeated rows are copies like any others; a
conversation without turns gives zeros, no edits and no turns; an empty table gives no rows;
other columns are not carried, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import slices
from stockweave.llm.role_grammar import Turn, repairs
from stockweave.session import materialise

CHUNK_TURNS = 4096
CHUNK_CHARS = 4_000_000
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# Turns as the tasks read them. ``there`` is false for a row that only names its conversation.
_TURNS = "conv_id bigint, turn bigint, role string, text string, there boolean, blank boolean, cut boolean, key binary"
_MEASURES = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_PLACE = "conv_id bigint, task int, chunk int"
REPAIRED = f"{_PLACE}, whole boolean, {_MEASURES}, audit string, roles array<string>, texts array<string>"
_CHUNKS = "turns array<bigint>, own_roles array<string>, own_texts array<string>, blanks array<boolean>, cuts array<boolean>, keys array<binary>"


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by a checksum of conversation and turn; ``there`` is false for those dropped."""
    text = F.coalesce("text", F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name) % 20
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        (kind != 0).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _described(rows: DataFrame) -> DataFrame:
    """Rows with what can be said of a turn by itself."""
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    turns = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        there.alias("there"),
    )
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return turns.select(
        "*",
        (end == "").alias("blank"),
        (~end.isin(*STOPS)).alias("cut"),
        F.when(end != "", F.unhex(F.md5(told.cast("binary")))).alias("key"),
    )


def _in_order(turns: DataFrame) -> DataFrame:
    """Ranges of conversations and turns. The number of the row parts even rows equal in everything."""
    keys = ["conv_id", "turn", "_hash", "_row"]
    marked = turns.select("*", F.xxhash64("role", "text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    return marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_hash", "_row")


def _names(ddl: str) -> list[str]:
    return [part.split(" ")[0] for part in ddl.split(", ")]


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL text, also where there is no session."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {"binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


class _Chunk:
    """Turns of one conversation, as they follow each other."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.turns, self.roles, self.texts, self.blanks, self.cuts, self.keys = [], [], [], [], [], []
        self.chars = 0

    def add(self, turn, role, text, blank, cut, key) -> None:
        for values, value in zip(self.columns(), (turn, role, text, blank, cut, key), strict=True):
            values.append(value)
        self.chars += len(text)

    def columns(self) -> tuple[list, ...]:
        return self.turns, self.roles, self.texts, self.blanks, self.cuts, self.keys

    def first_seen(self) -> list[int]:
        """Places whose role and text did not come earlier in this chunk."""
        seen: set[bytes] = set()
        return [n for n, key in enumerate(self.keys) if key is not None and not (key in seen or seen.add(key))]

    def judged(self, new: Iterable[int]) -> tuple[list[Turn], list[int]]:
        """The turns for the parser, given the places of those that are no copies; fault counts."""
        fresh, turns, counts = set(new), [], [0, 0, 0]
        for n, (role, blank, cut) in enumerate(zip(self.roles, self.blanks, self.cuts, strict=True)):
            copy = not blank and n not in fresh
            cut = cut and not blank and not copy
            for fault, found in enumerate((blank, copy, cut)):
                counts[fault] += found
            turns.append((role[:1], blank or copy, cut))
        return turns, counts

    def gaps(self, before: int | None) -> int:
        """Turn numbers left out, ``before`` being the last one of the chunk before."""
        numbers = [n for n in (before, *self.turns) if n is not None]
        return numbers[-1] - numbers[0] + 1 - len(set(numbers)) if numbers else 0

    def illegal(self, before: str | None) -> int:
        initials = [*([] if before is None else [before]), *(role[:1] for role in self.roles)]
        return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    def spoken(self, entry: int, edits: str, turns: list[Turn]) -> tuple[list[str], list[str]]:
        told = repairs().spoken(entry, edits, turns)[0]
        return [new or self.roles[n] for new, n in told], [self.texts[n] if n >= 0 else "" for _, n in told]


def _records(rows: Iterable[dict], ddl: str) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded amount of text."""
    schema = _arrow(ddl)
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(v) if isinstance(v, str) else 0 for v in row.values())
        size += sum(map(len, row.get("texts") or ())) + sum(map(len, row.get("own_texts") or ()))
        if size > CHUNK_CHARS or len(held) == 2000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterable[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    for part in slices(batches, size):
        yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


def _parse(chunk_turns: int, chunk_chars: int):
    """One pass over sorted turns: finished conversations, and chunks of the others."""

    def chunks(rows: Iterable[tuple]) -> Iterator[tuple[_Chunk, bool]]:
        """Chunks, with whether the conversation lies within the task and in one chunk."""
        first = True
        held: tuple[_Chunk, bool] | None = None
        for conv, own in groupby(rows, key=lambda row: row[0]):
            if held:
                yield held
            chunk, single = _Chunk(conv), True
            for _, turn, role, text, there, *flags in own:
                if len(chunk.turns) == chunk_turns or chunk.chars > chunk_chars:
                    yield chunk, False
                    chunk, single = _Chunk(conv), False
                if there:
                    chunk.add(turn, role, text, *flags)
            held = chunk, single and not first
            first = False
        if held:
            yield held[0], False

    def finished(chunk: _Chunk) -> dict:
        repair = repairs()
        turns, (blank, duplicate, truncated) = chunk.judged(chunk.first_seen())
        form, cost, ways = repair.run(0, turns)
        more, _, node, tail = repair.ends(form)
        audit = repair.edits(ways, node) + tail
        roles, texts = chunk.spoken(0, audit, turns)
        return {
            "whole": True, "gaps": chunk.gaps(None), "blank": blank, "duplicate": duplicate, "truncated": truncated,
            "illegal": chunk.illegal(None), "cost": cost + more, "audit": audit, "roles": roles, "texts": texts,
        }

    def run(batches):
        names = _names(_CHUNKS)
        task = TaskContext.get().partitionId()

        def out():
            for number, (chunk, closed) in enumerate(chunks(_rows(batches))):
                what = finished(chunk) if closed else dict(zip(names, chunk.columns(), strict=True)) | {"whole": False}
                yield {"conv_id": chunk.conv, "task": task, "chunk": number} | what

        yield from _records(out(), f"{REPAIRED}, {_CHUNKS}")

    return run


def _chunk_of(row: dict) -> _Chunk:
    chunk = _Chunk(row["conv_id"])
    chunk.turns, chunk.roles, chunk.texts, chunk.blanks, chunk.cuts, chunk.keys = (row[n] for n in _names(_CHUNKS))
    return chunk


def _dicts(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for part in slices(batches, 1):
        yield from part.to_pylist()


_TABLE = f"{_PLACE}, last_role string, last_turn string, entries array<int>, exits array<int>, costs array<bigint>, ranks array<int>"


def _tables(batches):
    """For every chunk the costs and ranked edits from each stack before it to each one after it."""

    def out():
        repair = repairs()
        for row in _dicts(batches):
            chunk = _chunk_of(row)
            turns, _ = chunk.judged(row["new"] or ())
            ways = []
            for entry in repair.stacks.nodes:
                form, cost, taken = repair.run(entry, turns)
                ways += [(entry, node, cost + more, repair.edits(taken, node)) for node, more, _ in form]
            order = {edits: n for n, edits in enumerate(sorted({w[3] for w in ways}))}
            known = [n for n in chunk.turns if n is not None]
            yield {
                "conv_id": chunk.conv, "task": row["task"], "chunk": row["chunk"],
                "last_role": turns[-1][0] if turns else None, "last_turn": str(known[-1]) if known else None,
                "entries": [w[0] for w in ways], "exits": [w[1] for w in ways],
                "costs": [w[2] for w in ways], "ranks": [order[w[3]] for w in ways],
            }

    yield from _records(out(), _TABLE)


_CHOICE = "task int, chunk int, entry int, exit int, tail string, cost bigint, before_role string, before_turn string"


def _choose(tables: pd.DataFrame) -> pd.DataFrame:
    """The cheapest way through the chunks of one conversation: narrow rows, one per chunk."""
    repair = repairs()
    tables = tables.sort_values(["task", "chunk"])
    best = {0: (0, 0)}
    steps = []
    for entries, exits, costs, ranks in zip(*[tables[c] for c in ("entries", "exits", "costs", "ranks")], strict=True):
        new: dict[int, tuple[int, tuple[int, int], int, int]] = {}
        for entry, node, cost, rank in zip(*[x.tolist() for x in (entries, exits, costs, ranks)], strict=True):
            if entry in best:
                way = (best[entry][0] + cost, (best[entry][1], rank), entry, cost)
                if node not in new or way[:2] < new[node][:2]:
                    new[node] = way
        order = {edits: n for n, edits in enumerate(sorted({way[1] for way in new.values()}))}
        best = {node: (way[0], order[way[1]]) for node, way in new.items()}
        steps.append(new)
    least = min(cost for cost, _ in best.values())
    more, _, node, tail = repair.ends(tuple(sorted((n, cost - least, rank) for n, (cost, rank) in best.items())))
    # ``more`` counts from the cheapest stack; only what the turns inserted at the end cost is still to be added.
    tails, extra = tail, more + least - best[node][0]
    rows = []
    for task, chunk, step in zip(tables["task"][::-1], tables["chunk"][::-1], reversed(steps), strict=True):
        _, _, entry, cost = step[node]
        rows.append((task, chunk, entry, node, tails, cost + extra))
        node, tails, extra = entry, "", 0
    chosen = pd.DataFrame(rows[::-1], columns=["task", "chunk", "entry", "exit", "tail", "cost"])
    for name in ("role", "turn"):
        before = tables[f"last_{name}"].ffill().shift()
        chosen[f"before_{name}"] = before.where(before.notna(), None).to_numpy(object)
    return chosen


def _write(batches):
    """The chunks with the edits chosen for them and what these leave."""

    def out():
        repair = repairs()
        for row in _dicts(batches):
            chunk = _chunk_of(row)
            turns, (blank, duplicate, truncated) = chunk.judged(row["new"] or ())
            audit = repair.edits(repair.run(row["entry"], turns)[2], row["exit"]) + row["tail"]
            roles, texts = chunk.spoken(row["entry"], audit, turns)
            before = row["before_turn"]
            yield {
                "conv_id": chunk.conv, "task": row["task"], "chunk": row["chunk"], "whole": False,
                "gaps": chunk.gaps(None if before is None else int(before)), "blank": blank, "duplicate": duplicate, "truncated": truncated,
                "illegal": chunk.illegal(row["before_role"]), "cost": row["chosen_cost"],
                "audit": audit, "roles": roles, "texts": texts,
            }

    yield from _records(out(), REPAIRED)


def repair(rows: DataFrame, chunk_turns: int = CHUNK_TURNS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Repaired conversations: one row each, or one row per chunk where ``whole`` is false.

    Chunks of a conversation follow each other by (task, chunk); measures add up over them, and
    ``audit``, ``roles`` and ``texts`` are joined in that order. Rows whose ``there`` is false (if
    there is such a column) only name their conversation. Stores one table, so it runs jobs at once.
    """
    parsed = _in_order(_described(rows)).mapInArrow(_parse(chunk_turns, chunk_chars), f"{REPAIRED}, {_CHUNKS}")
    parsed = materialise(parsed, "conversations")
    names = _names(REPAIRED)
    open_chunks = parsed.where(~F.col("whole")).drop(*names[3:])
    place = ["task", "chunk"]

    found = open_chunks.select("conv_id", *place, F.posexplode("keys").alias("at", "key")).where("key IS NOT NULL")
    firsts = found.groupBy("conv_id", "key").agg(F.min(F.struct(*place, "at")).alias("first")).select("first.*")
    new = firsts.groupBy(*place).agg(F.collect_list("at").alias("new"))
    judged = open_chunks.join(new, place, "left")

    tables = judged.mapInArrow(_tables, _TABLE)
    chosen = tables.groupBy("conv_id").applyInPandas(_choose, _CHOICE).withColumnRenamed("cost", "chosen_cost")
    written = judged.join(chosen, place).mapInArrow(_write, REPAIRED)
    return parsed.where("whole").select(*names).unionByName(written)


_DIGEST = f"conv_id bigint, {_MEASURES}, audit string, repaired_sha256 string"


def _told(batches):
    """Measures, edits and checksum of conversations whose chunks follow each other in order."""

    def out():
        names = _names(_MEASURES)
        for conv, chunks in groupby(_dicts(batches), key=lambda row: row["conv_id"]):
            sums, audit, told, begun = dict.fromkeys(names, 0), [], hashlib.sha256(), False
            for chunk in chunks:
                sums = {name: value + chunk[name] for name, value in sums.items()}
                audit.append(chunk["audit"])
                for role, text in zip(chunk["roles"], chunk["texts"], strict=True):
                    told.update(f"{'\n' if begun else ''}{role}:{text}".encode())
                    begun = True
            yield {"conv_id": conv, **sums, "audit": "".join(audit), "repaired_sha256": told.hexdigest()}

    yield from _records(out(), _DIGEST)


def digest(rows: DataFrame, chunk_turns: int = CHUNK_TURNS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per conversation of the damaged ``rows``: measures, cost, edits, checksum of the repaired turns."""
    repaired = repair(damage(rows), chunk_turns, chunk_chars)
    columns = _names(_DIGEST)
    lines = F.array_join(F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n")
    whole = repaired.where("whole").withColumn("repaired_sha256", F.sha2(lines.cast("binary"), 256)).select(*columns)
    parts = repaired.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "task", "chunk")
    return whole.unionByName(parts.mapInArrow(_told, _DIGEST))
