"""Alignment of the tokens of two tokenizers by lockstep merging.

Both tokenizers cut the same bytes: a byte-level BPE (A) of a space and the text, and a
SentencePiece model (B) that puts the space itself. The documents of a block are merged
side by side: one state vector holds the pointers into A's and B's token ends of every
document; a step compares the ends pointed at, emits a link and a cut where they are equal, moves the
pointers with the smaller end, and drops the documents that are through. A long
document has several places in the vector, one per stretch of bytes, as links depend on the
ends alone; so the number of steps follows the length of a stretch, not of a document.

How often a pair of ids is linked counts over the whole corpus: a block sums its own pairs
before they are shuffled, asks for each once, and its documents then add up what they hold.

Defined results: texts that are NULL, empty, or that a tokenizer does not give back byte for
byte have no tokens: zeros and empty strings; rows are aligned one by one, also repeated ones and
those without an id, and all of them count; an empty table gives no rows; other columns are not
carried, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.common import slices, whole_text
from stockweave.llm.pieces import MODEL, pieces
from stockweave.session import materialise

RANKS_A = "byte_bpe_50k.tiktoken"
STRETCH_BYTES = 2048
BLOCK_CHARS = 400_000
PAIR_SHIFT = 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "doc_id bigint, a array<int>, b array<int>, link_a array<int>, link_b array<int>"
DIGEST = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``lengths`` of them, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Tokenizers:
    """A and B with the bytes of their tokens."""

    def __init__(self, ranks: str, model: str):
        with open(ranks, "rb") as lines:
            entries = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # The same vocabulary and splits as the tokenizer in JSON form (the tests compare them), but faster.
        # There are no special tokens, so their strings are plain text.
        self.a = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=entries, special_tokens={}
        )
        self.b = pieces(model)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for token, rank in entries.items():
            self.bytes_a[rank] = token
        self.bytes_b = self.b.bytes
        self.lengths_a = np.array([len(t) for t in self.bytes_a])
        self.lengths_b = np.array([len(t) for t in self.bytes_b])
        # What may follow an id in the text of the groups: another token of its side, or the end of that side.
        self.told_a = [f"{i}{after}" for after in ",|" for i in range(len(self.bytes_a))]
        self.told_b = [f"{i}{after}" for after in ",;" for i in range(len(self.bytes_b))]
        self.told = self.told_a + self.told_b

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both, empty where they do not give back the text's bytes."""
        first, second = [], []
        for text, b in zip(texts, self.b.encode(texts), strict=True):
            a = self.a.encode_ordinary(f" {text}") if text else []
            told = f" {text}".encode() if text else b""
            same = b"".join(map(self.bytes_a.__getitem__, a)) == told
            if not same or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != told:
                a, b = [], b[:0]
            first.append(np.array(a, np.int64))
            second.append(b.astype(np.int64))
        return first, second


@lru_cache(1)
def tokenizers(ranks: str, model: str) -> Tokenizers:
    """One per Python worker."""
    return Tokenizers(ranks, model)


def merge(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stretch: int = STRETCH_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens that end together, in order.

    ``ends_a`` and ``ends_b`` are ends in bytes over all documents, increasing throughout; the
    documents' tokens begin at ``first_a`` and ``first_b``, which also hold the total numbers at
    their ends. A document's tokens cover the same bytes on both sides.
    """
    # Places in the vector: stretches of bytes, each within one document.
    begins = np.concatenate([[0], ends_a])[first_a[:-1]] if len(ends_a) else np.zeros(len(first_a) - 1, np.int64)
    stops = np.concatenate([[0], ends_a])[first_a[1:]] if len(ends_a) else begins
    counts = -(-(stops - begins) // stretch)
    owner = np.repeat(np.arange(len(counts)), counts)
    low = begins[owner] + stretch * spread(np.zeros(len(counts), np.int64), counts)
    high = np.minimum(low + stretch, stops[owner])
    at_a, to_a = (np.searchsorted(ends_a, x, "right") for x in (low, high))
    at_b, to_b = (np.searchsorted(ends_b, x, "right") for x in (low, high))
    found = []
    while True:
        alive = (at_a < to_a) & (at_b < to_b)
        if not alive.all():
            at_a, to_a, at_b, to_b = (x[alive] for x in (at_a, to_a, at_b, to_b))
        if not len(at_a):
            break
        a, b = ends_a[at_a], ends_b[at_b]
        equal = a == b
        if equal.any():
            found.append((at_a[equal], at_b[equal]))
        # Moved together, the vectors are new ones, so what was emitted stays as it is.
        at_a, at_b = at_a + (a <= b), at_b + (b <= a)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


@dataclass
class Block:
    """Tokens and links of some documents, one after another; ``first_*`` hold where each begins."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    first_link: np.ndarray

    @classmethod
    def of(cls, own: Tokenizers, texts: list[str], stretch: int = STRETCH_BYTES) -> Block:
        found = own.encode(texts)
        firsts = [np.concatenate([[0], np.cumsum([len(ids) for ids in side])]).astype(np.int64) for side in found]
        a, b = (np.concatenate([*side, np.empty(0, np.int64)]) for side in found)
        link_a, link_b = merge(np.cumsum(own.lengths_a[a]), np.cumsum(own.lengths_b[b]), *firsts, stretch)
        return cls(a, b, *firsts, link_a, link_b, np.searchsorted(link_a, firsts[0]))

    def told(self, own: Tokenizers) -> list[str]:
        """Per document the ids of its groups, ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.link_a], last_b[self.link_b] = 1, 1
        # Cuts before a token give its group. A token is written after the tokens before it of its own side,
        # and the other side's tokens of earlier groups (for B: of its own group too).
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends_a, ends_b = (np.concatenate([[0], link + 1]) for link in (self.link_a, self.link_b))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + ends_b[group_a]] = self.a + last_a * len(own.bytes_a)
        codes[np.arange(len(self.b)) + ends_a[group_b + 1]] = (
            len(own.told_a) + self.b + last_b * len(own.bytes_b)
        )
        firsts = self.first_a + self.first_b
        told = own.told
        return [
            "".join([told[code] for code in codes[i:j].tolist()])[:-1]
            for i, j in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)
        ]


def _paths(ranks: str | None, model: str | None) -> tuple[str, str]:
    return ranks or public_tokenizers.path(RANKS_A), model or public_tokenizers.path(MODEL)


def _blocks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[str]]]:
    """Documents and texts of about ``most`` characters; a longer text is a block of its own."""
    ids, texts, size = [], [], 0
    for part in slices(batches):
        for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
            if size and size + len(text) > most or len(texts) == 4 * most // 1000 + 1:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def _lists(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(values, pa.int32()))


def align(docs: DataFrame, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """Per document its tokens and links: ``a[link_a[i]]`` and ``b[link_b[i]]`` end together, which is also a cut."""
    paths = _paths(ranks, model)

    def run(batches):
        own = tokenizers(*paths)
        for ids, texts in _blocks(batches, BLOCK_CHARS):
            block = Block.of(own, texts)
            counts = np.diff(block.first_link)
            columns = [
                pa.array(ids, pa.int64()),
                _lists(block.a, block.first_a),
                _lists(block.b, block.first_b),
                _lists(block.link_a - np.repeat(block.first_a[:-1], counts), block.first_link),
                _lists(block.link_b - np.repeat(block.first_b[:-1], counts), block.first_link),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b", "link_a", "link_b"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, ALIGNED)


# A block's documents in arrays, its links as places in its list of pairs, and that list.
_BLOCK = "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_links array<bigint>, groups_sha256 array<string>, links binary, pairs array<bigint>, times array<bigint>"


def _align_blocks(paths: tuple[str, str], block_chars: int):
    def run(batches):
        own = tokenizers(*paths)
        task = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_blocks(batches, block_chars)):
            block = Block.of(own, texts)
            linked = (block.a[block.link_a] << PAIR_SHIFT) | block.b[block.link_b]
            pairs, links, times = np.unique(linked, return_inverse=True, return_counts=True)
            # Frequent pairs get small numbers, which compress.
            order = np.argsort(-times, kind="stable")
            width = "<u2" if len(order) <= 1 << 16 else "<u4"
            place = np.empty(len(order), width)
            place[order] = np.arange(len(order))
            sums = [hashlib.sha256(told.encode()).hexdigest() if told else "" for told in block.told(own)]
            row = {
                "block": (task << 32) + number, "doc_id": ids,
                "n_a": np.diff(block.first_a), "n_b": np.diff(block.first_b), "n_links": np.diff(block.first_link),
                "groups_sha256": sums, "links": place[links].tobytes(),
                "pairs": pairs[order], "times": times[order],
            }
            kinds = {"block": pa.int64(), "links": pa.binary(), "groups_sha256": pa.list_(pa.string())}
            columns = [pa.array([value], kinds.get(name, pa.list_(pa.int64()))) for name, value in row.items()]
            yield pa.RecordBatch.from_arrays(columns, list(row))
        pa.default_memory_pool().release_unused()

    return run


def _added_up(batches):
    """Documents with the counts of their links."""
    names = [part.split(" ")[0] for part in DIGEST.split(", ")]
    for part in slices(batches, 1):
        row = part.to_pydict()
        lengths = np.array(row["n_links"][0], np.int64)
        links = np.frombuffer(row["links"][0], "<u2" if len(row["links"][0]) == 2 * lengths.sum() else "<u4")
        # Pairs come in no order; each has its place.
        places = np.array(row["places"][0] or [], np.int64)
        counts, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        counts[places], best[places] = row["counts"][0] or [], row["best"][0] or []
        ends = np.concatenate([[0], np.cumsum(lengths)])
        sums = []
        for values in (best, counts):
            total = np.concatenate([[0], np.cumsum(values[links])])
            sums.append(total[ends[1:]] - total[ends[:-1]])
        columns = [
            row["doc_id"][0], row["n_a"][0], row["n_b"][0], lengths, lengths, *sums, row["groups_sha256"][0],
        ]
        kinds = [pa.string() if name == "groups_sha256" else pa.int64() for name in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, count, best`` of rows ``pair, times``: how often a pair is linked, and whether its B id has no higher."""
    counts = pairs.groupBy("pair").agg(F.sum("times").alias("count"))
    # A B id has at most as many pairs as A has ids.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << PAIR_SHIFT) - 1)))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def digest(
    docs: DataFrame, ranks: str | None = None, model: str | None = None, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Measures, counts and checksum of the groups of every document. Stores the blocks, so it runs jobs at once."""
    paths = _paths(ranks, model)
    texts = docs.select("doc_id", whole_text().alias("text"))
    blocks = materialise(texts.mapInArrow(_align_blocks(paths, block_chars), _BLOCK), "aligned")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "_")).select(
        "block", "place", F.col("_.pairs").alias("pair"), F.col("_.times").alias("times")
    )
    known = pairs.join(pair_counts(pairs), "pair").groupBy("block")
    known = known.agg(*[F.collect_list(c).alias(a) for c, a in (("place", "places"), ("count", "counts"))],
                      F.collect_list(F.col("best").cast("int")).alias("best"))
    return blocks.drop("pairs", "times").join(known, "block", "left").mapInArrow(_added_up, DIGEST)
