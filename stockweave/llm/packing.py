"""Packing of token sequences: bounded-space online best fit.

Documents become token ids; ids beyond the capacity start further pieces. Pieces arrive in
hashed order, in groups of bounded size that are packed side by side. A group keeps at most
``open_bins`` sequences open. A bitset with one bit per free space finds the tightest open
sequence that still holds a piece; when none does and no more may be open, the fullest closes.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed one by
one; rows without a document id are packed like others; other columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from stockweave.llm.common import arrow_type, mix, slices, whole_text
from stockweave.session import materialise

CAPACITY = 4096
OPEN_BINS = 512
GROUP_PIECES = 16_384
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, arrival bigint"

_WHITE_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
# Characters whose split into tokens does not depend on their neighbours: ASCII without the
# apostrophe, and composed Latin letters. Any run below is a token of its own before merging.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r"!-&(-/:-@\[-`{-~"
_OTHER = re.compile(rf"[^ \t\n\r\x0b\x0c0-9{_LETTERS}{_MARKS}]")
_RUN = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit numbers, with a bounded memory of runs.

    Equal to encoding the whole text: white space always separates tokens, and so do the
    borders of a run. New runs are encoded together and told apart by their word ends. The tokenizer
    lower-cases, so runs are kept in lower case. Two generations of ``most`` runs are kept, and runs of
    the older one that occur again move to the younger, so that frequent ones stay and rare ones go.
    """

    def __init__(self, path: str, most: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        # In a text these are one id each, whatever is around them; such texts are encoded whole.
        self.literals = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.most = most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")

    def _ids(self, text: str) -> np.ndarray:
        # The fast form leaves out the places of tokens in the text, which nothing needs here.
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def _learn(self, runs: set[str]) -> dict[str, bytes]:
        """Ids of runs that are one token each before merging, from one call."""
        new = sorted(runs)
        ids = self._ids(" ".join(new))
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) != len(new):
            return {run: self._ids(run).tobytes() for run in new}
        raw = ids.tobytes()
        return {run: raw[i:j] for run, i, j in zip(new, [0, *ends], ends, strict=False)}

    def encode(self, texts: list[str]) -> list[bytes]:
        words: set[str] = set()
        found = [None if any(x in text for x in self.literals) else self._runs(text, words) for text in texts]
        missing = set().union(*(runs for runs in found if runs)).difference(self.known)
        again = missing.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        missing -= again
        self.known |= self._learn(missing - words) | {w: self._ids(w).tobytes() for w in missing & words}
        encoded = [
            self._ids(text).tobytes() if runs is None else b"".join(map(self.known.__getitem__, runs))
            for text, runs in zip(texts, found, strict=True)
        ]
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        return encoded

    @staticmethod
    def _runs(text: str, words: set[str]) -> list[str]:
        """Runs; whole words, also added to ``words``, where a word holds other characters.

        In lower case, unless that brings in other characters (as that of İ is two).
        """
        lower = text.lower()
        if not _OTHER.search(lower):
            return _RUN.findall(lower)
        runs = []
        for word in _WHITE_SPACE.split(text):
            if _OTHER.search(word):
                words.add(word)
                runs.append(word)
            else:
                runs.extend(_RUN.findall(word))
        return runs


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per Python worker, so that tasks share what it has learnt."""
    return Encoder(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece, with a hashed order of arrival that also separates repeated rows."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], "<u4").tobytes()

    fields = T.StructType.fromDDL(PIECES).fields

    def cut(batches):
        number = 0
        task = TaskContext.get().partitionId()
        for part in slices(batches, 512):
            rows = []
            texts = [t or "" for t in part.column("text").to_pylist()]
            for doc, ids in zip(part.column("doc_id").to_pylist(), encoder(path).encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    own = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc, piece, start, len(own) // 4, zlib.crc32(own)))
            order = mix(np.arange(number, number + len(rows), dtype=np.uint64) + np.uint64(task << 40))
            number += len(rows)
            columns = [*zip(*rows, strict=True), order.view(np.int64)]
            arrays = [pa.array(c, arrow_type(f.dataType)) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, PIECES)


def best_fit(lengths: Iterable[int], capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> list[tuple[int, int]]:
    """(bin, offset) for every length, in the order given."""
    free_bits, count, opened = 0, 0, 0
    at_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed = []

    def take(free: int) -> int:
        nonlocal free_bits
        found = at_free[free].pop()
        if not at_free[free]:
            free_bits ^= 1 << free
        return found

    for length in lengths:
        fitting = free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = take(free)
        else:
            if opened == open_bins:
                take((free_bits & -free_bits).bit_length() - 1)
                opened -= 1
            own, free = count, capacity
            count += 1
            opened += 1
        placed.append((own, capacity - free))
        left = free - length
        if left:
            at_free[left].append(own)
            free_bits |= 1 << left
        else:
            opened -= 1
    return placed


def pack(
    rows: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """``rows`` of :func:`pieces` with ``sequence_id`` and ``offset``.

    ``rows`` must be stored, as their order of arrival and number are read apart. The number of
    groups follows the number of rows, so a group's size does not grow with the data.
    """
    groups = max(1, -(-rows.count() // group_pieces))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("arrival")
        placed = best_fit(group["length"].tolist(), capacity, open_bins)
        first = group["_group"].iloc[0] << 32
        return group.drop(columns=["_group", "arrival"]).assign(
            sequence_id=[first + own for own, _ in placed], offset=[offset for _, offset in placed]
        )

    grouped = rows.withColumn("_group", F.pmod("arrival", F.lit(groups)).cast("bigint")).groupBy("_group")
    schema = PIECES.replace("arrival bigint", "sequence_id bigint, offset bigint")
    return grouped.applyInPandas(fill, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Tokenise, cut and pack: one row per piece. Stores the pieces, so it runs jobs at once."""
    return pack(materialise(pieces(docs, capacity, tokenizer), "pieces"), capacity)
