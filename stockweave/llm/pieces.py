"""SentencePiece encoding through a table of distinct chunks, and decoding.

The model's pieces hold a marker (U+2581, a space in the text) only at their start, so none
crosses from one marked word into the next: a text's ids are those of its chunks, a run of
markers and the word after it, one after another. A worker keeps a table of the distinct chunks
it has met; new ones are segmented once, together, by the library's rules, and a text's ids are joined
from the table by position. The table is bounded: chunks beyond it are segmented once per
slice of texts. A model whose pieces cross markers has one chunk per text.

Defined results: a NULL or empty text has no ids and decodes to an empty text; U+2581 in a text
reads as a space, as in the library; repeated rows are encoded one by one; an empty table gives
no rows; :func:`encode` and :func:`decode` replace a column of the name they add and keep the others.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from stockweave.llm.common import with_computed

MODEL = "piece_bpe_32k.model"
MARK = "▁"
MOST_CHUNKS = 200_000
LONGEST_KEPT = 64
DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# A run of markers and the word after it. Texts are given one marker first, so nothing is left over.
_CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")


class Pieces:
    """A model with its table of chunks."""

    def __init__(self, path: str, most: int = MOST_CHUNKS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [self._bytes_of(i, name) for i, name in enumerate(names)]
        self.decimal = [str(i) for i in range(len(names))]
        probe = f"  a  {names[-1]}b "
        self.by_chunk = not any(MARK in name.lstrip(MARK) for name in names) and (
            self.model.decode(self.model.encode(probe)) == probe.replace(MARK, " ") and MARK in names
        )
        self.most = most
        self.known: dict[str, bytes] = {}
        if self.by_chunk:
            # The library adds a marker of its own, but none to an empty text.
            self.known[" "] = self.known[MARK] = np.array([names.index(MARK)], "<i4").tobytes()

    def _bytes_of(self, i: int, name: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(name[3:-1], 16)])
        return b"" if self.model.is_control(i) else name.replace(MARK, " ").encode()

    def _segment(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks, of which the library puts the first marker back."""
        new = sorted(chunks)
        found = self.model.encode([chunk[1:] for chunk in new], num_threads=1)
        return {chunk: np.array(ids, "<i4").tobytes() for chunk, ids in zip(new, found, strict=True)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.array(ids, "<i4") for ids in self.model.encode(texts, num_threads=1)]
        chunks = [_CHUNK.findall(f" {text}") if text else [] for text in texts]
        new = self._segment(set().union(*chunks) - self.known.keys())
        self.known |= new
        encoded = [np.frombuffer(b"".join(map(self.known.__getitem__, own)), "<i4") for own in chunks]
        full = len(self.known) > self.most
        for chunk in new:
            if full or len(chunk) > LONGEST_KEPT:
                del self.known[chunk]
        return encoded

    def decode(self, ids: list[int]) -> str:
        """As the library: the first marker is dropped; what is not UTF-8 is left to the library."""
        told = b"".join(map(self.bytes.__getitem__, ids))
        try:
            text = told.decode()
        except UnicodeDecodeError:
            return self.model.decode(ids)
        if not self.by_chunk or self.model.unk_id() in ids:
            return self.model.decode(ids)
        return text[1:] if text[:1] == " " and not self._from_byte(ids) else text

    def _from_byte(self, ids: list[int]) -> bool:
        """Whether the first piece that is no control piece is a byte."""
        return next((self.model.is_byte(i) for i in ids if not self.model.is_control(i)), False)


@lru_cache(1)
def pieces(path: str) -> Pieces:
    """One per Python worker, so that tasks share its table."""
    return Pieces(path)


def model_path(model: str | None) -> str:
    return model or public_tokenizers.path(MODEL)


def encode(docs: DataFrame, model: str | None = None, into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text``, without begin or end ids."""
    path = model_path(model)

    def prepare():
        def of(part: pa.RecordBatch) -> list:
            found = pieces(path).encode([t or "" for t in part.column("text").to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in found])])
            values = np.concatenate([*found, np.empty(0, "<i4")])
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))]

        return of

    return with_computed(docs, f"{into} array<int>", prepare)


def decode(rows: DataFrame, model: str | None = None, into: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids``."""
    path = model_path(model)

    def prepare():
        own = pieces(path)
        return lambda part: [[own.decode(ids or []) for ids in part.column("ids").to_pylist()]]

    return with_computed(rows, f"{into} string", prepare)


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Number and checksum of the ids of every text, and the checksum of what they decode to."""
    path = model_path(model)

    def prepare():
        own = pieces(path)

        def of(part: pa.RecordBatch) -> list:
            counts, sums, decoded = [], [], []
            for found in own.encode([t or "" for t in part.column("text").to_pylist()]):
                ids = found.tolist()
                counts.append(len(ids))
                sums.append(hashlib.sha256(",".join(map(own.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            return [counts, sums, decoded]

        return of

    return with_computed(docs.select("doc_id", "text"), DIGEST, prepare, drop=["text"])
