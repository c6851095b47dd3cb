"""Benchmark decontamination: n-gram windows of test items, looked up in every document.

The windows of the items travel to the tasks as a sorted array of hashes. Its size is checked:
items are taken in blocks of bounded text, and every block is held against all documents in a
pass of its own, so a large benchmark costs passes, not memory. Hits are compared byte by byte.

Defined results: a NULL or empty text has no words and no hits; an item without an id or
without words is no item; repeated item ids count once; repeated documents are judged one by
one; a column of the documents with the name of an added one gives way.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import partial, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import WordIds, as_bytes, restored, set_aside, whole_text, window_hashes, with_computed
from stockweave.session import materialise

WINDOW = 13
BLOCK_CHARS = 32_000_000
SHARE = 20  # contaminated from one word in 20

# Lower-cases A-Z and blanks every ASCII byte that is neither a letter nor a digit.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


class Windows:
    """Windows of one block of items, in arrays: about 45 bytes a word of the items.

    The words of the items, joined by single spaces, with their places; and for every length of
    windows their hashes in order with the words they begin at, and a bitmap of the hashes that
    tells most others apart at one look.
    """

    def __init__(self, items: Iterable[tuple[str, bytes]], size: int = WINDOW):
        ids, texts, counts, hashes = WordIds(), [], [], []
        self.items: list[str] = []
        by_length: dict[int, list[np.ndarray]] = defaultdict(list)
        at = 0
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            own = ids.of(words)
            length = min(size, len(own))
            found = window_hashes(own, length)
            by_length[length].append(np.stack([found, np.arange(at, at + len(found), dtype=np.uint64)]))
            self.items.append(item)
            texts.append(b" ".join(words))
            hashes.append(np.array([len(w) for w in words], np.int64))
            counts.append(len(words))
            at += len(words)
        self.text = b" ".join(texts)
        lengths = np.concatenate([*hashes, np.empty(0, np.int64)])
        self.ends = np.cumsum(lengths + 1) - 1  # places in the text where words end
        self.starts = self.ends - lengths
        self.item_ends = np.cumsum(np.array(counts, np.int64))
        self.by_length = {}
        for n, parts in by_length.items():
            table = np.concatenate(parts, axis=1)
            order = np.argsort(table[0], kind="stable")
            bits = np.zeros(1 << max(3, int(16 * table.shape[1] - 1).bit_length() - 3), np.uint8)
            place = table[0] & np.uint64(8 * len(bits) - 1)
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), self._bit(place))
            self.by_length[n] = (table[0][order], table[1][order].astype(np.int64), bits)

    @staticmethod
    def _bit(place: np.ndarray) -> np.ndarray:
        return np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8))

    def nbytes(self) -> int:
        arrays = [self.ends, self.starts, self.item_ends, *(x for found in self.by_length.values() for x in found)]
        return len(self.text) + sum(x.nbytes for x in arrays) + sum(map(len, self.items))

    def _items_of(self, n: int, number: int, told: bytes) -> set[str]:
        """Items that have the window ``told`` among those with the hash at ``number``; compared byte by byte."""
        hashes, begins, _ = self.by_length[n]
        found = set()
        for begin in begins[number : np.searchsorted(hashes, hashes[number], "right")].tolist():
            if self.text[self.starts[begin] : self.ends[begin + n - 1]] == told:
                found.add(self.items[int(np.searchsorted(self.item_ends, begin, "right"))])
        return found

    def find(self, text: bytes, ids: WordIds) -> tuple[int, list[int], set]:
        """Words of the text, [start, end) of merged hits in words, items found."""
        words = words_of(text)
        own = ids.of(words)
        items: set = set()
        spans = []
        known: dict[bytes, set[str]] = {}
        for n, (hashes, _, bits) in self.by_length.items():
            wanted = window_hashes(own, n)
            place = wanted & np.uint64(8 * len(bits) - 1)
            maybe = np.flatnonzero(bits[(place >> np.uint64(3)).astype(np.int64)] & self._bit(place))
            numbers = np.searchsorted(hashes, wanted[maybe])
            there = numbers < len(hashes)
            there[there] = hashes[numbers[there]] == wanted[maybe][there]
            for start, number in zip(maybe[there].tolist(), numbers[there].tolist(), strict=True):
                told = b" ".join(words[start : start + n])
                if told not in known:
                    known[told] = self._items_of(n, number, told)
                if hit := known[told]:
                    items |= hit
                    spans.append((start, start + n))
        return len(words), _merged(spans), items


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    """Flat [start, end, start, end ...] of the union of spans."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _blocks(benchmark: DataFrame, block_chars: int) -> list[Callable[[], list[tuple[str, bytes]]]]:
    """What fetches the items of each block."""
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), F.col("text").alias("words")
    )
    chars = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))

    def fetched(block: int) -> list[tuple[str, bytes]]:
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        return [(row.item, row.words.encode()) for row in part.collect()]

    return [partial(fetched, block) for block in range(blocks)]


def _looked_up(rows: DataFrame, items: list[tuple[str, bytes]], window: int, drop: list[str]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(Windows(items, window))

    def prepare():
        windows, ids = shared.value, WordIds()

        def compute(part):
            counts, hits, found = [], [], []
            for text in as_bytes(part.column("text")):
                n, spans, items = windows.find(text, ids)
                counts.append(n)
                hits.append(spans)
                found.append(sorted(items))
            return counts, hits, found

        return compute

    return with_computed(rows, _FOUND, prepare, drop)


def _put_together(part):
    """Word counts, and the hits and items of all blocks."""
    hits = [
        _merged([span for spans in own or [] for span in zip(spans[::2], spans[1::2], strict=True)])
        for own in part.column("_hits").to_pylist()
    ]
    items = [sorted({i for found in own or [] for i in found}) for own in part.column("_items").to_pylist()]
    return [len(words_of(text)) for text in as_bytes(part.column("text"))], hits, items


_FOUND = "n_words bigint, hits array<bigint>, items array<string>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (merged [start, end) word ranges, flat) and ``items`` (sorted ids).

    ``benchmark`` needs ``item_id`` and ``text``. Starts one job to size the benchmark and one
    per block to fetch it. With several blocks the documents are stored once with a row number, and every
    block stores the hits it finds under that number.
    """
    first, *others = _blocks(benchmark, block_chars)
    if not others:
        return _looked_up(docs, first(), window, [])
    rows = materialise(set_aside(docs, "text").withColumn("_at", F.monotonically_increasing_id()), "documents")
    found = []
    for items in (first, *others):
        hits = _looked_up(rows.select("_at", "text"), items(), window, ["text"])
        found.append(materialise(hits.where(F.size("hits") > 0).select("_at", "hits", "items"), "hits"))
    together = reduce(DataFrame.union, found).groupBy("_at")
    together = together.agg(F.collect_list("hits").alias("_hits"), F.collect_list("items").alias("_items"))
    out = rows.join(together, "_at", "left").drop("_at")
    added = [part.split(" ")[0] for part in _FOUND.split(", ")]
    out = with_computed(out, _FOUND, lambda: _put_together, ["_hits", "_items"])
    own = [c for c in docs.columns if c not in added]
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in own], *added)


def judged(scanned: DataFrame, share: int = SHARE) -> DataFrame:
    """Adds ``n_hit``, ``n_items`` and ``contaminated`` (at least one word in ``share`` is hit)."""
    # Starts and ends alternate, so subtracting the total from each in turn adds up end - start.
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, x: x - total)
    return scanned.withColumns(
        {"n_hit": hit, "n_items": F.size("items").cast("bigint")}
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones, in their own columns."""
    rows = judged(scan(set_aside(docs, "text"), benchmark, **options))
    return restored(rows.where(~F.col("contaminated")), docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with every hit word range cut out of ``text``; other words keep their spelling and spacing."""

    def prepare():
        def compute(part):
            found = zip(part.column("text").to_pylist(), part.column("hits").to_pylist(), strict=True)
            return ([cut(text, hits) for text, hits in found],)

        return compute

    rows = scan(set_aside(docs, "text"), benchmark, **options)
    return restored(with_computed(rows, "text string", prepare), docs.columns)


def cut(text: str | None, hits: list[int]) -> str | None:
    """The text without the words in the flat ranges ``hits``."""
    if text is None or not hits:
        return text
    raw = text.encode()
    blank = raw.translate(_WORD_BYTES)
    places, at = [], 0
    for word in blank.split():
        at = blank.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    kept, done = [], 0
    for start, end in zip(hits[::2], hits[1::2], strict=True):
        kept.append(raw[done : places[start][0]])
        done = places[end - 1][1]
    return b"".join([*kept, raw[done:]]).decode()


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with word, hit and item counts."""
    scanned = judged(scan(docs.select("doc_id", whole_text().alias("text")), benchmark))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _sql_words(table: str) -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM {table}"


# DuckDB SQL for the rows of :func:`digest` over the tables ``documents`` and ``benchmark``.
ORACLE_SQL = f"""
    WITH texts AS (SELECT row_number() OVER () AS number, doc_id, {_sql_words("documents")}),
    items AS (
        SELECT item, words, least({WINDOW}, len(words)) AS n
        FROM (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words("benchmark")} WHERE item_id IS NOT NULL)
        WHERE len(words) > 0),
    item_windows AS (
        SELECT DISTINCT item, n, array_to_string(words[s:s + n - 1], ' ') AS told
        FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM items)),
    windows AS (
        SELECT number, n, s, array_to_string(words[s:s + n - 1], ' ') AS told
        FROM (SELECT number, words, n, unnest(range(1, len(words) - n + 2)) AS s
              FROM texts, (SELECT DISTINCT n FROM item_windows))),
    hits AS (SELECT number, n, s, item FROM windows JOIN item_windows USING (n, told)),
    covered AS (
        SELECT number, count(DISTINCT place) AS n_hit FROM (SELECT number, unnest(range(s, s + n)) AS place FROM hits) GROUP BY number),
    found AS (
        SELECT number, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY number)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * n_hit >= len(words) AS contaminated
    FROM texts LEFT JOIN covered USING (number) LEFT JOIN found USING (number)"""
