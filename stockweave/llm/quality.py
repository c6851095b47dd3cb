"""Quality rules: plain counts, and the log-likelihood ratio of two hashed n-gram multinomials.

Letter runs, digit runs and symbol runs of a text are its tokens. Unigrams and bigrams of
tokens fall into a fixed number of buckets; one multinomial over the buckets is counted from
all documents (raw), one from trusted documents (target). A text's score is the sum of
log(target / raw) over its n-grams, divided by their number. Documents below a threshold go.
The threshold is read off trusted and distrusted documents that were not counted as target.

Trusted are documents that all their labels call good and not toxic. A hash of the id puts half
of them into the target; the others and all distrusted ones give the threshold. The raw
multinomial counts every document.

Defined results: a NULL or empty text has no words and fails the base rule; a text without
n-grams scores 0; without trusted documents every score is 0 and the threshold minus infinity,
so the base rule alone decides; repeated documents are judged one by one; a column of the
documents with the name of an added one gives way.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import (
    WHITE_SPACE,
    WordIds,
    as_bytes,
    mix,
    place_factors,
    restored,
    set_aside,
    slices,
    whole_text,
    window_hashes,
    with_computed,
)
from stockweave.operators.running import scan_chunks
from stockweave.session import materialise, scratch_scope

BUCKETS = 1 << 16
REPEATED_WINDOW = 8
FALSE_REJECT_COST = 10  # a good document lost weighs as many bad ones kept
SMOOTHING = 1.0
SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
_NOT_COUNTED = WHITE_SPACE + bytes(range(0x80, 0xC0))  # each character has one byte outside 80-BF


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated 8-word windows."""
    words = text.split()
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated_lines += 1
        elif line.strip(WHITE_SPACE):
            seen.add(line)
    chars = len(text.translate(None, _NOT_COUNTED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, repeated_lines, _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    if len(words) <= REPEATED_WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    hashes = window_hashes(ids + np.uint64(1), REPEATED_WINDOW)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(words) + 1, np.int64)
    covered[:-REPEATED_WINDOW] += twice
    covered[REPEATED_WINDOW:] -= twice
    return int((np.cumsum(covered) > 0).sum())


class Buckets:
    """Buckets of the unigrams and bigrams of a text."""

    def __init__(self, buckets: int = BUCKETS):
        self.ids = WordIds()
        self.buckets = np.uint64(buckets)

    def of(self, text: bytes) -> np.ndarray:
        ids = self.ids.of(_TOKEN.findall(text))
        one, two = place_factors(2)
        pairs = mix(ids[:-1] * one + ids[1:] * two)
        return (np.concatenate((mix(ids), pairs)) % self.buckets).astype(np.int64)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # log(target / raw) by bucket
    threshold: float

    def score(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum()) / len(buckets) if len(buckets) else 0.0


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, kind) of all judged documents: trusted ones for the target and for the threshold, distrusted ones."""
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"), F.max("toxic").alias("toxic"))
    )
    for_target = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    good = (F.col("low") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    kind = F.when(good, F.when(for_target, "target").otherwise("good")).when(F.col("high") == 0, "bad")
    return known.select("doc_id", kind.alias("kind")).where("kind IS NOT NULL")


def _counts(docs: DataFrame, labelled: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket, of all documents and of the target's."""

    def count(batches):
        of = Buckets(buckets)
        raw, kept = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in slices(batches):
            for trusted, text in zip(part.column("trusted").to_pylist(), as_bytes(part.column("text")), strict=True):
                found = of.of(text)
                np.add.at(raw, found, 1)
                if trusted:
                    np.add.at(kept, found, 1)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(kept[seen])], ["bucket", "raw", "target"])

    trusted = labelled.where("kind = 'target'").select("doc_id", F.lit(True).alias("trusted"))
    counted = (
        # The ids are hashed in each task, so texts are shuffled once and not sorted.
        docs.join(trusted.hint("shuffle_hash"), "doc_id", "left")
        .select("trusted", "text")
        .mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    )
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, kept = np.zeros(buckets), np.zeros(buckets)
    for row in rows:
        raw[row.bucket], kept[row.bucket] = row.raw, row.target
    return raw, kept


def best_threshold(good: Iterable[float], bad: Iterable[float], cost: float = FALSE_REJECT_COST) -> float:
    """The cut with the least cost when scores below it are rejected; of equal ones the lowest."""
    marks = sorted([(s, cost) for s in good] + [(s, -1.0) for s in bad])
    best, at, total = 0.0, -math.inf, 0.0
    for i, (score, change) in enumerate(marks):
        total += change
        if total < best and (i + 1 == len(marks) or marks[i + 1][0] > score):
            best, at = total, float(np.nextafter(score, math.inf))
    return at


def threshold_of(scores: DataFrame, cost: int = FALSE_REJECT_COST) -> float:
    """:func:`best_threshold` of (good, score) rows, however many: costs are added up in ranges of scores. Runs jobs."""
    change = F.sum(F.when(F.col("good"), float(cost)).otherwise(-1.0)).alias("change")
    marks = scores.groupBy("score").agg(change).withColumn("all", F.lit(0))
    summed = scan_chunks(marks, "all", ["score"], "change").where("total_after < 0")
    best = summed.agg(F.min(F.struct("total_after", "score")).alias("best")).first().best
    return -math.inf if best is None else float(np.nextafter(best.score, math.inf))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> QualityModel:
    """Count both multinomials over ``docs`` and read the threshold off all labelled documents.

    Reads the documents twice; the driver sees ``buckets`` counts. What is stored on the way is deleted.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    labelled = _labelled(labels)
    raw, target = _counts(docs, labelled, buckets)
    if not target.sum():
        return QualityModel(np.zeros(buckets), -math.inf)

    def log_share(counts):
        return np.log(counts + SMOOTHING) - math.log(counts.sum() + SMOOTHING * buckets)

    model = QualityModel(log_share(target) - log_share(raw), -math.inf)
    checked = labelled.where("kind <> 'target'").select("doc_id", (F.col("kind") == "good").alias("good"))
    with scratch_scope(docs.sparkSession):
        # Joined once they are scored: scores are narrow, texts are not.
        scores = _scored(docs, model, ["doc_id"]).select("doc_id", "score").join(checked, "doc_id").select("good", "score")
        return QualityModel(model.weights, threshold_of(materialise(scores, "scores")))


def _scored(docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = shared.value
        buckets = Buckets(len(model.weights))
        return lambda part: ([model.score(buckets.of(text)) for text in as_bytes(part.column("text"))],)

    return with_computed(docs.select("text", *keep), "score double", prepare, ["text"])


def judged(docs: DataFrame, model: QualityModel, drop: Iterable[str] = ()) -> DataFrame:
    """``docs`` with the measures, ``score``, ``base_failed`` and ``kept``, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = shared.value
        buckets = Buckets(len(model.weights))

        def compute(part):
            texts = as_bytes(part.column("text"))
            return [*zip(*map(measures, texts), strict=True), [model.score(buckets.of(t)) for t in texts]]

        return compute

    rows = with_computed(docs, f"{MEASURES}, score double", prepare, drop)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold))
    )


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, in their own columns."""
    rows = judged(set_aside(docs, "text"), fit(docs, labels))
    return restored(rows.where("kept"), docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its measures and verdict."""
    rows = judged(docs.select("doc_id", "text"), fit(docs, labels), ["text"])
    names = [field.split()[0] for field in MEASURES.split(", ")]
    return rows.select("doc_id", *names, "base_failed", "kept", "score")
