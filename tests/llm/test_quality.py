"""Quality rules against plain counting, and their defined cases."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from stockweave.llm import quality

DOCS = "doc_id bigint, text string, score string"
LABELS = "doc_id bigint, quality int, toxic int"
FOLDER = "/root/testdata/sf0.001"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(hit)


TEXTS = ["", " \n\t", "a", "é ü x\u0085y", "a b\na b\n\na b \nc", "x " * 40, "# | <&>", " \n ",
         "one two three four five six seven eight nine one two three four five six seven eight"]


@pytest.mark.parametrize("text", TEXTS)
def test_measures(text):
    assert quality.measures(text.encode()) == plain(text)


def test_corpus(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality.digest(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for doc, text in texts.items():
        row = rows[doc]
        counts = plain(text)
        assert tuple(row[1:6]) == counts
        assert row.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (row.base_failed and row.kept)


def test_verdicts_follow_the_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.digest(docs, labels).where("not base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.toxic]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_threshold():
    assert quality.best_threshold([1.0, 2.0], [0.0, 0.5]) == np.nextafter(0.5, 1)
    assert quality.best_threshold([1.0, 2.0], []) == -np.inf
    assert quality.best_threshold([], []) == -np.inf
    assert quality.best_threshold([1.0], [1.0] * 3) == -np.inf


def test_threshold_of_many_scores(spark):
    rng = np.random.default_rng(4)
    for good, bad in ((rng.integers(40, 100, 300), rng.integers(0, 60, 500)), ([1, 2], []), ([], []), ([1], [1] * 3), ([5], [5, 1, 1])):
        good, bad = [float(x) / 8 for x in good], [float(x) / 8 for x in bad]
        rows = spark.createDataFrame([(True, x) for x in good] + [(False, x) for x in bad], "good boolean, score double")
        assert quality.threshold_of(rows) == quality.best_threshold(good, bad)


def test_every_label_counts(spark):
    """More labelled documents than any fixed number that used to be taken."""
    n = 50_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word', id) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic")
    kinds = {r.kind: r.n for r in quality._labelled(labels).groupBy("kind").agg({"doc_id": "count"}).toDF("kind", "n").collect()}
    assert kinds["bad"] == n // 2 and kinds["target"] + kinds["good"] == n // 2
    raw, target = quality._counts(docs, quality._labelled(labels), 64)
    # A word and a number, and the pair of both.
    assert raw.sum() == 3 * n and target.sum() == 3 * kinds["target"]


def test_defined_cases(spark):
    text = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, None, "own"), (2, "", "own"), (3, text, "own"), (3, text, "own"), (None, text, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    rows = sorted(quality.digest(docs, none).collect(), key=str)
    assert sorted((r.doc_id or 0, r.kept) for r in rows) == [(0, True), (1, False), (2, False), (3, True), (3, True)]
    labels = spark.createDataFrame([(3, 1, 0), (3, None, None), (2, 0, None), (None, 1, 0)], LABELS)
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns and [r.score for r in kept.where("doc_id = 3").collect()] == ["own"] * 2
    assert quality.digest(docs.limit(0), labels).count() == 0
