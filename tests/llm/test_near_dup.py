"""Near-duplicates against all pairs, large groups, and defined cases."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from stockweave.llm import near_dup
from stockweave.llm.graph import components

DOCS = "doc_id bigint, text string, kept string"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    n = min(4, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain(texts):
    """doc -> (set size, component) by comparing every pair that shares a shingle."""
    sets = {d: shingles(t) for d, t in texts.items()}
    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    shared = defaultdict(int)
    for group in holders.values():
        for a, b in combinations(sorted(group), 2):
            shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in texts}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_corpus(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/sf{scale}/documents.parquet")
    rows = near_dup.duplicates(docs)
    assert result(rows) == plain({r.doc_id: r.text for r in docs.collect()})
    assert rows.where("kept != (doc_id = component_id)").count() == 0


def test_recall_at_the_limit():
    """Pairs of similarity 0.8 share a table key in nearly all trials."""
    rng = np.random.default_rng(5)
    signer, missed = near_dup.Shingles(), 0
    for _ in range(2000):
        both, left, right = (rng.integers(0, 2**64, n, np.uint64) for n in (400, 50, 50))
        (a, b), (c, d) = (signer.halves(np.concatenate((both, own))) for own in (left, right))
        missed += not (any(x == y for x, y in zip(a, c, strict=True)) and any(x == y for x, y in zip(b, d, strict=True)))
    assert missed <= 8


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b, c = (rng.integers(0, 2**64, int(rng.integers(0, 300)), np.uint64) for _ in range(3))
        bits = near_dup.parity(np.concatenate((a, b))) ^ near_dup.parity(np.concatenate((a, c)))
        assert np.bitwise_count(bits.view(np.uint64)).sum() <= len(b) + len(c)


def edited(words, rng, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return " ".join(words)


def mixed_groups(rng):
    """Two large groups that share most of their text, and texts near the limit to both."""
    base = [f"w{i}" for i in range(200)]
    other = base[:150] + [f"v{i}" for i in range(50)]
    texts = {i: edited(base if i % 2 else other, rng, 1) for i in range(80)}
    return texts, {100 + i: edited(base, rng, 6) for i in range(30)}


def test_two_groups_and_outsiders(spark):
    near, far = mixed_groups(random.Random(3))
    docs = spark.createDataFrame([(d, t, "own") for d, t in (near | far).items()], DOCS)
    assert result(near_dup.duplicates(docs)) == plain(near | far)


def test_many_outsiders(spark):
    """Texts that share a long passage but are mostly not similar enough, with some that are."""
    rng = random.Random(6)
    passage = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(60):
        own = [f"o{i}x{j}" for j in range(25)]
        texts[i] = " ".join(passage + own)
        if i % 4 == 0:
            texts[100 + i] = edited(passage + own, rng, 1)
    docs = spark.createDataFrame([(d, t, "own") for d, t in texts.items()], DOCS)
    assert result(near_dup.duplicates(docs)) == plain(texts)


def test_components_of_a_long_path(spark):
    n = 40
    vertices = spark.createDataFrame([(i * 7 % 41, i) for i in range(n)], "key bigint, comp bigint")
    edges = spark.createDataFrame([(i * 7 % 41, (i + 1) * 7 % 41) for i in range(n - 1)], "a bigint, b bigint")
    assert {r.comp for r in components(vertices, edges).collect()} == {0}


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "A  b"), (9, long), (2, long + " x"), (9, long),
            (None, long), (4, "a b c"), (1, "é É")]
    docs = spark.createDataFrame([(*r, "own") for r in rows], DOCS)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dup.duplicates(docs).collect())
    assert got == [(0, 57, None, True), (1, 1, 1, True), (2, 58, 2, True), (3, 1, 3, True), (4, 1, 4, True),
                   (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (9, 57, 2, False), (9, 57, 2, False)]
    kept = near_dup.keep_one(docs.union(docs.where("doc_id = 2")))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert near_dup.duplicates(docs.limit(0)).count() == 0


def test_other_texts_under_a_kept_id_stay(spark):
    a, z = "one two three four five six seven eight", "nothing of the kind is said here at all today"
    rows = [(1, a, "x"), (1, z, "y"), (2, f"{a} nine", "z"), (1, a.upper().replace(" ", "  "), "w"), (1, None, "v"), (1, " ", "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _words string")
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text if r.text and r.text.strip() else "") for r in kept.collect()]
    assert len(found) == 3 and {text.lower().replace("  ", " ") for _, text in found} == {a, z, ""}
    assert {i for i, _ in found} == {1}
    again = near_dup.keep_one(spark.createDataFrame(rows[::-1], docs.schema).repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))
