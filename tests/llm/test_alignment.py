"""Alignment against the tokenizers in their plain form and a merge of sets."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockweave.llm import alignment

PATHS = tuple(map(public_tokenizers.path, (alignment.RANKS_A, alignment.MODEL)))


class Plain:
    def __init__(self):
        path = public_tokenizers.path("byte_bpe_50k.json")
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in printable]
        self.byte = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(others)}
        with open(path) as f:
            self.entries = {i: token for token, i in json.load(f)["model"]["vocab"].items()}

    def tokens(self, text):
        """[(id, bytes)] of both."""
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.entries[i])) for i in self.a.encode(f" {text}", add_special_tokens=False).ids]
        b = [
            (i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
            for i, p in ((i, self.b.id_to_piece(i)) for i in self.b.encode(text))
        ]
        told = f" {text}".encode()
        same = all(b"".join(t for _, t in side) == told for side in (a, b))
        return (a, b) if same else ([], [])

    def links(self, text):
        """Ids of both sides and the links as places."""
        a, b = self.tokens(text)
        places = []
        for side in (a, b):
            ends, at = {}, 0
            for n, (_, token) in enumerate(side):
                at += len(token)
                ends[at] = n
            places.append(ends)
        both = sorted(places[0].keys() & places[1].keys())
        return [i for i, _ in a], [i for i, _ in b], [(places[0][x], places[1][x]) for x in both]

    def digest(self, texts):
        found = [self.links(t) for t in texts]
        counts = Counter((a[i], b[j]) for a, b, links in found for i, j in links)
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for a, b, links in found:
            groups, at = [], (0, 0)
            for i, j in links:
                groups.append("|".join(",".join(map(str, x)) for x in (a[at[0] : i + 1], b[at[1] : j + 1])))
                at = (i + 1, j + 1)
            told = ";".join(groups)
            own = [counts[a[i], b[j]] for i, j in links]
            n_best = sum(n == best[b[j]] for n, (_, j) in zip(own, links, strict=True))
            checksum = hashlib.sha256(told.encode()).hexdigest() if a else ""
            out.append((len(a), len(b), len(groups), len(links), n_best, sum(own), checksum))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


TEXTS = ["", " ", "a", "it's  a<|endoftext|> b", "你好 \U0001f600 é ÿ", "▁ marked", "x\n\ny \t z", "Straße 12,5 — “q”", "\0",
         "hello world " * 400, "unbroken" * 900]


@pytest.mark.parametrize("stretch", [1, 7, 2048, 10**9])
def test_blocks(plain, stretch):
    own = alignment.tokenizers(*PATHS)
    block = alignment.Block.of(own, TEXTS, stretch)
    for n, text in enumerate(TEXTS):
        a, b, links = plain.links(text)
        at_a, at_b = block.first_a[n], block.first_b[n]
        assert block.a[at_a : block.first_a[n + 1]].tolist() == a
        assert block.b[at_b : block.first_b[n + 1]].tolist() == b
        own_links = slice(block.first_link[n], block.first_link[n + 1])
        got = zip((block.link_a[own_links] - at_a).tolist(), (block.link_b[own_links] - at_b).tolist(), strict=True)
        assert list(got) == links


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" ab'\n1."), st.characters(codec="utf-8")), max_size=30), max_size=5))
def test_any_text(texts):
    plain, own = Plain.cached, alignment.tokenizers(*PATHS)
    block = alignment.Block.of(own, texts, 5)
    want = [row[-1] for row in plain.digest(texts)]
    assert [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in block.told(own)] == want


Plain.cached = Plain()


@given(st.lists(st.lists(st.integers(1, 9), min_size=1, max_size=20), max_size=5), st.integers(1, 40), st.randoms())
def test_merge(documents, stretch, generator):
    sides, firsts = ([], []), ([0], [0])
    base = 0
    for lengths in documents:
        total = sum(lengths)
        other = sorted({total, *(generator.randint(1, total) for _ in range(6))})
        for side, first, ends in zip(sides, firsts, (np.cumsum(lengths).tolist(), other), strict=True):
            side += [base + e for e in ends]
            first.append(len(side))
        base += total
    a, b = alignment.merge(*map(np.array, (*sides, *firsts)), stretch)
    both = sorted(set(sides[0]) & set(sides[1]))
    assert [sides[0][i] for i in a] == both == [sides[1][j] for j in b]


def test_same_classes_of_characters(plain):
    """The fast form of A splits as the plain form does, whatever the character."""
    own = alignment.tokenizers(*PATHS)
    points = [c for c in [*range(0x3000), *range(0x3000, 0x30000, 17)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}.{chr(c)}  x" for c in points]
    want = [e.ids for e in plain.a.encode_batch(texts, add_special_tokens=False)]
    assert [own.a.encode_ordinary(t) for t in texts] == want


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_chars", [alignment.BLOCK_CHARS, 3000])
def test_corpus(spark, plain, block_chars):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    want = [(r.doc_id, *m) for r, m in zip(rows, plain.digest([r.text for r in rows]), strict=True)]
    assert found(alignment.digest(docs.repartition(5), block_chars=block_chars)) == sorted(want, key=str)


def test_defined_cases(spark, plain):
    texts = [None, "", "a b", "a b", "▁", " ", "word " * 100_000, "z" * 50_000, *TEXTS]
    ids = [n if n != 3 else 2 for n in range(len(texts))]
    ids[5] = None
    rows = [(i, t, 1, "own", "x") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_a int, groups_sha256 string, block string")
    want = [(i, *m) for i, m in zip(ids, plain.digest([t or "" for t in texts]), strict=True)]
    assert found(alignment.digest(docs)) == sorted(want, key=str)
    assert alignment.digest(docs.limit(0)).count() == 0


def test_align(spark, plain):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in alignment.align(docs).collect():
        assert (r.a, r.b, list(zip(r.link_a, r.link_b, strict=True))) == plain.links(TEXTS[r.doc_id])
