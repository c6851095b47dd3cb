"""Language field against enumeration, held-out accuracy, switched text, and defined cases."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest

from stockweave.llm import language

DOCS = "doc_id bigint, text string, lang string, score string"
FOLDER = "/root/testdata/sf0.01"


def enumerated(scores, moves):
    """Label probabilities and expected moves over all label sequences."""
    size, labels = scores.shape
    chances, counts, total = np.zeros_like(scores), np.zeros((labels, labels)), 0.0
    for path in product(range(labels), repeat=size):
        weight = np.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += weight
        for t, y in enumerate(path):
            chances[t, y] += weight
        for a, b in zip(path, path[1:], strict=False):
            counts[a, b] += weight
    return chances / total, counts / total


def test_forward_backward():
    rng = np.random.default_rng(0)
    scores, moves, lengths = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3)), np.array([5, 1, 3])
    chances, counts = language.forward_backward(scores, lengths, moves)
    expected = [enumerated(scores[i, :n], moves) for i, n in enumerate(lengths)]
    for i, n in enumerate(lengths):
        assert np.allclose(chances[i, :n], expected[i][0])
        assert np.allclose(language.marginals(scores, lengths, moves)[i, :n], expected[i][0])
    assert np.allclose(counts, sum(c for _, c in expected))


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, language.fit(docs)


def test_held_out_accuracy(spark, trained):
    docs, _ = trained
    rows = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_inputs_are_the_text_alone(spark, trained):
    docs, model = trained
    text = docs.select("text").first().text
    frame = spark.createDataFrame([(1, text, "xx", "a"), (999, text, None, "b")], DOCS)
    a, b = language.identify(frame, model).collect()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score)


def test_switched_text(trained):
    docs, model = trained
    by = {r.lang: r.text for r in docs.where("n_chars > 400 and n_chars < 1500").collect()}
    parts = [language.words_of(by[code])[:40] for code in ("en", "de")]
    chances = language.Labeler(model).word_chances([" ".join(parts[0] + parts[1])])[0]
    labels = [model.languages[i] for i in chances.argmax(axis=1)]
    assert np.mean([y == "en" for y in labels[:40]]) > 0.8 and np.mean([y == "de" for y in labels[40:]]) > 0.8


def test_memory_of_words_does_not_change_labels(trained):
    docs, model = trained
    texts = [r.text for r in docs.limit(20).collect()]
    whole = language.Labeler(model).languages(texts)
    small = language.Labeler(model, most=50)
    assert [small.languages([t])[0] for t in texts] == whole


def test_defined_cases(spark):
    rows = [(i, t, lang, "own") for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 8 + [(None, "en"), ("", "de"), ("12 !", None)])]
    docs = spark.createDataFrame([*rows, (None, "the dog", "en", None), (None, "x" * 200_000, None, None)], DOCS)
    out = language.digest(docs)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.where("doc_id >= 16").collect()}
    assert got == {16: ("und", 0.0), 17: ("und", 0.0), 18: ("und", 0.0)}
    assert {r.lang_pred for r in out.where("doc_id < 16").collect()} == {"en", "de"}
    assert out.where("doc_id is null and not held_out").count() == 2
    nothing = language.digest(docs.withColumn("lang", docs.lang.substr(9, 0)).where("lang is null"))
    assert {r.lang_pred for r in nothing.collect()} <= {"und"}
    assert language.digest(docs.limit(0)).count() == 0


def many(spark, languages):
    """Four documents of each of ``languages`` languages, of words of its own."""
    rows = []
    for i in range(languages):
        name = "".join(chr(97 + i // 26**k % 26) for k in range(3))
        rows += [(5 * i + j, " ".join(f"{name}{x}{name}" for x in "qwertz"), name, "own") for j in range(4 + (i < 3))]
    return spark.createDataFrame(rows, DOCS)


def test_every_language_is_learned(spark):
    docs = many(spark, 140)
    model = language.fit(docs)
    learned = {r.lang for r in docs.where(~language.held_out()).select("lang").distinct().collect()}
    assert set(model.languages) == learned and len(learned) > 128
    rows = [r for r in language.identify(docs, model).collect() if r.lang in learned]
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99


def test_a_small_sample_has_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 5)
    docs = many(spark, 12)
    learned = {r.lang for r in docs.where(~language.held_out()).select("lang").distinct().collect()}
    assert set(language.fit(docs).languages) == learned and len(learned) > 5


def test_weights_and_parts_are_bounded(trained):
    assert language.buckets_for(4) == language.BUCKETS
    assert all(language.buckets_for(n) * n <= language.CELLS for n in (129, 1000, 30_000))
    docs, model = trained
    texts = [r.text for r in docs.limit(20).collect()]
    whole, parts = language.Labeler(model), language.Labeler(model)
    parts.stretches_at_once = 2
    for a, b in zip(whole.languages(texts), parts.languages(texts), strict=True):
        assert a[0] == b[0] and np.isclose(a[1], b[1]) and a[2] == b[2]


def test_only_letters_are_words(trained):
    assert language.words_of("² 12 ½ ⅷ _ ①") == [] and language.words_of("x²y naïve Ünï_cödé") == ["x", "y", "naïve", "ünï", "cödé"]
    assert language.words_of("été") == ["été"]
    assert language.Labeler(trained[1]).languages(["² 12", None, "½"]) == [("und", 0.0, 0)] * 3


def test_labels_at_a_cut_see_their_neighbours(spark, trained):
    """Stretches with words around them give the labels of one chain over the whole text."""
    docs, model = trained
    texts = [r.text for r in docs.where("n_chars > 3000").limit(20).collect()]
    text = " ".join(texts)
    words = language.words_of(text)
    whole = language.marginals(model.scores(words)[None], np.array([len(words)]), model.moves)[0]
    got = language.Labeler(model).word_chances([text])[0]
    assert len(words) > 10 * language.STRETCH and np.abs(whole - got).max() < 0.01
    assert np.array_equal(whole.argmax(axis=1), got.argmax(axis=1))
