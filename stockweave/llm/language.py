"""Language identification: a linear-chain conditional random field over words.

Words are runs of letters, lower-cased. A word's features are its affixes, character n-grams, the
word itself and membership in the learned lexicons; their hashed weights give a score per
language, and a learned matrix scores neighbouring labels. Forward-backward gives every word a
distribution over the languages given its neighbours. A text's language is the one with the most
expected words, its score their share. Long texts are labelled in stretches of ``STRETCH`` words,
all of them.

The field is trained on at most ``PER_LANGUAGE`` documents of every language, those with the
smallest hashes of their ids among ``PER_LANGUAGE`` parts of each; the driver sees their texts only.
Where that would be more than ``SAMPLE`` documents, every language gets fewer, but one at least, and
where the weights would be more than ``CELLS``, features share fewer buckets: no language is left out.
Stretches of different languages are also joined in training, so that the matrix learns from
switches within a text.

Defined results: ``und`` and score 0 for a NULL text, a text without letters, or when nothing was
learned; of equal languages the first in order; rows without an id are neither held out nor
learned from; repeated rows are judged one by one; other columns of the documents do not matter.
"""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.common import with_computed
from stockweave.session import materialise

UNKNOWN = "und"
BUCKETS = 1 << 17
STRETCH = 64
CONTEXT = 8  # words on either side of a stretch that its labels see
PER_LANGUAGE = 96
SAMPLE = 96 * 128  # documents for training, of all languages
CELLS = 1 << 24  # weights, of all languages
EPOCHS = 4
SWITCHED = 0.25  # share of training stretches that join two languages
LEXICON_COUNT, LEXICON_SHARE = 3, 0.8
SLOTS = 20  # feature places kept per word
# Letters with the marks that follow them; other numbers and signs are no letters.
_WORD = regex.compile(r"(?:\p{L}\p{M}*+)++")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_features(word: str) -> list[int]:
    """Buckets of the affixes, n-grams and the whole word; n-grams of long words are spread over all of it."""
    marked = f"<{word}>"
    names = [f"w{word}"]
    names += [f"p{word[:n]}" for n in (1, 2, 3)] + [f"s{word[-n:]}" for n in (1, 2, 3)]
    grams = [marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)]
    step = max(1, -(-len(grams) // (SLOTS - len(names))))
    names += grams[::step]
    return [zlib.crc32(name.encode()) % BUCKETS for name in names]


@dataclass
class Field:
    """Weights of the field; ``lexicon`` gives the language numbers a word is typical of."""

    languages: list[str]
    weights: np.ndarray  # (buckets + 1, languages); the last row stays 0
    lexicon: dict[str, int]
    of_lexicon: np.ndarray  # (languages + 1, languages); the last row stays 0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature rows per word, and the lexicon row."""
        buckets = len(self.weights) - 1
        table = np.full((len(words), SLOTS), buckets, np.int64)
        for i, word in enumerate(words):
            found = word_features(word)[:SLOTS]
            table[i, : len(found)] = found
            table[i, : len(found)] %= buckets
        none = len(self.languages)
        return table, np.array([self.lexicon.get(w, none) for w in words], np.int64)

    def scores(self, words: list[str]) -> np.ndarray:
        table, lexicon = self.places(words)
        return self.summed(table) + self.of_lexicon[lexicon]

    def summed(self, table: np.ndarray) -> np.ndarray:
        """Sum of the weights in each row of feature places, a column at a time."""
        out = self.weights[table[:, 0]]
        for column in table.T[1:]:
            out += self.weights[column]
        return out


def buckets_for(languages: int) -> int:
    """As many buckets, by powers of 2, as ``CELLS`` allows."""
    buckets = BUCKETS
    while buckets > 1 and buckets * languages > CELLS:
        buckets //= 2
    return buckets


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities per place, and expected counts of neighbouring labels.

    ``scores`` is (stretches, places, labels), padded after ``lengths`` places.
    """
    n, size, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves - moves.max())
    inside = np.arange(size)[None, :] < lengths[:, None]
    local[~inside] = 1.0
    ahead = np.empty_like(local)
    ahead[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, size):
        here = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = here / here.sum(axis=1, keepdims=True)
    behind = np.ones_like(local)
    counts = np.zeros((labels, labels))
    for t in range(size - 2, -1, -1):
        rest = local[:, t + 1] * behind[:, t + 1]
        live = inside[:, t + 1]
        back = rest @ step.T
        behind[:, t] = np.where(live[:, None], back / back.sum(axis=1, keepdims=True), 1.0)
        own, after = ahead[live, t], rest[live]
        counts += step * ((own / ((own @ step) * after).sum(axis=1, keepdims=True)).T @ after)
    both = ahead * behind
    return both / both.sum(axis=2, keepdims=True), counts


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Label probabilities only."""
    n, size, _ = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves - moves.max())
    local[np.arange(size)[None, :] >= lengths[:, None]] = 1.0
    ahead = np.empty_like(local)
    ahead[:, 0] = local[:, 0]
    for t in range(1, size):
        here = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = here / here.sum(axis=1, keepdims=True)
    # Places after the end are all equal, so what comes back from them is the same for a last
    # place of any label only if nothing is passed on: it is reset there.
    last = lengths - 1
    rest = np.ones((n, local.shape[2]))
    out = ahead
    for t in range(size - 2, -1, -1):
        rest = (rest * local[:, t + 1]) @ step.T
        rest /= rest.sum(axis=1, keepdims=True)
        rest[last <= t] = 1.0
        out[:, t] *= rest
    return out / out.sum(axis=2, keepdims=True)


def _stretches(texts: list[tuple[str, str | None]], languages: list[str], seed: int) -> list[list[tuple[str, int]]]:
    """Labelled training stretches, some of two languages."""
    rng = random.Random(seed)
    plain = []
    number = {language: i for i, language in enumerate(languages)}
    for language, text in texts:
        words = [(w, number[language]) for w in words_of(text)]
        plain += [words[i : i + STRETCH] for i in range(0, len(words), STRETCH)]
    out = []
    for words in plain:
        if rng.random() < SWITCHED:
            other = rng.choice(plain)
            cut, start = rng.randint(0, len(words)), rng.randint(0, len(other))
            words = (words[:cut] + other[start:])[:STRETCH]
        out.append(words)
    rng.shuffle(out)
    return out


def train(texts: list[tuple[str, str | None]], epochs: int = EPOCHS, seed: int = 11) -> Field:
    """A field from (language, text) pairs, by AdaGrad on the log-likelihood of the labels."""
    languages = sorted({language for language, _ in texts})
    size = len(languages)
    number = {language: i for i, language in enumerate(languages)}
    buckets = buckets_for(size)
    seen: dict[str, Counter] = defaultdict(Counter)
    for language, text in texts:
        for word in words_of(text):
            seen[word][number[language]] += 1
    lexicon = {}
    for word, counts in seen.items():
        (language, most), total = counts.most_common(1)[0], sum(counts.values())
        if total >= LEXICON_COUNT and most >= LEXICON_SHARE * total:
            lexicon[word] = language
    model = Field(languages, np.zeros((buckets + 1, size)), lexicon, np.zeros((size + 1, size)), np.zeros((size, size)))
    vocabulary = {word: i for i, word in enumerate(seen)}
    if not vocabulary:
        return model
    table, of_lexicon = model.places(list(vocabulary))
    sums = [np.full_like(m, 1e-8) for m in (model.weights, model.of_lexicon, model.moves)]

    def update(weights: np.ndarray, total: np.ndarray, slope: np.ndarray, rate: float) -> None:
        total += slope**2
        weights -= rate * slope / np.sqrt(total)

    for epoch in range(epochs):
        batch_of = _stretches(texts, languages, seed + epoch)
        for at in range(0, len(batch_of), 64):
            batch = [s for s in batch_of[at : at + 64] if s]
            if not batch:
                continue
            lengths = np.array([len(s) for s in batch])
            ids = np.zeros((len(batch), lengths.max()), np.int64)
            labels = np.zeros_like(ids)
            for i, stretch in enumerate(batch):
                ids[i, : len(stretch)] = [vocabulary[w] for w, _ in stretch]
                labels[i, : len(stretch)] = [label for _, label in stretch]
            inside = np.arange(ids.shape[1])[None, :] < lengths[:, None]
            words, inverse = np.unique(ids, return_inverse=True)
            rows, lex = table[words], of_lexicon[words]
            scores = (model.summed(rows) + model.of_lexicon[lex])[inverse.reshape(ids.shape)]
            chances, moves = forward_backward(scores, lengths, model.moves)
            slope = chances - np.eye(size)[labels]
            per_word = np.zeros((len(words), size))
            np.add.at(per_word, inverse.reshape(ids.shape)[inside], slope[inside])
            pairs = inside[:, 1:]
            np.subtract.at(moves, (labels[:, :-1][pairs], labels[:, 1:][pairs]), 1.0)
            touched, place = np.unique(rows, return_inverse=True)
            by_feature = np.zeros((len(touched), size))
            for column in place.reshape(rows.shape).T:
                np.add.at(by_feature, column, per_word)
            by_feature[touched == buckets] = 0
            total = sums[0][touched] + by_feature**2
            sums[0][touched] = total
            model.weights[touched] -= 0.2 * by_feature / np.sqrt(total)
            by_lexicon = np.zeros_like(model.of_lexicon)
            np.add.at(by_lexicon, lex, per_word)
            by_lexicon[size] = 0
            update(model.of_lexicon, sums[1], by_lexicon, 0.2)
            update(model.moves, sums[2], moves, 0.2)
    return model


class Labeler:
    """Labels words by a field, remembering the scores of words it has met.

    What is held at a time, words remembered and stretches labelled, shrinks as languages grow.
    """

    def __init__(self, model: Field, most: int = 400_000):
        size = max(1, len(model.languages))
        self.model, self.most = model, min(most, max(1, CELLS // size))
        self.words_at_once = min(8192, max(1, (1 << 20) // size))
        self.stretches_at_once = min(4096, max(1, (1 << 18) // size))
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.empty((1024, len(self.model.languages)), np.float32)

    def _ids(self, words: list[list[str]]) -> list[list[int]]:
        new = sorted(set().union(*words) - self.rows.keys())
        if len(self.rows) + len(new) > self.most and self.rows:
            self.forget()
            new = sorted(set().union(*words))
        start, end = len(self.rows), len(self.rows) + len(new)
        if end > len(self.scores):
            grown = np.empty((2 * end, self.scores.shape[1]), np.float32)
            grown[:start] = self.scores[:start]
            self.scores = grown
        step = self.words_at_once
        for at in range(0, len(new), step):
            self.scores[start + at : start + at + step][: len(new) - at] = self.model.scores(new[at : at + step])
        self.rows.update(zip(new, range(start, end), strict=True))
        return [list(map(self.rows.__getitem__, own)) for own in words]

    def _chances(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(text, label probabilities of its words), long texts in several parts one after another."""
        of_text = self._ids([words_of(text) for text in texts])
        most, group, stretches = self.stretches_at_once, [], 0
        for i, ids in enumerate(of_text):
            for at in range(0, len(ids), most * STRETCH):
                end = min(len(ids), at + most * STRETCH)
                own = -(-(end - at) // STRETCH)
                if stretches + own > most:
                    yield from self._labelled(group)
                    group, stretches = [], 0
                group.append((i, ids, at, end))
                stretches += own
        yield from self._labelled(group)

    def _labelled(self, group: list[tuple[int, list[int], int, int]]) -> Iterator[tuple[int, np.ndarray]]:
        """Label probabilities of the places from ``at`` to ``end`` of each text.

        A chain has ``CONTEXT`` more words on either side of its stretch, so that labels see their neighbours.
        """
        if not group:
            return
        chains, bounds = [], []
        for _, ids, at, end in group:
            for start in range(at, end, STRETCH):
                stop, low = min(start + STRETCH, end), max(0, start - CONTEXT)
                chains.append(ids[low : stop + CONTEXT])
                bounds.append((start - low, stop - low))
        lengths = np.array([len(chain) for chain in chains])
        places = np.arange(lengths.max())[None, :]
        padded = np.zeros((len(chains), lengths.max()), np.int64)
        padded[places < lengths[:, None]] = np.concatenate([np.array(chain, np.int64) for chain in chains])
        low, high = np.array(bounds).T[:, :, None]
        chances = marginals(self.scores[padded].astype(float), lengths, self.model.moves)[(places >= low) & (places < high)]
        ends = np.cumsum([end - at for _, _, at, end in group])[:-1]
        for (i, *_), own in zip(group, np.split(chances, ends), strict=True):
            yield i, own

    def word_chances(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text, the label probabilities of each of its words."""
        out = [[np.empty((0, len(self.model.languages)))] for _ in texts]
        for i, chances in self._chances(texts):
            out[i].append(chances)
        return [np.concatenate(parts) for parts in out]

    def languages(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """Language, score, and number of words labelled otherwise than the word before, per text."""
        out = [(UNKNOWN, 0.0, 0)] * len(texts)
        if not self.model.languages:
            return out
        current, total, labels = -1, np.empty(0), []

        def finish() -> None:
            if current >= 0:
                own = np.concatenate(labels)
                share = total / len(own)
                best = int(share.argmax())
                score = min(1.0, max(0.0, float(share[best])))
                out[current] = (self.model.languages[best], score, int((own[1:] != own[:-1]).sum()))

        for i, chances in self._chances(texts):
            if i != current:
                finish()
                current, total, labels = i, np.zeros(len(self.model.languages)), []
            total += chances.sum(axis=0)
            labels.append(chances.argmax(axis=1))
        finish()
        return out


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Field:
    """Choose the sample, which is stored, and train on it. Runs two jobs over the documents."""
    learned = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    order = F.xxhash64("doc_id")
    firsts = materialise(
        learned.groupBy("lang", F.pmod(order, F.lit(per_language)).alias("part")).agg(
            F.min(F.struct(order.alias("order"), "doc_id")).alias("first")
        ),
        "sample",
    )
    languages = firsts.select("lang").distinct().count()
    each = max(1, min(per_language, SAMPLE // max(1, languages)))
    of_language = Window.partitionBy("lang").orderBy("first")
    # At most SAMPLE rows, or one for every language.
    chosen = (
        firsts.withColumn("place", F.row_number().over(of_language))
        .where(F.col("place") <= each)
        .select("lang", F.col("first.doc_id").alias("doc_id"))
    )
    rows = learned.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).collect()
    return train(sorted((r.lang, r.text) for r in rows))


def identify(docs: DataFrame, model: Field) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``n_switches``; only ``text`` is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        labeler = Labeler(shared.value)

        def compute(part):
            return zip(*labeler.languages(part.column("text").to_pylist()), strict=True)

        return compute

    return with_computed(docs, "lang_pred string, score double, n_switches bigint", prepare)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with its predicted language."""
    rows = identify(docs.select("doc_id", "text"), fit(docs))
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_switches")
