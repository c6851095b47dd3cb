"""Personal data: labelers vote on candidate spans, EM weighs them, a classifier decides.

Certain forms (email, ip, card, phone with a country code) are found by pattern and check, and
always stand. Looser forms are candidates. Three labelers vote yes, no or not at all on every
candidate and certain span: the form (checksum, length), a gazetteer (top-level domains, card
issuers, country codes, first digits), and cue words before the span. Expectation-maximisation
over the counts of vote patterns estimates how often each labeler is right about each kind and how likely each
pattern is personal data; with these as soft labels a log-linear span classifier is trained on
the votes and on what no labeler sees: length, digits and classes of characters of the span, and the words
before and after it. Candidates it gives at least ``CERTAIN`` are added.

The counts are taken over all documents; their number is bounded by kinds, votes, shapes and numbers of
words, not by the data, so EM and training run on the driver.

Defined results: a NULL or empty text has no spans; repeated rows are judged one by one; without
candidates nothing is added; columns of the documents other than those used do not matter.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import restored, set_aside, whole_text
from stockweave.llm.spans import clear_of, listed, redacted, with_spans
from stockweave.session import materialise

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn", "name"]
CERTAIN = 0.9
CUE_CHARS = 24
ROUNDS = 60
WORDS = 16  # numbers of neighbouring words
# Chances of no, none and yes from which the estimate begins, of form, gazetteer and cue: if false, if true.
BEGIN = (
    ((0.35, 0.3, 0.35), (0.35, 0.3, 0.35), (0.6, 0.3, 0.1)),
    ((0.1, 0.3, 0.6), (0.1, 0.3, 0.6), (0.1, 0.3, 0.6)),
)
LEAN = 20.0  # candidates that a labeler's chances over all kinds weigh

# Equal to the plain forms. Runs are entered at their start only (or where the last match ended),
# never repeat a try at each of their characters, and numbers too short for a card are not matched.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "loose_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]++)++",
    "loose_phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "loose_iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "loose_ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "loose_name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?+",
}
LOOSE["said_email"] = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++"
LOOSE["loose_ip"] = r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\x20dot\x20|\x20\.\x20)[0-9]{1,3}){3}(?![0-9.])"
LOOSE_KIND = {
    "loose_email": 0, "said_email": 0, "loose_ip": 1, "loose_phone": 3, "loose_iban": 4, "loose_ssn": 5, "loose_name": 6,
}

# Gazetteers, by what they list.
DOMAINS = (
    "com org net edu gov mil int info biz io co me app dev ai eu us ca mx br ar cl uk ie fr de at ch it es pt nl be lu dk se no fi "
    "is pl cz sk hu ro bg gr tr ru ua in cn jp kr tw hk sg my th vn id ph au nz za eg ma ng ke il ae sa"
).split()
CALLING_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
    "212 213 216 234 254 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 966 971 972"
).split()
IBAN_COUNTRIES = (
    "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT JO KW KZ LB LI LT "
    "LU LV MC MD ME MK MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR UA VG XK"
).split()
FIRST_NAMES = (
    "Adam Alan Albert Alejandro Alexander Alice Amy Ana Andrea Andreas Andrew Angela Anna Anne Anthony Antonio Barbara Benjamin "
    "Bernard Brian Camille Carlos Carmen Caroline Catherine Charles Charlotte Christian Christine Christopher Claire Claudia "
    "Daniel David Deborah Diego Donald Dorothy Edward Elena Elizabeth Emily Emma Eric Eva Felix Fernando Francis Francisco "
    "Frank Franz Fritz Gabriel George Hannah Hans Heinz Helen Helga Henri Henry Ines Isabel Jack Jacques James Jan Jane Javier "
    "Jean Jennifer Jessica Joan Johann John Jonas Jorge Jose Joseph Juan Julia Jürgen Karen Karl Katharina Kevin Klaus Laura "
    "Lea Léa Linda Lisa Louis Lucas Lucía Luis Luise Manuel Margaret Maria María Marie Mark Martin Martina Mary Matthew Max "
    "Michael Michel Miguel Monika Nancy Nicolas Olivier Oliver Pablo Patricia Paul Pedro Peter Philippe Pierre Rafael Rebecca "
    "Richard Robert Rosa Sabine Samuel Sandra Sara Sarah Simon Sofía Sophie Stefan Stephen Susan Thomas Ursula Walter William Wolfgang"
).split()
# What a known value of each kind looks like.
GAZETTEER = [
    rf"(?i)[.\x20)\]](?:{'|'.join(DOMAINS)})$",
    r"^(?:10|127|172|192|198|203|8|1)(?![0-9])",
    r"^(?:4|5[1-5]|3[47]|6011|65|2[2-7])",
    rf"^\+(?:{'|'.join(CALLING_CODES)})(?![0-9]{{12}})",
    rf"^(?:{'|'.join(IBAN_COUNTRIES)})",
    r"^(?!000|666|9)",
    rf"\x20(?:{'|'.join(FIRST_NAMES)})(?!\p{{L}})",
]
CUES = [
    r"(?i)mail|contact|write|kontakt|correo|courriel",
    r"(?i)\bip\b|host|server|login|address|adresse",
    r"(?i)card|visa|credit|karte|carte|tarjeta|payment",
    r"(?i)phone|\btel|call|fax|mobil|cell",
    r"(?i)iban|account|konto|compte|cuenta|bank",
    r"(?i)ssn|social|security",
    r"(?i)dear|name|contact|from|signed|gruß|estimad",
]

# Words that tell of numbers and names of things.
THINGS = (
    r"(?i)\b(?:parts?|items?|article|catalogu?e|version|release|build|orders?|serial|invoice|ref|reference|model|isbn|page|figure|"
    r"section|chapter|batch|lot|sku|teil|artikel|ausgabe|seite|pi[eè]ce|num[ée]ro|r[eé]f[eé]rence|p[aá]gina|pedido)\b"
)


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less 9 above 9; the sum ends in 0."""

    def weighed(char: Column, i: Column) -> Column:
        digit = char.cast("int")
        twice = 2 * digit
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    weights = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(weights, F.lit(0), lambda total, x: total + x) % 10 == 0


def _mod_97(iban: Column) -> Column:
    """The checksum of account numbers: the first four characters go last, letters count from 10 on, the rest is 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        letter = F.ascii(char) - 55
        return F.when(char.rlike("[0-9]"), (rest * 10 + F.ascii(char) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _passes(kind: str, text: Column) -> Column:
    """The check of a certain form."""
    if kind == "ip":
        return text.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        count = F.length(_digits(text))
        return F.when(count.between(12, 19), _luhn(_digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _chosen(kind: Column, options: list[Column]) -> Column:
    out = options[-1]
    for i, option in reversed(list(enumerate(options[:-1]))):
        out = F.when(kind == i, option).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    """2 for yes, 0 for no, 1 for none."""
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _word_bucket(text: Column, pattern: str) -> Column:
    """The neighbouring word as one of ``WORDS`` numbers, 0 where there is none."""
    word = F.lower(F.regexp_extract(text, pattern, 1))
    return F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(word), F.lit(WORDS - 1))).cast("int")


def _judged(span: Column, kind: Column, base: Column, text: Column) -> Column:
    """start, kind, end, base, votes (form, gazetteer and cue as one number), shape and neighbouring words of a span."""
    body = span["text"]
    form = _chosen(
        kind,
        [
            _vote(base | body.rlike(r"[(\[]at[)\]]"), ~body.rlike(r"(?i)dot")),
            _vote(base | ~body.rlike(r"(?<![0-9])(?:2(?:5[6-9]|[6-9][0-9])|[3-9][0-9]{2})(?![0-9])"), F.lit(True)),
            _vote(base, ~base),
            _vote(base | body.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-]?[2-9]"), F.lit(True)),
            _vote(_mod_97(body), F.lit(True)),
            _vote(F.lit(False), body.rlike("-00-|-0000$")),
            _vote(body.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}"), F.lit(False)),
        ],
    )
    known = _chosen(kind, [body.rlike(p) for p in GAZETTEER])
    gazetteer = _vote(known, kind.isin(0, 2, 4))
    lead = F.substring(text, F.greatest(F.lit(1), span["start"] - CUE_CHARS + 1), F.least(span["start"], F.lit(CUE_CHARS)))
    other = lead.rlike(THINGS)
    for pattern in CUES:
        other = other | lead.rlike(pattern)
    cue = _vote(_chosen(kind, [lead.rlike(p) for p in CUES]), other)
    length = F.least(F.floor(F.length(body) / 6), F.lit(4)).cast("int")
    share = F.floor(3 * F.length(_digits(body)) / (F.length(body) + 1)).cast("int")
    classes = [body.rlike(p).cast("int") for p in (r"\p{Lu}", r"\x20", r"[-()\[\]]")]
    follow = F.substring(text, span["end"] + 1, F.lit(CUE_CHARS))
    return F.struct(
        span["start"].alias("start"),
        kind.alias("kind"),
        span["end"].alias("end"),
        base.alias("base"),
        (form * 9 + gazetteer * 3 + cue).cast("int").alias("votes"),
        ((length * 3 + share) * 8 + classes[0] * 4 + classes[1] * 2 + classes[2]).cast("int").alias("shape"),
        _word_bucket(lead, r"(\p{L}+)\P{L}*$").alias("before"),
        _word_bucket(follow, r"^\P{L}*(\p{L}+)").alias("after"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``marks``: certain spans and candidates, with votes and shapes.

    A loose form that overlaps a certain one is no candidate.
    """
    needs = {
        "email": F.col("text").contains("@"),
        "phone": F.col("text").contains("+"),
        "loose_email": F.col("text").rlike(r"[(\[]at[)\]]"),
    }
    rows = with_spans(docs.withColumn("text", whole_text()), PATTERNS | LOOSE, needs)

    def passing(kind: str) -> Column:
        return F.filter(kind, lambda s: _passes(kind, s["text"]))

    def all_judged(spans: Column, kind: int, base: bool) -> Column:
        return F.transform(spans, lambda s: _judged(s, F.lit(kind), F.lit(base), F.col("text")))

    rows = rows.withColumns({f"_{kind}": passing(kind) for kind in BASE})
    rows = rows.withColumn("_certain", F.concat(*[f"_{kind}" for kind in BASE]))
    found = [all_judged(F.col(f"_{kind}"), i, True) for i, kind in enumerate(BASE)]
    failed = F.filter("card", lambda s: ~_passes("card", s["text"]) & F.length(_digits(s["text"])).between(12, 19))
    for kind, spans in [(2, failed), *[(LOOSE_KIND[name], F.col(name)) for name in LOOSE]]:
        found.append(all_judged(clear_of(spans, F.col("_certain")), kind, False))
    rows = rows.withColumn("marks", F.concat(*found))
    return rows.drop(*PATTERNS, *LOOSE, *[f"_{k}" for k in BASE], "_certain")


def estimate(counts: dict[tuple[int, int], int], rounds: int = ROUNDS) -> dict[tuple[int, int], float]:
    """How likely each (kind, votes) is personal data, by EM over ``counts``.

    Labelers vote independently given the truth, each with its own chance of every vote per
    truth and kind; kinds with few candidates lean on the labeler's chances over all kinds. The share of personal data
    is per kind. It starts from labelers that are mostly right, the cue above all: the others say yes to most that has the form.
    """
    keys = sorted(counts)
    n = np.array([counts[key] for key in keys], float)
    kinds = np.array([kind for kind, _ in keys], np.int64)
    votes = np.array([(v // 9, v // 3 % 3, v % 3) for _, v in keys], np.int64).reshape(-1, 3)
    size = len(KINDS)
    # By truth, kind, labeler and vote.
    chance = np.empty((2, size, 3, 3))
    chance[:] = np.array(BEGIN)[:, None]
    share = np.full(size, 0.5)
    yes = np.zeros(len(keys))
    for _ in range(rounds):
        told = np.log(chance[:, kinds[:, None], np.arange(3)[None, :], votes]).sum(axis=2)
        odds = np.log(share[kinds]) - np.log(1 - share[kinds]) + told[1] - told[0]
        yes = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        all_ = np.bincount(kinds, n, size)
        share = (np.bincount(kinds, n * yes, size) + 1) / (all_ + 2)
        for truth, weight in enumerate((n * (1 - yes), n * yes)):
            seen = np.zeros((size, 3, 3))
            for labeler in range(3):
                np.add.at(seen, (kinds, labeler, votes[:, labeler]), weight)
            over_all = seen.sum(axis=0) + 1
            prior = LEAN * over_all / over_all.sum(axis=1, keepdims=True)
            chance[truth] = (seen + prior) / (seen.sum(axis=2, keepdims=True) + LEAN)
    return dict(zip(keys, yes.tolist(), strict=True))


SHAPES = 15 * 8
# Where the features of a mark begin: the bias, votes of three labelers, shapes by kind, words before and after by kind.
_PLACES = (0, 1, 4, 7, 10, 10 + len(KINDS) * SHAPES, 10 + len(KINDS) * (SHAPES + WORDS))
FEATURES = 10 + len(KINDS) * (SHAPES + 2 * WORDS)


def features(kind, votes, shape, before, after) -> list:
    """Places of the features that are on, for numbers, arrays or columns with whole-number division ``//``."""
    return [
        0 * kind + _PLACES[0],
        votes // 9 + _PLACES[1],
        votes // 3 % 3 + _PLACES[2],
        votes % 3 + _PLACES[3],
        kind * SHAPES + shape + _PLACES[4],
        kind * WORDS + before + _PLACES[5],
        kind * WORDS + after + _PLACES[6],
    ]


def train(cells: dict[tuple[int, ...], int], labels: dict[tuple[int, int], float], steps: int = 400) -> list[float]:
    """Weights of a logistic classifier of (kind, votes, shape, before, after) cells, by gradient steps on soft labels."""
    if not cells:
        return [0.0] * FEATURES
    told = np.array(sorted(cells), np.int64)
    n = np.array([cells[tuple(cell)] for cell in told.tolist()], float)
    wanted = np.array([labels[kind, votes] for kind, votes, *_ in told.tolist()])
    on = np.stack(features(*told.T))
    weights = np.zeros(FEATURES)
    # Features that are seldom on say little: they are held near 0.
    held = 0.002 + 0.5 / (1 + np.bincount(on.ravel(), np.tile(n, len(on)), FEATURES))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-weights[on].sum(axis=0)))
        slope = np.bincount(on.ravel(), np.tile((p - wanted) * n / n.sum(), len(on)), FEATURES)
        weights -= 2.0 * (slope + held * weights / len(on))
    return weights.tolist()


CELL = ["kind", "votes", "shape", "before", "after"]


def fit(rows: DataFrame) -> list[float]:
    """Weights from the marks of all ``rows``; the driver sees counts by kind, votes, shape and neighbouring words only."""
    marks = rows.select(F.explode("marks").alias("m"))
    cells = marks.groupBy(*[F.col(f"m.{c}").alias(c) for c in CELL]).count().collect()
    by_cell = {tuple(r[c] for c in CELL): r["count"] for r in cells}
    by_votes: dict[tuple[int, int], int] = defaultdict(int)
    for (kind, votes, *_), n in by_cell.items():
        by_votes[kind, votes] += n
    return train(by_cell, estimate(by_votes))


def _probability(mark: Column, weights: list[float]) -> Column:
    table = F.array(*[F.lit(w) for w in weights])
    kind, votes = mark["kind"], mark["votes"]
    places = [
        F.lit(_PLACES[0]),
        F.floor(votes / 9) + _PLACES[1],
        F.floor(votes / 3) % 3 + _PLACES[2],
        votes % 3 + _PLACES[3],
        kind * SHAPES + mark["shape"] + _PLACES[4],
        kind * WORDS + mark["before"] + _PLACES[5],
        kind * WORDS + mark["after"] + _PLACES[6],
    ]
    total = sum((F.get(table, place.cast("int")) for place in places), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def decided(rows: DataFrame, weights: list[float], certain: float = CERTAIN) -> DataFrame:
    """``rows`` of :func:`candidates` with ``base`` and ``spans``, arrays of (start, kind, end)."""

    def plain(mark: Column) -> Column:
        return F.struct(mark["start"].alias("start"), mark["kind"].alias("kind"), mark["end"].alias("end"))

    base = F.transform(F.filter("marks", lambda m: m["base"]), plain)
    kept = F.filter("marks", lambda m: m["base"] | (_probability(m, weights) >= certain))
    return rows.withColumns({"base": base, "spans": F.transform(kept, plain)}).drop("marks")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, as in ``<EMAIL>``."""
    found = materialise(candidates(set_aside(docs, "text")), "marks")
    rows = decided(found, fit(found))
    text = redacted(F.col("text"), F.col("spans"), [f"<{kind.upper()}>" for kind in KINDS])
    rows = rows.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))
    return restored(rows, docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with counts, the digest of the certain spans, and all spans."""
    found = materialise(candidates(docs.select("doc_id", "text")).drop("text"), "marks")
    rows = decided(found, fit(found))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("bigint")

    return rows.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        listed(F.col("spans"), KINDS).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )
