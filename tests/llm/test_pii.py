"""Personal data against Python's regular expressions, EM on known labelers, and defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

from stockweave.llm import pii

DOCS = "doc_id bigint, text string, spans string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    text = text or ""
    spans = []

    def add(kind, pattern, test):
        for m in re.finditer(pattern, text):
            if test(m[0], re.sub("[^0-9]", "", m[0])):
                spans.append((m.start(), kind, m.end()))

    add(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True)
    add(1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(p) <= 255 for p in s.split(".")))
    add(2, r"[0-9]([\x20-]?[0-9])+", lambda s, d: 12 <= len(d) <= 19 and luhn(d))
    add(3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15)
    return [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)]


TEXTS = [
    None, "", "a@b.c d.e@f-g.hi.jk@l.m x@y", "a@b.c_x@d.e.. .@-.-", "é 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111", "+1 (555) 010-9999. +49 30 1234567 8 +12 +1-2",
    "\U0001f600 x.y+z@mail.example.com, +1 212 555 0100", "7" * 50_000 + " x" * 10 + "a" * 50_000, "1 " * 30_000, "@" * 9,
    "a@b.c@d.e@f.g", "1.1.1.1.1", "+1+15550109999 (x) +1 5550109999 1", "5500005555555559.5500005555555559",
]


def check(rows, texts):
    for doc, text in texts.items():
        row, base = rows[doc], plain(text)
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (doc, base, row.spans)
        assert set(base) <= set(row.spans.split(","))
        kinds = Counter(s.split(":")[0] for s in base)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds[k] for k in pii.BASE]
        assert len([s for s in row.spans.split(",") if s]) == len(base) + row.n_added


def test_texts(spark):
    texts = dict(enumerate(TEXTS))
    docs = spark.createDataFrame([(d, t, "own") for d, t in texts.items()], DOCS)
    check({r.doc_id: r for r in pii.digest(docs).collect()}, texts)


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = pii.candidates(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    rows = {r.doc_id: r for r in pii.digest(docs).collect()}
    check(rows, {r.doc_id: r.text for r in docs.collect()})
    assert sum(r.n_email for r in rows.values()) and sum(r.n_phone for r in rows.values())


def test_loose_forms_are_added_with_support(spark):
    rng = random.Random(1)
    texts = {}
    for i in range(300):
        number = f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        texts[i] = f"call my phone {number} or +1 {number} mail a{i}@b.com" if i % 2 else f"text {i} without any"
    docs = spark.createDataFrame([(d, t, "own") for d, t in texts.items()], DOCS)
    rows = {r.doc_id: r for r in pii.digest(docs).collect()}
    check(rows, texts)
    assert all(rows[i].n_added == i % 2 for i in texts)


def plain_em(counts, rounds):
    """The same estimate in loops."""
    digits = {votes: (votes // 9, votes // 3 % 3, votes % 3) for _, votes in counts}
    kinds = range(len(pii.KINDS))
    chance = {(y, k, j): pii.BEGIN[y][j] for y in (0, 1) for k in kinds for j in range(3)}
    share = dict.fromkeys(kinds, 0.5)
    posterior = {}
    for _ in range(rounds):
        for kind, votes in counts:
            odds = math.log(share[kind] / (1 - share[kind]))
            for j, vote in enumerate(digits[votes]):
                odds += math.log(chance[1, kind, j][vote] / chance[0, kind, j][vote])
            posterior[kind, votes] = 1 / (1 + math.exp(-odds))
        for k in kinds:
            own = [(n, posterior[kind, votes]) for (kind, votes), n in counts.items() if kind == k]
            share[k] = (sum(n * p for n, p in own) + 1) / (sum(n for n, _ in own) + 2)
        seen = Counter()
        for (kind, votes), n in counts.items():
            for j, vote in enumerate(digits[votes]):
                seen[1, kind, j, vote] += n * posterior[kind, votes]
                seen[0, kind, j, vote] += n * (1 - posterior[kind, votes])
        for y, k, j in chance:
            over_all = [1 + sum(seen[y, other, j, v] for other in kinds) for v in range(3)]
            total = sum(seen[y, k, j, v] for v in range(3)) + pii.LEAN
            chance[y, k, j] = [(seen[y, k, j, v] + pii.LEAN * over_all[v] / sum(over_all)) / total for v in range(3)]
    return posterior


def votes_of(reliability, n, share, kind, rng):
    counts = Counter()
    for _ in range(n):
        truth = rng.random() < share
        votes = [2 * (truth if rng.random() < right else not truth) for right in reliability]
        counts[kind, votes[0] * 9 + votes[1] * 3 + votes[2]] += 1
    return counts


def test_em_equals_the_plain_one():
    counts = votes_of((0.9, 0.8, 0.6), 500, 0.3, 0, random.Random(2)) + votes_of((0.6, 0.95, 0.7), 300, 0.6, 4, random.Random(3))
    found, want = pii.estimate(counts, 12), plain_em(counts, 12)
    assert found.keys() == want.keys() and all(math.isclose(found[k], want[k], abs_tol=1e-9) for k in want)


def test_em_finds_the_reliable_labeler_of_each_kind():
    """A labeler may be good at one kind and poor at another."""
    rng = random.Random(2)
    counts = votes_of((0.95, 0.9, 0.6), 4000, 0.4, 0, rng) + votes_of((0.6, 0.9, 0.95), 4000, 0.4, 3, rng)
    found = pii.estimate(counts)
    assert found[0, 26] > 0.95 and found[0, 24] > 0.9 and found[0, 0] < 0.05 and found[0, 2] < 0.1
    assert found[3, 8] > 0.9 and found[3, 18] < 0.1 and found[3, 26] > 0.95
    weights = pii.train({(*key, 3, 0, 0): n for key, n in counts.items()}, found)
    told = {votes: sum(weights[i] for i in pii.features(0, votes, 3, 0, 0)) for votes in (26, 0)}
    assert told[26] > 2 > -2 > told[0]


def planted(rng):
    """A sentence and whether what it holds is personal data: obfuscated data, and numbers and words of the same forms."""
    name, site = rng.choice(["anna.k", "j.doe", "m_lopez"]), rng.choice(["mail", "post-box", "home"])
    phone = f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    ssn = f"{rng.randint(1, 665):03d}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
    ip = "[.]".join(str(rng.choice([10, 127, 192, 172])) if i == 0 else str(rng.randint(0, 255)) for i in range(4))
    word = rng.choice(["meadow", "lattice", "harbour", "engine"])
    yes = [
        ("email", f"please write an email to {name} [at] {site} [dot] {rng.choice(['com', 'org', 'de'])}", name),
        ("email", f"you can contact {name} at {site} dot {rng.choice(['com', 'net'])} today", name),
        ("phone", f"call me, my phone is {phone} all day", phone),
        ("ssn", f"my social security number {ssn} was lost", ssn),
        ("iban", f"transfer to my account {rng.choice(['DE89 3704 0044 0532 0130 00', 'GB82 WEST 1234 5698 7654 32', 'FR1420041010050500013M02606'])} please", "account"),
        ("ip", f"login to the server at {ip} as root", ip),
        ("name", f"dear {rng.choice(['Dr.', 'Mrs.', 'Herr'])} {rng.choice(['Maria', 'Thomas', 'Karl'])} {rng.choice(['Weber', 'Stone'])}, thank you", "dear"),
    ]
    no = [
        ("", f"the {word} stood at {word} dot {word} of the grid", ""),
        ("", f"spare part {phone} fits the {word}", ""),
        ("", f"the batch DE{rng.randint(10, 99)} {rng.randint(1000, 9999)} 0044 0532 0130 01 of the {word}", ""),
        ("", f"catalogue entry {rng.choice(['000', '666', '900'])}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} of the {word}", ""),
        ("", f"release {rng.randint(300, 999)}[.]{rng.randint(300, 999)}[.]{rng.randint(1, 9)}[.]{rng.randint(300, 999)} of the {word}", ""),
    ]
    return rng.choice(yes if rng.random() < 0.5 else no)


def test_planted_obfuscated_data(spark):
    """Precision and recall of what the classifier adds, document by document."""
    rng = random.Random(8)
    truth = {i: planted(rng) for i in range(1500)}
    docs = spark.createDataFrame([(i, f"some text before. {text}. and after", "own") for i, (_, text, _) in truth.items()], DOCS)
    rows = pii.digest(docs).collect()
    added = {r.doc_id: {s.split(":")[0] for s in r.spans.split(",") if s} for r in rows}
    right = sum(kind in added[i] for i, (kind, *_) in truth.items() if kind)
    recall = right / sum(bool(kind) for kind, *_ in truth.values())
    precision = right / max(1, sum(bool(found) for found in added.values()))
    by_kind = {k: (sum(k in added[i] for i, t in truth.items() if t[0] == k), sum(t[0] == k for t in truth.values())) for k in pii.KINDS}
    print(recall, precision, by_kind, Counter(t[1].split()[0] for i, t in truth.items() if added[i] and not t[0]))
    assert recall > 0.85 and precision > 0.95


def test_redaction_and_defined_cases(spark):
    rows = [(1, "é a@b.com x 8.8.8.8", "own"), (2, None, "own"), (3, "", "own"), (3, "plain", "own"), (None, "+1 555 010 9999!", None)]
    docs = spark.createDataFrame(rows, DOCS)
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert sorted((r.text for r in clean.collect()), key=str) == sorted(["é <EMAIL> x <IP>", "", "", "plain", "<PHONE>!"], key=str)
    assert {r.spans for r in clean.collect()} == {"own", None}
    assert pii.digest(docs.limit(0)).count() == 0 and pii.redact(docs.limit(0)).count() == 0
