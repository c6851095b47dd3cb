"""Secret scan: patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a run of base64 characters of at least ``WINDOW`` characters with a letter and a
digit. A window moves over it; its entropy is kept by the change of two counts per step, not
counted anew. The part covered by windows above the threshold of the candidate's character
class is a secret, unless the allow list knows it or a pattern has found it already.

Defined results: a NULL or empty text has no spans; repeated rows are scanned one by one; the
columns of the documents other than id and text do not matter. Patterns and counts use
DataFrame functions only and are linear in the length of the text, also for one long candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import whole_text
from stockweave.llm.spans import clear_of, let, listed, marked, with_spans

KINDS = ["assign", "access", "hex", "entropy"]
WINDOW = 20
BLOCK = 64  # windows walked at a time
# Bits per character from which a window counts, by class of the whole candidate.
CLASSES = (("^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0), ("^[A-Za-z0-9]+$", 3.6), ("", 3.8))

# Equal to the plain forms: runs are maximal either way, and what would be dropped as too short
# is not matched in the first place.
PATTERNS = {
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++""",
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "[0-9a-f]{24,}+",
    "candidate": f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}+",
}
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?(.*)$"""
# Forms of public identifiers and placeholders.
ALLOWED = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)example|placeholder|changeme|your[_-]|xxxx|0123456789|abcdefgh",
    "^(?:https?|www)",
)


def _times(part: Column, char: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, char, F.lit("")))


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def _window_totals(text: Column, size: int) -> Column:
    """Per window of ``text``, at least one, the sum of c log2 c over the counts c of its characters.

    When a window moves by one, only the counts of the character that leaves and of the one
    that enters change, and so do only two terms of the sum.
    """
    first = F.substring(text, F.lit(1), F.lit(size))
    total = F.aggregate(
        F.array_distinct(F.split(first, "")), F.lit(0.0), lambda sum_, char: sum_ + _term(_times(first, char))
    )

    def step(state: Column, start: Column) -> Column:
        before = F.substring(text, start, F.lit(size))
        leaving, kept = F.substring(before, 1, 1), F.substring(before, 2, size - 1)
        entering = F.substring(text, start + size, F.lit(1))
        left, came = _times(kept, leaving), _times(kept, entering)
        total = state["total"] - _term(left + 1) + _term(left) - _term(came) + _term(came + 1)
        return F.struct(total.alias("total"), F.array_append(state["all"], total).alias("all"))

    moves = F.when(F.length(text) > size, F.sequence(F.lit(1), F.length(text) - size)).otherwise(F.array().cast("array<int>"))
    start = let(total, lambda value: F.struct(value.alias("total"), F.array(value).alias("all")))
    return F.aggregate(moves, start, step, lambda state: state["all"])


def window_entropies(text: Column, size: int = WINDOW) -> Column:
    """Entropy in bits per character of every window of ``size`` characters, by incremental counts.

    It is log2(size) - sum(c log2 c) / size over the counts c of the characters. The text is
    walked in blocks with the start of the next one, so that a step costs the same anywhere.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def with_next(found: Column) -> Column:
        following = F.concat(F.slice(found, F.lit(2), F.size(found)), F.array(F.lit("")))
        return F.zip_with(found, following, lambda block, after: F.concat(block, F.substring(after, 1, size - 1)))

    parts = F.filter(let(blocks, with_next), lambda part: F.length(part) >= size)
    totals = F.flatten(F.transform(parts, lambda part: _window_totals(part, size)))
    return F.transform(totals, lambda t: F.log2(F.lit(float(size))) - t / size)


def _threshold(text: Column) -> Column:
    chosen = F.lit(CLASSES[-1][1])
    for pattern, bits in reversed(CLASSES[:-1]):
        chosen = F.when(text.rlike(pattern), F.lit(bits)).otherwise(chosen)
    return chosen


def _suspicious(span: Column) -> Column:
    """The part of a candidate that dense windows cover, as a span; NULL if there is none."""

    def part(dense: Column) -> Column:
        first = F.array_position(dense, True)
        last = F.size(dense) - F.array_position(F.reverse(dense), True)
        found = F.struct((span["start"] + first - 1).alias("start"), (span["start"] + last + WINDOW).alias("end"))
        return F.when(first > 0, found)

    def dense(least: Column) -> Column:
        return F.transform(window_entropies(span["text"]), lambda bits: bits >= least)

    return let(let(_threshold(span["text"]), dense), part)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``, NULL as empty) and columns ``assign``, ``access``, ``hex`` and ``entropy``, arrays of spans."""
    rows = with_spans(docs.withColumn("text", whole_text()), PATTERNS)
    value = lambda s: F.regexp_extract(s["text"], VALUE, 1)
    rows = rows.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= 6))
    known = F.concat("assign", "access", "hex")

    def wanted(span: Column) -> Column:
        told = span["text"].rlike("[0-9]") & span["text"].rlike("[A-Za-z]")
        for form in ALLOWED:
            told = told & ~span["text"].rlike(form)
        return told

    rows = rows.withColumn("_known", known).withColumn("candidate", F.filter("candidate", wanted))
    rows = rows.withColumn("candidate", clear_of(F.col("candidate"), F.col("_known")))
    entropy = F.filter(F.transform("candidate", _suspicious), lambda s: s.isNotNull())
    return rows.withColumn("entropy", entropy).drop("candidate", "_known")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with counts, the digest of the pattern spans, and all spans."""
    rows = scan(docs.select("doc_id", "text"))
    base = F.concat(*[marked(F.col(kind), i) for i, kind in enumerate(KINDS[:3])])
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.concat(base, marked(F.col("entropy"), 3)), KINDS).alias("spans"),
        F.size("entropy").cast("bigint").alias("n_entropy"),
    )
