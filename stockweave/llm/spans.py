"""Places of pattern matches in texts, as column expressions.

Spans are arrays of (start, end, text) in code points, end exclusive, in the order of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:bigint,end:bigint,text:string>>"


BLOCK = 256  # elements that are added up one by one


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded_before(numbers: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Per element of an array of bigint what ``combine`` makes of those before it, ``zero`` for the first.

    It runs within blocks and over blocks, as an array that grows is copied at every step.
    """
    first = F.lit(zero).cast("bigint")

    def running(values: Column, start: Column) -> Column:
        def step(state: Column, value: Column) -> Column:
            return F.struct(
                combine(state["at"], value).alias("at"), F.array_append(state["out"], state["at"]).alias("out")
            )

        begin = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, begin, step, lambda state: state["out"])

    def in_blocks(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, BLOCK))

        def joined(parts: Column) -> Column:
            whole = F.transform(parts, lambda part: F.aggregate(part, first, lambda x, y: combine(x, y)))
            return F.flatten(F.zip_with(parts, running(whole, first), running))

        return F.when(F.size(values) > 0, let(blocks, joined)).otherwise(F.array().cast("array<bigint>"))

    return let(numbers, in_blocks)


def totals_before(numbers: Column) -> Column:
    return folded_before(numbers, 0, lambda total, x: total + x)


def _placed(gaps: Column, matches: Column) -> Column:
    """Spans from the texts between the matches and the matches themselves."""

    def sized(gap: Column, match: Column) -> Column:
        # The last gap has no match after it.
        return F.struct(F.length(gap).cast("bigint").alias("gap"), match.alias("text"), F.length(match).alias("size"))

    def spans(parts: Column) -> Column:
        parts = F.filter(parts, lambda part: part["text"].isNotNull())
        before = totals_before(F.transform(parts, lambda part: part["gap"] + part["size"]))

        def span(part: Column, at: Column) -> Column:
            start = at + part["gap"]
            return F.struct(start.alias("start"), (start + part["size"]).alias("end"), part["text"].alias("text"))

        return F.zip_with(parts, before, span)

    return let(F.zip_with(gaps, matches, sized), spans)


def with_spans(df: DataFrame, patterns: Mapping[str, str], needs: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with one column of spans per pattern of ``patterns`` over its ``text``, which is not NULL.

    Texts that fail the condition in ``needs``, cheaper than the pattern, have no match.
    The projections are stacked, so that a match list used twice is computed once.
    """
    needs = needs or {}
    text = {name: F.when(needs[name], F.col("text")).otherwise("") if name in needs else F.col("text") for name in patterns}
    found = {f"_{n}_matches": F.regexp_extract_all(text[n], F.lit(p), F.lit(0)) for n, p in patterns.items()}
    gaps = {f"_{n}_gaps": F.when(F.size(f"_{n}_matches") > 0, F.split("text", p, -1)) for n, p in patterns.items()}
    spans = {n: F.coalesce(_placed(F.col(f"_{n}_gaps"), F.col(f"_{n}_matches")), F.array().cast(SPANS)) for n in patterns}
    return df.withColumns(found).withColumns(gaps).withColumns(spans).drop(*found, *gaps)


def marked(spans: Column, kind: int) -> Column:
    """Spans as (start, kind, end), which sorts by start and then kind."""
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


def listed(marks: Column, kinds: list[str]) -> Column:
    """Sorted marks as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(F.array_sort(marks), lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"], m["end"])), ","
    )


_END = 1 << 62


def clear_of(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``; both are walked in order, not held against each other."""

    def placed(found: Column, own: bool) -> Column:
        def one(span: Column) -> Column:
            text = span["text"] if own else F.lit(None).cast("string")
            return F.struct(
                span["start"].alias("start"), F.lit(own).alias("own"), span["end"].alias("end"), text.alias("text")
            )

        return F.transform(found, one)

    def kept(marks: Column) -> Column:
        ends = F.transform(marks, lambda m: F.when(m["own"], F.lit(0).cast("bigint")).otherwise(m["end"]))
        starts = F.transform(marks, lambda m: F.when(m["own"], F.lit(_END)).otherwise(m["start"]))
        before = folded_before(ends, 0, F.greatest)
        after = F.reverse(folded_before(F.reverse(starts), _END, F.least))
        free = F.zip_with(
            F.zip_with(before, after, lambda x, y: F.struct(x.alias("before"), y.alias("after"))),
            marks,
            lambda near, m: F.when(
                m["own"] & (near["before"] <= m["start"]) & (near["after"] >= m["end"]),
                F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text")),
            ),
        )
        return F.filter(free, lambda span: span.isNotNull())

    walked = let(F.array_sort(F.concat(placed(spans, True), placed(others, False))), kept)
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), walked).otherwise(spans)


def redacted(text: Column, marks: Column, labels: list[str]) -> Column:
    """``text`` with every marked place replaced by the label of its kind; overlapping ones become one."""
    names = F.array(*[F.lit(k) for k in labels])

    def step(state: Column, mark: Column) -> Column:
        fresh = mark["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, mark["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], gap, F.get(names, mark["kind"]))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], mark["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        F.array_sort(marks), zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    return F.when(F.size(marks) > 0, done).otherwise(text)
