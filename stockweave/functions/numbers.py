"""Numeric expressions with the NULL behaviour the parameters need."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def null_if_zero(x: Column, default: Column) -> Column:
    """``x``, or ``default`` where ``x`` is zero or missing."""
    return F.coalesce(F.nullif(x, F.lit(0.0)), default)


def guarded_sqrt(x: Column) -> Column:
    """Square root; NULL (not NaN) below zero, where rounding may push a variance."""
    return F.when(x >= 0, F.sqrt(x))


def nan_to_null(x: Column) -> Column:
    """NaN compares greater than every number in Spark, so it must not reach the rules."""
    return F.when(~F.isnan(x), x)


def population_variance(x: Column) -> Column:
    """Mean of squares minus square of the mean, as an aggregate."""
    return F.avg(x * x) - F.avg(x) * F.avg(x)


_EXPONENT = 1000  # powers of two up to this one and its inverse are doubles


def _times_power(x: Column, exponent: int) -> Column:
    """``x`` times a power of two, in steps that are doubles themselves."""
    while exponent:
        step = max(-_EXPONENT, min(_EXPONENT, exponent))
        x = x * F.lit(2.0**step)
        exponent -= step
    return x


@dataclass(frozen=True)
class Scale:
    """How numbers are cut into whole parts, so that sums do not depend on the order of addition.

    Numbers that all have at most six decimals are added as whole millionths (or as whole
    numbers), as they are written. Others are cut into ``parts`` groups of ``bits`` binary
    digits from 2**``low`` up, whose sums hold every digit of every number. Parts are chosen so
    that the sum of all numbers fits. NaN counts as missing; infinities are counted apart.
    """

    decimals: int | None = 0
    low: int = 0
    bits: int = 62
    parts: int = 1
    infinite: bool = False
    narrow: bool = True  # every sum fits a decimal

    # Facts about the numbers: name, expression, how facts of parts of the rows are combined.
    _FACTS = {
        "numbers": (lambda x: F.count(x), F.sum),
        "largest": (lambda x: F.max(F.abs(x)), F.max),
        "whole": (lambda x: F.bool_and(F.rint(x) == x), F.bool_and),
        "short": (lambda x: F.bool_and(F.rint(x * 1e6) / 1e6 == x), F.bool_and),
        "lowest": (lambda x: F.min(_lowest_digit(x)), F.min),
        "infinite": (lambda x: F.bool_or(F.abs(x) == float("inf")), F.bool_or),
    }

    @classmethod
    def facts(cls, x: Column) -> list[Column]:
        """What is to be known of ``x``, as aggregates."""
        x = nan_to_null(x)
        finite = F.when(F.abs(x) != float("inf"), x)
        return [
            fact(x if name == "infinite" else finite).alias(f"_{name}") for name, (fact, _) in cls._FACTS.items()
        ]

    @classmethod
    def combined(cls) -> list[Column]:
        """The facts of all rows from those of groups of them."""
        return [combine(f"_{name}").alias(f"_{name}") for name, (_, combine) in cls._FACTS.items()]

    @classmethod
    def of(cls, facts: Row) -> Scale:
        largest, numbers = facts["_largest"] or 0.0, facts["_numbers"] or 1
        infinite = bool(facts["_infinite"])
        if facts["_whole"] in (True, None) and largest * numbers < 2.0**62:
            return cls(infinite=infinite)
        if facts["_short"] and largest * 1e6 * numbers < 2.0**62:
            return cls(decimals=6, infinite=infinite)
        low = max(-1074, int(facts["_lowest"]))
        bits = max(1, 62 - int(numbers).bit_length())
        digits = math.frexp(largest)[1] - low
        narrow = digits + int(numbers).bit_length() <= 125
        return cls(None, low, bits, max(1, -(-digits // bits)), infinite, narrow)

    def split(self, x: Column) -> list[Column]:
        """``x`` as whole numbers, to be added one by one."""
        x = nan_to_null(x)
        finite = F.when(F.abs(x) != float("inf"), x).otherwise(F.when(x.isNotNull(), 0.0)) if self.infinite else x
        found = []
        if self.decimals is not None:
            found.append(F.rint(finite * 10.0**self.decimals).cast("bigint"))
        else:
            for place in range(self.parts):
                low = self.low + place * self.bits
                # Remainders, powers of two and the cut at the point are all exact.
                part = finite % F.lit(2.0 ** (low + self.bits)) if low + self.bits <= 1023 else finite
                found.append(_times_power(part, -low).cast("bigint"))
        if self.infinite:
            found += [(x == sign * float("inf")).cast("bigint") for sign in (1, -1)]
        return found

    def joined(self, sums: list[Column]) -> Column:
        """The number that sums of the parts stand for; infinities of both signs give NULL."""
        if self.infinite:
            *sums, above, below = sums
            value = self._finite(sums)
            return (
                F.when((above > 0) & (below > 0), None)
                .when(above > 0, float("inf"))
                .when(below > 0, -float("inf"))
                .otherwise(value)
            )
        return self._finite(sums)

    def _finite(self, sums: list[Column]) -> Column:
        if self.decimals is not None:
            value = sums[0].cast("double")
            return value / 10.0**self.decimals if self.decimals else value
        if self.parts == 1:
            return _times_power(sums[0].cast("double"), self.low)
        if self.narrow:
            places = [F.lit(Decimal(1 << place * self.bits)) for place in range(self.parts)]
            wide = [(s.cast("decimal(20,0)") * place).cast("decimal(38,0)") for s, place in zip(sums, places, strict=True)]
            total = reduce(lambda a, b: (a + b).cast("decimal(38,0)"), wide)
            return _times_power(total.cast("double"), self.low)
        # Wider than any decimal: the parts as digits of one sign, added from the lowest one on.
        return F.coalesce(self._digits(sums), -self._digits([-s for s in sums]))

    def _digits(self, sums: list[Column]) -> Column:
        """The number if it is not negative, else NULL."""
        powers = [2.0 ** (self.low + n * self.bits) for n in range(self.parts)]
        parts = F.array(*[F.struct(s.alias("sum"), F.lit(p).alias("power")) for s, p in zip(sums, powers, strict=True)])

        def add(done: Column, part: Column) -> Column:
            total = part["sum"] + done["carry"]
            digit = total.bitwiseAND(F.lit((1 << self.bits) - 1))
            return F.struct(
                F.shiftright(total, self.bits).alias("carry"), (done["value"] + digit * part["power"]).alias("value")
            )

        def ended(done: Column) -> Column:
            top = _times_power(done["carry"].cast("double"), self.low + self.parts * self.bits)
            return F.when(done["carry"] >= 0, done["value"] + top)

        begin = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(0.0).alias("value"))
        return F.aggregate(parts, begin, add, ended)


def _lowest_digit(x: Column) -> Column:
    """An exponent of two that divides ``x``: 0, -10, or that of the last place of a double."""
    last = (F.floor(F.log2(F.abs(x))) - 54).cast("int")
    return F.when(x == F.rint(x), 0).when(x * 1024 == F.rint(x * 1024), -10).otherwise(last)


def scale_of(df: DataFrame, value: str) -> Scale:
    """The scale that fits a column. Runs a job."""
    return Scale.of(df.agg(*Scale.facts(F.col(value))).first())
