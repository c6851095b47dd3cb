"""Object ids and the text form of object cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Object types in output order, and the prefix of material ids.
OBJECT_TYPES = ("MAT", "PLA", "PO_ITEM", "SO_ITEM", "CUSTOMER", "SUPPLIER", "MAT_PLA")
MATERIAL_PREFIX = "MAT-"
# Types whose ids are unambiguous without their type name in front.
UNPREFIXED = ("MAT", "PLA", "MAT_PLA")


def whole_number_text(c: Column) -> Column:
    """A number as integer text: 12.0 reads ``12``."""
    return c.cast("bigint").cast("string")


def material_id(material: Column) -> Column:
    return F.concat(F.lit(MATERIAL_PREFIX), whole_number_text(material))


def pair_id(material: Column, plant: Column) -> Column:
    """Material and plant in one id; NULL without a plant."""
    return F.concat(material_id(material), F.lit("_"), plant)


def object_id(object_type: Column, name: Column) -> Column:
    """The id of an object in the log."""
    return F.when(object_type.isin(*UNPREFIXED), name).otherwise(F.concat(object_type, F.lit("--"), name))


def object_cell(object_type: str, name: Column, known: Column) -> Column:
    """One-element array with the object id where ``known`` is present, else NULL."""
    return F.when(known.isNotNull(), F.array(object_id(F.lit(object_type), name)))


# What a backslash stands before in a cell, and what follows it there.
_ESCAPES = (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"))


def encode_cell(cell: Column) -> Column:
    """Array cell as CSV text, e.g. ``['MAT-1', 'MAT-2']`` or ``[]``; a NULL element reads ``null``."""

    def quoted(element: Column) -> Column:
        for raw, escaped in _ESCAPES:
            element = F.replace(element, F.lit(raw), F.lit(escaped))
        return F.coalesce(F.concat(F.lit("'"), element, F.lit("'")), F.lit("null"))

    # Nearly all cells hold one plain id.
    only = F.when(F.size(cell) == 1, F.get(cell, F.lit(0)))
    plain = only.isNotNull() & ~reduce(Column.__or__, [only.contains(raw) for raw, _ in _ESCAPES])
    several = F.concat(F.lit("["), F.array_join(F.transform(cell, quoted), ", "), F.lit("]"))
    return F.when(plain, F.concat(F.lit("['"), only, F.lit("']"))).otherwise(several)


# The pieces of a cell: texts in quotes, words, marks.
_PIECES = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"\s,\[\]]+|[\s,\[\]]+|['"]"""


def _one_plain(text: Column) -> Column:
    """Whether a cell holds one id without escapes: its second quote is the last but one character."""
    closed = F.locate("'", text, 3) == F.length(text) - 1
    return text.startswith("['") & text.endswith("']") & closed & ~text.contains("\\")


def _without_none(text: Column) -> Column:
    """``None`` outside of quotes becomes ``null``, the word of the parser."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){_PIECES}"), F.lit(0))
    words = F.transform(pieces, lambda piece: F.when(piece == "None", "null").otherwise(piece))
    return F.when(text.contains("None"), F.array_join(words, "")).otherwise(text)


def decode_cell(text: Column) -> Column:
    """CSV text back to an array; a bare string becomes a one-element array.

    An element ``None`` or ``null`` is NULL. Text that starts a list and is none fails the job.
    """
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true", "mode": "FAILFAST"}
    # Not NULL for a list as written; a NULL result means text the parser gave up on.
    parsed = F.from_json(_without_none(text), "array<string>", options)
    broken = F.raise_error(F.concat(F.lit("not a list of objects: "), text)).cast("array<string>")
    return (
        F.when(_one_plain(text), F.array(F.substring(text, F.lit(3), F.length(text) - 4)))
        .when(text.startswith("["), F.coalesce(parsed, broken))
        .when(text.isNotNull(), F.array(text))
    )


def first_object(text: Column) -> Column:
    """The first object of a cell's text, NULL if it holds none."""
    return F.get(decode_cell(text), F.lit(0))
