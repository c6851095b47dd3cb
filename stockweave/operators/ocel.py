"""The object-centric log as event, relation and object tables, and its summary.

Input is a log in its published form: ``ocel:*`` columns with object cells as arrays. What a log
holds follows from its columns: every ``ocel:type:<name>`` is an object type, and every column
besides those, the id, the activity and the time is an attribute of its events.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.objects import OBJECT_TYPES

EID, ACTIVITY, TIMESTAMP = "ocel:eid", "ocel:activity", "ocel:timestamp"
OID, TYPE = "ocel:oid", "ocel:type"
BEFORE, AFTER = "Stock Before", "Stock After"


def object_column(object_type: str) -> str:
    return f"{TYPE}:{object_type}"


# Columns of the log of this library, in output order.
LOG_ORDER = [
    ACTIVITY,
    TIMESTAMP,
    *[object_column(t) for t in OBJECT_TYPES[:-1]],
    BEFORE,
    AFTER,
    object_column(OBJECT_TYPES[-1]),
    EID,
]


def object_types(columns: Iterable[str]) -> list[str]:
    """The object types of a log, in the order of its columns."""
    prefix = object_column("")
    return [c.removeprefix(prefix) for c in columns if c.startswith(prefix)]


def attributes(columns: Iterable[str]) -> list[str]:
    """The attributes of the events of a log, in the order of its columns."""
    return [c for c in columns if c not in (EID, ACTIVITY, TIMESTAMP) and not c.startswith(object_column(""))]


def object_lists(log: DataFrame) -> list[Column]:
    """Per object type a struct (type, ids) of the objects of an event."""
    types = object_types(log.columns)
    if not types:
        return [F.struct(F.lit("").alias("type"), F.lit(None).cast("array<string>").alias("ids"))]
    return [F.struct(F.lit(t).alias("type"), F.col(f"`{object_column(t)}`").alias("ids")) for t in types]


def ocel_events(log: DataFrame) -> DataFrame:
    return log.select(EID, ACTIVITY, TIMESTAMP, *[f"`{name}`" for name in attributes(log.columns)])


def _relations(log: DataFrame, *kept: str) -> DataFrame:
    """One row per event and object with the ``kept`` columns; missing objects leave no row."""
    by_type = log.select(*kept, F.explode(F.array(*object_lists(log))).alias("o"))
    return by_type.select(*kept, F.explode("o.ids").alias(OID), F.col("o.type").alias(TYPE))


def ocel_relations(log: DataFrame) -> DataFrame:
    """One row per event and object."""
    return _relations(log, EID, ACTIVITY, TIMESTAMP)


def ocel_objects(log: DataFrame) -> DataFrame:
    """Distinct (id, type) of all objects that take part in an event."""
    return _relations(log).distinct()


def ocel_summary(log: DataFrame) -> DataFrame:
    """(section, name, value): events per activity, objects per type, and the totals.

    One pass: an event gives one row for its activity and one per object, and the first
    aggregation already brings both down to distinct names before anything is shuffled.
    """
    activity = F.struct(
        F.lit("events").alias("section"),
        F.col(f"`{ACTIVITY}`").alias("name"),
        F.array(F.lit(None).cast("string")).alias("ids"),
    )
    objects = [
        F.struct(F.lit("objects").alias("section"), o["type"].alias("name"), o["ids"].alias("ids"))
        for o in object_lists(log)
    ]
    counted = (
        log.select(F.explode(F.array(activity, *objects)).alias("x"))
        .select("x.section", "x.name", F.explode("x.ids").alias("oid"))
        .groupBy("section", "name", "oid")
        .agg(F.count("*").alias("n"))
    )
    per_name = counted.groupBy("section", "name").agg(
        F.sum(F.when(F.col("section") == "events", F.col("n")).otherwise(F.lit(1))).alias("value"),
    )
    return with_totals(per_name)


def with_totals(per_name: DataFrame) -> DataFrame:
    """Adds the totals of events and objects and the numbers of activities and object types."""
    # One row per activity and per object type from here on.
    section, names = F.col("section"), F.when(F.col("section") == "events", "activities").otherwise("object types")
    lines = F.array(
        F.struct(section, F.col("name"), F.col("value")),
        F.struct(section, F.lit("total").alias("name"), F.col("value")),
        F.struct(names.alias("section"), F.lit("total").alias("name"), F.lit(1).cast("bigint").alias("value")),
    )
    spread = per_name.select(F.explode(lines).alias("x")).select("x.*")
    return spread.groupBy("section", "name").agg(F.sum("value").alias("value"))
