"""The jobs a user runs: event log, parameters and relabelled log from the ERP tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.objects import OBJECT_TYPES, material_id, object_cell, pair_id
from stockweave.operators import demand, object_index
from stockweave.operators.demand import ReplenishmentPolicy
from stockweave.operators.events import all_events, describe, material_keys, receipts
from stockweave.operators.ocel import ACTIVITY, AFTER, BEFORE, EID, LOG_ORDER, TIMESTAMP, object_column
from stockweave.operators.relabel import relabel
from stockweave.operators.running import SkewPolicy, find_hot_keys
from stockweave.operators.stock import StockAfter, adjusted_events, number_events
from stockweave.session import materialise
from stockweave.sources.tables import Tables


@dataclass(frozen=True)
class JobSettings:
    """``as_of`` ends the demand year (the day the job runs if None)."""

    as_of: dt.date | None = None
    stock_after: StockAfter = "reference"
    replenishment: ReplenishmentPolicy = field(default_factory=ReplenishmentPolicy)
    skew: SkewPolicy = field(default_factory=SkewPolicy)


# Published column names of the log and of the parameters.
LOG_COLUMNS = {
    "activity": ACTIVITY,
    "event_date": TIMESTAMP,
    "stock_before": BEFORE,
    "stock_after": AFTER,
    "eid": EID,
}
PARAMETER_COLUMNS = {
    "material_number": "Material Number",
    "plant": "Plant",
    "annual_demand": "Annual Demand (D_m)",
    "average_daily_demand": "Average Daily Demand (d_m)",
    "stddev_daily_demand": "Std Dev of Daily Demand (σ_m)",
    "average_lead_time": "Average Lead Time (l_m)",
    "eoq": "EOQ",
    "safety_stock": "Safety Stock (SS)",
    "reorder_point": "Reorder Point (ROP)",
}


def hot_materials(tables: Tables, skew: SkewPolicy = SkewPolicy()) -> DataFrame | None:
    """Materials with too many events for one task."""
    return find_hot_keys(material_keys(tables), skew)


def hot_documents(tables: Tables, skew: SkewPolicy = SkewPolicy()) -> DataFrame | None:
    """Purchase documents with too many receipts for one task; none is looked for where there are too few rows."""
    if tables["GoodsReceiptsAndIssues"].count() <= skew.max_group_rows:
        return None
    return find_hot_keys(receipts(tables).select("purchase_document_number"), skew)


def stored_events(tables: Tables, settings: JobSettings = JobSettings()) -> DataFrame:
    """All narrow events, joined together once and stored. Runs jobs at once."""
    return materialise(all_events(tables, hot_documents(tables, settings.skew)), "events")


def adjusted(
    tables: Tables,
    settings: JobSettings = JobSettings(),
    parameters: DataFrame | None = None,
    ordered: bool = False,
    events: DataFrame | None = None,
) -> DataFrame:
    """Narrow events with position, adjusted stock and, where given, the parameters of their pair.

    ``ordered`` sorts by material and event order. Unless given as ``events``, the events are
    stored first, as counting and running sums both read them; so this runs jobs at once, before any
    action on the result.
    """
    events = stored_events(tables, settings) if events is None else events
    numbering = number_events(events, settings.skew)
    return adjusted_events(events, numbering, settings.stock_after, parameters, ordered)


def event_id(position) -> F.Column:
    return F.concat(F.lit("e"), position.cast("string"))


def published(events: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Described events in the published columns of the log, and those of ``more`` after them."""
    material, plant = F.col("material"), F.col("plant")
    cells = {
        "MAT": object_cell("MAT", material_id(material), material),
        "PLA": object_cell("PLA", plant, plant),
        "MAT_PLA": object_cell("MAT_PLA", pair_id(material, plant), plant),
    }
    for object_type in ("PO_ITEM", "SO_ITEM", "CUSTOMER", "SUPPLIER"):
        name = F.col(object_type.lower())
        cells[object_type] = object_cell(object_type, name, name)
    cells = {object_column(t): cells[t] for t in OBJECT_TYPES}
    return (
        events.withColumns({**cells, "eid": event_id(F.col("position"))})
        .withColumnsRenamed(LOG_COLUMNS)
        .select(*[f"`{c}`" for c in (*LOG_ORDER, *more)])
    )


def event_log(
    tables: Tables, settings: JobSettings = JobSettings(), ordered: bool = False, events: DataFrame | None = None
) -> DataFrame:
    """The object-centric event log. ``events`` may give the stored events."""
    return published(describe(adjusted(tables, settings, ordered=ordered, events=events)))


def log_index(tables: Tables, settings: JobSettings = JobSettings(), events: DataFrame | None = None) -> DataFrame:
    """Activities and objects of the event log as narrow keys, without building the log."""
    return object_index.index(stored_events(tables, settings) if events is None else events)


def log_objects(tables: Tables, settings: JobSettings = JobSettings()) -> DataFrame:
    """Distinct (id, type) of the objects of the event log: ``ocel_objects`` of it, from keys."""
    return object_index.objects(log_index(tables, settings))


def log_summary(tables: Tables, settings: JobSettings = JobSettings()) -> DataFrame:
    """``ocel_summary`` of the event log, from keys."""
    return object_index.summary(log_index(tables, settings))


def parameters(tables: Tables, settings: JobSettings = JobSettings()) -> DataFrame:
    """Replenishment parameters per material and plant, in engine column names."""
    return demand.replenishment_parameters(
        demand.replenishment_inputs(tables, settings.as_of, settings.replenishment)
    )


def inventory_parameters(
    tables: Tables, settings: JobSettings = JobSettings(), ordered: bool = False
) -> DataFrame:
    """The parameters in published column names, on request sorted by material and plant."""
    found = parameters(tables, settings)
    if ordered:
        found = found.orderBy(*demand.PAIR)
    return found.withColumnsRenamed(PARAMETER_COLUMNS)


def _pair_parameters(tables: Tables, settings: JobSettings) -> DataFrame:
    found = parameters(tables, settings).withColumnRenamed("material_number", "material")
    return found.select("*", demand.overstock_level())


def events_with_parameters(
    tables: Tables, settings: JobSettings = JobSettings(), ordered: bool = False
) -> DataFrame:
    """Described events with all parameters of their pair and the overstock level."""
    return describe(adjusted(tables, settings, _pair_parameters(tables, settings), ordered))


def relabelled_events(
    tables: Tables, settings: JobSettings = JobSettings(), ordered: bool = False
) -> DataFrame:
    """Described events with the bounds of their pair and the new activity."""
    bounds = _pair_parameters(tables, settings).select(
        "material", "plant", "safety_stock", "overstock_level"
    )
    return relabel(describe(adjusted(tables, settings, bounds, ordered)))


def relabelled_event_log(
    tables: Tables, settings: JobSettings = JobSettings(), ordered: bool = False
) -> DataFrame:
    """The event log with every activity labelled by stock band."""
    return published(relabelled_events(tables, settings, ordered))
