"""Registered queries over the test tables and their DuckDB counterparts.

Every query stages the ERP tables from the raw parquet files and runs over all of them.
"""

from __future__ import annotations

import datetime as dt
import importlib
import warnings
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from stockweave.operators import demand, events, ocel, quality, stock
from stockweave.operators.running import SkewPolicy, find_hot_keys
from stockweave.plans import files, inventory
from stockweave.plans.inventory import JobSettings
from stockweave.session import materialise, scratch_path
from stockweave.sinks.event_log_csv import write_event_log
from stockweave.sinks.ocel_xml import write_ocel_xml
from stockweave.sources.contracts import CONTRACTS, SOFT_REFERENCES
from stockweave.sources.event_log_csv import read_event_log
from stockweave.sources.footers import file_columns
from stockweave.sources.ocel_xml import read_ocel_events, read_ocel_objects, read_ocel_relations
from stockweave.sources.staging import stage
from stockweave.sources.tables import Tables, file_schemas, read_tables, write_tables

AS_OF = dt.date(1997, 1, 1)
LEAP_DAY = dt.date(1996, 2, 29)
SETTINGS = JobSettings(as_of=AS_OF)
# Most materials are cut into chunks.
CHUNKED = JobSettings(as_of=AS_OF, skew=SkewPolicy(max_group_rows=30, sample_fraction=1.0))
CORRECTED = JobSettings(as_of=AS_OF, stock_after="running")

STOCK_COLUMNS = [
    "activity",
    "event_date",
    "material",
    "plant",
    "doc_key",
    "item_key",
    "quantity_change",
    "stock_before",
    "stock_after",
]
EVENT_COLUMNS = [
    "activity",
    "event_date",
    "material",
    "plant",
    "po_item",
    "so_item",
    "customer",
    "supplier",
    "quantity_change",
]


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text, arrays as their size and elements: forms both engines print alike."""

    def shown(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind.startswith("array"):
            return F.concat(F.size(column), F.lit(":"), F.array_join(column, "|", "NULL")).alias(name)
        return column.cast("string").alias(name) if kind == "date" else column

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def _hot(tables: Tables) -> DataFrame | None:
    return inventory.hot_materials(tables, SETTINGS.skew)


def _described(branch) -> Callable[[Tables], DataFrame]:
    return lambda tables: events.describe(branch(tables)).select(*EVENT_COLUMNS)


def _running(tables: Tables, rows: DataFrame | None = None) -> DataFrame:
    # Stored, as the scale and the sums both read them.
    return stock.running_stock(inventory.stored_events(tables, SETTINGS) if rows is None else rows, _hot(tables))


def _running_stock(tables: Tables) -> DataFrame:
    return events.describe(_running(tables)).select(*STOCK_COLUMNS)


def _of_quantities(change: Callable[[], Column], limit: int) -> Callable[[Tables], DataFrame]:
    """Running stock of other quantities, groups above ``limit`` rows cut into chunks."""

    def run(tables: Tables) -> DataFrame:
        policy = SkewPolicy(max_group_rows=limit, sample_fraction=1.0)
        rows = materialise(events.all_events(tables).withColumn("quantity_change", change()), "events")
        hot = find_hot_keys(rows.select("material"), policy)
        return events.describe(stock.running_stock(rows, hot)).select(*STOCK_COLUMNS)

    return run


def _with_decimals() -> Column:
    return F.round(F.col("quantity_change") * F.lit(0.7) + F.lit(0.1) * (F.col("item_key") % 3), 1)


def _any_double() -> Column:
    """Thirds, and among them numbers so large that a sum of doubles would lose the thirds."""
    large = F.when(F.col("item_key") % 7 == 0, F.lit(1e13)).when(F.col("item_key") % 7 == 1, F.lit(-1e13))
    return F.col("quantity_change") / 3 + F.coalesce(large, F.lit(0.0))


def _running_stock_complete(tables: Tables) -> DataFrame:
    return events.describe(stock.complete(_running(tables))).select(*STOCK_COLUMNS)


def _event_ids(tables: Tables) -> DataFrame:
    rows = inventory.stored_events(tables, SETTINGS)
    numbering = stock.number_events(rows, SETTINGS.skew)
    positioned = stock.with_position(_running(tables, rows), numbering.offsets)
    return events.describe(positioned).select(
        "activity",
        "material",
        "plant",
        "doc_key",
        "item_key",
        "position",
        inventory.event_id(F.col("position")).alias("eid"),
    )


def _stock_floor(tables: Tables) -> DataFrame:
    return stock.stock_floor(stock.complete(_running(tables)))


def _adjusted(settings: JobSettings) -> Callable[[Tables], DataFrame]:
    return lambda tables: inventory.adjusted(tables, settings).select(
        inventory.event_id(F.col("position")).alias("eid"),
        "material",
        "plant",
        "adding_stock",
        "stock_before",
        "stock_after",
    )


def _log(tables: Tables) -> DataFrame:
    return inventory.event_log(tables, SETTINGS)


def _relabelled(tables: Tables) -> DataFrame:
    return inventory.relabelled_event_log(tables, SETTINGS)


def _overstock_level(tables: Tables) -> DataFrame:
    return inventory.parameters(tables, SETTINGS).select(
        *demand.PAIR, "safety_stock", "eoq", demand.overstock_level()
    )


def _log_with_parameters(tables: Tables) -> DataFrame:
    return inventory.events_with_parameters(tables, SETTINGS).select(
        inventory.event_id(F.col("position")).alias("eid"),
        "activity",
        "material",
        "plant",
        "stock_before",
        "stock_after",
        "annual_demand",
        "average_daily_demand",
        "stddev_daily_demand",
        "average_lead_time",
        "eoq",
        "safety_stock",
        "reorder_point",
        "overstock_level",
    )


def _labels(branch: int) -> Callable[[Tables], DataFrame]:
    """The new labels of one activity."""
    return lambda tables: (
        inventory.relabelled_events(tables, SETTINGS)
        .where(F.col("branch") == branch)
        .select(
            inventory.event_id(F.col("position")).alias("eid"),
            "stock_before",
            "stock_after",
            "safety_stock",
            "overstock_level",
            F.col("activity").alias("label"),
        )
    )


def _csv_roundtrip(tables: Tables) -> DataFrame:
    spark = tables["Materials"].sparkSession
    path = scratch_path(spark, "event-log")
    files.write_log(tables, path, SETTINGS)
    return read_event_log(spark, path)


def _relabelled_csv_roundtrip(tables: Tables) -> DataFrame:
    spark = tables["Materials"].sparkSession
    log, out = scratch_path(spark, "event-log"), scratch_path(spark, "relabelled-log")
    files.write_log(tables, log, SETTINGS, ordered=False)
    files.write_relabelled_log(spark, tables, log, out, SETTINGS)
    return read_event_log(spark, out)


def _order_log(tables: Tables) -> DataFrame:
    """One row per purchase order: all its materials in one cell, no plant, the rest unknown."""
    items, documents = tables["PurchaseOrderItems"], tables["PurchaseOrderDocuments"]
    rows = (
        items.join(documents, items.purchase_order_number == documents.purchase_document_number)
        .groupBy("purchase_order_number", "purchase_order_date")
        .agg(
            F.array_sort(F.collect_list(F.concat(F.lit("MAT-"), F.col("material_number")))).alias("materials"),
            F.sum("quantity").alias("quantity"),
        )
    )
    known = {
        ocel.ACTIVITY: F.lit("Order"),
        ocel.TIMESTAMP: F.col("purchase_order_date"),
        ocel.object_column("MAT"): F.col("materials"),
        ocel.object_column("PLA"): F.array().cast("array<string>"),
        ocel.BEFORE: F.lit(0.0),
        ocel.AFTER: F.col("quantity"),
        ocel.EID: F.concat(F.lit("o"), F.col("purchase_order_number")),
    }
    empty = F.lit(None).cast("array<string>")
    return rows.select(*[known.get(c, empty).alias(c) for c in ocel.LOG_ORDER])


# Attributes of the wide log that are numbers.
WIDE_KINDS = {"Quantity": "double", "Document": "bigint"}


def _wide_log(tables: Tables) -> DataFrame:
    """The event log with two more object types, one of them with several objects, and two more attributes."""
    found = events.describe(inventory.adjusted(tables, SETTINGS))
    line = F.concat(F.col("doc_key").cast("string"), F.lit("-"), F.col("item_key").cast("string"))
    more = {
        ocel.object_column("DOC"): F.array(F.concat(F.lit("DOC--"), F.col("doc_key").cast("string"))),
        "Quantity": F.col("quantity_change"),
        ocel.object_column("LINE"): F.array(F.concat(F.lit("LINE--"), line), F.concat(F.lit("PLACE--"), F.col("plant"))),
        "Document": F.col("doc_key"),
    }
    return inventory.published(found.withColumns(more), list(more))


def _wide_csv(tables: Tables) -> str:
    path = scratch_path(tables["Materials"].sparkSession, "wide-log")
    write_event_log(_wide_log(tables), path)
    return path


def _wide_roundtrip(tables: Tables) -> DataFrame:
    return read_event_log(tables["Materials"].sparkSession, _wide_csv(tables), WIDE_KINDS)


def _relabelled_wide_roundtrip(tables: Tables) -> DataFrame:
    spark = tables["Materials"].sparkSession
    out = scratch_path(spark, "relabelled-log")
    files.write_relabelled_log(spark, tables, _wide_csv(tables), out, SETTINGS)
    return read_event_log(spark, out, WIDE_KINDS)


def _wide_xml(derive) -> Callable[[Tables], DataFrame]:
    """Relabelled wide log to XML and back."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["Materials"].sparkSession
        xml = scratch_path(spark, "wide-ocel")
        write_ocel_xml(_relabelled_wide_roundtrip(tables), xml)
        return derive(spark, xml)

    return run


def _multi_object_roundtrip(tables: Tables) -> DataFrame:
    spark = tables["Materials"].sparkSession
    path = scratch_path(spark, "order-log")
    write_event_log(_order_log(tables), path)
    return read_event_log(spark, path)


def _of_csv_log(derive, build) -> Callable[[Tables], DataFrame]:
    """Object tables of a log that was written to CSV and read again."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["Materials"].sparkSession
        path = scratch_path(spark, "event-log")
        write_event_log(build(tables), path)
        return derive(read_event_log(spark, path))

    return run


def _xml_roundtrip(read) -> Callable[[Tables], DataFrame]:
    """Relabelled log to CSV, the CSV to XML, and the XML read back."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["Materials"].sparkSession
        csv, xml = scratch_path(spark, "relabelled-log"), scratch_path(spark, "ocel")
        write_event_log(_relabelled(tables), csv)
        write_ocel_xml(read_event_log(spark, csv), xml)
        return read(spark, xml)

    return run


def _xml_of_tables(read) -> Callable[[Tables], DataFrame]:
    """The XML of the log in one pass over its events, read back."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["Materials"].sparkSession
        path = scratch_path(spark, "ocel")
        files.write_xml(tables, path, SETTINGS)
        return read(spark, path)

    return run


MOVED = ["GoodsReceiptsAndIssues", "PurchaseOrderItems", "PurchaseOrderDocuments"]


def _write_plain(tables: Tables, path: str, names: list[str]) -> None:
    """One folder of files per table, as another program would write them."""
    for name in names:
        tables[name].write.parquet(f"{path}/{name}")


def _stored(run: Callable[[Tables], DataFrame], write=write_tables) -> Callable[[Tables], DataFrame]:
    """Over tables that were written and are read again; :func:`write_tables` puts movements in months."""

    def over_files(tables: Tables) -> DataFrame:
        spark = tables["Materials"].sparkSession
        path = scratch_path(spark, "tables")
        write(tables, path, names=MOVED)
        return run(read_tables(spark, path, MOVED))

    return over_files


def _other_schema(tables: Tables) -> DataFrame:
    """The report over files in which a type, a column's presence and the number of columns differ."""
    spark = tables["Materials"].sparkSession
    path = scratch_path(spark, "tables")
    items = tables["PurchaseOrderItems"].withColumn("quantity", F.col("quantity").cast("string"))
    frames = {"PurchaseOrderItems": items.drop("change_date").withColumn("more", F.lit(1)), "Materials": tables["Materials"]}
    write_tables(frames, path)
    return quality.contract_report(file_schemas(spark, path, list(frames)))


def _schema_of_each_file(tables: Tables) -> DataFrame:
    """The report over a folder of which one file differs from the others."""
    spark = tables["Materials"].sparkSession
    path = scratch_path(spark, "tables")
    items = tables["PurchaseOrderItems"]
    for _ in range(2):
        items.coalesce(1).write.mode("append").parquet(f"{path}/PurchaseOrderItems")
    other = items.withColumn("quantity", F.col("quantity").cast("string")).drop("change_date").withColumn("more", F.lit(1))
    other.coalesce(1).write.mode("append").parquet(f"{path}/PurchaseOrderItems")
    tables["Materials"].coalesce(1).write.parquet(f"{path}/Materials")
    names = ("PurchaseOrderItems", "Materials")
    return quality.file_schema_report({name: file_columns(spark, f"{path}/{name}") for name in names})


def _broken(tables: Tables) -> Tables:
    """Tables with repeated and missing keys, and with references to rows that are not there."""
    items = tables["SalesOrderItems"]
    again = items.where("sales_document_number % 7 = 0")
    unknown = items.where("sales_document_number % 5 = 0").withColumn("item_number", F.lit(None).cast("bigint"))
    return Tables(
        {
            **tables,
            "SalesOrderItems": items.union(again).union(unknown),
            "SalesOrderDocuments": tables["SalesOrderDocuments"].where("sales_document_number % 3 <> 0"),
            "Materials": tables["Materials"].where("material_number % 4 <> 0"),
        }
    )


def _staged(table: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: tables[table]


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "stg_materials": _staged("Materials"),
    "stg_sales_order_documents": _staged("SalesOrderDocuments"),
    "stg_sales_order_items": _staged("SalesOrderItems"),
    "stg_purchase_order_documents": _staged("PurchaseOrderDocuments"),
    "stg_purchase_order_items": _staged("PurchaseOrderItems"),
    "stg_goods_movements": _staged("GoodsReceiptsAndIssues"),
    "stg_order_suggestions": _staged("OrderSuggestions"),
    "stg_purchase_requisitions": _staged("PurchaseRequisitions"),
    "stg_material_stocks": _staged("MaterialStocks"),
    "stg_sales_document_flows": _staged("SalesDocumentFlows"),
    "stg_material_documents": _staged("MaterialDocuments"),
    "dq_schema": quality.contract_report,
    "dq_primary_keys": quality.primary_key_report,
    "dq_foreign_keys": quality.foreign_key_report,
    "dq_soft_references": quality.soft_reference_report,
    "dq_schema_of_files": _other_schema,
    "dq_schema_of_each_file": _schema_of_each_file,
    "dq_primary_keys_broken": lambda tables: quality.primary_key_report(_broken(tables)),
    "dq_foreign_keys_broken": lambda tables: quality.foreign_key_report(_broken(tables)),
    "stock_changes": events.stock_changes,
    "ev_purchase_suggestion": _described(events.purchase_suggestions),
    "ev_purchase_order": _described(events.purchase_orders),
    "ev_goods_receipt": _described(events.goods_receipts),
    "ev_sales_order": _described(events.sales_orders),
    "ev_goods_issue": _described(events.goods_issues),
    "all_events": _described(events.all_events),
    "running_stock": _running_stock,
    "running_stock_fractional": _of_quantities(_with_decimals, SkewPolicy().max_group_rows),
    "running_stock_fractional_chunked": _of_quantities(_with_decimals, 30),
    "running_stock_any_double": _of_quantities(_any_double, SkewPolicy().max_group_rows),
    "running_stock_any_double_chunked": _of_quantities(_any_double, 30),
    "running_stock_complete": _running_stock_complete,
    "event_ids": _event_ids,
    "stock_floor": _stock_floor,
    "stock_adjusted": _adjusted(SETTINGS),
    "stock_adjusted_corrected": _adjusted(CORRECTED),
    "event_log": lambda tables: inventory.event_log(tables, SETTINGS, ordered=True),
    "event_log_chunked": lambda tables: inventory.event_log(tables, CHUNKED),
    "materials_plants": demand.materials_plants,
    "daily_demand": lambda tables: demand.daily_demand(tables, AS_OF),
    "demand_stats": lambda tables: demand.demand_stats(tables, AS_OF),
    "daily_demand_stored": _stored(lambda tables: demand.daily_demand(tables, AS_OF)),
    "lead_times_stored": _stored(lambda tables: demand.lead_times(tables, AS_OF)),
    "daily_demand_plain_files": _stored(lambda tables: demand.daily_demand(tables, AS_OF), _write_plain),
    "lead_times_plain_files": _stored(lambda tables: demand.lead_times(tables, AS_OF), _write_plain),
    "lead_times": lambda tables: demand.lead_times(tables, AS_OF),
    "daily_demand_leap_day": lambda tables: demand.daily_demand(tables, LEAP_DAY),
    "lead_times_leap_day": lambda tables: demand.lead_times(tables, LEAP_DAY),
    "replenishment_inputs": lambda tables: demand.replenishment_inputs(tables, AS_OF),
    "inventory_parameters": lambda tables: inventory.inventory_parameters(tables, SETTINGS, ordered=True),
    "overstock_level": _overstock_level,
    "log_with_parameters": _log_with_parameters,
    "label_goods_receipt": _labels(events.RECEIPT_BRANCH),
    "label_goods_issue": _labels(events.ISSUE_BRANCH),
    "label_sales_order": _labels(events.SALES_BRANCH),
    "label_purchase_order": _labels(events.PURCHASE_BRANCH),
    "label_purchase_suggestion": _labels(events.SUGGESTION_BRANCH),
    "relabelled_event_log": _relabelled,
    "ocel_events": lambda tables: ocel.ocel_events(_log(tables)),
    "ocel_relations": lambda tables: ocel.ocel_relations(_log(tables)),
    "ocel_objects": lambda tables: ocel.ocel_objects(_log(tables)),
    "ocel_summary": lambda tables: ocel.ocel_summary(_log(tables)),
    "ocel_objects_of_keys": lambda tables: inventory.log_objects(tables, SETTINGS),
    "ocel_summary_of_keys": lambda tables: inventory.log_summary(tables, SETTINGS),
    "ocel_xml_of_tables": _xml_of_tables(read_ocel_events),
    "ocel_xml_objects_of_tables": _xml_of_tables(read_ocel_objects),
    "post_ocel_events": lambda tables: ocel.ocel_events(_relabelled(tables)),
    "post_ocel_summary": lambda tables: ocel.ocel_summary(_relabelled(tables)),
    "event_log_csv_roundtrip": _csv_roundtrip,
    "relabelled_log_csv_roundtrip": _relabelled_csv_roundtrip,
    "multi_object_csv_roundtrip": _multi_object_roundtrip,
    "wide_log_csv_roundtrip": _wide_roundtrip,
    "relabelled_wide_log_csv_roundtrip": _relabelled_wide_roundtrip,
    "wide_ocel_summary": lambda tables: ocel.ocel_summary(_relabelled_wide_roundtrip(tables)),
    "wide_ocel_xml_events": _wide_xml(read_ocel_events),
    "wide_ocel_xml_relations": _wide_xml(read_ocel_relations),
    "csv_ocel_summary": _of_csv_log(ocel.ocel_summary, _log),
    "post_ocel_relations": _of_csv_log(ocel.ocel_relations, _relabelled),
    "post_ocel_objects": _of_csv_log(ocel.ocel_objects, _relabelled),
    "ocel_xml_roundtrip": _xml_roundtrip(read_ocel_events),
    "ocel_xml_relations_roundtrip": _xml_roundtrip(read_ocel_relations),
    "ocel_xml_objects_roundtrip": _xml_roundtrip(read_ocel_objects),
}


# Queries that read item numbers through one branch at most; the others store the
# numbered lines once and read them from there.
_ONE_BRANCH = {
    *(name for name in _QUERIES if name.startswith(("stg_", "ev_"))),
    "dq_foreign_keys",
    "stock_changes",
    "materials_plants",
    "daily_demand",
    "daily_demand_leap_day",
    "demand_stats",
}


def _over_staged(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(_QUERIES[name](stage(spark, sf_dir, SETTINGS.skew, name not in _ONE_BRANCH)))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The relabelled event log at sf0.001."""
    return queries()["relabelled_event_log"](spark, "/root/testdata/sf0.001")


def _optional() -> list[ModuleType]:
    """Modules with more queries, as far as they are there."""
    found = []
    for name in ("stockweave.llm.queries", "corpus_pipeline"):
        try:
            found.append(importlib.import_module(name))
        except ImportError as missing:
            # Also where a library is missing that only these modules need.
            if missing.name not in ("stockweave.llm", "stockweave.llm.queries", "corpus_pipeline"):
                warnings.warn(f"{name} is left out: {missing}", stacklevel=2)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _over_staged(name) for name in _QUERIES}
    for module in _optional():
        found |= module.queries()
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.build(CONTRACTS, SOFT_REFERENCES)
    for module in _optional():
        found |= module.oracle_sql()
    return found
