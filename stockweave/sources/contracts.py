"""Declared schemas, keys and references of the eleven ERP input tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LONG, DOUBLE, TEXT, DATE, FLAG = (
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.DateType(),
    T.BooleanType(),
)


@dataclass(frozen=True)
class Reference:
    """Columns of a child table that should exist as ``parent(parent_columns)``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[Reference, ...] = field(default=())


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_TO_MATERIAL = Reference(("material_number",), "Materials", ("material_number",))

# Table names, column names and keys of the input database.
CONTRACTS: dict[str, Contract] = {
    "SalesOrderDocuments": Contract(
        _schema(
            sales_document_number=LONG,
            document_creation_date=DATE,
            customer_number=LONG,
            document_date_in_document=DATE,
            sales_document_type=TEXT,
            order_type=TEXT,
            order_reason=TEXT,
        ),
        ("sales_document_number",),
    ),
    "SalesOrderItems": Contract(
        _schema(
            sales_document_number=LONG,
            item_number=LONG,
            material_number=LONG,
            plant=TEXT,
            order_quantity=DOUBLE,
            net_price=DOUBLE,
        ),
        ("sales_document_number", "item_number"),
        (
            Reference(("sales_document_number",), "SalesOrderDocuments", ("sales_document_number",)),
            _TO_MATERIAL,
        ),
    ),
    "Materials": Contract(
        _schema(
            material_number=LONG,
            material_type=TEXT,
            industry_sector=TEXT,
            material_group=TEXT,
            valuation_class=TEXT,
            gross_weight=DOUBLE,
            net_weight=DOUBLE,
            weight_unit=TEXT,
            volume=DOUBLE,
            volume_unit=TEXT,
            transport_group=TEXT,
        ),
        ("material_number",),
    ),
    "PurchaseRequisitions": Contract(
        _schema(
            client=TEXT,
            purchase_document_number=LONG,
            item_number_of_purchasing_document=LONG,
            purchase_requisition_number=LONG,
            purchase_requisition_item=LONG,
            purchase_requisition_date=DATE,
            document_type=TEXT,
            purchasing_document_category=TEXT,
            planned_delivery_time=LONG,
            latest_possible_goods_receipt=DATE,
            quantity=DOUBLE,
            unit_of_measure=TEXT,
        ),
        ("purchase_requisition_number",),
    ),
    "MaterialStocks": Contract(
        _schema(
            client=TEXT,
            material_number=LONG,
            plant=TEXT,
            storage_location=TEXT,
            stock_in_quality_inspection=DOUBLE,
            stock_in_transfer=DOUBLE,
            stock_in_posting=DOUBLE,
            stock_of_material_provided_to_vendor=DOUBLE,
            blocked_stock=DOUBLE,
            returns_stock=DOUBLE,
        ),
        ("material_number", "plant", "storage_location"),
        (_TO_MATERIAL,),
    ),
    "GoodsReceiptsAndIssues": Contract(
        _schema(
            client=TEXT,
            purchase_document_number=LONG,
            line_item_in_purchase_document=LONG,
            sequential_number_of_account_assignment=LONG,
            movement_type=TEXT,
            fiscal_year=LONG,
            document_number=LONG,
            accounting_document_line=LONG,
            material_number=LONG,
            plant=TEXT,
            reference_document_number=LONG,
            document_date_in_document=DATE,
            posting_date_in_the_document=DATE,
            date_of_the_posting_in_the_document=DATE,
            time_of_the_posting_in_the_document=TEXT,
            quantity=DOUBLE,
        ),
        (),
        (_TO_MATERIAL,),
    ),
    "SalesDocumentFlows": Contract(
        _schema(
            client=TEXT,
            sales_document=LONG,
            sales_document_item=LONG,
            subsequent_sales_document=LONG,
            subsequent_sales_document_item=LONG,
            document_category_of_subsequent_document=TEXT,
            document_category_of_preceding_document=TEXT,
            document_date=DATE,
        ),
        (
            "sales_document",
            "sales_document_item",
            "subsequent_sales_document",
            "subsequent_sales_document_item",
        ),
        (Reference(("sales_document",), "SalesOrderDocuments", ("sales_document_number",)),),
    ),
    "PurchaseOrderItems": Contract(
        _schema(
            purchase_order_number=LONG,
            purchase_order_item_number=LONG,
            material_number=LONG,
            plant=TEXT,
            quantity=DOUBLE,
            change_date=DATE,
            net_price=DOUBLE,
        ),
        ("purchase_order_number", "purchase_order_item_number"),
        (
            Reference(("purchase_order_number",), "PurchaseOrderDocuments", ("purchase_document_number",)),
            _TO_MATERIAL,
        ),
    ),
    "PurchaseOrderDocuments": Contract(
        _schema(
            purchase_document_number=LONG,
            record_creation_date=DATE,
            account_number_of_vendor=LONG,
            purchase_order_date=DATE,
            purchasing_document_category=TEXT,
            purchasing_document_type=TEXT,
            blocking_indicator=FLAG,
        ),
        ("purchase_document_number",),
    ),
    "MaterialDocuments": Contract(
        _schema(
            client=TEXT,
            material_document_number=LONG,
            material_document_year=LONG,
            line_item=LONG,
            material_number=LONG,
            plant=TEXT,
            storage_location=TEXT,
            vendors_account_number=LONG,
            customer_number=LONG,
            movement_type=TEXT,
            receiving_plant=TEXT,
            quantity=DOUBLE,
            posting_date_in_the_document=DATE,
        ),
        ("material_document_number", "material_document_year", "line_item"),
        (_TO_MATERIAL,),
    ),
    "OrderSuggestions": Contract(
        _schema(
            order_number=LONG,
            order_position=LONG,
            article_number=LONG,
            order_quantity=DOUBLE,
            date=DATE,
            order_date=DATE,
            delivery_date=DATE,
            plant=TEXT,
        ),
        ("order_number", "order_position"),
        (Reference(("article_number",), "Materials", ("material_number",)),),
    ),
}

# References the event and lead-time joins rely on although no key declares them.
SOFT_REFERENCES: tuple[tuple[str, Reference], ...] = (
    (
        "GoodsReceiptsAndIssues",
        Reference(("purchase_document_number",), "PurchaseOrderDocuments", ("purchase_document_number",)),
    ),
    (
        "GoodsReceiptsAndIssues",
        Reference(
            ("purchase_document_number", "line_item_in_purchase_document"),
            "PurchaseOrderItems",
            ("purchase_order_number", "purchase_order_item_number"),
        ),
    ),
)


class ContractError(ValueError):
    """A table does not have the columns its contract declares."""


def differences(name: str, schema: T.StructType) -> list[str]:
    """What separates ``schema`` from the contract of table ``name``; empty if nothing does."""
    actual = {f.name: f.dataType for f in schema.fields}
    found = []
    for expected in CONTRACTS[name].schema.fields:
        kind = actual.pop(expected.name, None)
        if kind is None:
            found.append(f"{name}.{expected.name} is missing")
        elif kind != expected.dataType:
            found.append(
                f"{name}.{expected.name} is {kind.simpleString()}, not {expected.dataType.simpleString()}"
            )
    found.extend(f"{name}.{extra} is not declared" for extra in actual)
    return found


def conform(name: str, df: DataFrame) -> DataFrame:
    """``df`` in contract column order; raises before any row is read if it does not fit."""
    problems = differences(name, df.schema)
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(*CONTRACTS[name].schema.fieldNames())
