"""The ERP tables as projections of the order/line-item test tables.

Even order keys are purchases, odd ones sales. A line has no unique number in the
test data, so lines are numbered within their order.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave.operators.running import SkewPolicy, find_hot_keys, scan
from stockweave.session import materialise, spread_by
from stockweave.sources.contracts import CONTRACTS
from stockweave.sources.tables import Tables

LONG, INT, DOUBLE, TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
CLOCK = T.TimestampNTZType()

# Columns that a mapping uses.
RAW = {
    "part": [
        ("p_partkey", LONG),
        ("p_name", TEXT),
        ("p_brand", TEXT),
        ("p_type", TEXT),
        ("p_size", INT),
        ("p_retailprice", DOUBLE),
    ],
    "orders": [
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", TEXT),
        ("o_orderdate", CLOCK),
        ("o_orderpriority", TEXT),
    ],
    "lineitem": [
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", DOUBLE),
        ("l_extendedprice", DOUBLE),
        ("l_returnflag", TEXT),
        ("l_shipdate", CLOCK),
    ],
}

# Total order of the lines of one order; the flag only separates copies.
LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_returnflag",
]

# SQL over the raw columns, shared by several tables below.
PLANT = "concat('Plant', l_suppkey % 5 + 1)"
CLIENT = "concat('Client', l_suppkey % 5 + 1)"
BOUGHT, SOLD = "l_orderkey % 2 = 0", "l_orderkey % 2 = 1"
MOVED = f"({BOUGHT} AND l_returnflag <> 'R') OR {SOLD}"
MOVEMENT = (
    f"CASE WHEN {BOUGHT} THEN 'Goods Receipt' WHEN l_returnflag = 'N' THEN 'Goods Issue' ELSE 'Transfer' END"
)
ORDERED, SHIPPED = "CAST(o_orderdate AS DATE)", "CAST(l_shipdate AS DATE)"
SUGGESTED = f"date_sub({ORDERED}, 7)"
PLANNED_DAYS = "o_custkey % 30 + 1"

# Per ERP table: the raw frame, its filter, and one SQL expression per contract column.
MAPPINGS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "Materials": (
        "part",
        None,
        {
            "material_number": "p_partkey",
            "material_type": "p_type",
            "industry_sector": "p_name",
            "material_group": "p_brand",
            "valuation_class": "concat('ValClass', p_partkey % 3 + 1)",
            "gross_weight": "p_size",
            "net_weight": "p_size",
            "weight_unit": "'kg'",
            "volume": "p_retailprice",
            "volume_unit": "'m3'",
            "transport_group": "concat('TG', p_partkey % 3 + 1)",
        },
    ),
    "SalesOrderDocuments": (
        "orders",
        "o_orderkey % 2 = 1",
        {
            "sales_document_number": "o_orderkey",
            "document_creation_date": ORDERED,
            "customer_number": "o_custkey",
            "document_date_in_document": ORDERED,
            "sales_document_type": "o_orderstatus",
            "order_type": "o_orderpriority",
            "order_reason": "o_orderpriority",
        },
    ),
    "SalesOrderItems": (
        "lines",
        SOLD,
        {
            "sales_document_number": "l_orderkey",
            "item_number": "item",
            "material_number": "l_partkey",
            "plant": PLANT,
            "order_quantity": "l_quantity",
            "net_price": "l_extendedprice",
        },
    ),
    "PurchaseOrderDocuments": (
        "orders",
        "o_orderkey % 2 = 0",
        {
            "purchase_document_number": "o_orderkey",
            "record_creation_date": ORDERED,
            "account_number_of_vendor": "o_custkey % 10",
            "purchase_order_date": ORDERED,
            "purchasing_document_category": "o_orderstatus",
            "purchasing_document_type": "o_orderpriority",
            "blocking_indicator": "o_orderstatus = 'P'",
        },
    ),
    "PurchaseOrderItems": (
        "lines",
        BOUGHT,
        {
            "purchase_order_number": "l_orderkey",
            "purchase_order_item_number": "item",
            "material_number": "l_partkey",
            "plant": PLANT,
            "quantity": "l_quantity",
            "change_date": SHIPPED,
            "net_price": "l_extendedprice",
        },
    ),
    "GoodsReceiptsAndIssues": (
        "lines",
        MOVED,
        {
            "client": CLIENT,
            "purchase_document_number": "l_orderkey",
            "line_item_in_purchase_document": "item",
            "sequential_number_of_account_assignment": "l_linenumber",
            "movement_type": MOVEMENT,
            "fiscal_year": f"year({SHIPPED})",
            "document_number": "l_orderkey",
            "accounting_document_line": "item",
            "material_number": "l_partkey",
            "plant": PLANT,
            "reference_document_number": "l_orderkey",
            "document_date_in_document": SHIPPED,
            "posting_date_in_the_document": SHIPPED,
            "date_of_the_posting_in_the_document": SHIPPED,
            "time_of_the_posting_in_the_document": "'00:00:00'",
            "quantity": "l_quantity",
        },
    ),
    "OrderSuggestions": (
        "dated_lines",
        f"{BOUGHT} AND l_returnflag = 'R'",
        {
            "order_number": "l_orderkey",
            "order_position": "item",
            "article_number": "l_partkey",
            "order_quantity": "l_quantity",
            "date": SUGGESTED,
            "order_date": SUGGESTED,
            "delivery_date": f"date_add({SUGGESTED}, 14)",
            "plant": PLANT,
        },
    ),
    "PurchaseRequisitions": (
        "orders",
        "o_orderkey % 2 = 0",
        {
            "client": "concat('Client', o_custkey % 5 + 1)",
            "purchase_document_number": "o_orderkey",
            "item_number_of_purchasing_document": "1",
            "purchase_requisition_number": "o_orderkey",
            "purchase_requisition_item": "1",
            "purchase_requisition_date": ORDERED,
            "document_type": "o_orderpriority",
            "purchasing_document_category": "o_orderstatus",
            "planned_delivery_time": PLANNED_DAYS,
            "latest_possible_goods_receipt": f"date_add({ORDERED}, CAST({PLANNED_DAYS} AS INT))",
            "quantity": "o_custkey % 100 + 1",
            "unit_of_measure": "'PCS'",
        },
    ),
    "MaterialStocks": (
        "part",
        None,
        {
            "client": "concat('Client', p_partkey % 5 + 1)",
            "material_number": "p_partkey",
            "plant": "concat('Plant', p_partkey % 5 + 1)",
            "storage_location": "concat('Storage', p_partkey % 10 + 1)",
            "stock_in_quality_inspection": "p_size",
            "stock_in_transfer": "p_size",
            "stock_in_posting": "p_size",
            "stock_of_material_provided_to_vendor": "p_size",
            "blocked_stock": "p_size",
            "returns_stock": "p_size",
        },
    ),
    "SalesDocumentFlows": (
        "lines",
        SOLD,
        {
            "client": CLIENT,
            "sales_document": "l_orderkey",
            "sales_document_item": "item",
            "subsequent_sales_document": "l_orderkey",
            "subsequent_sales_document_item": "item",
            "document_category_of_subsequent_document": (
                "CASE l_returnflag WHEN 'N' THEN 'Delivery' WHEN 'R' THEN 'Credit Memo' ELSE 'Invoice' END"
            ),
            "document_category_of_preceding_document": "'Order'",
            "document_date": SHIPPED,
        },
    ),
    "MaterialDocuments": (
        "lines",
        MOVED,
        {
            "client": CLIENT,
            "material_document_number": "l_orderkey",
            "material_document_year": f"year({SHIPPED})",
            "line_item": "item",
            "material_number": "l_partkey",
            "plant": PLANT,
            "storage_location": "concat('Storage', l_partkey % 10 + 1)",
            "vendors_account_number": "l_suppkey",
            "customer_number": "l_orderkey % 50 + 1",
            "movement_type": MOVEMENT,
            "receiving_plant": PLANT,
            "quantity": "l_quantity",
            "posting_date_in_the_document": SHIPPED,
        },
    ),
}


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(column, kind) for column, kind in RAW[name]])
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def numbered_lines(lineitem: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Line items with ``item``, their 1-based position within the order."""
    hot = find_hot_keys(lineitem.select("l_orderkey"), policy)
    # Rows of parquet files are counted from their footers.
    lines = scan(spread_by(lineitem, "l_orderkey", lineitem.count()), "l_orderkey", LINE_ORDER, hot=hot)
    return lines.withColumn("item", F.col("seq") + 1).drop("seq")


class RawFrames:
    """The frames the mappings select from, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, policy: SkewPolicy, store_lines: bool):
        self._read = partial(read_raw, spark, folder)
        self._policy = policy
        self._store_lines = store_lines

    @cached_property
    def part(self) -> DataFrame:
        return self._read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")

    @cached_property
    def lines(self) -> DataFrame:
        lines = numbered_lines(self._read("lineitem"), self._policy)
        # Used as long as the tables are, so not tied to the job that asks first.
        return materialise(lines, "lines", scoped=False) if self._store_lines else lines

    @cached_property
    def dated_lines(self) -> DataFrame:
        return self.lines.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def stage(
    spark: SparkSession, folder: str, policy: SkewPolicy = SkewPolicy(), store_lines: bool = False
) -> Tables:
    """All eleven tables as lazy projections of ``part``, ``orders`` and ``lineitem``.

    ``store_lines`` writes the numbered lines to the shared folder at first use. It pays off
    when several tables take item numbers from them: the lines are then shuffled once
    instead of once per table.
    """
    raw = RawFrames(spark, folder, policy, store_lines)

    def table(name: str) -> DataFrame:
        source, condition, columns = MAPPINGS[name]
        rows = getattr(raw, source)
        if condition:
            rows = rows.where(condition)
        return rows.selectExpr(
            *[
                f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in CONTRACTS[name].schema.fields
            ]
        )

    return Tables({name: partial(table, name) for name in CONTRACTS})
