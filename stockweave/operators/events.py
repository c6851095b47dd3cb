"""The five event branches and their union.

Events travel in a narrow form: one row per event with keys, date and quantity only.
Activity names and item ids follow from ``branch`` and the document keys, so
:func:`describe` adds them after the shuffle instead of carrying them through it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.operators.joins import spread_left_join
from stockweave.sources.tables import Tables

# Movement types, activity names, and the branch order that breaks same-day ties.
RECEIPT, ISSUE = "Goods Receipt", "Goods Issue"
ACTIVITIES = (
    "Create Purchase Suggestion Item",
    "Create Purchase Order Item",
    "Goods Receipt",
    "Create Sales Order Item",
    "Goods Issue",
)
SUGGESTION_BRANCH, PURCHASE_BRANCH, RECEIPT_BRANCH, SALES_BRANCH, ISSUE_BRANCH = range(5)

# Order of the events of one material. The columns after item_key only separate
# events that share all document keys, so that equal rows are interchangeable.
EVENT_ORDER = [
    "event_date",
    "branch",
    "doc_key",
    "item_key",
    "document_number",
    "plant",
    "quantity_change",
    "party",
]


def _events(
    df: DataFrame,
    branch: int,
    date: str,
    doc_key: str,
    item_key: str,
    change: Column,
    material: str = "material_number",
    party: str | None = None,
    document_number: str | None = None,
) -> DataFrame:
    """Narrow event rows; ``party`` is the vendor or customer the branch refers to."""

    def optional(name: str | None) -> Column:
        return F.col(name) if name else F.lit(None).cast("bigint")

    return df.where(F.col(material).isNotNull()).select(
        F.lit(branch).alias("branch"),
        F.col(date).alias("event_date"),
        F.col(material).alias("material"),
        F.col("plant"),
        F.col(doc_key).alias("doc_key"),
        F.col(item_key).alias("item_key"),
        optional(document_number).alias("document_number"),
        optional(party).alias("party"),
        change.cast("double").alias("quantity_change"),
    )


def _movements(tables: Tables, kind: str) -> DataFrame:
    return tables["GoodsReceiptsAndIssues"].where(F.col("movement_type") == kind)


def stock_changes(tables: Tables) -> DataFrame:
    """Signed quantity of every movement; types other than receipt and issue count 0."""
    kind, quantity = F.col("movement_type"), F.col("quantity")
    return tables["GoodsReceiptsAndIssues"].select(
        "material_number",
        F.col("date_of_the_posting_in_the_document").alias("event_time"),
        F.when(kind == RECEIPT, quantity)
        .when(kind == ISSUE, -quantity)
        .otherwise(F.lit(0.0))
        .alias("quantity_change"),
    )


def purchase_suggestions(tables: Tables) -> DataFrame:
    return _events(
        tables["OrderSuggestions"],
        SUGGESTION_BRANCH,
        date="date",
        material="article_number",
        doc_key="order_number",
        item_key="order_position",
        change=F.lit(0.0),
    )


def purchase_orders(tables: Tables) -> DataFrame:
    items, documents = tables["PurchaseOrderItems"], tables["PurchaseOrderDocuments"]
    return _events(
        items.join(documents, items.purchase_order_number == documents.purchase_document_number),
        PURCHASE_BRANCH,
        date="purchase_order_date",
        doc_key="purchase_order_number",
        item_key="purchase_order_item_number",
        party="account_number_of_vendor",
        change=F.lit(0.0),
    )


def receipts(tables: Tables) -> DataFrame:
    return _movements(tables, RECEIPT)


def goods_receipts(tables: Tables, hot_documents: DataFrame | None = None) -> DataFrame:
    """Receipts keep their row when the purchase document is unknown; the supplier is then NULL.

    Receipts of ``hot_documents``, and those without a document, are spread over tasks.
    """
    vendors = tables["PurchaseOrderDocuments"].select(
        "purchase_document_number", "account_number_of_vendor"
    )
    spread = ["material_number", "document_number", "line_item_in_purchase_document", "quantity"]
    return _events(
        spread_left_join(receipts(tables), vendors, "purchase_document_number", spread, hot_documents),
        RECEIPT_BRANCH,
        date="date_of_the_posting_in_the_document",
        doc_key="purchase_document_number",
        item_key="line_item_in_purchase_document",
        document_number="document_number",
        party="account_number_of_vendor",
        change=F.col("quantity"),
    )


def sales_orders(tables: Tables) -> DataFrame:
    return _events(
        tables["SalesOrderItems"].join(tables["SalesOrderDocuments"], "sales_document_number"),
        SALES_BRANCH,
        date="document_creation_date",
        doc_key="sales_document_number",
        item_key="item_number",
        party="customer_number",
        change=F.lit(0.0),
    )


def goods_issues(tables: Tables) -> DataFrame:
    """The customer of an issue is its reference document number; issues link to no order item."""
    return _events(
        _movements(tables, ISSUE),
        ISSUE_BRANCH,
        date="date_of_the_posting_in_the_document",
        doc_key="purchase_document_number",
        item_key="line_item_in_purchase_document",
        document_number="document_number",
        party="reference_document_number",
        change=-F.col("quantity"),
    )


def all_events(tables: Tables, hot_documents: DataFrame | None = None) -> DataFrame:
    """UNION ALL of the five branches."""
    branches = [
        purchase_suggestions(tables),
        purchase_orders(tables),
        goods_receipts(tables, hot_documents),
        sales_orders(tables),
        goods_issues(tables),
    ]
    return reduce(DataFrame.unionByName, branches)


def material_keys(tables: Tables) -> DataFrame:
    """One ``material`` row per source row an event may come from; joins nothing."""
    columns = [
        ("OrderSuggestions", "article_number"),
        ("PurchaseOrderItems", "material_number"),
        ("GoodsReceiptsAndIssues", "material_number"),
        ("SalesOrderItems", "material_number"),
    ]
    return reduce(
        DataFrame.union, [tables[table].select(F.col(c).alias("material")) for table, c in columns]
    )


def _in(*branches: int) -> Column:
    return F.col("branch").isin(*branches)


def describe(events: DataFrame) -> DataFrame:
    """Add the activity and the raw object columns a narrow event stands for."""
    activity = F.element_at(F.array(*map(F.lit, ACTIVITIES)), F.col("branch") + 1)
    # concat gives NULL as soon as one part is NULL.
    item = F.concat(F.col("doc_key").cast("string"), F.lit("-"), F.col("item_key").cast("string"))
    party = F.col("party").cast("string")
    return events.withColumns(
        {
            "activity": activity,
            "po_item": F.when(_in(PURCHASE_BRANCH, RECEIPT_BRANCH), item),
            "so_item": F.when(_in(SALES_BRANCH), item),
            "customer": F.when(_in(SALES_BRANCH, ISSUE_BRANCH), party),
            "supplier": F.when(_in(PURCHASE_BRANCH, RECEIPT_BRANCH), party),
        }
    )
