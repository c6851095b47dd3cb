"""Contract, key and reference reports on rows with known violations."""

from __future__ import annotations

import pytest
from conftest import movement, purchase, purchase_item, sale_item
from pyspark.sql import functions as F

from stockweave.operators import quality
from stockweave.sources.contracts import CONTRACTS, ContractError, differences
from stockweave.sources.tables import Tables


@pytest.fixture(scope="module")
def tables(make_tables):
    return make_tables(
        Materials=[{"material_number": 1}, {"material_number": 2}, {"material_number": 2}, {}],
        SalesOrderItems=[sale_item(1, 1), sale_item(1, 1), sale_item(1, 1), sale_item(1, 2), sale_item(2, None)],
        SalesOrderDocuments=[{"sales_document_number": 1}],
        PurchaseOrderItems=[purchase_item(1, 1, material=1), purchase_item(2, 1, material=9)],
        PurchaseOrderDocuments=[purchase(1, "2024-01-01")],
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2024-01-01", 1.0, material=9, doc=1, line=1),
            movement("Goods Receipt", "2024-01-01", 1.0, material=9, doc=1, line=2),
            movement("Goods Receipt", "2024-01-01", 1.0, material=8, doc=5, line=1),
            movement("Goods Issue", "2024-01-01", 1.0, material=None),
        ],
        MaterialStocks=[{"material_number": 7, "plant": "P", "storage_location": "S"}],
        MaterialDocuments=[{"material_document_number": 1, "material_document_year": 2024, "line_item": 1}],
        SalesDocumentFlows=[{"sales_document": 3}],
        PurchaseRequisitions=[{"purchase_requisition_number": 1}, {"purchase_requisition_number": 1}],
        OrderSuggestions=[{"order_number": 1, "order_position": 1, "article_number": 1}],
    )


def test_primary_keys(tables):
    report = {
        r.table_name: (r.rows, r.null_keys, r.repeated_keys, r.surplus_rows, r.violations)
        for r in quality.primary_key_report(tables).collect()
    }
    assert report == {
        "Materials": (4, 1, 1, 1, 2),
        "SalesOrderDocuments": (1, 0, 0, 0, 0),
        "SalesOrderItems": (5, 1, 1, 2, 3),
        "PurchaseRequisitions": (2, 0, 1, 1, 1),
        "MaterialStocks": (1, 0, 0, 0, 0),
        "SalesDocumentFlows": (1, 1, 0, 0, 1),
        "PurchaseOrderItems": (2, 0, 0, 0, 0),
        "PurchaseOrderDocuments": (1, 0, 0, 0, 0),
        "MaterialDocuments": (1, 0, 0, 0, 0),
        "OrderSuggestions": (1, 0, 0, 0, 0),
    }


def test_foreign_keys(tables):
    report = {
        (r.table_name, r.key_columns): (r.referencing_rows, r.missing_keys, r.violations)
        for r in quality.foreign_key_report(tables).collect()
    }
    assert report == {
        ("SalesOrderItems", "sales_document_number"): (5, 1, 1),
        ("SalesOrderItems", "material_number"): (5, 0, 0),
        ("MaterialStocks", "material_number"): (1, 1, 1),
        ("GoodsReceiptsAndIssues", "material_number"): (3, 2, 3),
        ("SalesDocumentFlows", "sales_document"): (1, 1, 1),
        ("PurchaseOrderItems", "purchase_order_number"): (2, 1, 1),
        ("PurchaseOrderItems", "material_number"): (2, 1, 1),
        ("MaterialDocuments", "material_number"): (0, 0, 0),
        ("OrderSuggestions", "article_number"): (1, 0, 0),
    }


def test_soft_references(tables):
    report = {
        r.key_columns: (r.referencing_rows, r.missing_keys, r.violations, r.severity)
        for r in quality.soft_reference_report(tables).collect()
    }
    assert report == {
        "purchase_document_number": (3, 1, 1, "warning"),
        "purchase_document_number, line_item_in_purchase_document": (3, 2, 2, "warning"),
    }


def test_references_to_a_key_share_one_shuffle(tables):
    text = quality.foreign_key_report(tables)._jdf.queryExecution().executedPlan().toString()
    parents = {(ref.parent, ref.parent_columns) for c in CONTRACTS.values() for ref in c.foreign_keys}
    assert text.count("Exchange hashpartitioning") == len(parents) == 3 and "Join" not in text


def test_contract_differences_stop_before_reading(spark, tables):
    wrong = (
        tables["Materials"].drop("volume").withColumn("gross_weight", F.lit("heavy")).withColumn("extra", F.lit(1))
    )
    assert differences("Materials", wrong.schema) == [
        "Materials.gross_weight is string, not double",
        "Materials.volume is missing",
        "Materials.extra is not declared",
    ]
    with pytest.raises(ContractError, match="volume is missing"):
        Tables({"Materials": wrong})["Materials"]


def test_contract_report(tables):
    wrong = tables["Materials"].drop("volume").withColumn("gross_weight", F.lit("heavy"))
    report = {r.column_name: tuple(r)[2:] for r in quality.contract_report({"Materials": wrong}).collect()}
    assert report["material_number"] == ("bigint", "bigint", True, 4, 1)
    assert report["gross_weight"] == ("double", "string", False, 4, 0)
    assert report["volume"] == ("double", None, False, 4, 4)


def test_contracts_cover_all_keys():
    assert len(CONTRACTS) == 11
    assert sum(bool(c.primary_key) for c in CONTRACTS.values()) == 10
    assert sum(len(c.foreign_keys) for c in CONTRACTS.values()) == 9
