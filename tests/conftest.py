from __future__ import annotations

import datetime as dt

import pytest

from stockweave.session import build_session
from stockweave.sources.contracts import CONTRACTS
from stockweave.sources.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", 8, shuffle_partitions=4, **{"spark.sql.maxMetadataStringLength": "2000"})
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def make_tables(spark):
    """ERP tables from lists of dicts; columns left out are NULL, tables left out are empty."""

    def make(**rows: list[dict]) -> Tables:
        frames = {}
        for name, contract in CONTRACTS.items():
            names = contract.schema.fieldNames()
            unknown = {k for row in rows.get(name, []) for k in row} - set(names)
            assert not unknown, unknown
            data = [tuple(row.get(c) for c in names) for row in rows.get(name, [])]
            frames[name] = spark.createDataFrame(data, contract.schema)
        return Tables(frames)

    return make


def movement(kind: str, date: str, quantity: float | None, material=1, plant="Plant1", doc=None, line=None, **more):
    return {
        "movement_type": kind,
        "date_of_the_posting_in_the_document": day(date) if date else None,
        "quantity": quantity,
        "material_number": material,
        "plant": plant,
        "purchase_document_number": doc,
        "line_item_in_purchase_document": line,
        **more,
    }


def purchase(doc: int, date: str, vendor: int = 7) -> dict:
    return {"purchase_document_number": doc, "purchase_order_date": day(date), "account_number_of_vendor": vendor}


def purchase_item(doc: int, item: int, material=1, plant="Plant1") -> dict:
    return {
        "purchase_order_number": doc,
        "purchase_order_item_number": item,
        "material_number": material,
        "plant": plant,
    }


def sale(doc: int, date: str, customer: int = 12) -> dict:
    return {"sales_document_number": doc, "document_creation_date": day(date), "customer_number": customer}


def sale_item(doc: int, item: int, material=1, plant="Plant1") -> dict:
    return {"sales_document_number": doc, "item_number": item, "material_number": material, "plant": plant}


def suggestion(number: int, date: str, material=1, plant="Plant1") -> dict:
    return {
        "order_number": number,
        "order_position": 1,
        "article_number": material,
        "date": day(date),
        "plant": plant,
    }
