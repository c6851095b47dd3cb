"""Events, running stock, floor and ids against hand-worked cases."""

from __future__ import annotations

import pytest
from conftest import movement, purchase, purchase_item, sale, sale_item, suggestion

from stockweave.operators import events, stock
from stockweave.operators.running import SkewPolicy
from stockweave.plans.inventory import JobSettings, event_log

EVERY_GROUP_HOT = SkewPolicy(max_group_rows=0, sample_fraction=1.0)


@pytest.fixture(scope="module")
def one_material(make_tables):
    return make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2024-01-01", 10.0),
            movement("Goods Issue", "2024-01-02", 30.0),
            movement("Goods Receipt", "2024-01-04", 5.0),
        ],
        SalesOrderItems=[sale_item(4, 1, plant="Plant2")],
        SalesOrderDocuments=[sale(4, "2024-01-03")],
    )


def test_running_stock(one_material):
    rows = stock.running_stock(events.all_events(one_material)).orderBy("event_date").collect()
    assert [(r.stock_before, r.stock_after) for r in rows] == [(None, 10), (10, -20), (-20, -20), (-20, -15)]


@pytest.mark.parametrize("skew", [SkewPolicy(), EVERY_GROUP_HOT], ids=["windows", "chunks"])
@pytest.mark.parametrize(
    "mode, expected",
    [
        ("reference", [("e1", 30, 50), ("e2", 0, 20), ("e3", 0, 20)]),
        ("running", [("e1", 30, 0), ("e2", 0, 0), ("e3", 0, 5)]),
    ],
)
def test_adjusted_stock(one_material, mode, expected, skew):
    log = event_log(one_material, JobSettings(stock_after=mode, skew=skew), ordered=True).collect()
    assert [(r["ocel:eid"], r["Stock Before"], r["Stock After"]) for r in log] == expected


def test_unknown_mode_is_refused(one_material):
    with pytest.raises(ValueError):
        event_log(one_material, JobSettings(stock_after="other"))


def test_floor(one_material):
    completed = stock.complete(stock.running_stock(events.all_events(one_material)))
    floors = {r.plant: (r.min_before, r.min_after, r.adding_stock) for r in stock.stock_floor(completed).collect()}
    assert floors == {"Plant1": (-20, -20, 20), "Plant2": (-20, -20, 20)}


def test_object_cells(make_tables):
    tables = make_tables(
        OrderSuggestions=[suggestion(9, "2023-12-01")],
        PurchaseOrderItems=[purchase_item(3, 2)],
        PurchaseOrderDocuments=[purchase(3, "2024-01-01", vendor=5)],
        SalesOrderItems=[sale_item(4, 1)],
        SalesOrderDocuments=[sale(4, "2024-01-03", customer=12)],
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2023-11-01", 10.0),
            movement("Goods Receipt", "2024-01-02", 10.0, doc=3, line=2),
            movement("Goods Receipt", "2024-01-05", 10.0, doc=99, line=1),
            movement("Goods Issue", "2024-01-04", 1.0, doc=4, line=1, reference_document_number=77),
        ],
    )
    cells = {
        (r["ocel:activity"], str(r["ocel:timestamp"])): [
            r[f"ocel:type:{t}"] for t in ("MAT", "PLA", "MAT_PLA", "PO_ITEM", "SO_ITEM", "CUSTOMER", "SUPPLIER")
        ]
        for r in event_log(tables).collect()
    }
    same = [["MAT-1"], ["Plant1"], ["MAT-1_Plant1"]]
    assert cells == {
        ("Create Purchase Suggestion Item", "2023-12-01"): [*same, None, None, None, None],
        ("Create Purchase Order Item", "2024-01-01"): [*same, ["PO_ITEM--3-2"], None, None, ["SUPPLIER--5"]],
        ("Goods Receipt", "2024-01-02"): [*same, ["PO_ITEM--3-2"], None, None, ["SUPPLIER--5"]],
        ("Create Sales Order Item", "2024-01-03"): [*same, None, ["SO_ITEM--4-1"], ["CUSTOMER--12"], None],
        ("Goods Issue", "2024-01-04"): [*same, None, None, ["CUSTOMER--77"], None],
        # The purchase document is unknown: the event stays, its supplier is missing.
        ("Goods Receipt", "2024-01-05"): [*same, ["PO_ITEM--99-1"], None, None, None],
    }


def test_rows_outside_every_branch(make_tables):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Transfer", "2024-01-01", 10.0),
            movement("Goods Receipt", "2024-01-02", 10.0, material=None),
            movement("Goods Issue", "2024-01-03", 4.0, material=None),
        ],
        PurchaseOrderItems=[purchase_item(1, 1), purchase_item(2, 1, material=None)],
        PurchaseOrderDocuments=[purchase(2, "2024-01-01")],
        SalesOrderItems=[sale_item(1, 1), sale_item(2, 1, material=None)],
        SalesOrderDocuments=[sale(2, "2024-01-01")],
        OrderSuggestions=[suggestion(1, "2024-01-01", material=None)],
    )
    assert events.all_events(tables).count() == 0
    changes = sorted(r.quantity_change for r in events.stock_changes(tables).collect())
    assert changes == [-4.0, 0.0, 10.0]


@pytest.mark.parametrize("skew", [SkewPolicy(), EVERY_GROUP_HOT], ids=["windows", "chunks"])
def test_missing_plant_and_quantity(make_tables, skew):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2024-01-01", None),
            movement("Goods Receipt", "2024-01-02", 8.0),
            movement("Goods Issue", "2024-01-03", 9.0, plant=None),
            movement("Goods Issue", "2024-01-04", None),
            movement("Goods Receipt", "2024-01-05", 3.0),
        ]
    )
    log = event_log(tables, JobSettings(stock_after="running", skew=skew), ordered=True).collect()
    # The first two events know no earlier stock; a missing quantity changes nothing.
    assert [(r["ocel:eid"], r["Stock Before"], r["Stock After"], r["ocel:type:MAT_PLA"]) for r in log] == [
        ("e2", None, None, None),
        ("e3", 0, 0, ["MAT-1_Plant1"]),
        ("e4", 0, 3, ["MAT-1_Plant1"]),
    ]


def test_missing_date_comes_first(make_tables):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2024-01-01", 1.0),
            movement("Goods Receipt", None, 5.0),
        ]
    )
    (row,) = event_log(tables).collect()
    assert (row["ocel:eid"], row["Stock Before"]) == ("e1", 5)


def test_same_day_order_follows_branches(make_tables):
    tables = make_tables(
        OrderSuggestions=[suggestion(1, "2024-01-01")],
        PurchaseOrderItems=[purchase_item(3, 2)],
        PurchaseOrderDocuments=[purchase(3, "2024-01-01")],
        SalesOrderItems=[sale_item(4, 1)],
        SalesOrderDocuments=[sale(4, "2024-01-01")],
        GoodsReceiptsAndIssues=[
            movement("Goods Issue", "2024-01-01", 1.0, doc=4, line=1),
            movement("Goods Receipt", "2024-01-01", 1.0, doc=3, line=2),
            movement("Goods Receipt", "2024-01-01", 2.0, doc=3, line=1),
        ],
    )
    running = events.describe(stock.running_stock(events.all_events(tables))).orderBy("seq").collect()
    assert [(r.activity, r.stock_after) for r in running] == [
        ("Create Purchase Suggestion Item", 0),
        ("Create Purchase Order Item", 0),
        ("Goods Receipt", 2),
        ("Goods Receipt", 3),
        ("Create Sales Order Item", 3),
        ("Goods Issue", 2),
    ]


def test_empty_tables(make_tables):
    assert event_log(make_tables()).count() == 0
