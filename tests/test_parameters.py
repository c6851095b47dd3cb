"""Demand, lead times and replenishment parameters against hand-worked cases."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import movement, purchase, purchase_item, sale, sale_item, suggestion

from stockweave.operators import demand
from stockweave.plans.inventory import PARAMETER_COLUMNS, JobSettings, inventory_parameters

AS_OF = dt.date(2024, 7, 1)


@pytest.fixture(scope="module")
def tables(make_tables):
    return make_tables(
        GoodsReceiptsAndIssues=[
            # A: two days with demand, one issue too old, one receipt before its order.
            movement("Goods Issue", "2024-01-02", 10.0, material=1),
            movement("Goods Issue", "2024-01-02", 20.0, material=1),
            movement("Goods Issue", "2024-01-05", 10.0, material=1),
            movement("Goods Issue", "2023-06-30", 99.0, material=1),
            movement("Goods Receipt", "2024-01-10", 5.0, material=1, doc=1, line=1),
            movement("Goods Receipt", "2023-12-25", 5.0, material=1, doc=1, line=1),
            # B: one day with demand.
            movement("Goods Issue", "2024-02-01", 12.0, material=2),
            # D: received on the day of the order.
            movement("Goods Receipt", "2024-03-01", 5.0, material=4, doc=2, line=1),
        ],
        PurchaseOrderItems=[purchase_item(1, 1, material=1), purchase_item(2, 1, material=4)],
        PurchaseOrderDocuments=[purchase(1, "2024-01-01"), purchase(2, "2024-03-01")],
        SalesOrderItems=[sale_item(1, 1, material=3)],
        SalesOrderDocuments=[sale(1, "2024-01-01")],
    )


# material: annual, average, deviation, lead, EOQ, SS, ROP
EXPECTED = {
    1: (40, 20, 10, 9, 28.28, 49.35, 229.35),
    2: (12, 12, 1.2, 7, 15.49, 5.22, 89.22),
    3: (0, 1, 0.1, 7, 0, 0.44, 7.44),
    4: (0, 1, 0.1, 7, 0, 0.44, 7.44),
}


def test_parameters(tables):
    published = inventory_parameters(tables, JobSettings(as_of=AS_OF), ordered=True)
    assert published.columns == list(PARAMETER_COLUMNS.values())
    rows = published.collect()
    assert [r["Material Number"] for r in rows] == [1, 2, 3, 4]
    for row in rows:
        assert tuple(row)[2:] == pytest.approx(EXPECTED[row["Material Number"]])


def test_statistics_before_defaults(tables):
    stats = {r.material_number: r for r in demand.demand_stats(tables, AS_OF).collect()}
    assert (stats[1].days_with_demand, stats[1].variance_daily_demand) == (2, 100)
    assert (stats[2].days_with_demand, stats[2].stddev_daily_demand) == (1, 0)
    assert (stats[3].annual_demand, stats[3].days_with_demand) == (None, 0)
    leads = {r.material_number: r.average_lead_time for r in demand.lead_times(tables, AS_OF).collect()}
    assert leads == {1: 9, 4: 0}


def test_the_year_starts_on_its_first_day_and_has_no_end(make_tables):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Issue", "2023-06-30", 1.0),
            movement("Goods Issue", "2023-07-01", 2.0),
            movement("Goods Issue", "2030-01-01", 4.0),
            movement("Goods Issue", None, 8.0),
            movement("Goods Receipt", "2024-01-01", 16.0),
        ]
    )
    assert sorted(r.daily_quantity for r in demand.daily_demand(tables, AS_OF).collect()) == [2.0, 4.0]
    # From 29 February the year starts on 28 February.
    leap = demand.daily_demand(tables, dt.date(2024, 2, 29))
    assert leap.count() == 3


def test_the_wall_clock_is_the_default(make_tables):
    today, old = dt.date.today().isoformat(), (dt.date.today() - dt.timedelta(days=800)).isoformat()
    tables = make_tables(
        GoodsReceiptsAndIssues=[movement("Goods Issue", today, 2.0), movement("Goods Issue", old, 4.0)]
    )
    assert [r.daily_quantity for r in demand.daily_demand(tables).collect()] == [2.0]


def test_lead_time_belongs_to_the_ordered_item(make_tables):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "2024-01-05", 1.0, material=50, plant="Plant9", doc=1, line=1),
            movement("Goods Receipt", "2024-01-07", 1.0, material=1, doc=1, line=2),
        ],
        PurchaseOrderItems=[purchase_item(1, 1, material=1)],
        PurchaseOrderDocuments=[purchase(1, "2024-01-01")],
    )
    assert [tuple(r) for r in demand.lead_times(tables, AS_OF).collect()] == [(1, "Plant1", 4.0)]


def test_pairs_of_all_tables_with_missing_parts(make_tables):
    tables = make_tables(
        GoodsReceiptsAndIssues=[
            movement("Transfer", "2024-01-01", 1.0, material=1),
            movement("Goods Issue", "2024-01-02", 3.0, material=2, plant=None),
        ],
        PurchaseOrderItems=[purchase_item(1, 1, material=1), purchase_item(1, 2, material=None)],
        SalesOrderItems=[sale_item(1, 1, material=2, plant=None)],
        OrderSuggestions=[suggestion(1, "2024-01-01", material=5)],
    )
    pairs = {tuple(r) for r in demand.materials_plants(tables).collect()}
    assert pairs == {(1, "Plant1"), (None, "Plant1"), (2, None), (5, "Plant1")}
    # A missing plant equals no plant, so this demand reaches no pair.
    rows = {r.material_number: r for r in demand.replenishment_inputs(tables, AS_OF).collect()}
    assert (rows[2].annual_demand, rows[2].average_daily_demand) == (0, 1)


def test_zero_demand_keeps_a_zero_deviation(make_tables):
    tables = make_tables(GoodsReceiptsAndIssues=[movement("Goods Issue", "2024-01-02", 0.0)])
    (row,) = demand.replenishment_inputs(tables, AS_OF).collect()
    assert (row.annual_demand, row.average_daily_demand, row.stddev_daily_demand) == (0, 1, 0)


def test_constants_are_parameters(tables):
    policy = demand.ReplenishmentPolicy(fixed_order_cost=400.0, holding_cost_per_unit_per_year=5.0, z_score=2.0)
    found = demand.replenishment_parameters(demand.replenishment_inputs(tables, AS_OF, policy))
    row = found.where("material_number = 1").first()
    assert (row.eoq, row.safety_stock, row.reorder_point) == (80.0, 60.0, 240.0)
