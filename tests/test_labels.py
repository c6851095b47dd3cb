"""The relabelling rules over a full grid of stocks, with labels written out by hand."""

from __future__ import annotations

import pytest

from stockweave.operators.relabel import relabel

GR, GI, SO = "Goods Receipt", "Goods Issue", "Create Sales Order Item"
PO, PS = "Create Purchase Order Item", "Create Purchase Suggestion Item"
NAMES = {"U": "Understock", "N": "Normal", "O": "Overstock"}

# Safety stock 10, overstock level 20. Stocks: below, at and between the bounds, at the upper, above.
STOCKS = [5.0, 10.0, 15.0, 20.0, 25.0]
# One line per stock before, one entry per stock after; "--" leaves the activity unchanged.
CHANGES = {
    GR: ["UU UN UN UO UO", "-- NN NN NO NO", "-- NN NN NO NO", "-- -- -- OO OO", "-- -- -- OO OO"],
    GI: ["UU -- -- -- --", "NU NN NN -- --", "NU NN NN -- --", "-- ON ON OO OO", "-- ON ON OO OO"],
    SO: ["UU UU -- -- --", "UU UU NN -- --", "NU NU NN -- --", "OU OU ON OO OO", "OU OU ON OO OO"],
}
# No demand: both bounds at 10, so Normal is empty. Stocks below, at, above.
NARROW_STOCKS = [5.0, 10.0, 15.0]
NARROW = {
    GR: ["UU UO UO", "-- OO OO", "-- OO OO"],
    GI: ["UU -- --", "-- OO OO", "-- OO OO"],
    SO: ["UU UU --", "UU UU OO", "OU OU OO"],
}


def _label(activity: str, code: str) -> str:
    return activity if code == "--" else f"{activity} ({NAMES[code[0]]} to {NAMES[code[1]]})"


def _grid(stocks, rules, safety, overstock):
    for activity, lines in rules.items():
        for before, line in zip(stocks, lines):
            for after, code in zip(stocks, line.split()):
                yield activity, before, after, safety, overstock, _label(activity, code)


def cases():
    yield from _grid(STOCKS, CHANGES, 10.0, 20.0)
    yield from _grid(NARROW_STOCKS, NARROW, 10.0, 10.0)
    for activity in (PO, PS):
        for before, band in zip([5.0, 9.99, 10.0, 15.0, 20.0, 25.0], "UUNNOO"):
            for after in (None, 0.0, 99.0):
                yield activity, before, after, 10.0, 20.0, f"{activity} ({NAMES[band]})"
        yield activity, 10.0, 10.0, 10.0, 10.0, f"{activity} (Overstock)"
    for activity in (GR, GI, SO, PO, PS):
        yield activity, None, None, 10.0, 20.0, activity
        yield activity, None, 15.0, 10.0, 20.0, activity
        yield activity, 15.0, 15.0, None, None, activity
        yield activity, float("nan"), float("nan"), 10.0, 20.0, activity
    for activity in (GR, GI, SO):
        yield activity, 15.0, None, 10.0, 20.0, activity
        yield activity, 5.0, float("nan"), 10.0, 20.0, activity
    yield "Transfer", 5.0, 5.0, 10.0, 20.0, "Transfer"
    yield None, 5.0, 5.0, 10.0, 20.0, None


def test_every_case(spark):
    rows = [(i, *case) for i, case in enumerate(cases())]
    schema = (
        "i int, activity string, stock_before double, stock_after double, safety_stock double, "
        "overstock_level double, expected string"
    )
    df = spark.createDataFrame(rows, schema)
    labelled = relabel(df)
    assert labelled.columns == df.columns
    wrong = [tuple(r) for r in labelled.collect() if r.activity != r.expected]
    assert not wrong


@pytest.mark.parametrize("activity, count", [(GR, 6), (GI, 5), (SO, 6), (PO, 3), (PS, 3)])
def test_all_labels_occur(activity, count):
    labels = {case[-1] for case in cases() if case[0] == activity} - {activity}
    assert len(labels) == count
