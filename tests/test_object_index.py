"""Objects and summary from keys against those of the log itself; joins with missing and hot keys."""

from __future__ import annotations

import random

import pytest
from conftest import movement, purchase, purchase_item, sale, sale_item, suggestion
from pyspark.sql import functions as F

from stockweave.operators import events, object_index, ocel
from stockweave.operators.joins import spread_left_join
from stockweave.operators.running import SkewPolicy
from stockweave.plans import inventory
from stockweave.plans.inventory import JobSettings


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def gaps(make_tables):
    """Materials whose first events have no quantity, NaN or no quantity at all, missing plants and documents."""
    rng = random.Random(2)
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    quantities = [None, None, float("nan"), 1.0, 2.5, float("inf")]
    moved = [
        movement(
            rng.choice(["Goods Receipt", "Goods Issue", "Transfer"]),
            rng.choice([None, *days]),
            None if m == 3 else rng.choice(quantities),
            material=m,
            plant=rng.choice(["A", "B", None]),
            doc=rng.choice([None, 3, 4]),
            line=rng.choice([None, 1]),
            reference_document_number=rng.choice([None, 8]),
        )
        for m in (1, 2, 3, 4, 5, None)
        for _ in range(6)
    ]
    return make_tables(
        GoodsReceiptsAndIssues=moved,
        PurchaseOrderItems=[purchase_item(3, 1), purchase_item(3, 2, plant=None), purchase_item(9, 1, material=6)],
        PurchaseOrderDocuments=[purchase(3, "2024-01-05"), purchase(9, "2024-01-06")],
        SalesOrderItems=[sale_item(4, 1, material=7), sale_item(4, 1, material=7)],
        SalesOrderDocuments=[sale(4, "2024-01-03")],
        OrderSuggestions=[suggestion(5, "2024-01-02", material=6), suggestion(6, "2024-01-09", material=8)],
    )


def test_keys_give_the_objects_and_the_summary_of_the_log(gaps):
    log = inventory.event_log(gaps)
    assert rows(inventory.log_objects(gaps)) == rows(ocel.ocel_objects(log)) != []
    assert rows(inventory.log_summary(gaps)) == rows(ocel.ocel_summary(log))


def test_the_log_lacks_the_first_events(gaps):
    found = events.all_events(gaps)
    assert found.count() - object_index.left_out(found).count() == inventory.event_log(gaps).count()


def test_an_empty_log_has_no_objects(make_tables):
    empty = make_tables()
    assert rows(inventory.log_objects(empty)) == [] == rows(inventory.log_summary(empty))


def test_keys_need_neither_window_nor_text(gaps):
    found = events.all_events(gaps).drop("none")
    plan = object_index.index(found)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MAT-" not in plan


LEFT = "doc bigint, n bigint"


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_rows_without_a_key_are_spread(spark, sorted_joins):
    left = spark.range(20_000).selectExpr("IF(id % 10 = 0, id % 300, NULL) AS doc", "id AS n").repartition(3)
    right = spark.range(0, 300, 2).selectExpr("id AS doc", "id * 2 AS vendor")
    joined = spread_left_join(left, right, "doc", ["n"])
    found = sizes(joined)
    assert len(found) == 4 and found[-1] < 1.5 * found[0]
    assert rows(joined) == rows(left.join(right, "doc", "left"))


def test_hot_keys_are_spread(spark, sorted_joins):
    left = spark.range(20_000).selectExpr("IF(id % 10 < 8, 7, id % 300) AS doc", "id AS n").repartition(3)
    right = spark.createDataFrame([(i, i * 2) for i in range(0, 300)] + [(7, -1)], "doc bigint, vendor bigint")
    hot = spark.createDataFrame([(7,), (1000,)], "doc bigint")
    joined = spread_left_join(left, right, "doc", ["n"], hot, copies=1024)
    found = sizes(joined)
    assert len(found) == 4 and found[-1] < 1.5 * found[0]
    assert rows(joined) == rows(left.join(right, "doc", "left"))


def test_receipts_of_hot_documents_are_the_same_events(gaps):
    skew = SkewPolicy(max_group_rows=1, sample_fraction=1.0)
    hot = inventory.hot_documents(gaps, skew)
    assert {r[0] for r in hot.collect()} == {3, 4}
    assert rows(events.goods_receipts(gaps, hot)) == rows(events.goods_receipts(gaps))
    assert inventory.hot_documents(gaps) is None
    log = inventory.event_log(gaps, JobSettings(skew=skew))
    assert log.count() == inventory.event_log(gaps).count()


def test_events_are_sorted_once_for_the_objects(gaps):
    stored = inventory.stored_events(gaps)
    found = object_index.index(stored)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    # No (kind, object) twice, though each kind is counted by itself.
    assert found.count() == found.select(*object_index.KEY).distinct().count() > 0
