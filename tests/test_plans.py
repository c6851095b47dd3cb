"""What the physical plans must and must not contain, and invariants over staged data."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockweave.operators import demand, events, running, stock
from stockweave.operators.running import SkewPolicy, scan_chunks
from stockweave.plans import files, inventory
from stockweave.plans.inventory import JobSettings
from stockweave.session import materialise, scratch_path, scratch_scope, shared_folder, side_by_side
from stockweave.sinks.ocel_xml import write_ocel_xml
from stockweave.sources.event_log_csv import read_event_log
from stockweave.sources.staging import stage
from stockweave.sources.tables import read_tables, write_tables

AS_OF = dt.date(1997, 1, 1)
SETTINGS = JobSettings(as_of=AS_OF)
# Every group with more than a few rows is cut into chunks.
CHUNKED = JobSettings(as_of=AS_OF, skew=SkewPolicy(max_group_rows=55, sample_fraction=1.0))


@pytest.fixture(scope="module")
def typed(spark):
    path = scratch_path(spark, "typed")
    write_tables(stage(spark, SMALL), path)
    return read_tables(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_running_sums_share_one_window_and_one_shuffle(typed):
    text = plan(stock.running_stock(events.all_events(typed)))
    assert len(re.findall(r"\bWindow \[", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(material#", text)) == 1


def test_the_adjusted_log_shuffles_events_once(spark, typed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(inventory.adjusted(typed, SETTINGS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange carries the events by material; the other one the offsets.
    assert len(re.findall(r"Exchange hashpartitioning\(material#", text)) == 2
    # One window in one task adds up the top digits of the materials, 2**20 rows at most.
    assert text.count("SinglePartition") == 1 and re.search(r"SinglePartition.*\n.*keys=\[_top#", text)


def test_the_ordered_log_shuffles_events_once(spark, typed):
    """By ranges of the material: no second shuffle to the positions, nor one for the offsets."""
    found = inventory.adjusted(typed, SETTINGS, ordered=True)
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)", plan(found))
    assert [kind for kind, _ in exchanges if kind == "rangepartitioning"] == ["rangepartitioning"]
    assert not any("position" in key or "DIV" in key for _, key in exchanges)
    parts = found.select("position", F.spark_partition_id().alias("part")).collect()
    places = [r.position for r in parts]
    assert places == sorted(set(places)) and [r.part for r in parts] == sorted(r.part for r in parts)
    assert len({r.part for r in parts}) > 1
    columns = inventory.adjusted(typed, SETTINGS).columns
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.select(columns)) == rows(inventory.adjusted(typed, SETTINGS))


def test_columns_and_filters_reach_the_scan(typed):
    text = plan(demand.daily_demand(typed, AS_OF))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "movement_type",
        "material_number",
        "plant",
        "date_of_the_posting_in_the_document",
        "quantity",
    }
    assert "EqualTo(movement_type,Goods Issue)" in text
    assert "GreaterThanOrEqual(date_of_the_posting_in_the_document,1996-01-01)" in text


@pytest.mark.parametrize("as_of", [AS_OF, dt.date(1996, 2, 29), None])
def test_year_scans_read_the_months_of_the_year(typed, as_of):
    for df in (demand.daily_demand(typed, as_of), demand.lead_times(typed, as_of)):
        filters = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df)) if f]
        assert len(filters) == 1 and "posting_month" in filters[0] and ">=" in filters[0]


def test_months_are_pruned_not_lost(typed, spark):
    small = stage(spark, SMALL)
    assert rows(demand.daily_demand(typed, AS_OF)) == rows(demand.daily_demand(small, AS_OF))
    assert rows(typed["GoodsReceiptsAndIssues"]) == rows(small["GoodsReceiptsAndIssues"])


def test_events_are_joined_once_per_log(spark, typed, monkeypatch):
    """The tables are read when the events are stored; counting and sums read the stored events."""
    stored = []
    monkeypatch.setattr(inventory, "materialise", lambda df, name: stored.append(df) or materialise(df, name))
    log = plan(inventory.event_log(typed, SETTINGS))
    assert len(stored) == 1
    assert "GoodsReceiptsAndIssues" not in log and "PurchaseOrderDocuments" not in log
    assert len(re.findall(r"FileScan parquet", plan(stored[0]))) == 8


def test_scratch_is_deleted(spark, typed):
    def stored():
        return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}

    before = stored()
    with scratch_scope(spark):
        assert inventory.event_log(typed, SETTINGS).count()
        assert stored() - before
    assert stored() == before
    out = scratch_path(spark, "kept")
    files.write_log(typed, out, SETTINGS)
    write_ocel_xml(read_event_log(spark, out), f"{out}-xml")
    assert {name.split("-")[0] for name in stored() - before} == {"kept"}


def test_side_by_side_stops_the_rest(spark):
    begun = []

    def fail():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        side_by_side(spark, [fail, *[lambda: begun.append(spark.range(10).count()) for _ in range(20)]], at_once=1)
    assert len(begun) < 20


def test_chunked_plan_gives_the_same_log(typed):
    assert inventory.hot_materials(typed, CHUNKED.skew).count()
    assert rows(inventory.event_log(typed, CHUNKED)) == rows(inventory.event_log(typed, SETTINGS))
    assert rows(inventory.relabelled_event_log(typed, CHUNKED)) == rows(
        inventory.relabelled_event_log(typed, SETTINGS)
    )


def test_a_hot_order_gets_the_same_line_numbers(spark):
    few = SkewPolicy(max_group_rows=8, sample_fraction=1.0)
    for table in ("PurchaseOrderItems", "GoodsReceiptsAndIssues"):
        assert rows(stage(spark, SMALL, few)[table]) == rows(stage(spark, SMALL)[table])


def test_a_dominant_material_is_spread_over_chunks(spark, typed, monkeypatch):
    kept = []
    monkeypatch.setattr(running, "materialise", lambda df: kept.append(df.cache()) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = events.all_events(typed).withColumns({"material": F.lit(1).cast("bigint"), "event_date": F.lit(AS_OF)})
        total = scan_chunks(copies, "material", events.EVENT_ORDER, "quantity_change").count()
        sizes = [r["count"] for r in kept[-1].groupBy("_chunk").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == total and len(sizes) == 4 and max(sizes) < total / 2


def test_invariants(typed):
    raw = stock.running_stock(events.all_events(typed))
    moved = {
        r.material: r.total
        for r in events.all_events(typed).groupBy("material").agg(F.sum("quantity_change").alias("total")).collect()
    }
    last = Window.partitionBy("material").orderBy(F.desc("seq"))
    ends = raw.withColumn("r", F.row_number().over(last)).where("r = 1").collect()
    assert {r.material: r.stock_after for r in ends} == moved
    assert raw.where("seq = 0 AND stock_before IS NOT NULL").count() == 0

    for mode in ("reference", "running"):
        log = inventory.event_log(typed, JobSettings(as_of=AS_OF, stock_after=mode))
        assert log.where("`Stock Before` < 0 OR `Stock After` < 0").count() == 0
        assert log.count() == log.select("ocel:eid").distinct().count() == raw.count() - len(moved)
    assert inventory.relabelled_event_log(typed, SETTINGS).count() == log.count()
    pairs = demand.materials_plants(typed).count()
    assert inventory.parameters(typed, SETTINGS).count() == pairs


def test_falling_stock_labels_need_the_running_mode(typed):
    def falling(settings):
        labels = inventory.relabelled_event_log(typed, settings).select("ocel:activity")
        return labels.where("`ocel:activity` LIKE '%Normal to Understock)' OR `ocel:activity` LIKE '%Overstock to Normal)'")

    assert falling(SETTINGS).count() == 0
    assert falling(JobSettings(as_of=AS_OF, stock_after="running")).count() > 0


def test_large_materials_are_shuffled_by_chunk_never_by_pair(spark, typed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = inventory.stored_events(typed, CHUNKED)
        numbering = stock.number_events(found, CHUNKED.skew)
        parameters = inventory.parameters(typed, SETTINGS).withColumnRenamed("material_number", "material")
        hot = numbering.offsets.join(numbering.hot, "material", "left_semi")
        text = plan(stock._floored_by_chunks(found, hot, numbering.scale, materialise(parameters)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    names = [re.sub(r"#\d+L?|, \d+$", "", e) for e in exchanges]
    assert names and not [e for e in names if e.startswith("material, plant")]
    assert {"_chunk, material"} < set(names)
