"""CSV and XML: cell text, round trips, relabelling from a file."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import re
from dataclasses import asdict
from xml.etree import ElementTree

import pytest
from conftest import SMALL, movement, purchase, purchase_item, sale, sale_item
from pyspark.sql import functions as F

from stockweave.functions.objects import decode_cell, encode_cell, first_object
from stockweave.operators import demand, ocel
from stockweave.plans import files, inventory
from stockweave.plans.inventory import JobSettings
from stockweave.session import scratch_path, write_text
from stockweave.sinks import event_log_csv
from stockweave.sinks.event_log_csv import write_event_log
from stockweave.sinks.ocel_xml import LINES_NOTE, event_elements, write_ocel_xml
from stockweave.sources.event_log_csv import read_event_log, read_event_log_text, with_position
from stockweave.sources.ocel_xml import read_ocel_events, read_ocel_objects, read_ocel_relations
from stockweave.sources.staging import stage
from stockweave.sources.tables import Months, read_tables, write_tables

SETTINGS = JobSettings(as_of=dt.date(1997, 1, 1))


@pytest.fixture(scope="module")
def tables(make_tables):
    return make_tables(
        GoodsReceiptsAndIssues=[
            movement("Goods Receipt", "1996-01-02", 10.0, doc=3, line=1),
            movement("Goods Issue", "1996-03-02", 30.0, plant="Plant, \"2\"", doc=4, line=1, reference_document_number=4),
            movement("Goods Issue", "1996-04-02", 1.0, plant="It's\\a", doc=4, line=1, reference_document_number=4),
            movement("Goods Issue", "1996-05-02", 1.0, plant=None),
        ],
        PurchaseOrderItems=[purchase_item(3, 1)],
        PurchaseOrderDocuments=[purchase(3, "1996-01-05")],
        SalesOrderItems=[sale_item(4, 1)],
        SalesOrderDocuments=[sale(4, "1996-02-01")],
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "ids, text",
    [
        (["MAT-1"], "['MAT-1']"),
        (None, None),
        (["It's"], r"['It\'s']"),
        (["a\\b"], r"['a\\b']"),
        (["two\nlines"], r"['two\nlines']"),
        (['say "x"'], "['say \"x\"']"),
        (["ä_5"], "['ä_5']"),
        (["a", "b, 'c'", ""], r"['a', 'b, \'c\'', '']"),
        ([], "[]"),
        (["a", None], "['a', null]"),
        ([None], "[null]"),
        (["None"], "['None']"),
        (["a", "None", "It's None, null"], r"['a', 'None', 'It\'s None, null']"),
    ],
)
def test_cell_text(spark, ids, text):
    df = spark.createDataFrame([(ids, text)], "ids array<string>, text string")
    row = df.select(encode_cell(F.col("ids")).alias("t"), decode_cell(F.col("text")).alias("i")).first()
    assert (row.t, row.i) == (text, ids)


def test_bare_text_and_double_quotes_decode(spark):
    df = spark.createDataFrame([("Plant1",), ('["It\'s"]',), ("['a', 'b']",)], "t string")
    assert [r.i for r in df.select(decode_cell(F.col("t")).alias("i")).collect()] == [
        ["Plant1"],
        ["It's"],
        ["a", "b"],
    ]


@pytest.mark.parametrize(
    "text, ids",
    [
        ("['a', None]", ["a", None]),
        ("[None]", [None]),
        ("[ None,'None' , \"None\"]", [None, "None", "None"]),
        (r"['\'None\'', None, '']", ["'None'", None, ""]),
    ],
)
def test_none_in_a_cell(spark, text, ids):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decode_cell(F.col("t"))).first()[0] == ids


@pytest.mark.parametrize("text", ["['a'", "[", "['a' 'b']"])
def test_broken_cells_fail(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="MALFORMED|not a list"):
        df.select(decode_cell(F.col("t")).alias("i")).collect()


def test_first_object(spark):
    df = spark.createDataFrame([("['MAT-1']",), (r"['It\'s', 'b']",), ("bare",), ("[]",), (None,)], "t string")
    assert [r.q for r in df.select(first_object(F.col("t")).alias("q")).collect()] == ["MAT-1", "It's", "bare", None, None]


def csv_file(tmp_path, *lines):
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_columns_are_found_by_name(spark, tmp_path):
    order = [c for c in reversed(ocel.LOG_ORDER)]
    values = {ocel.ACTIVITY: "Goods Issue", ocel.EID: "e7", ocel.AFTER: "2.5", ocel.object_column("MAT"): "['MAT-1']"}
    path = csv_file(tmp_path, ",".join([*order, "more"]), ",".join([*[values.get(c, "") for c in order], "x"]))
    row = read_event_log(spark, path).first()
    assert (row[ocel.ACTIVITY], row[ocel.EID], row[ocel.AFTER], row[ocel.BEFORE]) == ("Goods Issue", "e7", 2.5, None)
    assert row[ocel.object_column("MAT")] == ["MAT-1"]


def test_bad_numbers_and_missing_columns_fail(spark, tmp_path):
    row = ["1x" if c == ocel.AFTER else "" for c in ocel.LOG_ORDER]
    with pytest.raises(Exception, match="MALFORMED"):
        read_event_log(spark, csv_file(tmp_path, ",".join(ocel.LOG_ORDER), ",".join(row))).collect()
    with pytest.raises(ValueError, match="lacks"):
        read_event_log(spark, csv_file(tmp_path, ",".join(ocel.LOG_ORDER[1:])))


def test_relabelled_file_keeps_labels_and_order(spark, tables):
    """Also for plants with quotes and backslashes."""
    log, out = scratch_path(spark, "log"), scratch_path(spark, "post")
    files.write_log(tables, log, SETTINGS)
    files.write_relabelled_log(spark, tables, log, out, SETTINGS)
    assert rows(read_event_log(spark, out)) == rows(inventory.relabelled_event_log(tables, SETTINGS))


def test_log_survives_csv(spark, tables):
    log = inventory.event_log(tables, SETTINGS)
    path = scratch_path(spark, "log")
    write_event_log(log, path)
    back = read_event_log(spark, path)
    assert back.columns == log.columns and [f.dataType for f in back.schema] == [f.dataType for f in log.schema]
    assert rows(back) == rows(log) and len(rows(log)) == 5
    header = spark.read.text(path).first().value
    assert header == ",".join(ocel.LOG_ORDER)


def test_csv_is_in_event_order(spark):
    small = stage(spark, SMALL)
    path = scratch_path(spark, "log")
    files.write_log(small, path, SETTINGS)
    text = read_event_log_text(spark, path).select(
        F.input_file_name().alias("f"), F.expr("CAST(substr(`ocel:eid`, 2) AS BIGINT)").alias("p")
    )
    per_file = text.groupBy("f").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).orderBy("f").collect()
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))


def test_relabelling_from_csv_equals_relabelling_in_memory(spark):
    small = stage(spark, SMALL)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "post")
    files.write_log(small, log, SETTINGS, ordered=False)
    files.write_relabelled_log(spark, small, log, out, SETTINGS)
    assert rows(read_event_log(spark, out)) == rows(inventory.relabelled_event_log(small, SETTINGS))


def test_relabelled_rows_stand_in_the_order_of_the_log(spark):
    small = stage(spark, SMALL)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "post")
    files.write_log(small, log, SETTINGS)
    files.write_relabelled_log(spark, small, log, out, SETTINGS)
    text, total = with_position(read_event_log_text(spark, out))
    found = text.orderBy("position").select("position", "`ocel:eid`").collect()
    places = [int(r[1][1:]) for r in found]
    assert places == sorted(places) and [r[0] for r in found] == list(range(total))


def test_relabelled_rows_go_to_their_place_without_a_sample(spark):
    small = stage(spark, SMALL)
    log = scratch_path(spark, "log")
    files.write_log(small, log, SETTINGS)
    df = files.relabel_text_log(read_event_log_text(spark, log), inventory.parameters(small, SETTINGS))
    assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_relabelling_shuffles_the_rows_of_the_log_once(spark):
    """Once placed, they go straight to their partition; the bounds come to them."""
    small = stage(spark, SMALL)
    log = scratch_path(spark, "log")
    files.write_log(small, log, SETTINGS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = files.relabel_text_log(read_event_log_text(spark, log), inventory.parameters(small, SETTINGS))
        shown = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", shown)
    assert len([columns for columns in shuffled if "position#" in columns]) == 1


def test_pairs_and_rows_without_a_pair_meet_in_every_partition(spark, tables, tmp_path):
    """A pair in all partitions gets its bounds in each; one without plant, material or parameters gets none."""
    cells = ["['MAT-1'],['It\\'s\\\\a']", "['MAT-1'],", ",['It\\'s\\\\a']", "['MAT-77'],['Nowhere']", "[],[]"]
    lines = [f"e{i},,{cell.split(',')[0]},Goods Issue,{cell.split(',')[1]},,1996-04-02,5,4,own,7" for i, cell in enumerate(cells * 8)]
    out = scratch_path(spark, "post")
    files.write_relabelled_log(spark, tables, csv_file(tmp_path, WIDE, *lines), out, SETTINGS)
    found = with_position(read_event_log_text(spark, out))[0].orderBy("position")
    labels = [(r[0], r[1]) for r in found.select(f"`{ocel.EID}`", f"`{ocel.ACTIVITY}`").collect()]
    assert [eid for eid, _ in labels] == [f"e{i}" for i in range(40)]
    assert all(label.startswith("Goods Issue (") == (n % 5 == 0) for n, (_, label) in enumerate(labels))


def test_positions_over_many_blocks(spark, tmp_path):
    lines = [f"e{i},a,2024-01-01,{'x' * (i % 50)}" for i in range(3000)]
    header = f"{ocel.EID},{ocel.ACTIVITY},{ocel.TIMESTAMP},note"
    for n, part in enumerate((lines[:100], [], lines[100:2500], lines[2500:])):
        (tmp_path / f"part-{n}.csv").write_text("\n".join([header, *part]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows, total = with_position(read_event_log_text(spark, str(tmp_path)))
        found = {r.position: r[0] for r in rows.select(f"`{ocel.EID}`", "position").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert total == 3000 and found == {i: f"e{i}" for i in range(3000)}


def test_written_files_are_compressed(spark, tables, tmp_path):
    csv, xml = str(tmp_path / "csv"), str(tmp_path / "xml")
    files.write_log(tables, csv, SETTINGS)
    files.write_xml(tables, xml, SETTINGS)
    for folder in ("csv", "xml/events", "xml/objects", "xml/event-types", "xml/object-types"):
        parts = [p for p in (tmp_path / folder).iterdir() if p.name.startswith("part-")]
        assert parts and all(p.read_bytes()[:2] == b"\x1f\x8b" for p in parts), folder
    assert read_event_log(spark, csv).count() == read_ocel_events(spark, xml).count() == inventory.event_log(tables, SETTINGS).count() > 0


def test_positions_over_files_of_one_task(spark, tmp_path, monkeypatch):
    """A task cuts its rows into several files, whose names follow its rows."""
    monkeypatch.setitem(event_log_csv.GZIP, "maxRecordsPerFile", "7")
    names = {ocel.EID: F.concat(F.lit("e"), F.col("id")), ocel.ACTIVITY: F.lit("a"), ocel.TIMESTAMP: F.lit(dt.date(2024, 1, 1))}
    path = str(tmp_path / "log")
    write_event_log(spark.range(0, 100, 1, 2).select(*[c.alias(n) for n, c in names.items()]), path)
    rows, total = with_position(read_event_log_text(spark, path))
    found = {r.position: r[0] for r in rows.select(f"`{ocel.EID}`", "position").collect()}
    assert len(list((tmp_path / "log").glob("part-*"))) == 16
    assert total == 100 and found == {i: f"e{i}" for i in range(100)}


@pytest.mark.parametrize(
    "cell, found",
    [("['a']", ["a"]), ("['']", [""]), ("['a', 'b']", ["a", "b"]), ("['a', ']']", ["a", "]"]), ("['a\\'b']", ["a'b"]), ("['é\nx']", ["é\nx"]), ("['", None)],
)
def test_cells_of_one_and_more_ids(spark, cell, found):
    df = spark.createDataFrame([(cell,)], "t string").select(decode_cell(F.col("t")).alias("x"))
    if found is None:
        with pytest.raises(Exception):
            df.collect()
    else:
        assert df.first().x == found


WIDE = f"{ocel.EID},Weight,{ocel.object_column('MAT')},{ocel.ACTIVITY},{ocel.object_column('PLA')},{ocel.object_column('Lot')},{ocel.TIMESTAMP},{ocel.BEFORE},{ocel.AFTER},activity,stock_before"


def test_a_log_keeps_all_its_columns(spark, tables, tmp_path):
    """Other object types, other attributes, also with names that relabelling uses itself."""
    first = "e1,2.50,['MAT-1'],Goods Issue,['It\\'s\\\\a'],\"['L1', None, 'None']\",1996-04-02,5,4,own,7"
    second = "e2,,['MAT-9'],Count,,,1996-04-03,,,,"
    path = csv_file(tmp_path, WIDE, first, second)
    out = scratch_path(spark, "post")
    files.write_relabelled_log(spark, tables, path, out, SETTINGS)
    log = read_event_log(spark, out, {"Weight": "double"})
    assert ",".join(log.columns) == WIDE
    one, two = sorted(log.collect(), key=lambda r: r[ocel.EID])
    assert one["Weight"] == 2.5 and one[ocel.object_column("Lot")] == ["L1", None, "None"]
    assert one[ocel.ACTIVITY].startswith("Goods Issue (") and (one["activity"], one["stock_before"]) == ("own", "7")
    assert tuple(two) == ("e2", None, ["MAT-9"], "Count", None, None, dt.date(1996, 4, 3), None, None, None, None)

    xml = scratch_path(spark, "xml")
    write_ocel_xml(log, xml)
    events = read_ocel_events(spark, xml)
    assert dict(events.dtypes)["Weight"] == "double" and rows(events) == rows(ocel.ocel_events(log))
    assert ("L1", "Lot") in rows(read_ocel_objects(spark, xml))
    assert {r.name for r in ocel.ocel_summary(log).where("section = 'objects'").collect()} == {"MAT", "PLA", "Lot", "total"}


def test_a_log_without_objects_or_attributes(spark, tmp_path):
    log = read_event_log(spark, csv_file(tmp_path, f"{ocel.TIMESTAMP},{ocel.EID},{ocel.ACTIVITY}", "1996-04-02,e1,a"))
    assert rows(ocel.ocel_relations(log)) == [] and rows(ocel.ocel_events(log)) == [("e1", "a", dt.date(1996, 4, 2))]
    xml = scratch_path(spark, "xml")
    write_ocel_xml(log, xml)
    assert rows(read_ocel_events(spark, xml)) == [("e1", "a", dt.date(1996, 4, 2))]


def test_log_survives_xml(spark, tables):
    log = inventory.event_log(tables, SETTINGS)
    path = scratch_path(spark, "xml")
    write_ocel_xml(log, path)
    assert rows(read_ocel_events(spark, path)) == rows(ocel.ocel_events(log))
    assert rows(read_ocel_relations(spark, path)) == rows(ocel.ocel_relations(log))
    assert rows(read_ocel_objects(spark, path)) == rows(ocel.ocel_objects(log))
    text = "\n".join(r.value for r in spark.read.text(f"{path}/events").collect())
    assert 'type="Create Sales Order Item" time="1996-02-01T00:00:00Z"' in text
    assert '<relationship object-id="SO_ITEM--4-1" qualifier="SO_ITEM"' in text
    types = {
        r._name for r in spark.read.format("xml").option("rowTag", "object-type").load(f"{path}/object-types").collect()
    }
    assert types == {"MAT", "PLA", "PO_ITEM", "SO_ITEM", "CUSTOMER", "SUPPLIER", "MAT_PLA"}


def test_tables_of_plain_files_lose_nothing(spark, tables):
    """Movements that do not lie by month, with and without a note that says they do."""
    path = scratch_path(spark, "tables")
    for name in tables:
        tables[name].write.parquet(f"{path}/{name}")
    as_of = dt.date(1996, 12, 1)
    wanted = rows(demand.daily_demand(tables, as_of)), rows(demand.lead_times(tables, as_of))
    assert wanted[0]
    for _ in range(2):
        back = read_tables(spark, path)
        assert (rows(demand.daily_demand(back, as_of)), rows(demand.lead_times(back, as_of))) == wanted
        assert rows(back["GoodsReceiptsAndIssues"]) == rows(tables["GoodsReceiptsAndIssues"])
        months = Months("posting_month", "date_of_the_posting_in_the_document")
        write_text(spark, f"{path}/layout.json", json.dumps({"months": {"GoodsReceiptsAndIssues": asdict(months)}}))


def test_tables_by_month_without_their_note(spark, tables):
    path = scratch_path(spark, "tables")
    write_tables(tables, path)
    write_text(spark, f"{path}/layout.json", json.dumps({"months": {}}))
    back = read_tables(spark, path)
    as_of = dt.date(1996, 12, 1)
    assert rows(demand.daily_demand(back, as_of)) == rows(demand.daily_demand(tables, as_of)) != []


def test_typed_tables_survive_parquet(spark, tables):
    path = scratch_path(spark, "tables")
    write_tables(tables, path)
    back = read_tables(spark, path)
    assert set(back) == set(tables)
    for name in tables:
        assert rows(back[name]) == rows(tables[name]), name


def test_summary(spark, tables):
    found = {(r.section, r.name): r.value for r in ocel.ocel_summary(inventory.event_log(tables, SETTINGS)).collect()}
    assert found == {
        ("events", "Create Purchase Order Item"): 1,
        ("events", "Create Sales Order Item"): 1,
        ("events", "Goods Issue"): 3,
        ("events", "total"): 5,
        ("activities", "total"): 3,
        ("objects", "MAT"): 1,
        ("objects", "PLA"): 3,
        ("objects", "MAT_PLA"): 3,
        ("objects", "PO_ITEM"): 1,
        ("objects", "SO_ITEM"): 1,
        ("objects", "CUSTOMER"): 2,
        ("objects", "SUPPLIER"): 1,
        ("objects", "total"): 12,
        ("object types", "total"): 7,
    }


ODD_TEXTS = ["plain", "  sp  ", "a&b", "a<b>c", "q\"u'o", "n\nl", "c\rr", "]]>", "é\U0001f600", "\u0085x", "", "\n x \n", "null", "&amp;", None]


def odd_log(spark):
    day, kinds = dt.date(1996, 4, 2), "string, `{}` string, `{}` date, `{}` array<string>, `{}` array<string>, Note string, ` y` double"
    kinds = f"`{ocel.EID}` {kinds}".format(ocel.ACTIVITY, ocel.TIMESTAMP, ocel.object_column("MAT"), ocel.object_column("Lot"))
    found = [(f"e{n}", text, day, [text], ["L1", text, "L2"], text, float(n)) for n, text in enumerate(ODD_TEXTS)]
    found += [("f1", "a", day, None, [], "x", None), ("f2", "a", None, ["m"], ["b", "c"], "  ", 1.5), (None, "a", day, ["m"], None, "y", 2.5)]
    return spark.createDataFrame(found, kinds)


def test_lines_of_xml_hold_what_the_xml_parser_reads(spark, tmp_path, monkeypatch):
    """Elements on one line, plain or not, read as lines and by Spark's XML reader; every file is a whole document."""
    monkeypatch.setitem(event_log_csv.GZIP, "maxRecordsPerFile", "4")
    log, path = odd_log(spark), str(tmp_path / "xml")
    write_ocel_xml(log.coalesce(2), path)
    parts = [ElementTree.fromstring(gzip.decompress(p.read_bytes())) for p in (tmp_path / "xml/events").glob("part-*.xml.gz")]
    assert {p.tag for p in parts} == {"events"} and sum(map(len, parts)) == log.count() and max(map(len, parts)) == 4
    read = [read_ocel_events, read_ocel_relations, read_ocel_objects]
    found = [rows(r(spark, path)) for r in read]
    assert ("  sp  ".strip(), "MAT") in found[2] and len(found[0]) == log.count()
    assert ("L2", "Lot") in found[2] and ("f2", "c") in {(r[0], r[3]) for r in found[1]}
    for folder in ("events", "objects"):
        (tmp_path / "xml" / folder / LINES_NOTE).unlink()
    assert [rows(r(spark, path)) for r in read] == found


def test_events_are_read_as_lines(spark, tables, tmp_path):
    """Spark's XML reader and writer took most of the time of the XML; they get single elements only."""
    path = str(tmp_path / "xml")
    write_ocel_xml(inventory.event_log(tables, SETTINGS), path)
    for read in (read_ocel_events, read_ocel_relations, read_ocel_objects):
        plan = read(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" in plan and plan.count("from_xml") == 1, read


def test_files_of_others_in_a_folder_of_lines(spark, tmp_path):
    log, path = odd_log(spark), str(tmp_path / "xml")
    write_ocel_xml(log, path)
    other = event_elements(log)
    options = {"rootTag": "events", "rowTag": "event"}
    other.write.mode("append").format("xml").options(**options).save(f"{path}/events")
    with pytest.raises(Exception, match="not an element on one line"):
        read_ocel_events(spark, path).collect()
    other.write.mode("overwrite").format("xml").options(**options).save(f"{path}/events")
    before = rows(read_ocel_events(spark, path))
    write_ocel_xml(log, path, "append")
    assert rows(read_ocel_events(spark, path)) == sorted(before * 2, key=str)


def test_characters_that_xml_lacks_fail(spark, tmp_path):
    log = odd_log(spark).withColumn("Note", F.lit("a\x01"))
    with pytest.raises(Exception, match="Invalid white space character"):
        write_ocel_xml(log, str(tmp_path / "xml"))


def test_attributes_of_other_types_are_escaped(spark, tmp_path):
    log, path = odd_log(spark).withColumn("Note", F.array(F.lit("a<b"), F.lit("c"))), str(tmp_path / "xml")
    write_ocel_xml(log, path)
    assert {r.Note for r in read_ocel_events(spark, path).collect()} == {"[a<b, c]"}
