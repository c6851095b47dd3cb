"""Headline jobs at one scale factor; prints one JSON line.

``stage_tables`` writes the typed ERP tables; the other jobs read those tables and run to
the end without keeping their rows. Every job runs once on a smaller scale factor, where
there is one, to warm the JVM, and then once for the record.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

from stockweave.operators import demand, ocel, quality
from stockweave.plans import files, inventory
from stockweave.plans.inventory import JobSettings
from stockweave.session import build_session, scratch_path, scratch_scope
from stockweave.sources.staging import stage
from stockweave.sources.tables import read_tables, write_tables

SETTINGS = JobSettings(as_of=dt.date(1997, 1, 1))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark, tables) -> dict:
    def log():
        return inventory.event_log(tables, SETTINGS)

    return {
        "event_log": lambda: consume(log()),
        "event_log_csv": lambda: files.write_log(tables, scratch_path(spark, "log"), SETTINGS),
        "inventory_parameters": lambda: consume(inventory.inventory_parameters(tables, SETTINGS)),
        "lead_times": lambda: consume(demand.lead_times(tables, SETTINGS.as_of)),
        "relabelled_event_log": lambda: consume(inventory.relabelled_event_log(tables, SETTINGS)),
        "ocel_relations": lambda: consume(ocel.ocel_relations(log())),
        "ocel_objects": lambda: consume(inventory.log_objects(tables, SETTINGS)),
        "ocel_summary": lambda: consume(inventory.log_summary(tables, SETTINGS)),
        "ocel_xml": lambda: files.write_xml(tables, scratch_path(spark, "xml"), SETTINGS),
        "dq_primary_keys": lambda: consume(quality.primary_key_report(tables)),
        "dq_foreign_keys": lambda: consume(quality.foreign_key_report(tables)),
    }


def timed(spark, action) -> float:
    start = time.perf_counter()
    with scratch_scope(spark):
        action()
    return round(time.perf_counter() - start, 3)


def run(spark, folder: str) -> dict[str, float]:
    staged = scratch_path(spark, "tables")
    seconds = {"stage_tables": timed(spark, lambda: write_tables(stage(spark, folder, store_lines=True), staged))}
    for name, job in jobs(spark, read_tables(spark, staged)).items():
        seconds[name] = timed(spark, job)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scale = re.search(r"sf([\d.]+)$", folder)
    spark = build_session("bench", cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    smaller = Path(folder).with_name("sf0.01")
    if smaller.is_dir() and smaller != Path(folder):
        print("warm-up", run(spark, str(smaller)), file=sys.stderr, flush=True)
    seconds = run(spark, folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
