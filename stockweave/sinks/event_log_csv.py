"""Event logs as CSV folders with a header, gzip part files of a million rows at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.objects import encode_cell
from stockweave.operators.ocel import TIMESTAMP

CSV_OPTIONS = {"header": "true", "escape": '"', "dateFormat": "yyyy-MM-dd"}
# Repeated ids make most of a log, so the fastest level is enough. One task reads a compressed
# file, hence the bound on its rows.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}


def encoded(log: DataFrame) -> DataFrame:
    """The log with array cells as text and dates in ISO form: CSV holds no arrays."""
    kinds = dict(log.dtypes)

    def text(name: str):
        column = F.col(f"`{name}`")
        if kinds[name].startswith("array"):
            return encode_cell(column).alias(name)
        return column.cast("string").alias(name) if name == TIMESTAMP else column

    return log.select(*[text(name) for name in log.columns])


def write_event_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    encoded(log).write.mode(mode).options(**CSV_OPTIONS, **GZIP).csv(path)
