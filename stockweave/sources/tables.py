"""The typed ERP tables as one handle, read from and written to parquet."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave.session import read_text, side_by_side, write_text
from stockweave.sources.contracts import CONTRACTS, conform

MONTH = "posting_month"


@dataclass(frozen=True)
class Months:
    """A table stored in one folder per month: the folder's column, and the date it is taken from."""

    column: str
    date: str


# Tables that are filtered by date, and written by month of that date.
BY_MONTH = {"GoodsReceiptsAndIssues": Months(MONTH, "date_of_the_posting_in_the_document")}
LAYOUT = "layout.json"


class Tables(Mapping):
    """Contract-checked DataFrames by table name.

    A table may be given as a function that builds its DataFrame; it is called when the
    table is first used. Nothing is read until an action runs.
    """

    def __init__(
        self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], months: Mapping[str, Months] | None = None
    ):
        self._sources = dict(frames)
        self._months = dict(months or {})
        self._checked: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._checked:
            source = self._sources[name]
            df = source if isinstance(source, DataFrame) else source()
            self._checked[name] = conform(name, df.drop(self._months[name].column) if name in self._months else df)
        return self._checked[name]

    def since(self, name: str, date: str, bound: Column) -> DataFrame:
        """Rows of a table from ``bound`` on; a table known to be stored by month of it reads no earlier month."""
        table = self[name]
        months = self._months.get(name)
        if months and months.date == date:
            month = F.col(months.column)
            # A row without a month may have any date.
            stored = self._sources[name].where((month >= F.trunc(bound, "month")) | month.isNull())
            table = stored.select(*table.columns)
        return table.where(F.col(date) >= bound)

    def __iter__(self) -> Iterator[str]:
        return iter(self._sources)

    def __len__(self) -> int:
        return len(self._sources)


def read_layout(spark: SparkSession, folder: str) -> dict[str, Months]:
    """Which tables of ``folder`` lie by month, as :func:`write_tables` noted there; none without a note."""
    text = read_text(spark, f"{folder}/{LAYOUT}")
    return {name: Months(**told) for name, told in json.loads(text)["months"].items()} if text else {}


def read_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> Tables:
    """Scan ``folder/<table>`` with the declared schema, so no inference job runs.

    Months are folders where the note of :func:`write_tables` says so; they are declared too, as
    their type would be guessed otherwise. Other folders are filtered by the date itself.
    """
    months = {name: m for name, m in read_layout(spark, folder).items() if name in (names or CONTRACTS)}

    def scan(name: str) -> DataFrame:
        schema = CONTRACTS[name].schema
        if name in months:
            schema = T.StructType([*schema.fields, T.StructField(months[name].column, T.DateType())])
            return spark.read.schema(schema).parquet(f"{folder}/{name}")
        # Folders within the table add columns of their own, which the contract does not know.
        return spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.fieldNames())

    return Tables({name: scan(name) for name in (names or CONTRACTS)}, months)


def file_schemas(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables as their files declare them, whatever the contract says, for the contract report."""
    months = read_layout(spark, folder)
    found = {name: spark.read.parquet(f"{folder}/{name}") for name in (names or CONTRACTS)}
    return {name: df.drop(months[name].column) if name in months else df for name, df in found.items()}


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, mode: str = "errorifexists", names: list[str] | None = None
) -> None:
    """Write tables in contract column order, movements in one folder per month of posting.

    Rows of a month are brought together first, so that a folder gets few files; adaptive
    execution splits large months. A note in the folder says which tables lie by month.
    """

    def write(name: str) -> None:
        df = tables[name]
        if name in BY_MONTH:
            months = df.withColumn(MONTH, F.trunc(BY_MONTH[name].date, "month"))
            months.hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH).parquet(f"{folder}/{name}")
        else:
            df.write.mode(mode).parquet(f"{folder}/{name}")

    names = list(names or tables)
    if not names:
        return
    spark = tables[names[0]].sparkSession
    # Noted first: a note about a table that is not there yet does no harm.
    noted = read_layout(spark, folder) | {name: BY_MONTH[name] for name in names if name in BY_MONTH}
    write_text(spark, f"{folder}/{LAYOUT}", json.dumps({"months": {n: asdict(m) for n, m in noted.items()}}))
    side_by_side(spark, [partial(write, name) for name in names])
