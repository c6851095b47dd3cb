"""Reports on contracts, keys and references of the ERP tables.

Spark tables enforce no constraints, so these jobs report violations instead of
rejecting rows. Keys are counted before they are shuffled or joined, so a key that
repeats many times costs one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.sources.contracts import CONTRACTS, SOFT_REFERENCES, Reference


def _union(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def contract_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared column: declared and actual type, rows and NULLs."""

    def report(table: str, df: DataFrame) -> DataFrame:
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        declared = CONTRACTS[table].schema.fields
        filled = [
            (F.count(f.name) if f.name in actual else F.lit(0)).cast("bigint").alias(f"filled_{i}")
            for i, f in enumerate(declared)
        ]
        counted = df.agg(F.count("*").alias("rows"), *filled)
        lines = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("declared_type"),
                F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
                F.lit(actual.get(f.name) == f.dataType.simpleString()).alias("conforms"),
                F.col("rows"),
                (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
            )
            for i, f in enumerate(declared)
        ]
        return counted.select(F.explode(F.array(*lines)).alias("x")).select("x.*")

    return _union([report(table, df) for table, df in frames.items()])


def file_schema_report(columns: Mapping[str, DataFrame]) -> DataFrame:
    """Per table, column and type found: in how many files, and whether that is as declared.

    ``columns`` gives per table (path, column_name, actual_type) of its files. Declared columns that
    files lack have no actual type, columns that are not declared no declared one.
    """

    def report(table: str, found: DataFrame) -> DataFrame:
        declared = F.create_map(
            *[F.lit(x) for f in CONTRACTS[table].schema.fields for x in (f.name, f.dataType.simpleString())]
        )
        per_file = found.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "actual_type"))).alias("own"))
        names = F.array_union(F.map_keys(declared), F.map_keys("own"))
        lines = F.transform(names, lambda n: F.struct(n.alias("column_name"), F.try_element_at("own", n).alias("actual_type")))
        each = per_file.select(F.explode(lines).alias("x")).select("x.*")
        counted = each.groupBy("column_name", "actual_type").agg(F.count("*").alias("files"))
        expected = F.try_element_at(declared, F.col("column_name"))
        return counted.select(
            F.lit(table).alias("table_name"),
            "column_name",
            expected.alias("declared_type"),
            "actual_type",
            expected.eqNullSafe(F.col("actual_type")).alias("conforms"),
            "files",
        )

    return _union([report(table, found) for table, found in columns.items()])


def _total(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)


def _any_null(columns: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def primary_key_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key: rows, rows with a NULL in the key, keys used twice, rows to remove."""

    def report(table: str, key: tuple[str, ...]) -> DataFrame:
        missing, n = F.col("missing"), F.col("n")
        repeated = ~missing & (n > 1)
        grouped = frames[table].groupBy(*key).agg(F.count("*").alias("n"))
        return (
            grouped.select("n", _any_null(key).alias("missing"))
            .agg(
                _total(n, "rows"),
                _total(F.when(missing, n), "null_keys"),
                _total(F.when(repeated, 1), "repeated_keys"),
                _total(F.when(repeated, n - 1), "surplus_rows"),
            )
            .select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(key)).alias("key_columns"),
                "*",
                (F.col("null_keys") + F.col("surplus_rows")).alias("violations"),
            )
        )

    return _union([report(t, CONTRACTS[t].primary_key) for t in frames if CONTRACTS[t].primary_key])


def _references_to(frames: Mapping[str, DataFrame], parent: str, key: tuple[str, ...], children: list[tuple[str, Reference]]) -> DataFrame:
    """The references to one key of ``parent``, all checked in one shuffle by that key.

    Rows carry a tag that tells whether they are the parent's or of which reference, and are
    counted per key and tag before they are shuffled.
    """

    def tagged(table: str, columns: tuple[str, ...], tag: int) -> DataFrame:
        named = [F.col(c).alias(k) for c, k in zip(columns, key, strict=True)]
        return frames[table].select(*named, F.lit(tag).alias("tag")).dropna(subset=list(key))

    rows = [tagged(parent, key, -1), *(tagged(child, ref.columns, i) for i, (child, ref) in enumerate(children))]
    counts = [F.count(F.when(F.col("tag") == i, 1)).alias(f"n{i}") for i in range(len(children))]
    per_key = reduce(DataFrame.unionByName, rows).groupBy(*key).agg(F.max(F.col("tag") == -1).alias("found"), *counts)
    totals = []
    for i in range(len(children)):
        n = F.col(f"n{i}")
        missing = ~F.col("found") & (n > 0)
        totals += [_total(n, f"rows{i}"), _total(F.when(missing, 1), f"keys{i}"), _total(F.when(missing, n), f"violations{i}")]
    lines = [
        F.struct(
            F.lit(child).alias("table_name"),
            F.lit(", ".join(ref.columns)).alias("key_columns"),
            F.lit(parent).alias("parent_table"),
            F.col(f"rows{i}").alias("referencing_rows"),
            F.col(f"keys{i}").alias("missing_keys"),
            F.col(f"violations{i}").alias("violations"),
        )
        for i, (child, ref) in enumerate(children)
    ]
    return per_key.agg(*totals).select(F.explode(F.array(*lines)).alias("x")).select("x.*")


def _reference_reports(frames: Mapping[str, DataFrame], references: Iterable[tuple[str, Reference]]) -> DataFrame:
    by_parent: dict[tuple[str, tuple[str, ...]], list[tuple[str, Reference]]] = {}
    for child, ref in references:
        if child in frames and ref.parent in frames:
            by_parent.setdefault((ref.parent, ref.parent_columns), []).append((child, ref))
    return _union([_references_to(frames, parent, key, children) for (parent, key), children in by_parent.items()])


def foreign_key_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared foreign key: rows with a key, keys without a parent, rows affected."""
    return _reference_reports(frames, [(table, ref) for table in frames for ref in CONTRACTS[table].foreign_keys])


def soft_reference_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Same for the references the joins rely on without a declared key; a warning, not an error."""
    return _reference_reports(frames, SOFT_REFERENCES).withColumn("severity", F.lit("warning"))
