"""Running totals and positions inside ordered groups, safe for very large groups.

A window per group is one shuffle and one sort, and is what runs for ordinary
groups. A group too large for one task (say, one material with a third of all
events) is cut into range chunks instead: every chunk is scanned on its own and
shifted by the totals of the chunks before it. Values are added as whole numbers
that hold all their digits, so both ways give the same totals, and which groups
count as large changes the plan only, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.numbers import Scale, nan_to_null, scale_of
from stockweave.session import materialise


@dataclass(frozen=True)
class SkewPolicy:
    """Groups of more than ``max_group_rows`` are cut into chunks, however many there are."""

    max_group_rows: int = 5_000_000
    sample_fraction: float = 0.001


def find_hot_keys(keys: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame | None:
    """Values of the one-column frame ``keys`` that occur more than ``max_group_rows`` times.

    Counts come from a sample when the limit is high enough for the sample to be
    certain; a wrong guess costs time, not correctness.
    """
    (name,) = keys.columns
    fraction = policy.sample_fraction
    if fraction * policy.max_group_rows < 1_000:
        fraction = 1.0
    sampled = keys.sample(fraction, seed=7) if fraction < 1.0 else keys
    counts = sampled.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return hot_keys(counts, policy, fraction)


def hot_keys(counts: DataFrame, policy: SkewPolicy, fraction: float = 1.0) -> DataFrame | None:
    """Same from (key, n) counts taken over ``fraction`` of the rows; None if there are none.

    The keys stay a table, so their number is not limited. Runs a job, and another one to store them if there are any.
    """
    key, n = counts.columns
    limit = fraction * policy.max_group_rows
    if (counts.agg(F.max(n)).first()[0] or 0) <= limit:
        return None
    return materialise(counts.where(F.col(n) > F.lit(limit)).select(key), "hot-keys")


def split_hot(df: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(ordinary rows, rows of the hot keys or None)."""
    if hot is None:
        return df, None
    keys = hot.toDF(key)
    return df.join(keys, key, "left_anti").select(df.columns), df.join(keys, key, "left_semi").select(df.columns)


def _ordering(order: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in order]


def scan_groups(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: str | None = None,
    counted: str | None = None,
    scale: Scale | None = None,
) -> DataFrame:
    """Add ``seq`` (0-based) and, for ``value``, ``total_before``/``total_after`` per group.

    With ``counted``, rows where that column is NULL take no number of their own. Without a
    ``scale`` a job looks for the one that fits ``value``.
    """
    if value is None:
        return _scan_parts(df, groups, order, counted=counted)
    scale = scale or scale_of(df, value)
    scanned = _scan_parts(df, groups, order, value, counted, scale)
    return _in_units(scanned, scale, value)


def _sums(scale: Scale) -> list[str]:
    return [f"_sum_{n}" for n in range(len(scale.split(F.lit(0.0))))]


def _scan_parts(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    value: str | None = None,
    counted: str | None = None,
    scale: Scale | None = None,
) -> DataFrame:
    """``seq``, and up to each row the number of values (``_seen``) and the sums of their parts."""
    window = Window.partitionBy(*groups).orderBy(*_ordering(order))
    window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {"seq": F.count(F.col(counted) if counted else F.lit(1)).over(window) - 1}
    if value and scale:
        added["_seen"] = F.count(nan_to_null(F.col(value))).over(window)
        for name, part in zip(_sums(scale), scale.split(F.col(value)), strict=True):
            added[name] = F.coalesce(F.sum(part).over(window), F.lit(0))
    return df.withColumns(added)


def _in_units(scanned: DataFrame, scale: Scale, value: str) -> DataFrame:
    """Totals after and before a row, NULL where no value was seen; the latter lack the row's own."""
    names = _sums(scale)
    known = nan_to_null(F.col(value)).isNotNull()
    own = [F.when(known, part).otherwise(F.lit(0)) for part in scale.split(F.col(value))]
    earlier = [F.col(name) - part for name, part in zip(names, own, strict=True)]
    totals = {
        "total_before": F.when(F.col("_seen") > known.cast("bigint"), scale.joined(earlier)),
        "total_after": F.when(F.col("_seen") > 0, scale.joined([F.col(n) for n in names])),
    }
    return scanned.withColumns(totals).drop("_seen", *names)


def chunks_of(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``_chunk``, ranges of (group, order), and ``_copy``. Stores the rows twice.

    The copy id separates rows equal in every ordering column, so that even a group
    of copies is cut. It is stored before the range shuffle, and the chunk number
    after it, because both must stay the same when a lost task runs again.
    """
    numbered = materialise(df.withColumn("_copy", F.monotonically_increasing_id()))
    ranges = numbered.repartitionByRange(F.col(group), *_ordering([*order, "_copy"]))
    return materialise(ranges.withColumn("_chunk", F.spark_partition_id()))


def chunk_shifts(chunked: DataFrame, group: str, value: str | None = None, scale: Scale | None = None) -> DataFrame:
    """Per chunk and group in it: rows, values and sums of the chunks before it. One narrow row each."""
    totals = {"seq": F.count("*")}
    if value and scale:
        totals["_seen"] = F.count(nan_to_null(F.col(value)))
        totals |= {n: F.sum(part) for n, part in zip(_sums(scale), scale.split(F.col(value)), strict=True)}
    earlier = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = chunked.groupBy("_chunk", group).agg(*[c.alias(n) for n, c in totals.items()])
    before = [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in totals]
    return per_chunk.select("_chunk", group, *before)


def scan_in_chunks(
    chunked: DataFrame,
    group: str,
    order: Sequence[str],
    value: str | None = None,
    counted: str | None = None,
    scale: Scale | None = None,
    shifts: DataFrame | None = None,
) -> DataFrame:
    """The scan of :func:`chunks_of`, partitioned by (chunk, group); ``_chunk`` stays.

    Every chunk is scanned by itself and shifted by what came before it. ``shifts`` may be given
    where ``chunked`` holds rows besides those that were counted.
    """
    shifts = chunk_shifts(chunked, group, value, scale) if shifts is None else shifts
    scanned = _scan_parts(chunked, ["_chunk", group], [*order, "_copy"], value, counted, scale)
    shifted = scanned.join(shifts, ["_chunk", group])
    names = [c.removesuffix("_before") for c in shifts.columns[2:]]
    shifted = shifted.withColumns({n: F.col(n) + F.col(f"{n}_before") for n in names})
    shifted = shifted.drop("_copy", *shifts.columns[2:])
    return _in_units(shifted, scale, value) if value and scale else shifted


def scan_chunks(
    df: DataFrame, group: str, order: Sequence[str], value: str | None = None, scale: Scale | None = None
) -> DataFrame:
    """Same columns as :func:`scan_groups`, with every group cut into range chunks."""
    chunked = chunks_of(df, group, order)
    if value:
        scale = scale or scale_of(chunked, value)
    return scan_in_chunks(chunked, group, order, value, scale=scale).drop("_chunk")


def scan(
    df: DataFrame, group: str, order: Sequence[str], value: str | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Per-group scan: a window for ordinary groups, chunks for the ``hot`` ones."""
    scale = scale_of(df, value) if value else None
    ordinary, large = split_hot(df, group, hot)
    scanned = scan_groups(ordinary, [group], order, value, scale=scale)
    if large is None:
        return scanned
    return scanned.unionByName(scan_chunks(large, group, order, value, scale))


_DIGIT = 22  # bits of the key resolved per level


def _rows_before(parent: str | None, child: str, n: str) -> Column:
    siblings = Window.partitionBy(parent if parent else F.lit(0))
    frame = siblings.orderBy(child).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(frame), F.lit(0))


def key_offsets(counts: DataFrame, key: str, count: str) -> DataFrame:
    """(key, offset): rows held by all smaller keys, for a frame with one row per bigint key.

    ``counts`` should be stored, as it is read more than once. The key is read as three digits
    of 22 bits: totals are taken per prefix and each level adds up its siblings only, so no
    window partition exceeds 2**22 rows whatever the keys are.
    """
    low = counts.select(
        F.col(key),
        F.shiftright(F.col(key), _DIGIT).alias("_mid"),
        F.col(count).alias("_n"),
    )
    middle = (
        low.groupBy("_mid")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_top", F.shiftright(F.col("_mid"), _DIGIT))
    )
    top = middle.groupBy("_top").agg(F.sum("_n").alias("_n"))

    top = top.select("_top", _rows_before(None, "_top", "_n").alias("_top_offset"))
    middle = (
        middle.select("_mid", "_top", _rows_before("_top", "_mid", "_n").alias("_in_top"))
        .join(top, "_top")
        .select("_mid", (F.col("_in_top") + F.col("_top_offset")).alias("_mid_offset"))
    )
    return (
        low.select(key, "_mid", _rows_before("_mid", key, "_n").alias("_in_mid"))
        .join(middle, "_mid")
        .select(key, (F.col("_in_mid") + F.col("_mid_offset")).alias("offset"))
    )
