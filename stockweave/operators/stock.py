"""Running stock, event ids, stock floor and adjustment.

The events are shuffled once, by material: the running sums, the event position, the floor
per (material, plant) and the parameters of the pair all work inside that partitioning. A
narrow pass before it counts the events per material.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave.functions.numbers import Scale
from stockweave.operators.events import EVENT_ORDER
from stockweave.operators.running import (
    SkewPolicy,
    chunk_shifts,
    chunks_of,
    hot_keys,
    key_offsets,
    scan_chunks,
    scan_groups,
    scan_in_chunks,
    split_hot,
)
from stockweave.session import materialise, spread_by

StockAfter = Literal["reference", "running"]
PAIR = ["material", "plant"]
ROWS_PER_FILE = 1_000_000


def _as_stock(scanned: DataFrame) -> DataFrame:
    return scanned.withColumnsRenamed({"total_before": "stock_before", "total_after": "stock_after"})


def running_stock(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Stock of the material before and after every event, over all its plants.

    ``stock_before`` is NULL on the first event of a material.
    """
    known = events.agg(F.count("*").alias("total"), *Scale.facts(F.col("quantity_change"))).first()
    scale = Scale.of(known)
    ordinary, large = split_hot(events, "material", hot)
    ordinary = spread_by(ordinary, "material", known["total"])
    scanned = scan_groups(ordinary, ["material"], EVENT_ORDER, "quantity_change", scale=scale)
    if large is not None:
        scanned = scanned.unionByName(scan_chunks(large, "material", EVENT_ORDER, "quantity_change", scale))
    return _as_stock(scanned)


def complete(running: DataFrame) -> DataFrame:
    """Events with a known stock before and after; this drops the first event of a material."""
    return running.dropna(subset=["stock_before", "stock_after"])


@dataclass(frozen=True)
class Numbering:
    """What one narrow pass over the events tells: how many there are before each material."""

    total: int
    offsets: DataFrame  # (material, offset)
    hot: DataFrame | None  # (material), None if no material is too large
    scale: Scale  # holds every quantity


def number_events(events: DataFrame, skew: SkewPolicy = SkewPolicy()) -> Numbering:
    """Count the events per material, and from that offsets, materials too large for one task and the scale."""
    facts = Scale.facts(F.col("quantity_change"))
    counts = materialise(events.groupBy("material").agg(F.count("*").alias("n"), *facts), "counts")
    known = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most"), *Scale.combined()).first()
    counts = counts.select("material", "n")
    return Numbering(
        total=known["total"] or 0,
        offsets=key_offsets(counts, "material", "n"),
        hot=hot_keys(counts, skew) if (known["most"] or 0) > skew.max_group_rows else None,
        scale=Scale.of(known),
    )


def with_position(running: DataFrame, offsets: DataFrame) -> DataFrame:
    """``position``: 0-based row in the order (material, event order), over all events.

    To be taken before :func:`complete`, so that positions of dropped events stay unused.
    """
    return running.join(offsets, "material").withColumn("position", F.col("offset") + F.col("seq")).drop("offset")


def _adding(stock_min: Column) -> Column:
    """What lifts the lowest stock of a pair to zero; pairs without a plant have none."""
    return F.when(F.col("plant").isNotNull(), F.greatest(F.lit(0.0), -stock_min))


def stock_floor(completed: DataFrame) -> DataFrame:
    """(material, plant) with the lowest stock seen and the amount that lifts it to zero."""
    return (
        completed.where(F.col("plant").isNotNull())
        .groupBy(*PAIR)
        .agg(F.min("stock_before").alias("min_before"), F.min("stock_after").alias("min_after"))
        .withColumn("stock_min", F.least("min_before", "min_after"))
        .withColumn("adding_stock", _adding(F.col("stock_min")))
    )


def _known() -> Column:
    return F.col("stock_before").isNotNull() & F.col("stock_after").isNotNull()


def _lowest() -> Column:
    return F.when(_known(), F.least("stock_before", "stock_after"))


def _in_position_order(events: DataFrame, numbering: Numbering) -> DataFrame:
    """Complete events with ``position`` and ``adding_stock``, sorted by position over all partitions.

    Positions follow the materials, so a range of materials holds a range of positions, and the windows
    of a material need no other partitioning: one shuffle does for both. The offset of a material is a row
    ahead of its events, as a join would shuffle the events once more.
    """
    least = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-numbering.total // ROWS_PER_FILE))
    rows = events.unionByName(numbering.offsets, allowMissingColumns=True).repartitionByRange(parts, "material")
    scanned = scan_groups(rows, ["material"], EVENT_ORDER, "quantity_change", counted="branch", scale=numbering.scale)
    earlier = Window.partitionBy("material").orderBy(*[F.col(c).asc_nulls_first() for c in EVENT_ORDER])
    earlier = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.last("offset", ignorenulls=True).over(earlier)
    placed = _as_stock(scanned).withColumn("position", offset + F.col("seq")).drop("offset")
    floored = placed.withColumn("adding_stock", _adding(F.min(_lowest()).over(Window.partitionBy(*PAIR))))
    return floored.where(F.col("branch").isNotNull() & _known()).sortWithinPartitions("position")


def _floored_by_window(
    events: DataFrame, offsets: DataFrame, scale: Scale, parameters: DataFrame | None, total: int
) -> DataFrame:
    """Complete events with ``position``, ``adding_stock`` and the parameters of their pair.

    Being partitioned by material is enough for a window over (material, plant), so the
    floor costs no shuffle. Neither do the parameters: they travel as rows of their own in
    the shuffle of the events, ahead of the events of their material, and the same window
    hands them to the events of their pair.
    """
    names = [c for c in parameters.columns if c not in PAIR] if parameters is not None else []
    if names:
        events = events.unionByName(parameters.dropna(subset=PAIR), allowMissingColumns=True)
    # Only events have a branch.
    events = spread_by(events, "material", total)
    scanned = scan_groups(events, ["material"], EVENT_ORDER, "quantity_change", counted="branch", scale=scale)
    rows = with_position(_as_stock(scanned), offsets)
    pair = Window.partitionBy(*PAIR)
    of_pair = {name: F.when(F.col("plant").isNotNull(), F.max(name).over(pair)) for name in names}
    return rows.withColumns({"adding_stock": _adding(F.min(_lowest()).over(pair)), **of_pair}).where(
        F.col("branch").isNotNull() & _known()
    )


def _floored_by_chunks(
    events: DataFrame, offsets: DataFrame, scale: Scale, parameters: DataFrame | None
) -> DataFrame:
    """Same for materials too large for one task, out of the partitioning of their chunks.

    A chunk gives the lowest stock of each of its pairs, already shifted by the chunks before
    it. These few rows are brought together by material, along with the parameters, and
    what is known of a pair goes back into each of its chunks as a row ahead of the events.
    Events are shuffled by chunk only, never by pair.
    """
    names = [c for c in parameters.columns if c not in PAIR] if parameters is not None else []
    chunked = chunks_of(events, "material", EVENT_ORDER)
    shifts = chunk_shifts(chunked, "material", "quantity_change", scale).join(offsets, "material")
    # From here on ``seq`` counts all events.
    shifts = shifts.withColumn("seq_before", F.col("seq_before") + F.col("offset"))
    shifts = materialise(shifts.select("_chunk", "material", *[c for c in shifts.columns if c.endswith("_before")]))

    def scanned(rows: DataFrame) -> DataFrame:
        found = scan_in_chunks(rows, "material", EVENT_ORDER, "quantity_change", "branch", scale, shifts)
        return _as_stock(found)

    narrow = chunked.select("_chunk", "_copy", *EVENT_ORDER, "material")
    lowest = scanned(narrow).where(F.col("plant").isNotNull()).groupBy("_chunk", *PAIR).agg(F.min(_lowest()).alias("lowest"))
    if names:
        lowest = lowest.unionByName(parameters.dropna(subset=PAIR), allowMissingColumns=True)
    pair = Window.partitionBy(*PAIR)
    of_pair = {"adding_stock": _adding(F.min("lowest").over(pair)), **{n: F.max(n).over(pair) for n in names}}
    known = lowest.repartition("material").withColumns(of_pair).where(F.col("_chunk").isNotNull()).drop("lowest")

    rows = scanned(chunked.unionByName(known, allowMissingColumns=True))
    here = Window.partitionBy("_chunk", *PAIR)
    handed = {n: F.when(F.col("plant").isNotNull(), F.max(n).over(here)) for n in ("adding_stock", *names)}
    rows = rows.withColumns(handed).where(F.col("branch").isNotNull() & _known())
    return rows.withColumn("position", F.col("seq")).drop("_chunk")


def _adjust(floored: DataFrame, stock_after: StockAfter) -> DataFrame:
    lifted = F.col("stock_before") + F.col("adding_stock")
    if stock_after == "reference":
        # Builds on the lifted stock before, not on the running stock after: the event's
        # own quantity drops out and the floor counts twice.
        after = lifted + F.col("adding_stock")
    elif stock_after == "running":
        after = F.col("stock_after") + F.col("adding_stock")
    else:
        raise ValueError(f"unknown stock_after mode {stock_after!r}")
    return floored.withColumns({"stock_before": lifted, "stock_after": after})


def adjusted_events(
    events: DataFrame,
    numbering: Numbering,
    stock_after: StockAfter = "reference",
    parameters: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Narrow events with position and stock lifted so that no (material, plant) falls below zero.

    ``parameters``, with one row per (material, plant), adds its other columns to the events
    of the pair: a left join that is planned along with the floor. ``ordered`` sorts by position.
    """
    # Ranges are found by a sample, for which parameters would be computed once more.
    if ordered and numbering.hot is None and parameters is None:
        return _adjust(_in_position_order(events, numbering), stock_after).drop("seq")
    ordinary, large = split_hot(events, "material", numbering.hot)
    floored = _floored_by_window(ordinary, numbering.offsets, numbering.scale, parameters, numbering.total)
    if large is not None:
        of_hot = numbering.offsets.join(numbering.hot, "material", "left_semi")
        if parameters is not None:
            parameters = parameters.join(numbering.hot, "material", "left_semi")
        floored = floored.unionByName(_floored_by_chunks(large, of_hot, numbering.scale, parameters))
    adjusted = _adjust(floored, stock_after).drop("seq")
    return in_order(adjusted, numbering.total) if ordered else adjusted


def part_of_position(spark: SparkSession, total: int, rows_per_file: int = ROWS_PER_FILE) -> tuple[int, Column]:
    """A number of partitions of equal size that follow each other, and the one that a position belongs to.

    The number of partitions follows the number of rows, with at least the session's number for small logs.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-total // rows_per_file))
    rows = max(1, -(-total // parts))
    return parts, F.expr(f"CAST(position DIV {rows} AS INT)")


def in_order(events: DataFrame, total: int, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Events by position, in the partitions of :func:`part_of_position`.

    Positions are known and nearly dense, so each row's partition follows from its position;
    sorting globally would first run the whole plan to sample them.
    """
    parts, own = part_of_position(events.sparkSession, total, rows_per_file)
    return events.repartitionById(parts, own).sortWithinPartitions("position")
