"""Joins that stay even where keys are not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = 64
MOST_BROADCAST = 1_000_000


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    hot: DataFrame | None = None,
    copies: int = COPIES,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key``, with left rows of the keys in ``hot`` spread over ``copies`` tasks.

    Rows without a key match nothing, and would meet in one task; they are spread too, by a hash
    of the columns ``spread``. ``hot`` has one column with the name ``key``; it goes to every task if it has at
    most ``MOST_BROADCAST`` rows, as such keys are few by their size. Above that hot keys are left
    to adaptive execution.
    """
    own = F.hash(*spread)
    place = F.pmod(own, F.lit(copies))
    if hot is not None and hot.count() > MOST_BROADCAST:
        hot = None
    if hot is None:
        salt = F.when(F.col(key).isNull(), own).otherwise(F.lit(0))
        # Always 0, but no constant: the optimizer would take a constant out of the keys of the join.
        salted, matches = left.withColumn("_salt", salt), right.withColumn("_salt", F.pmod(F.hash(key), F.lit(1)))
    else:
        marked = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
        salt = F.when(F.col(key).isNull(), own).when(F.col("_hot"), place).otherwise(F.lit(0))
        salted = left.join(marked, key, "left").withColumn("_salt", salt).drop("_hot")
        all_copies = F.sequence(F.lit(0), F.when(F.col("_hot"), copies - 1).otherwise(F.lit(0)))
        matches = right.join(marked, key, "left").withColumn("_salt", F.explode(all_copies)).drop("_hot")
    return salted.join(matches, [key, "_salt"], "left").drop("_salt")
