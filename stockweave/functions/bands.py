"""Stock bands and the activity labels built from them.

Understock lies below the safety stock, Overstock from the overstock level up, Normal
between. A comparison with a missing value holds for no band, so such an event keeps
its activity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The labels. A band change that is not listed leaves the activity as it is.
LABELS = (
    "Goods Receipt (Understock to Understock)",
    "Goods Receipt (Understock to Normal)",
    "Goods Receipt (Understock to Overstock)",
    "Goods Receipt (Normal to Normal)",
    "Goods Receipt (Normal to Overstock)",
    "Goods Receipt (Overstock to Overstock)",
    "Goods Issue (Understock to Understock)",
    "Goods Issue (Normal to Understock)",
    "Goods Issue (Normal to Normal)",
    "Goods Issue (Overstock to Normal)",
    "Goods Issue (Overstock to Overstock)",
    "Create Sales Order Item (Understock to Understock)",
    "Create Sales Order Item (Normal to Understock)",
    "Create Sales Order Item (Overstock to Understock)",
    "Create Sales Order Item (Normal to Normal)",
    "Create Sales Order Item (Overstock to Normal)",
    "Create Sales Order Item (Overstock to Overstock)",
    "Create Purchase Order Item (Understock)",
    "Create Purchase Order Item (Normal)",
    "Create Purchase Order Item (Overstock)",
    "Create Purchase Suggestion Item (Understock)",
    "Create Purchase Suggestion Item (Normal)",
    "Create Purchase Suggestion Item (Overstock)",
)
SALES = "Create Sales Order Item"
LABELLED_BY_START = ("Create Purchase Order Item", "Create Purchase Suggestion Item")


def band(stock: Column, is_low: Column, overstock: Column) -> Column:
    """Band of ``stock``, of which ``is_low`` says whether it is Understock."""
    return (
        F.when(is_low, "Understock")
        .when(~is_low & (stock < overstock), "Normal")
        .when(~is_low & (stock >= overstock), "Overstock")
    )


def relabelled(
    df: DataFrame, activity: str, before: str, after: str, safety: str, overstock: str
) -> DataFrame:
    """``df`` with the labelled activity in place of the plain one.

    A sales order item counts the safety stock itself as Understock: always for the stock
    after, and for the stock before if the event ends in Understock.

    Each step is a projection of its own, which keeps the generated methods small enough
    for the JIT compiler.
    """
    name, low, high = F.col(activity), F.col(safety), F.col(overstock)
    sales = name == SALES
    ends_low = F.when(sales, F.col(after) <= low).otherwise(F.col(after) < low)
    starts_low = F.when(sales & F.col("_ends_low"), F.col(before) <= low).otherwise(F.col(before) < low)
    by_start = F.concat(name, F.lit(" ("), F.col("_start"), F.lit(")"))
    by_change = F.concat(name, F.lit(" ("), F.col("_start"), F.lit(" to "), F.col("_end"), F.lit(")"))
    label = F.when(name.isin(*LABELLED_BY_START), by_start).otherwise(by_change)
    return (
        df.withColumn("_ends_low", ends_low)
        .withColumn("_starts_low", starts_low)
        .withColumns(
            {
                "_start": band(F.col(before), F.col("_starts_low"), high),
                "_end": band(F.col(after), F.col("_ends_low"), high),
            }
        )
        .withColumn("_label", label)
        .withColumn(activity, F.when(F.col("_label").isin(*LABELS), F.col("_label")).otherwise(name))
        .drop("_ends_low", "_starts_low", "_start", "_end", "_label")
    )
