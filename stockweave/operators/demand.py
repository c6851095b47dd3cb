"""Demand statistics, lead times and replenishment parameters per material and plant."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.numbers import guarded_sqrt, null_if_zero, population_variance
from stockweave.operators.events import ISSUE, RECEIPT
from stockweave.sources.tables import Tables

PAIR = ["material_number", "plant"]


@dataclass(frozen=True)
class ReplenishmentPolicy:
    """Cost constants, service level and the defaults for pairs without history."""

    fixed_order_cost: float = 100.0
    holding_cost_per_unit_per_year: float = 10.0
    z_score: float = 1.645
    default_daily_demand: float = 1.0
    default_stddev_share: float = 0.1
    default_lead_time: float = 7.0


def _since(as_of: dt.date | None) -> Column:
    """The same day of the year before ``as_of``, or before the UTC day the job runs.

    29 February gives 1 March, the day its number falls on in a shorter month.
    """
    day = F.lit(as_of) if as_of else F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    earlier = F.add_months(day, -12)
    return F.date_add(earlier, F.dayofmonth(day) - F.dayofmonth(earlier))


def _moved_since(tables: Tables, as_of: dt.date | None) -> DataFrame:
    return tables.since("GoodsReceiptsAndIssues", "date_of_the_posting_in_the_document", _since(as_of))


def materials_plants(tables: Tables) -> DataFrame:
    """Distinct (material, plant) pairs of the four tables that mention them; NULLs compare equal."""
    named = [
        tables["PurchaseOrderItems"].select(*PAIR),
        tables["GoodsReceiptsAndIssues"].select(*PAIR),
        tables["SalesOrderItems"].select(*PAIR),
        tables["OrderSuggestions"].select(F.col("article_number").alias("material_number"), "plant"),
    ]
    return reduce(DataFrame.union, named).distinct()


def daily_demand(tables: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Issued quantity per pair and day, from one year before ``as_of`` on; no upper bound."""
    posted = F.col("date_of_the_posting_in_the_document")
    return (
        _moved_since(tables, as_of)
        .where(F.col("movement_type") == ISSUE)
        .groupBy(*PAIR, F.to_date(posted).alias("demand_date"))
        .agg(F.sum("quantity").alias("daily_quantity"))
    )


def demand_stats(tables: Tables, as_of: dt.date | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Annual demand, mean, days and population deviation of daily demand, for every pair.

    Daily demand is aggregated per pair first and joined to the pairs afterwards, one
    row to one; it holds a day only once, so counting days needs no distinct.
    """
    quantity = F.col("daily_quantity")
    variance = F.col("variance_daily_demand")
    stats = (
        daily_demand(tables, as_of)
        .groupBy(*PAIR)
        .agg(
            F.sum(quantity).alias("annual_demand"),
            F.avg(quantity).alias("average_daily_demand"),
            F.count("demand_date").alias("days_with_demand"),
            population_variance(quantity).alias("variance_daily_demand"),
        )
        .withColumn("stddev_daily_demand", guarded_sqrt(variance))
    )
    pairs = materials_plants(tables) if pairs is None else pairs
    return pairs.join(stats, PAIR, "left").fillna(0, subset=["days_with_demand"])


def lead_times(tables: Tables, as_of: dt.date | None = None) -> DataFrame:
    """Mean days from purchase order to receipt per pair; receipts before the order are left out.

    Material and plant are those of the ordered item; the receipt may name others.
    """
    posted = F.col("date_of_the_posting_in_the_document")
    receipts = (
        _moved_since(tables, as_of)
        .where(F.col("movement_type") == RECEIPT)
        .select(
            F.col("purchase_document_number").alias("purchase_order_number"),
            F.col("line_item_in_purchase_document").alias("purchase_order_item_number"),
            posted.alias("received"),
        )
    )
    ordered = (
        tables["PurchaseOrderDocuments"]
        .where(F.col("purchase_order_date").isNotNull())
        .select(F.col("purchase_document_number").alias("purchase_order_number"), "purchase_order_date")
    )
    items = tables["PurchaseOrderItems"].select(
        "purchase_order_number", "purchase_order_item_number", *PAIR
    )
    days = F.datediff("received", "purchase_order_date").cast("double")
    # Receipts first: they leave only the items received in the last year to join to documents.
    return (
        items.join(receipts, ["purchase_order_number", "purchase_order_item_number"])
        .join(ordered, "purchase_order_number")
        .select(*PAIR, days.alias("lead_time_days"))
        .where(F.col("lead_time_days") >= 0)
        .groupBy(*PAIR)
        .agg(F.avg("lead_time_days").alias("average_lead_time"))
    )


def replenishment_inputs(
    tables: Tables, as_of: dt.date | None = None, policy: ReplenishmentPolicy = ReplenishmentPolicy()
) -> DataFrame:
    """Demand and lead time per pair with defaults filled in, and the constants as columns."""
    joined = demand_stats(tables, as_of).join(lead_times(tables, as_of), PAIR, "left")
    average, deviation = F.col("average_daily_demand"), F.col("stddev_daily_demand")
    default_average = F.lit(policy.default_daily_demand)
    return joined.select(
        *PAIR,
        F.coalesce("annual_demand", F.lit(0.0)).alias("annual_demand"),
        null_if_zero(average, default_average).alias("average_daily_demand"),
        # Falls back on the average itself, so a zero average leaves a zero deviation.
        null_if_zero(
            deviation, F.coalesce(average, default_average) * F.lit(policy.default_stddev_share)
        ).alias("stddev_daily_demand"),
        null_if_zero(F.col("average_lead_time"), F.lit(policy.default_lead_time)).alias("average_lead_time"),
        F.lit(policy.fixed_order_cost).alias("fixed_order_cost"),
        F.lit(policy.holding_cost_per_unit_per_year).alias("holding_cost_per_unit_per_year"),
        F.lit(policy.z_score).alias("z_score"),
    )


def replenishment_parameters(inputs: DataFrame) -> DataFrame:
    """Economic order quantity, safety stock and reorder point, rounded to two places."""
    annual, lead = F.col("annual_demand"), F.col("average_lead_time")
    cost, holding = F.col("fixed_order_cost"), F.col("holding_cost_per_unit_per_year")
    order_quantity = F.when(annual > 0, guarded_sqrt((2 * annual * cost) / holding)).otherwise(F.lit(0.0))
    buffer = F.col("z_score") * F.col("stddev_daily_demand") * guarded_sqrt(lead)
    reorder = F.col("average_daily_demand") * lead + buffer
    return inputs.select(
        *PAIR,
        "annual_demand",
        "average_daily_demand",
        "stddev_daily_demand",
        "average_lead_time",
        F.round(order_quantity, 2).alias("eoq"),
        F.round(buffer, 2).alias("safety_stock"),
        F.round(reorder, 2).alias("reorder_point"),
    )


def overstock_level() -> Column:
    """Upper bound of the Normal band: rounded safety stock plus rounded order quantity."""
    return (F.col("safety_stock") + F.col("eoq")).alias("overstock_level")
