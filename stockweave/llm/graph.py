"""Connected components of an undirected graph, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.session import materialise


def _empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


def _roots(parents: DataFrame) -> DataFrame:
    """(comp, root) from (comp, root), each root smaller than its comp, followed to the end."""
    roots = materialise(parents, "roots")
    while True:
        beyond = roots.select(F.col("comp").alias("root"), F.col("root").alias("next"))
        jumped = roots.join(beyond, "root", "left").select("comp", F.coalesce("next", "root").alias("root"), "next")
        jumped = materialise(jumped, "roots")
        roots = jumped.select("comp", "root")
        if _empty(jumped.where("next IS NOT NULL")):
            return roots


def _replaced(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``df`` with the values of ``column`` that have a root replaced by it."""
    by = roots.select(F.col("comp").alias(column), F.col("root").alias("_root"))
    return df.join(by, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices`` (key, comp) with the smallest ``comp`` that each can reach in place of its own.

    ``edges`` has a and b, keys; both should be stored. Edges become links between the values of
    comp. In each round every value takes the smallest it is linked to, chains of such steps are
    followed to their ends by doubling, and links within one value are dropped; only values with
    no smaller neighbour are left, at most half of those that have links.
    """
    ends = [vertices.select(F.col("key").alias(end), F.col("comp").alias(f"{end}_comp")) for end in ("a", "b")]
    links = edges.select("a", "b").join(ends[0], "a").join(ends[1], "b").select(
        F.greatest("a_comp", "b_comp").alias("high"), F.least("a_comp", "b_comp").alias("low")
    )
    links = materialise(links.where("high > low").distinct(), "links")
    while not _empty(links):
        roots = _roots(links.groupBy(F.col("high").alias("comp")).agg(F.min("low").alias("root")))
        vertices = materialise(_replaced(vertices.select("key", "comp"), "comp", roots), "labels")
        links = _replaced(_replaced(links, "high", roots), "low", roots).where("high != low")
        links = links.select(F.greatest("high", "low").alias("high"), F.least("high", "low").alias("low"))
        links = materialise(links.distinct(), "links")
    return vertices.select("key", "comp")
