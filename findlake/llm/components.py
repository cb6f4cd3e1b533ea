"""Connected components of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (columns ``a``, ``b``); equal roots mean
    that a chain of links leads from one to the other.

    Each round maps every node to the smallest node next to it, follows that map three times and
    rewrites the links. Where a node has very many links, only their minimum is shuffled, and the
    joins read written tables, so a skewed side can be split.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
        step = written(both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("r")), "component-step")
        for _ in range(2):
            step = written(_through(step, "r", step).select("v", "r"), "component-step")
        labels = step.withColumnsRenamed({"v": "node", "r": "root"}) if labels is None else _through(labels, "root", step)
        labels = written(labels, "component-labels")
        moved = _through(_through(edges, "a", step), "b", step)
        edges = written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    return labels


def _through(rows: DataFrame, column: str, step: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by what ``step`` maps it to, if anything."""
    to = step.select(F.col("v").alias("_v"), F.col("r").alias("_r"))
    joined = rows.join(to, F.col(column) == F.col("_v"), "left")
    return joined.withColumn(column, F.coalesce("_r", column)).select(*rows.columns)
