"""Connected components of links between documents or classes, by star contractions over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import forget, stored, stored_at


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    x = edges.join(low, "u")
    return x.select("u", F.col("m").alias("v")).union(x.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link towards a smaller one, which has none itself."""
    ends = edges.groupBy("u").agg(F.count("*").alias("up")).withColumn("down", F.lit(0)).union(
        edges.select("v", F.lit(0).cast("long"), F.lit(1)).distinct())
    bad = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
    return bad.isEmpty()


def star_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)``: the smallest node of each linked node's component.  Small-star and large-star steps alternate
    until all links are stars; edges of a node combine before they are shuffled, and each step's edges are a stored
    table, of which only the last one stays."""
    spark = links.sparkSession
    edges, path = stored_at(_small_star(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                                        .where("u <> v").distinct()).distinct(), "edges")
    while not _stars(edges):
        new, new_path = stored_at(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        forget(spark, path)
        edges, path = new, new_path
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct()), "labels")


def joined_components(label: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, label)`` after more links ``(a, b)`` between nodes, some of them in no component so far.  Links become
    links of labels, so the work is that of the components that join, not of all links anew."""
    x = links.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
    x = stored(x.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct(), "links")
    if x.isEmpty():
        return label
    above = star_components(x).toDF("below", "above")
    moved = label.join(above, F.col("label") == F.col("below"), "left").select("node", F.coalesce("above", "label").alias("label"))
    fresh = above.join(label, F.col("below") == F.col("node"), "left_anti").select("below", "above")
    return stored(moved.union(fresh), "labels")
