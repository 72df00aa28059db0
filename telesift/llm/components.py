"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telesift.session import scratch_path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of all linked nodes; the label is the component's smallest node.

    Rounds of two steps: every node hands its larger neighbours to its smallest neighbour, then its smaller ones. Links
    become stars around the smallest node in a number of rounds that grows with the logarithm of the longest chain; links that
    are such stars already need none. A round's links are written, so that lost executors don't bring earlier rounds back.
    Nodes of any degree are grouped by minimum and joined, never collected. Null ends are left out.
    """
    spark = links.sparkSession
    name = scratch_path(spark, "components")
    one = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v AND u IS NOT NULL AND v IS NOT NULL")
    one.write.parquet(f"{name}/0")
    for k in range(200):
        # u > v in every row.
        edges = spark.read.parquet(f"{name}/{k}")
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), "v"), F.struct(F.col("v").alias("node"), "v"))).alias("e"))
        least = ends.groupBy("e.node").agg(F.min("e.v").alias("label"), F.max("e.v").alias("most"))
        # In stars every node meets their smallest one only, which meets itself.
        if not least.agg(F.max(F.col("label") < F.col("most"))).first()[0]:
            return least.select("node", "label")
        # A node with larger neighbours is some row's v, so that its label is the smallest of it and its neighbours.
        nearest = least.select(F.col("node").alias("x"), F.col("label").alias("m"))
        large = edges.select(F.col("v").alias("x"), F.col("u")).join(nearest, "x").select("u", F.col("m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
        small = large.join(smallest, F.col("u") == F.col("x"))
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small.select("e.u", "e.v").filter("u <> v").distinct().write.parquet(f"{name}/{k + 1}")
    raise RuntimeError("links didn't settle into components")
