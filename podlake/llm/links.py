"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected ``edges``; a component
    is named by its smallest node. Each round takes the smallest label among a
    node and its neighbours, then the label of that label; the number of rounds
    is logarithmic for paths and two or three for stars. Every round is written
    to the shared folder."""
    both = stored(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                  .unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y")))
                  .where("x <> y").distinct(), "component-edges")
    labels = stored(both.groupBy("x").agg(F.min("y").alias("y"))
                    .select(F.col("x").alias("node"), F.least("x", "y").alias("label")), "component-labels")
    while True:
        near = (both.join(labels, both["y"] == labels["node"]).groupBy("x")
                .agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["x"])
                .select("node", "label", F.least("label", "near").alias("next")))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = stored(step.join(jump, "next", "left")
                     .select("node", F.least("next", F.coalesce("far", "next")).alias("label"),
                             F.col("label").alias("old")), "component-labels")
        if new.where("label <> old").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")
