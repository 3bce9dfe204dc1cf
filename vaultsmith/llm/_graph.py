"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import keep


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long); component = smallest node.

    Each round points every node at its smallest neighbour (an aggregate, combined
    map-side, so a node with very many links is no bottleneck), follows the pointers twice
    and rewrites the links between the nodes pointed at; links inside one node vanish.
    The rounds end when none is left. Their number grows with the logarithm of a
    component's diameter, and each round's tables are written to shared storage, so
    lineage stays short and both sides of every join are plain scans that AQE can split.
    """
    edges = keep(links.where("a <> b").select("a", "b").distinct(), f"{label}-links")
    members: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = keep(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("to")), f"{label}-step")
        up = step.select(F.col("node").alias("to"), F.col("to").alias("up"))
        root = keep(step.join(up, "to", "left").select("node", F.coalesce("up", "to").alias("root")), f"{label}-root")
        if members is None:
            members = root.select("node", F.col("root").alias("component"))
        else:
            moved = root.select(F.col("node").alias("component"), "root")
            members = keep(members.join(moved, "component", "left")
                           .select("node", F.coalesce("root", "component").alias("component")), f"{label}-members")
        ra = root.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = keep(edges.join(ra, "a").join(rb, "b").where("ra <> rb")
                     .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                     f"{label}-links")
    if members is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members
