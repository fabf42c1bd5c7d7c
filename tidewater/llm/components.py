"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (x, y); nodes share a label if links connect them.

    Each round points every node at its smallest neighbour, jumps once along
    the pointers and contracts the links to the nodes pointed at, so the
    graph at least halves.  Each round is written to the shared folder; no
    group of links is ever gathered, minima are combined before the shuffle.
    """
    both = links.select("x", "y").where("x <> y")
    edges = materialize(both.unionAll(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = None
    while edges.limit(1).count():
        point = edges.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("to"))
        jump = point.select(F.col("x").alias("to"), F.col("to").alias("next"))
        move = materialize(point.join(jump, "to").select(F.col("x").alias("node"), F.col("next").alias("label")), "moves")
        if labels is None:
            labels = move
        else:
            step = move.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = materialize(labels.join(step, "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")), "labels")
        ends = move.select(F.col("node").alias("x"), F.col("label").alias("lx"))
        other = move.select(F.col("node").alias("y"), F.col("label").alias("ly"))
        edges = materialize(edges.join(ends, "x").join(other, "y").where("lx <> ly")
                            .select(F.col("lx").alias("x"), F.col("ly").alias("y")).distinct(), "links")
    if labels is None:
        return links.select(F.col("x").alias("node"), F.col("y").alias("label")).limit(0)
    return labels
