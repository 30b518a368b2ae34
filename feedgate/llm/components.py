"""Connected components of a table of links, without collecting links or labels anywhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[str, DataFrame], DataFrame]


def components(links: DataFrame, keep: Keep) -> DataFrame:
    """``links(a, b)`` to ``(node, root)``: the smallest node that each linked node can reach.

    Union-find as joins. In each round every node takes its smallest neighbour as parent, parents are
    followed by pointer doubling until they are roots, and links between roots form the next, at most half
    as large, graph. Rounds grow with the logarithm of the nodes, whatever the shape of a component. Every
    step is written by ``keep`` (name, table), so a lost executor repeats one step only, joins know their
    sizes, and the partitions of a hot root can be split.
    """
    edges = keep(
        "links0",
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
    )
    labels, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parent = keep(f"parent{turn}", parent.select("node", F.least("node", "low").alias("root")))
        step = 0
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
            moved = keep(
                f"jump{turn}_{step}",
                parent.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")),
            )
            parent, step = moved.select("node", "root"), step + 1
            if moved.where("moved").isEmpty():
                break
        labels = (
            parent
            if labels is None
            else keep(
                f"labels{turn}",
                labels.join(parent.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
                    "node", F.coalesce("top", "root").alias("root")
                ),
            )
        )
        ends = edges.join(parent.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(
            parent.select(F.col("node").alias("b"), F.col("root").alias("y")), "b"
        )
        edges = keep(
            f"links{turn + 1}",
            ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
        )
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
