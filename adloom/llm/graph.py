"""Connected components of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import staged


def thinned(pairs: DataFrame) -> DataFrame:
    """Fewer pairs that connect the same nodes: each node's smaller neighbours, and the
    node, are tied to the smallest of them. A clique becomes a star."""
    smallest = pairs.groupBy("b").agg(F.min("a").alias("least"))
    near = pairs.join(smallest, "b")
    return (
        near.where("a > least")
        .select(F.col("least").alias("a"), F.col("a").alias("b"))
        .unionAll(smallest.select(F.col("least").alias("a"), "b"))
        .distinct()
    )


def components(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root) of every node, root being the smallest node it reaches by pairs.

    Each round a node takes the smallest root among its own and its neighbours', then its
    root's root, so paths shorten by half; the rounds are written and end when no root
    changes. Only linked nodes take part.
    """
    both = staged(
        pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))
        ),
        "links",
    )
    roots = staged(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "roots")
    while True:
        other = roots.select(F.col("node").alias("other"), F.col("root").alias("_other"))
        best = both.join(other, "other").groupBy("node").agg(F.min("_other").alias("_best"))
        nearer = roots.join(best, "node").select(
            "node", "root", F.least("root", "_best").alias("_near")
        )
        jump = roots.select(F.col("node").alias("_near"), F.col("root").alias("_far"))
        following = staged(
            nearer.join(jump, "_near").select(
                "node", F.least("_near", "_far").alias("root"), F.col("root").alias("_old")
            ),
            "roots",
        )
        changed = not following.where("root <> _old").isEmpty()
        roots = following.drop("_old")
        if not changed:
            return nodes.join(roots, "node", "left").select(
                "node", F.coalesce("root", "node").alias("root")
            )
