"""Connected components of links, without ever gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import Scratch

#: Labels (16 bytes each) that are broadcast at most; more are joined by shuffling.
BROADCAST_LABELS = 250_000


def components(links: DataFrame, scratch: Scratch, rounds: int | None = None) -> DataFrame:
    """(node, comp): the smallest node reachable over `links` (a, b); nodes without a link are left out.

    Each round every node takes the smallest label among its neighbours, then the label that this one had, so that
    chains shorten by halves. Rounds end when no label changes, or after `rounds`: then equal labels are still of one
    component, but one component may have several.
    """
    both = scratch.store(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = scratch.store(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")))
    bounded = F.broadcast if label.count() <= BROADCAST_LABELS else lambda df: df
    turn = 0
    while rounds is None or turn < rounds:
        of = lambda key: bounded(label.select(F.col("node").alias(key), F.col("comp").alias(f"comp_{key}")))  # noqa: B023, E731
        near = both.join(of("b"), "b").groupBy("a").agg(F.min("comp_b").alias("m"))
        least = near.join(of("a"), "a").select("a", F.col("comp_a").alias("comp"), F.least("comp_a", "m").alias("next"))
        moved = least.join(of("next"), "next", "left").select(F.col("a").alias("node"), F.least("next", F.coalesce("comp_next", "next")).alias("next"), "comp")
        moved = scratch.store(moved)
        turn += 1
        changed = not moved.where("next <> comp").isEmpty()
        label = moved.select("node", F.col("next").alias("comp"))
        if not changed:
            break
    return label
