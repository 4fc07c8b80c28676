"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.session import pinned


def _towards_least(edges: DataFrame, both: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour ``v`` of ``u`` linked to the least of ``u`` and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if larger_only:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)


def _state(edges: DataFrame) -> tuple[int, int | None]:
    """How many ``edges`` there are and what they are, however many: nothing here overflows."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``u, root`` for each id in ``links`` (u, v): the least id it is connected with.

    Large and small stars in turn until nothing changes; every round is written to
    the shared folder. Ids without a link are not in the result.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = pinned(edges.filter("u > v").distinct(), "links")
    seen = None
    while True:
        state = _state(edges)
        if state[0] == 0 or state == seen:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(edges, both, larger_only=True)
        large = pinned(large.filter("u > v").distinct(), "large-star")
        # small star: only neighbours below, so edges already point down
        small = _towards_least(large, large, larger_only=False)
        edges = pinned(small.filter("u > v").distinct(), "small-star")
    roots = edges.select("v").distinct().select(F.col("v").alias("u"), F.col("v").alias("root"))
    return edges.select("u", F.col("v").alias("root")).union(roots)
