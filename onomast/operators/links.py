"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.scratch import discard, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link each greater neighbour of a node to the least of its closed neighbourhood. Small: the lesser ones."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    linked = both.join(least.hint("merge"), "u")  # by shuffle at any size, so nothing passes through the driver
    if large:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.select(F.col("v").alias("a"), "m").union(least.select(F.col("u"), F.col("m"))).where("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct()


def edges_of(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Each link once, the greater node as u; self-links and links with a null end are left out."""
    return pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()


def one_round(edges: DataFrame) -> DataFrame:
    """Both stars; the result is stored and the given table deleted."""
    new = stored(_star(_star(edges, True), False), "edges")
    discard(edges)
    return new


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """For every node of an edge list its ``component``, the least node it reaches: columns node, component.

    Each round is written to the shared folder; the rounds stop when every node leads to one root, and it is an error if that
    takes more than ``max_rounds`` (the number of rounds grows as the logarithm of the nodes). The result reads the last one's
    table, which ``discard`` deletes. Edges with a null end and self-links give no row; no edges, no rows.
    """
    now = stored(edges_of(edges, a, b), "edges")
    for _ in range(max_rounds):
        now = one_round(now)
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("leads"), F.lit(0).alias("led")), F.struct(F.col("v").alias("x"), F.lit(0).alias("leads"), F.lit(1).alias("led")))).alias("e")).select("e.*")
        if ends.groupBy("x").agg(F.sum("leads").alias("leads"), F.max("led").alias("led")).where("leads > 1 or (leads > 0 and led > 0)").isEmpty():
            # every node has one edge, to one that has none: the least of its component
            out = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
            out._stored_at = now._stored_at
            return out
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
