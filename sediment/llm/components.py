"""Connected components by contraction: every round merges nodes into a neighbour.

In a round each node chooses, among itself and its neighbours, the one with the least
priority; edges are then drawn between the chosen nodes. The first round takes the ids as
priorities, which settles stars around their smallest node at once; later rounds take hashes
that change with the round, so chains shrink by a constant factor whatever their order. Only
edges between nodes that still differ go on. Every step is a combinable aggregate or a join of
frames in the shared folder, and no edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.sinks.staging import staged


def _priority(column: str, number: int):
    ordered = F.col(column) if number == 0 else F.xxhash64(F.lit(number), F.col(column))
    return F.struct(ordered.alias("p"), F.col(column).alias("node"))


def _contracted(edges: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """node -> chosen, and the edges between chosen nodes."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    chosen = staged(
        both.groupBy("a")
        .agg(F.min(_priority("b", number)).alias("other"))
        .select(F.col("a").alias("node"), F.least(_priority("a", number), F.col("other"))["node"].alias("chosen"))
    )
    left = chosen.select(F.col("node").alias("a"), F.col("chosen").alias("next_a"))
    right = chosen.select(F.col("node").alias("b"), F.col("chosen").alias("next_b"))
    moved = (
        edges.join(left, "a")
        .join(right, "b")
        .filter("next_a <> next_b")
        .select(F.least("next_a", "next_b").alias("a"), F.greatest("next_a", "next_b").alias("b"))
    )
    return chosen, staged(moved.distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for edges (a, b) of long ids without loops."""
    current, maps = staged(edges.select("a", "b").distinct()), []
    while not current.isEmpty():
        chosen, current = _contracted(current, len(maps))
        maps.append(chosen)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    roots = maps[0].withColumnRenamed("chosen", "root")
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), "chosen")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("chosen", "root").alias("root"))
    roots = staged(roots)
    smallest = staged(roots.groupBy("root").agg(F.min("node").alias("component")))
    return staged(roots.join(smallest, "root").select("node", "component"))
