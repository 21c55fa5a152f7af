"""Connected components by contraction.

In each round every node points to the one of lowest priority among itself and its neighbours;
priorities are hashes, so long chains shrink by a factor and not by a step. Edges are rewritten to
what their ends point to, and those within one node go. When no edge is left, the pointers are
followed back from the last round to the first.

A neighbourhood is reduced by a minimum, which is combined before it is shuffled, and pointers are
joined with tables read from the shared folder, where Spark splits the partitions of a hub. No node
list and no component is ever held by one task or by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.session import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, component): the nodes of the edges, each with its component's smallest.

    Nulls, loops and repeated edges are ignored.
    """
    left = edges.filter("a is not null and b is not null and a <> b").select("a", "b")
    left = written(left.distinct(), "edges")
    pointers: list[DataFrame] = []
    while not left.isEmpty():
        salt = F.lit(len(pointers))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.least(
            F.min(F.struct(F.xxhash64("b", salt).alias("rank"), F.col("b").alias("node"))),
            F.struct(F.xxhash64("a", salt).alias("rank"), F.col("a").alias("node")),
        )
        to = written(both.groupBy("a").agg(lowest["node"].alias("to")), "pointers")
        pointers.append(to)
        left = (
            left.join(to, "a")
            .select(F.col("to").alias("from"), F.col("b").alias("a"))
            .join(to, "a")
            .select(F.col("from").alias("a"), F.col("to").alias("b"))
            .filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        )
        left = written(left.distinct(), "edges")
    if not pointers:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))

    found = pointers.pop().select(F.col("a").alias("node"), F.col("to").alias("component"))
    while pointers:
        later = found.select(F.col("node").alias("to"), F.col("component").alias("end"))
        found = written(
            pointers.pop()
            .join(later, "to", "left")
            .select(F.col("a").alias("node"), F.coalesce("end", "to").alias("component")),
            "followed",
        )
    smallest = written(
        found.groupBy("component").agg(F.min("node").alias("smallest")), "smallest"
    )
    return found.join(smallest, "component").select("node", F.col("smallest").alias("component"))
