"""Connected components of an edge list, by joins that halve what is left."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.operators.staging import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; the component is its smallest
    node (stages each round).

    Each round draws a priority for every node, points each at the first by
    priority of its neighbours and itself, follows such pointers once more, and
    renames the edges by them. Whatever order the nodes' numbers have along a
    chain, about a third of its nodes at most are left each time, so rounds grow
    with the logarithm of the longest chain. A first neighbour is merged before
    it is shuffled, so a node with a third of all edges is no single task's
    work; renaming joins on the node, where AQE splits a large one.
    """
    near = staged(_proper(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    names, number = None, 0  # node -> its name after the rounds so far
    while not near.isEmpty():
        number += 1

        def ranked(node, number=number):
            return F.struct(F.xxhash64(F.lit(number), node).alias("rank"), F.col(node).alias("node"))

        both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(
            F.least(F.min(ranked("b")), ranked("a"))["node"].alias("to")
        )
        hop = lowest.select(F.col("a").alias("to"), F.col("to").alias("then"))
        step = staged(
            lowest.join(hop, "to").select(F.col("a").alias("node"), F.col("then").alias("name")),
            "step",
        )
        if names is None:
            names = step
        else:
            later = step.select(F.col("node").alias("name"), F.col("name").alias("newer"))
            names = staged(
                names.join(later, "name", "left").select(
                    "node", F.coalesce("newer", "name").alias("name")
                ),
                "names",
            )
        left = step.select(F.col("node").alias("a"), F.col("name").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("name").alias("y"))
        near = staged(
            _proper(
                near.join(left, "a").join(right, "b").select(
                    F.col("x").alias("a"), F.col("y").alias("b")
                )
            ),
            "edges",
        )
    if names is None:
        return near.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = names.groupBy("name").agg(F.min("node").alias("component"))
    return names.join(smallest, "name").select("node", "component")


def _proper(edges: DataFrame) -> DataFrame:
    """Each edge between different nodes once, the smaller node first."""
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
