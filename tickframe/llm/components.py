"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import discard, materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _smallest(edges: DataFrame) -> DataFrame:
    """Per u the smallest of u and its neighbours. Written out, so that the join with it has a
    plain exchange on both sides and adaptive execution can split a hub's partition."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(src, dst) of longs -> (node, component): per node of an edge the smallest node that it
    can reach. Null ends and loops are left out; an empty table gives an empty result.

    Every round is a grouped minimum and an equi-join; a star's hub is never gathered in one row.
    Rounds go on until the edges stay as they are (a logarithmic number on usual graphs)."""
    now = materialise(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges"
    )
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _smallest(both)
        large = materialise(both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        m2 = _smallest(large)
        after = materialise(
            large.join(m2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m2.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        for old in (now, m, large, m2):
            discard(old)
        now, state = after, _state(after)
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def smallest_of_component(classes: DataFrame, components: DataFrame, node: str, name: str) -> DataFrame:
    """classes(node, name, ...) with component_id, the smallest name of all classes of the node's
    component (its own name if the node is in none; null where no class of it has a name).

    Names may be null or repeated, nodes are unique. The smallest is found by a partial aggregate and
    goes back by a join with a plain exchange on both sides, so that a great component can be split."""
    d = classes.join(components.withColumnRenamed("node", node), node, "left").withColumn("_part", F.coalesce("component", node)).drop("component")
    d = materialise(d, "classes")
    smallest = materialise(d.groupBy("_part").agg(F.min(name).alias("component_id")), "names")
    return d.join(smallest, "_part").drop("_part")
