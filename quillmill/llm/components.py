"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, drop, saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that links lead to, for each node of ``links``.

    Each round hangs every node under the smallest neighbour known (large star: larger neighbours; small star: smaller
    ones), so the number of rounds grows with the logarithm of the longest path. A round only takes minima per node
    (with partial sums before the shuffle) and joins them back; no neighbourhood is gathered in a task. Rounds are
    written to the shared folder. Links from a node to itself and null ends are ignored; an empty table gives no rows.
    """
    up = (
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    up = saved(up, "cc")
    for _ in range(most_rounds):
        both = up.unionByName(up.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).withColumn("m", F.least("m", "hi"))
        # large star: the larger neighbours of each node move under the least of its neighbourhood
        large = (
            both.filter(F.col("lo") > F.col("hi")).join(least, "hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        large = saved(large, "cc")
        # small star: the smaller neighbours of each node, and itself, move under the least of them
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = (
            small.filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
        )
        small = saved(small, "cc")
        drop(up, large)
        up = small
        ends = up.select("hi", F.lit(1).alias("h"), F.lit(0).alias("l")).unionByName(
            up.select(F.col("lo").alias("hi"), F.lit(0).alias("h"), F.lit(1).alias("l"))
        )
        open_ = ends.groupBy("hi").agg(F.sum("h").alias("h"), F.max("l").alias("l")).filter("h > 1 or (h > 0 and l > 0)")
        if open_.isEmpty():
            break
    else:
        raise RuntimeError(f"components are not complete after {most_rounds} rounds")
    return up.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        up.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def smallest_ids(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(cls, component_id): the smallest ``least`` among the ``classes`` (cls, least) of a component, for the nodes of ``found``."""
    members = saved(classes.select("cls", "least").join(found, F.col("cls") == F.col("node")).select("cls", "component", "least"), "members")
    names = saved(members.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_qm_members")), "names")
    return attach(members, names, "component", "_qm_members", members.count()).select("cls", "component_id")
