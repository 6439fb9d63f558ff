"""Connected components of a graph given as pairs, without collecting any of it.

Every node points to a smaller node of its component.  A round lets each node, and the node it
points to, take the smallest pointer among its neighbours, and then follows pointers one step
(hooking and shortcutting); the number of rounds grows with the logarithm of the longest chain.
Each round's pointers are written to the shared folder: lineage stays short, a lost executor
costs one task, and both sides of every join on a hub come straight from a shuffle, so adaptive
execution can split the hub's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.session import store


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is the smallest node it reaches.

    Links may repeat, come in either direction or join a node with itself.  Rows with a null are
    ignored.  No links, no rows.
    """
    both = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    pairs = store(links.filter("a is not null and b is not null").select(both.alias("p")).select("p.u", "p.v").distinct(), "links")
    pointers = store(pairs.groupBy(F.col("v").alias("node")).agg(F.first("v").alias("root")), "pointers")
    while True:
        smallest = (
            pairs.join(pointers.select(F.col("node").alias("u"), F.col("root").alias("seen")), "u")
            .groupBy(F.col("v").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        no_old = F.lit(None).cast("bigint")
        hooks = F.array(
            F.struct(F.col("node"), F.least("seen", "root").alias("root"), F.col("root").alias("old")),
            F.struct(F.col("root").alias("node"), F.col("seen").alias("root"), no_old.alias("old")),
        )
        hooked = store(
            smallest.join(pointers, "node")
            .select(F.explode(hooks).alias("h"))
            .groupBy("h.node")
            .agg(F.min("h.root").alias("root"), F.max("h.old").alias("old")),
            "hooked",
        )
        further = hooked.select(F.col("node").alias("root"), F.col("root").alias("further"))
        followed = store(
            hooked.join(further, "root").select("node", F.col("further").alias("root"), "old"), "pointers"
        )
        pointers = followed.select("node", "root")
        if followed.filter("root != old").isEmpty():
            return pointers
