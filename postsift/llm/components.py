"""Connected components of a table of edges, by joins, with every round written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.tables import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each round hooks every root to the smallest root next to it and then shortens the way to
    the root, so long chains take few rounds. A round is a few joins on node ids; the driver
    sees one count per round. No edges give no rows.
    """
    linked = settled(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = settled(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")))
    while True:
        a, b = roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        across = linked.join(a, "a").join(b, "b").where("ra <> rb")
        hooks = across.groupBy(F.greatest("ra", "rb").alias("node")).agg(F.min(F.least("ra", "rb")).alias("hook"))
        hooked = roots.join(hooks, "node", "left").select("node", F.coalesce(F.least("root", "hook"), "root").alias("root"))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        raised = hooked.join(up, "root").select("node", F.col("above").alias("root"))
        again = raised.select(F.col("node").alias("root"), F.col("root").alias("above"))
        new = settled(raised.join(again, "root").select("node", F.col("above").alias("root")))
        changed = new.join(roots.withColumnRenamed("root", "old"), "node").where("root <> old").limit(1).count()
        roots = new
        if not changed:
            return roots
