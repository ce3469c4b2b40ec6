"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import materialize


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for nodes with links.

    ``links`` has bigint columns ``a``, ``b``. Each round every node takes the
    smallest root among its own and its neighbours', then the root of that root, so
    a chain of n links takes about log n rounds. Every round is written, which
    keeps plans short; nothing but a count of changes comes to the driver. The
    minimum over neighbours is taken in part before the exchange, and both sides
    of the join are read from files, so the links of a hub can be split.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(spark, both, "links")
    roots = materialize(
        spark,
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("root")
        ),
        "roots",
    )
    changed = 1
    while changed:
        near = both.join(roots.withColumnRenamed("node", "b"), "b")
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = materialize(
            spark,
            roots.join(near, "node").select(
                "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
            ),
            "roots-step",
        )
        jump = stepped.select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = materialize(
            spark,
            stepped.join(jump, "root", "left").select(
                "node", "old", F.coalesce("further", "root").alias("root")
            ),
            "roots",
        )
        changed = roots.where("root <> old").count()
        roots = roots.select("node", "root")
    return roots
