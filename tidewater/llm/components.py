"""Connected components of a link table, by contraction on Spark.

Every round each node hooks to its smallest neighbour, hooks are followed a few
steps, and the links are rewritten between the nodes hooked to. A component
loses at least half of its nodes in a round, so rounds grow with the logarithm
of its size. All tables stay distributed; each round's tables are written and
reread, so lineage does not grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of
    its component. Null ends and self links are ignored."""
    now = materialise(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                      .where("a is not null and b is not null and a <> b").distinct(), "links")
    steps: list[DataFrame] = []
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        hooks = materialise(hooks, "hooks")
        # follow each hook twice: chains of hooks get four times shorter
        for _ in range(2):
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            hooks = materialise(hooks.join(up, "root").select("node", F.col("top").alias("root")), "hooks")
        steps.append(hooks)
        now = (now.join(hooks.toDF("a", "x"), "a").join(hooks.toDF("b", "y"), "b").where("x <> y")
               .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        now = materialise(now, "links")
    if not steps:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0]
    for later in steps[1:]:
        out = (out.join(later.toDF("root", "top"), "root", "left")
               .select("node", F.coalesce("top", "root").alias("root")))
    return materialise(out, "components")
