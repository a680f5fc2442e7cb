"""Hierarchies as edge tables (child, parent) and their transitive closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize


#: Levels after which a closure that still grows is taken for a mistake.
LEVELS = 1000


def closure(edges: DataFrame, child: str = "child", parent: str = "parent", max_depth: int | None = None) -> DataFrame:
    """(descendant, ancestor, depth) with the shortest depth of each pair; cycles end by themselves, as no pair is found twice.

    Without ``max_depth`` it goes on until there is no new pair, and raises after ``LEVELS`` levels.
    """
    step = materialize(edges.select(F.col(child).alias("descendant"), F.col(parent).alias("ancestor")).filter("descendant <> ancestor").distinct(), "hierarchy")
    found = front = step.withColumn("depth", F.lit(1))
    up = step.select(F.col("descendant").alias("ancestor"), F.col("ancestor").alias("next"))
    for depth in range(2, (LEVELS if max_depth is None else max_depth) + 1):
        new = front.join(up, "ancestor").select("descendant", F.col("next").alias("ancestor")).filter("descendant <> ancestor").distinct()
        new = materialize(new.join(found, ["descendant", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)), "closure")
        if new.isEmpty():
            return found
        found, front = found.unionByName(new), new
        if depth % 20 == 0:  # a union of few scans, however deep
            found = materialize(found, "closure")
    if max_depth is None:
        raise RuntimeError(f"a hierarchy of more than {LEVELS} levels")
    return found


def vocabulary(spark: SparkSession, parents: dict[str, str | None]) -> DataFrame:
    """(name, ancestor, depth of the ancestor below the root): the reflexive closure of a small vocabulary."""
    rows = []
    for name in parents:
        at, chain = name, []
        while at is not None:
            chain.append(at)
            at = parents[at]
        rows += [(name, a, len(chain) - 1 - k) for k, a in enumerate(chain)]
    return spark.createDataFrame(rows, "name string, ancestor string, depth int")
