"""Vectors of a graph's nodes from random walks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import dense_position, salts_for
from atlasmill.operators.fabricate import share


def random_walks(edges: DataFrame, length: int, each: int, seed: int = 0) -> DataFrame:
    """(start, walk, step, node) of ``each`` walks of up to ``length`` nodes from every node, along (u, v) in both directions.

    A node's neighbours are numbered, and a step is a join by (node, drawn number): a hub's neighbours are
    spread by their number and nothing is gathered. The draws hash seed, walk and step.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct()
    both = materialize(both, "walk-edges")
    listed = materialize(dense_position(both, "u", ["v"], "at", salts_for(both.count())), "walk-neighbours")
    degree = materialize(listed.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "walk-degrees")
    now = degree.select(F.col("u").alias("start"), F.explode(F.sequence(F.lit(1), F.lit(each))).alias("walk"), F.col("u").alias("node"))
    steps = [now.select("start", "walk", F.lit(0).alias("step"), "node")]
    for step in range(1, length):
        drawn = now.join(degree.withColumnRenamed("u", "node"), "node").withColumn("at", F.floor(share(seed, f"step{step}", "start", "walk") * F.col("n")).cast("long"))
        now = materialize(drawn.join(listed.withColumnRenamed("u", "node"), ["node", "at"]).select("start", "walk", F.col("v").alias("node")), "walk-step")
        steps.append(now.select("start", "walk", F.lit(step).alias("step"), "node"))
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


def walk_vectors(walks: DataFrame, size: int = 32, window: int = 5, seed: int = 0, parts: int = 8) -> DataFrame:
    """(id, embedding) of the nodes by skip-gram over the walks, which are ``length`` nodes each."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    order = F.transform(F.array_sort(F.collect_list(F.struct("step", "node"))), lambda s: s["node"])
    texts = materialize(walks.groupBy("start", "walk").agg(order.alias("nodes")).select("nodes"), "walks")
    model = Word2Vec(vectorSize=size, windowSize=window, minCount=1, seed=seed, numPartitions=parts, inputCol="nodes", outputCol="v").fit(texts)
    return model.getVectors().select(F.col("word").alias("id"), vector_to_array("vector").alias("embedding"))
