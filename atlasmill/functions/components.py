"""Connected components by alternating large-star and small-star contraction.

Every round is two grouped minima and two joins over the edge list; nothing is gathered on the
driver but one row of counters. The neighbours of a node are dealt to salts, so that a hub with a
third of all edges is spread: minima are taken a salt first, and the minimum of a node's salts goes
back to each of them. The rounds stop when the edge set no longer changes; the number of rounds
grows with the logarithm of the longest path. Only the last round's files are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.lineage import remove, write_shared
from atlasmill.functions.ranks import salts_for

#: Salts of a node's neighbours at least.
LEAST_SALTS = 32


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame, salts: int) -> DataFrame:
    """Link every neighbour larger than ``u`` to the smallest node around ``u``; the neighbours of a hub are spread over ``salts`` tasks."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
    parts = both.groupBy("u", "s").agg(F.min("v").alias("m"))
    low = parts.select("u", "s", F.least("u", F.min("m").over(W.partitionBy("u"))).alias("m"))  # ``salts`` rows a node at most
    # merged, not broadcast: rounds are many, and each broadcast would be held by the driver for a while
    return both.filter("v > u").hint("merge").join(low, ["u", "s"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link ``u`` and its smaller neighbours to the smallest of them (edges point downwards).

    After a large star a node's smaller neighbours are minima around its former neighbours: few, and fewer each round.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    pairs = F.explode(F.array_distinct(F.array(F.struct(own.alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))).alias("e")
    return edges.hint("merge").join(low, "u").select(pairs).select("e.u", "e.v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", name: str = "components", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node; the component is its smallest node.

    ``edges`` may hold both directions, repeats, self links and nulls (the last two are ignored).
    An empty edge list gives an empty result.
    """
    pairs = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v")
    now, path = write_shared(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = _signature(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        salts = salts_for(2 * seen[0], least=LEAST_SALTS)
        after, written = write_shared(_small_star(_large_star(now, salts)), name)
        remove(path)
        now, path = after, written
        again = _signature(now)
        if again == seen:
            break
        seen = again
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
