"""Pair tables: training splits, ranks, transforms, evaluation and comparison of rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import ordered_totals
from atlasmill.operators.fabricate import share
from atlasmill.operators.graph import rank_rows

#: diseases of a block that a drug meets at once; of a task
BLOCK, TASK = 128, 50_000


def by_score(score: str = "score") -> list[Column]:
    return [F.col(score).desc(), F.col("source"), F.col("target")]


def global_rank(table: DataFrame, score: str = "score") -> DataFrame:
    """``rank`` 1..N by score (ties by source, target) and ``quantile_rank``."""
    ranked = rank_rows(table, by_score(score), "__r").withColumn("rank", F.col("__r") + 1).drop("__r")
    n = ranked.agg(F.count(F.lit(1))).first()[0]
    return ranked.withColumn("quantile_rank", F.col("rank") / F.lit(float(max(1, n))))


def pairs_outside(drugs: DataFrame, diseases: DataFrame, known: DataFrame) -> DataFrame:
    """The product of drugs and diseases, each once, but for the ``known`` pairs: (source, target).

    The product is never shuffled: blocks of the diseases meet drugs with their known diseases, by block, and what is left of
    a block is unfolded in place. Only the axes and the known pairs move. A drug's known diseases are one row.
    A block is unfolded for one drug after the other, and a task has few enough diseases for a dictionary: so files of the product
    repeat themselves and are small.
    """
    targets = diseases.select("target").distinct()
    parts = int(drugs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = targets.count()
    many = max(1, -(-n // BLOCK))
    block = F.pmod(F.xxhash64("target"), F.lit(many)).cast("int").alias("__block")
    taken = known.select("source", "target", block).groupBy("source", "__block").agg(F.collect_set("target").alias("__known"))
    taken = taken.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("__block", "__known"))).alias("__known"))
    asked = drugs.select("source").distinct().join(taken, "source", "left").repartition(parts, "source")
    listed = targets.groupBy(block).agg(F.collect_list("target").alias("__all")).repartition(max(1, -(-n // TASK)), "__block")
    known_here = F.col("__known")[F.col("__block")]
    left = F.when(known_here.isNull(), F.col("__all")).otherwise(F.array_except("__all", known_here))
    return listed.crossJoin(asked).select("source", F.explode(left).alias("target"))


def open_pairs(drugs: DataFrame, diseases: DataFrame, train: DataFrame) -> DataFrame:
    """All drug-disease pairs but those of the training set."""
    return pairs_outside(drugs, diseases, train)


def open_pair_counts(drugs: DataFrame, diseases: DataFrame, train: DataFrame) -> DataFrame:
    """(target, n) of :func:`open_pairs` by disease, without making them: all drugs less those that the disease is trained with."""
    drugs = drugs.select("source").distinct()
    taken = train.select("source", "target").distinct().join(drugs, "source", "left_semi").groupBy("target").agg(F.count(F.lit(1)).alias("__n"))
    left = F.lit(drugs.count()) - F.coalesce(F.col("__n"), F.lit(0))
    return diseases.select("target").distinct().join(taken, "target", "left").select("target", left.cast("long").alias("n")).filter("n > 0")


def flag_pairs(table: DataFrame, flags: dict[str, DataFrame]) -> DataFrame:
    """One boolean column for each set of pairs."""
    for name, known in flags.items():
        table = table.join(known.select("source", "target").distinct().withColumn(name, F.lit(True)), ["source", "target"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return table


def frequent_flyer(table: DataFrame, weights: tuple[float, float, float] = (0.001, 1.0, 1.0), decay: tuple[float, float, float] = (0.05, 0.05, 0.05)) -> DataFrame:
    """``transformed``: sum of weighted powers of the pair's quantiles overall, within its disease and within its drug."""
    ranked = global_rank(table)
    drugs, diseases = (table.select(c).distinct().count() for c in ("source", "target"))
    of_disease = F.rank().over(W.partitionBy("target").orderBy(F.desc("score"))) / F.lit(float(max(1, drugs)))
    of_drug = F.rank().over(W.partitionBy("source").orderBy(F.desc("score"))) / F.lit(float(max(1, diseases)))
    quantiles = (F.col("quantile_rank"), of_disease, of_drug)
    total = sum((F.lit(w) * F.pow(q, F.lit(-d)) for w, q, d in zip(weights, quantiles, decay, strict=True)), F.lit(0.0))
    return ranked.withColumn("transformed", total)


def frequent_table(ranked: DataFrame, entity: str, tops: list[int]) -> DataFrame:
    """Mean and best score and the count among the first n pairs, for each entity."""
    return ranked.groupBy(entity).agg(F.avg("score").alias("mean_score"), F.max("score").alias("max_score"), *[F.count_if(F.col("rank") <= n).alias(f"top_{n}") for n in tops])


def drug_split(pairs: DataFrame, share: float = 0.2, seed: int = 0) -> DataFrame:
    """``split``: of each drug's pairs, in md5 order, greatest(1, round(n * share)) are TEST."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), "source", "target"))
    w = W.partitionBy("source")
    return pairs.withColumn("split", F.when(F.row_number().over(w.orderBy(digest, "target")) <= F.greatest(F.lit(1), F.round(F.count(F.lit(1)).over(w) * F.lit(share))), "TEST").otherwise("TRAIN"))


def negative_sample(positives: DataFrame, drugs: DataFrame, diseases: DataFrame, each: int, seed: int = 0) -> DataFrame:
    """For each listed drug of a positive pair, ``each`` diseases that it has no positive with (all of them, if fewer).

    The diseases are in md5 order, and a drug takes them from a drawn position on, round the end. Among
    ``each`` more than it has positives enough are free, so no more are looked at, and nothing is crossed.
    """
    known = positives.select("source", "target").distinct()
    listed = rank_rows(diseases.select("target").distinct(), [F.md5(F.concat_ws("|", F.lit(str(seed)), "target")), F.col("target")], "__at")
    n = F.lit(listed.count()).cast("long")
    asked = known.groupBy("source").agg(F.count(F.lit(1)).alias("__has")).join(drugs.select("source").distinct(), "source", "left_semi")
    first = F.floor(share(seed, "first", "source") * n)
    tried = asked.withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.least(n, F.col("__has") + each) - 1))).withColumn("__at", ((first + F.col("__k")) % n).cast("long"))
    free = tried.join(listed, "__at").join(known, ["source", "target"], "left_anti")
    return free.withColumn("__n", F.row_number().over(W.partitionBy("source").orderBy("__k"))).filter(F.col("__n") <= each).select("source", "target")


def recall_at(table: DataFrame, tops: list[int]) -> DataFrame:
    """(n, recall): the share of positives among the first n pairs."""
    ranked = global_rank(table)
    n_pos = F.count_if(F.col("y") == 1)
    row = ranked.agg(*[F.try_divide(F.count_if((F.col("rank") <= n) & (F.col("y") == 1)), n_pos).alias(str(n)) for n in tops])
    return row.unpivot([], [str(n) for n in tops], "n", "recall").select(F.col("n").cast("long").alias("n"), F.col("recall").cast("double").alias("recall"))


def specific_ranking(table: DataFrame, by: str) -> DataFrame:
    """Positives with ``rank``: 1 + the negatives of the same ``by`` with a score at least theirs."""
    w = W.partitionBy(by).orderBy(F.desc("score")).rangeBetween(W.unboundedPreceding, W.currentRow)
    return table.filter("y is not null").withColumn("rank", 1 + F.count_if(F.col("y") == 0).over(w)).filter("y = 1")


def ranking_metrics(ranked: DataFrame, ks: list[int]) -> DataFrame:
    """(metric, value): mean reciprocal rank and hits within k."""
    row = ranked.agg(F.avg(1 / F.col("rank")).alias("mrr"), *[F.avg((F.col("rank") <= k).cast("double")).alias(f"hit_{k}") for k in ks])
    return row.unpivot([], row.columns, "metric", "value")


def auroc(table: DataFrame) -> DataFrame:
    """Area under the curve by rank sums, ties at their average rank; 0.5 if there is one class only."""
    scores = materialize(table.filter("y is not null").groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")), "scores")
    ranked = ordered_totals(scores, [F.col("score").asc()], {"below": "n"}).withColumn("avg_rank", F.col("below") + (F.col("n") + 1) / 2)
    p, n = F.sum("pos"), F.sum("n")
    area = F.try_divide(F.sum(F.col("avg_rank") * F.col("pos")) - p * (p + 1) / 2, (p * (n - p)).cast("double"))
    return ranked.agg(F.coalesce(area, F.lit(0.5)).cast("double").alias("auroc"))


def entropy_at(ranked: DataFrame, entity: str, tops: list[int]) -> DataFrame:
    """(n, entropy) of the entities among the first n pairs, to the base of the number of all entities."""
    spark = ranked.sparkSession
    total = ranked.select(entity).distinct().count()
    grid = F.broadcast(spark.createDataFrame([(n,) for n in tops], "n long"))
    counts = ranked.join(grid, F.col("rank") <= F.col("n")).groupBy("n", entity).agg(F.count(F.lit(1)).alias("c"))
    share = F.col("c") / F.sum("c").over(W.partitionBy("n"))
    return counts.withColumn("h", -share * F.log(share) / F.log(F.lit(float(max(2, total))))).groupBy("n").agg(F.sum("h").alias("entropy"))


def commonality(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """Share of the first n pairs of both rankings that are in both (divided by n)."""
    key = ["source", "target"]
    both = a.filter(F.col("rank") <= n).select(*key).join(b.filter(F.col("rank") <= n).select(*key), key)
    return both.agg((F.count(F.lit(1)) / F.lit(float(n))).alias("commonality"))
