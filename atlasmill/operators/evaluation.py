"""Labelled test sets, checks on tables, stability between rankings, and reports on folds.

Rankings are frames with ``source``, ``target`` and a gapless ``rank`` from 1 (see ``ranking.global_rank``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.operators.graph import rank_rows

KEY = ["source", "target"]


def train_rows_in(table: DataFrame, train: DataFrame) -> DataFrame:
    """The training pairs that a table should not hold."""
    return table.join(train.select(*KEY).distinct(), KEY, "left_semi")


def score_breaks(ranked: DataFrame) -> DataFrame:
    """Ranks whose score exceeds that of the rank before; neighbours meet by an equi-join, not in one window."""
    before = ranked.select((F.col("rank") + 1).alias("rank"), F.col("score").alias("score_before"))
    return ranked.select("rank", "score").join(before, "rank").filter(F.col("score") > F.col("score_before"))


def labelled_pairs(table: DataFrame, positive: str, negative: str) -> DataFrame:
    """Rows flagged ``positive`` with y = 1 and rows flagged ``negative`` with y = 0; a row with both flags is there twice."""
    flags = F.concat(F.when(F.col(positive), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")), F.when(F.col(negative), F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    return table.withColumn("y", F.explode(flags))


def restrict_to_positive_targets(table: DataFrame, positive: str, removal: list[str]) -> DataFrame:
    """Rows of targets with a positive; rows with a removal flag leave unless they are positives."""
    targets = table.filter(F.col(positive)).select("target").distinct()
    removed = F.lit(False)
    for flag in removal:
        removed = removed | F.coalesce(F.col(flag), F.lit(False))
    return table.join(targets, "target", "left_semi").filter(F.col(positive) | ~removed)


def positive_quantiles(ranked: DataFrame, positive: str) -> DataFrame:
    """Positives with ``non_pos_rank`` (their rank when other positives are left out) and its quantile among the rest."""
    negatives = ranked.agg(F.count_if(~F.col(positive)).alias("__neg"))
    among = rank_rows(ranked.filter(F.col(positive)), [F.col("rank")], "__among")
    rank = F.col("rank") - F.col("__among")
    return among.crossJoin(F.broadcast(negatives)).withColumn("non_pos_rank", rank).withColumn("non_pos_quantile", F.try_divide(rank - 1, F.col("__neg"))).drop("__among", "__neg")


def overlap_at(rankings: list[DataFrame], n: int) -> DataFrame:
    """Pairs among the first n of every ranking."""
    tops = [r.filter(F.col("rank") <= n).select(*KEY) for r in rankings]
    out = tops[0]
    for top in tops[1:]:
        out = out.join(top, KEY, "left_semi")
    return out


def common_top(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """(source, target, rank_a, rank_b) of the pairs among the first n of both."""
    one, two = (r.filter(F.col("rank") <= n).select(*KEY, F.col("rank").alias(f"rank_{x}")) for r, x in ((a, "a"), (b, "b")))
    return one.join(two, KEY)


def _beta_fraction(x: float, a: float, b: float) -> float:
    """The continued fraction of the incomplete beta function, evaluated forwards by convergents' ratios."""
    tiny = 1e-300
    upper, lower = 1.0, 1.0 / max(tiny, 1.0 - (a + b) * x / (a + 1.0))
    value = lower
    for m in range(1, 500):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            lower = 1.0 + term * lower
            upper = 1.0 + term / upper
            lower, upper = 1.0 / (lower or tiny), upper or tiny
            value *= lower * upper
        if abs(lower * upper - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(1.0 - x, b, a) / b


def correlation_pvalue(r: float, n: int) -> float | None:
    """Two-sided p-value of a rank correlation of n items by the t distribution; none below three items."""
    if n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    t2 = r * r * (n - 2) / (1.0 - r * r)
    return incomplete_beta((n - 2) / (n - 2 + t2), (n - 2) / 2.0, 0.5)


def spearman_at(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """(stat, pvalue) of the rank correlation over the pairs among the first n of both; nulls below two pairs."""
    both = rank_rows(rank_rows(common_top(a, b, n), [F.col("rank_a")], "__a"), [F.col("rank_b")], "__b")
    row = both.agg(F.corr("__a", "__b").alias("r"), F.count(F.lit(1)).alias("n")).first()
    r = None if row["r"] is None or math.isnan(row["r"]) else row["r"]
    return a.sparkSession.createDataFrame([(r, None if r is None else correlation_pvalue(r, row["n"]))], "stat double, pvalue double")


def hypergeometric_tail(k: int, total: int, marked: int, drawn: int) -> float:
    """Probability of at least ``k`` marked items among ``drawn`` of ``total``."""

    def log_choose(n: int, m: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1)

    low, high = max(k, drawn + marked - total, 0), min(marked, drawn)
    whole = log_choose(total, drawn)
    return min(1.0, math.fsum(math.exp(log_choose(marked, i) + log_choose(total - marked, drawn - i) - whole) for i in range(low, high + 1)))


def hypergeometric_at(a: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """(stat, pvalue): rank numbers that common pairs take in both rankings, against chance. Nulls if both are empty."""
    both = common_top(a, b, n)
    overlap = both.select("rank_a").intersect(both.select("rank_b")).count()
    total = a.filter(F.col("rank") <= n).select(*KEY).union(b.filter(F.col("rank") <= n).select(*KEY)).distinct().count()
    if not total:
        return a.sparkSession.createDataFrame([(None, None)], "stat double, pvalue double")
    drawn = min(n, total)
    return a.sparkSession.createDataFrame([(overlap * total / float(n * n), hypergeometric_tail(overlap, total, drawn, drawn))], "stat double, pvalue double")


def rank_commonality(spearman: float | None, commonality: float | None) -> float | None:
    """Harmonic mean of the absolute rank correlation and the commonality."""
    if spearman is None or commonality is None or abs(spearman) + commonality == 0:
        return None
    return 2 * abs(spearman) * commonality / (abs(spearman) + commonality)


def aggregate_folds(metrics: DataFrame) -> DataFrame:
    """(metric, mean, std, median, min, max) over the folds of (fold, metric, value)."""
    v = F.col("value")
    return metrics.groupBy("metric").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.percentile(v, 0.5).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) of equal bins; 0 and bins + 1 hold what lies outside, nulls have no bin."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def run_info(spark: SparkSession, values: dict[str, object]) -> DataFrame:
    """A key/value table of a run."""
    return spark.createDataFrame([(k, None if v is None else str(v)) for k, v in values.items()], "key string, value string")
