"""Comparison of models over a common set of pairs: harmonised tables, curves over n and k, bootstrap.

Curves have a grid of a parameter's size; positives are put on the grid by arithmetic and summed there, so that a curve costs one
aggregation whatever the grid is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.functions.resample import redrawn_curves
from atlasmill.operators.graph import rank_rows
from atlasmill.operators.ranking import by_score, pairs_outside

KEY = ["source", "target"]
#: tables that are combined in one grouping (bits of a long)
MEET = 60
#: shares of the highest scores, and the accuracy of their sketch
SHARES, ACCURACY = [2 ** (-k / 4) for k in range(1, 49)], 10_000
#: positives of a piece of the list that hits are drawn from
PIECE = 16_384


def _own(rows: DataFrame, where: Column | None) -> DataFrame:
    rows = rows.dropna(subset=KEY)
    return rows if where is None else rows.filter(where)


@dataclass(frozen=True)
class PairSpace:
    """A table without its product: axes, and rows with the pairs that it has of their product; ``flags`` are the columns of named sets of test pairs.

    ``where`` tells which rows of ``rows`` are the table's (None: all), so that spaces cut from one table can be combined in one pass over it.
    A pair may have several rows; it is in a set if one of them is. A row with a null end is no pair.
    """

    drugs: DataFrame
    diseases: DataFrame
    rows: DataFrame
    flags: tuple[str, ...] = ()
    where: Column | None = None

    @property
    def own(self) -> DataFrame:
        return _own(self.rows, self.where)

    @property
    def pairs(self) -> DataFrame:
        """The pairs that the table has, each once."""
        return self.own.select(*KEY).distinct()

    @property
    def excluded(self) -> DataFrame:
        """The pairs of the product that the table lacks; as many as the product has, for a thin table."""
        return pairs_outside(self.drugs, self.diseases, self.pairs)

    def dense(self) -> DataFrame:
        """All pairs but the excluded, with a boolean column for each set of test pairs."""
        return _meet([self])


def sparse(table: DataFrame, flags: list[str], where: Column | None = None) -> PairSpace:
    """The axes, pairs and flagged pairs of a dense table, or of its rows where ``where`` holds."""
    own = _own(table, where)
    return PairSpace(own.select("source").distinct(), own.select("target").distinct(), table, tuple(flags), where)


def _meet(spaces: list[PairSpace], drop_inconsistent: bool = False) -> DataFrame:
    """The pairs that all spaces have, each once, with a boolean for each set: whether it has the pair in all of them.

    One grouping of the rows by pair, in which a space is a bit; spaces that are cut from one table read it once.
    """
    flags, all_in = spaces[0].flags, (1 << len(spaces)) - 1
    cut: dict[int, list[int]] = {}
    for k, space in enumerate(spaces):
        cut.setdefault(next(j for j in range(k + 1) if spaces[j].rows is space.rows), []).append(k)
    parts = []
    for first, ks in cut.items():
        bits = [F.lit(1 << k) if spaces[k].where is None else F.when(spaces[k].where, 1 << k).otherwise(0) for k in ks]
        marked = spaces[first].rows.dropna(subset=KEY).select(*KEY, reduce(Column.__add__, bits).cast("long").alias("__in"), *[F.col(f) for f in flags])
        parts.append(marked.filter("__in <> 0").select(*KEY, "__in", *[F.when(F.col(f), F.col("__in")).otherwise(0).alias(f) for f in flags]))
    found = reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.bit_or("__in").alias("__in"), *[F.bit_or(f).alias(f) for f in flags]).filter(F.col("__in") == all_in)
    if drop_inconsistent:
        for f in flags:
            found = found.filter(F.col(f).isin(0, all_in))
    return found.select(*KEY, *[(F.col(f) == all_in).alias(f) for f in flags])


def same_excluded(a: PairSpace, b: PairSpace) -> bool:
    """Whether both lack the same pairs, without making them.

    A pair that only one lacks is a pair of the other within its axes, or of an end that only it has; such an end lacks a pair if it has fewer than the other axis.
    """
    for one, other in ((a, b), (b, a)):
        lacks = other.pairs.join(one.drugs, "source", "left_semi").join(one.diseases, "target", "left_semi").join(one.pairs, KEY, "left_anti")
        if not lacks.isEmpty():
            return False
        for end, own, others, across in (("source", one.drugs, other.drugs, one.diseases), ("target", one.diseases, other.diseases, one.drugs)):
            has = one.pairs.groupBy(end).agg(F.count(F.lit(1)).alias("__n"))
            left = own.join(others, end, "left_anti").join(has, end, "left").filter(F.coalesce("__n", F.lit(0)) < across.count())
            if not left.isEmpty():
                return False
    return True


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equal as bags of rows; different columns raise."""
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"columns differ: {sorted(a.columns)} and {sorted(b.columns)}")
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def combine(spaces: list[PairSpace], drop_inconsistent: bool = False) -> PairSpace:
    """All tables harmonised: common axes, all exclusions, common test pairs; pairs tested in some of the tables only are excluded on request."""
    if not spaces:
        raise ValueError("nothing to combine")
    if len(spaces) > MEET:
        return combine([combine(spaces[:MEET], drop_inconsistent), *spaces[MEET:]], drop_inconsistent)
    for other in spaces[1:]:
        if set(other.flags) != set(spaces[0].flags):
            raise ValueError(f"test sets differ: {sorted(spaces[0].flags)} and {sorted(other.flags)}")
    drugs = reduce(lambda a, b: a.join(b, "source", "left_semi"), [x.drugs for x in spaces])
    diseases = reduce(lambda a, b: a.join(b, "target", "left_semi"), [x.diseases for x in spaces])
    return PairSpace(drugs, diseases, _meet(spaces, drop_inconsistent), spaces[0].flags)


def harmonize(a: PairSpace, b: PairSpace, drop_inconsistent: bool = False) -> PairSpace:
    """Two tables combined."""
    return combine([a, b], drop_inconsistent)


def restrict(common: PairSpace, predictions: DataFrame) -> DataFrame:
    """The common pairs with their predictions; a pair without one has a null score."""
    return common.dense().join(predictions, KEY, "left")


def rank_within(df: DataFrame, group: list[str], order: list[Column], out: str, keep: list[str] | None = None) -> DataFrame:
    """``out`` from 1 within each group, by one range sort over groups and order: no task has to hold a group. Of the columns, the group and those of ``keep`` stay (None: all)."""
    ranked = rank_rows(df, [*[F.col(c) for c in group], *order], "__place", None if keep is None else [*group, *keep])
    first = ranked.groupBy(*group).agg(F.min("__place").alias("__from"))
    return ranked.join(first, group).withColumn(out, F.col("__place") - F.col("__from") + 1).drop("__place", "__from")


def first_ranks(table: DataFrame, groups: list[str], n_max: int, positive: str = "positive") -> tuple[DataFrame, DataFrame]:
    """The first ``n_max`` rows at least of each group, by score, as (groups, ``positive``, rank), and the number of positives of each whole group (groups, ``__all``).

    All rows are read for the sketches of the scores. Only rows from a score on that leaves enough of them are sorted: what is below
    cannot be among the first. That enough were left is counted; if not, all rows are sorted.
    """
    shares = F.array(*[F.lit(x) for x in SHARES])
    sketch = F.percentile_approx("score", F.array(*[F.lit(1 - x) for x in SHARES]), ACCURACY)
    found = table.groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows"), F.count("score").alias("__n"), F.count_if(positive).alias("__all"), sketch.alias("__scores"))
    enough = F.size(F.filter(shares, lambda x: x * F.col("__n") >= n_max + 2 * F.col("__n") / ACCURACY))
    sizes = materialize(found.select(*groups, "__rows", "__all", F.when(enough > 0, F.get("__scores", enough - 1)).alias("__least")), "sketches")
    rank = lambda rows: rank_within(rows, groups, by_score(), "rank", [positive])
    totals = sizes.select(*groups, "__all")
    if sizes.filter("__least is not null").isEmpty():
        return rank(table), totals
    ahead = table.join(F.broadcast(sizes.select(*groups, "__least")), groups).filter(F.col("__least").isNull() | (F.col("score") >= F.col("__least"))).drop("__least")  # a row for each group
    ranked = rank(materialize(ahead, "ahead"))
    left = ranked.groupBy(*groups).agg(F.count(F.lit(1)).alias("__left"))
    short = sizes.join(left, groups, "left").filter(F.coalesce("__left", F.lit(0)) < F.least(F.col("__rows"), F.lit(n_max)))
    return (ranked if short.isEmpty() else rank(table)), totals


def grid(spark: SparkSession, n_max: int, points: int) -> DataFrame:
    """(i, n): ``points`` >= 2 equal steps from 1 to ``n_max``, not rounded."""
    return spark.range(points).select(F.col("id").alias("i"), (1 + F.col("id") * F.lit(n_max - 1) / F.lit(float(points - 1))).alias("n"))


def _first_point(rank: Column, n_max: int, points: int) -> Column:
    """Index of the first grid point that is at least ``rank``, in whole numbers."""
    return F.ceil((rank - 1) * (points - 1) / F.lit(n_max - 1)).cast("long")


def _cumulate(hits: DataFrame, groups: list[str], points: DataFrame) -> DataFrame:
    """Running sums of (groups, i, c) over every grid point, in windows of a grid's size."""
    keys = hits.select(*groups).distinct()
    full = keys.crossJoin(F.broadcast(points)).join(hits, [*groups, "i"], "left")
    along = W.partitionBy(*groups).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    return full.withColumn("c", F.coalesce(F.sum("c").over(along), F.lit(0)))


def recall_curve(ranked: DataFrame, groups: list[str], n_max: int, points: int, positive: str = "positive", weight: Column | None = None) -> DataFrame:
    """(groups, n, recall) on the grid from the positives' ranks in each group; groups without positives have no rows."""
    w = F.lit(1) if weight is None else weight
    found = ranked.filter(F.col(positive)).groupBy(*groups, _first_point(F.col("rank"), n_max, points).alias("i")).agg(F.sum(w).alias("c"))
    totals = found.groupBy(*groups).agg(F.sum("c").alias("__total"))
    curve = _cumulate(found, groups, grid(ranked.sparkSession, n_max, points))
    return curve.join(totals, groups).select(*groups, "n", F.coalesce(F.try_divide(F.col("c"), F.col("__total")), F.lit(0.0)).cast("double").alias("recall"))


#: Distribution function of a Poisson(1) count, to eight places: more than 11 copies are rarer than that.
POISSON = [round(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)), 8) for k in range(11)]


def poisson_weight(seed: int, *cols: str) -> Column:
    """A reproducible Poisson(1) count from the md5 of the columns: a row's copies in one bootstrap sample."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *cols)), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    out = F.lit(len(POISSON))
    for k in reversed(range(len(POISSON))):
        out = F.when(u < POISSON[k], k).otherwise(out)
    return out


def resampled(positives: DataFrame, times: int, seed: int = 0) -> DataFrame:
    """Positives for each resample with their ``copies``; what is not drawn is left out."""
    rows = positives.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    return rows.withColumn("copies", poisson_weight(seed, "resample", *KEY)).filter("copies > 0")


def redrawn(positives: DataFrame, groups: list[str], order: list[Column], times: int, seed: int = 0) -> DataFrame:
    """Bootstrap samples of each group's positives: for each of ``times`` resamples as many draws with replacement as there are positives. ``copies`` counts the draws of a positive, without a limit; what is not drawn is left out."""
    placed = rank_within(positives, groups, order, "__i")
    sized = placed.select(*groups, "__i").join(placed.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n")), groups)
    # dealt by number, as few small rows become ``times`` as many
    draws = sized.repartition(int(positives.sparkSession.conf.get("spark.sql.shuffle.partitions")), *groups, "__i").withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "resample", *groups, "__i")), 1, 8), 16, 10).cast("long")
    drawn = draws.withColumn("__i", F.shiftright(u * F.col("__n"), 32) + 1).groupBy(*groups, "resample", "__i").agg(F.count(F.lit(1)).alias("copies"))
    return materialize(placed.join(drawn, [*groups, "__i"]).drop("__i"), "redrawn")


def redrawn_recall(ranked: DataFrame, groups: list[str], n_max: int, points: int, times: int, seed: int = 0, positive: str = "positive", totals: DataFrame | None = None) -> DataFrame:
    """(groups, resample, n, recall) of ``times`` bootstrap samples of each group's positives, as :func:`redrawn` draws them in the order of ``rank``.

    A positive only counts by its grid point, so a group is drawn from as many numbers as the grid has points. ``totals`` has the positives of
    each group (``__all``), if ``ranked`` lacks some whose rank is over ``n_max``.
    """
    at = F.least(_first_point(F.col("rank"), n_max, points), F.lit(points)).cast("int")
    found = ranked.filter(F.col(positive)).groupBy(*groups, at.alias("__place")).agg(F.count(F.lit(1)).alias("__n"))
    if totals is not None:
        rest = totals.join(found.groupBy(*groups).agg(F.sum("__n").alias("__n")), groups, "left").select(*groups, F.lit(points).alias("__place"), (F.col("__all") - F.coalesce("__n", F.lit(0))).alias("__n"))
        found = found.unionByName(rest.filter("__n > 0")).groupBy(*groups, "__place").agg(F.sum("__n").alias("__n"))
    runs = found.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct("__place", "__n"))).alias("__runs"))
    listed = runs.select(*groups, F.col("__runs.__place").alias("__places"), F.col("__runs.__n").alias("__rows"))
    n = 1 + F.col("i") * F.lit(n_max - 1) / F.lit(float(points - 1))
    return redrawn_curves(listed, groups, points, times, seed).select(*groups, "resample", n.alias("n"), F.col("share").alias("recall"))


def recall_bootstrap(ranked: DataFrame, groups: list[str], n_max: int, points: int, times: int, seed: int = 0, positive: str = "positive") -> DataFrame:
    """(groups, n, mean, std) of the recall curve over folds and resamples stacked."""
    drawn = resampled(ranked.filter(F.col(positive)), times, seed)
    curves = recall_curve(drawn, [*groups, "resample"], n_max, points, positive, F.col("copies"))
    return curve_statistics(curves, [*groups, "n"], "recall")


def curve_statistics(curves: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and population deviation of ``value`` for each point."""
    return curves.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def ranks_against_negatives(table: DataFrame, groups: list[str], positive: str = "positive") -> DataFrame:
    """Positives with ``rank_negatives``: rank in their group (ties by source, target) less the distinct higher scores of positives."""
    ranked = rank_within(table, groups, by_score(), "__r").filter(F.col(positive))
    among = F.dense_rank().over(W.partitionBy(*groups).orderBy(F.desc("score")))
    return ranked.withColumn("rank_negatives", F.col("__r") - among + 1).drop("__r")


def hit_curve(positives: DataFrame, groups: list[str], k_max: int, weight: Column | None = None, k_min: int = 1) -> DataFrame:
    """(groups, k, hit): share of positives with ``rank_negatives`` at most k, for k from ``k_min`` (0 or 1) to ``k_max``."""
    w = F.lit(1) if weight is None else weight
    found = positives.groupBy(*groups, F.col("rank_negatives").alias("i")).agg(F.sum(w).alias("c"))
    totals = found.groupBy(*groups).agg(F.sum("c").alias("__total"))
    ks = positives.sparkSession.range(k_min, k_max + 1).select(F.col("id").alias("i"))
    return _cumulate(found, groups, ks).join(totals, groups).select(*groups, F.col("i").alias("k"), (F.col("c") / F.col("__total")).alias("hit"))


def redrawn_hits(positives: DataFrame, groups: list[str], order: list[Column], k_max: int, times: int, seed: int = 0, k_min: int = 1) -> DataFrame:
    """(groups, resample, k, hit) of ``times`` bootstrap samples of each group's positives, as :func:`redrawn` draws them in the order of ``order`` (total).

    A group is drawn from as a list of places on the curve, put together from pieces: four bytes a positive.
    """
    at = F.least(F.greatest(F.col("rank_negatives") - k_min, F.lit(0)), F.lit(k_max - k_min + 1)).cast("int")
    placed = rank_within(positives.withColumn("__k", at), groups, order, "__i").select(*groups, F.col("__k").alias("__place"), "__i")
    piece = lambda row: F.array_sort(F.collect_list(row))
    pieces = placed.groupBy(*groups, F.floor(F.col("__i") / PIECE).alias("__at")).agg(piece(F.struct("__i", "__place"))["__place"].alias("__piece"))
    listed = pieces.groupBy(*groups).agg(F.flatten(piece(F.struct("__at", "__piece"))["__piece"]).alias("__places")).withColumn("__rows", F.lit(None).cast("array<long>"))
    curves = redrawn_curves(listed, groups, k_max - k_min + 1, times, seed)
    return curves.select(*groups, "resample", (F.col("i") + k_min).alias("k"), F.col("share").alias("hit"))


def hit_bootstrap(positives: DataFrame, groups: list[str], k_max: int, times: int, seed: int = 0) -> DataFrame:
    """(groups, k, mean, std) of the hit curve over resamples."""
    curves = hit_curve(resampled(positives, times, seed), [*groups, "resample"], k_max, F.col("copies"))
    return curve_statistics(curves, [*groups, "k"], "hit")


def random_recall(points: DataFrame, rows: int) -> DataFrame:
    """(n, recall) of a random classifier over a table of ``rows`` pairs."""
    return points.select("n", F.least(F.lit(1.0), F.col("n") / F.lit(float(max(1, rows)))).alias("recall"))


def _along(found: DataFrame, keys: DataFrame, points: DataFrame, value: str) -> DataFrame:
    """Running sums of ``value`` over every grid point ``i`` of every key, keys without a row of ``found`` included."""
    groups = keys.columns
    along = W.partitionBy(*groups).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    full = keys.crossJoin(F.broadcast(points)).join(found, [*groups, "i"], "left")
    return full.withColumn(value, F.coalesce(F.sum(value).over(along), F.lit(0)))


def commonality_curve(ranked: DataFrame, n_max: int, points: int) -> DataFrame:
    """(one, other, fold, n, commonality) of all pairs of models in each fold: the share of the first n pairs of both, on ``points`` whole n from 1 to ``n_max``.

    ``ranked`` has model, fold, source, target and ``rank`` from 1. The rankings are joined once; a common pair counts from the greater rank on.
    """
    rows = ranked.filter(F.col("rank") <= n_max).select("model", "fold", *KEY, "rank")
    both = rows.withColumnRenamed("model", "one").join(rows.select(F.col("model").alias("other"), "fold", *KEY, F.col("rank").alias("__rank")), ["fold", *KEY]).filter("one < other")
    first = F.greatest(F.lit(0), F.ceil((2 * F.greatest("rank", "__rank") - 3) * (points - 1) / F.lit(2 * (n_max - 1)))).cast("long")
    found = both.groupBy("one", "other", "fold", first.alias("i")).agg(F.count(F.lit(1)).alias("c"))
    models = ranked.select("model", "fold").distinct()
    keys = models.withColumnRenamed("model", "one").join(models.withColumnRenamed("model", "other"), "fold").filter("one < other").select("one", "other", "fold")
    whole = grid(ranked.sparkSession, n_max, points).withColumn("n", F.round("n").cast("long"))
    return _along(found, keys, whole, "c").select("one", "other", "fold", "n", (F.col("c") / F.col("n")).alias("commonality"))


def entropy_curve(ranked: DataFrame, entity: str, n_max: int, points: int) -> DataFrame:
    """(model, fold, n, entropy) of the entities among the first n pairs, to the base of the number of all, on ``points`` whole n from 0 to ``n_max``; 0 at n = 0.

    The k-th pair of an entity adds k ln k - (k - 1) ln(k - 1) to the sum that gives the entropy, so the curve costs one pass.
    """
    groups = ["model", "fold"]
    total = ranked.groupBy(*groups).agg(F.count_distinct(entity).alias("__all"))
    k = F.row_number().over(W.partitionBy(*groups, entity).orderBy("rank"))
    rows = ranked.filter(F.col("rank") <= n_max).select(*groups, "rank", entity).withColumn("__k", k)
    adds = F.col("__k") * F.log(F.col("__k").cast("double")) - F.when(F.col("__k") > 1, (F.col("__k") - 1) * F.log((F.col("__k") - 1).cast("double"))).otherwise(0.0)
    first = F.ceil((2 * F.col("rank") - 1) * (points - 1) / F.lit(2 * n_max)).cast("long")
    found = rows.groupBy(*groups, first.alias("i")).agg(F.count(F.lit(1)).alias("c"), F.sum(adds).alias("x"))
    whole = entropy_grid(ranked.sparkSession, n_max, points)
    keys = total.select(*groups)
    curve = _along(found.drop("x"), keys, whole, "c").join(_along(found.drop("c"), keys, whole.drop("n"), "x"), [*groups, "i"]).join(total, groups)
    nats = F.when(F.col("c") > 0, F.log(F.col("c").cast("double")) - F.col("x") / F.col("c")).otherwise(0.0)
    return curve.select(*groups, "n", (nats / F.log(F.greatest(F.lit(2), "__all").cast("double"))).alias("entropy"))


def entropy_grid(spark: SparkSession, n_max: int, points: int) -> DataFrame:
    """(i, n): ``points`` >= 2 steps from 0 to ``n_max``, rounded."""
    return spark.range(points).select(F.col("id").alias("i"), F.round(F.col("id") * F.lit(n_max) / F.lit(float(points - 1))).cast("long").alias("n"))


def maximal_entropy(points: DataFrame, entities: int) -> DataFrame:
    """(n, entropy): the most that n pairs over ``entities`` can have, to their number's base; 0 at n = 0."""
    each, more = F.floor(F.col("n") / entities), F.col("n") % entities
    log = lambda p: F.log(p) / F.log(F.lit(float(max(2, entities))))
    high, low = (each + 1) / F.col("n"), each / F.col("n")
    out = -more * high * log(high) - F.when(each > 0, (entities - more) * low * log(low)).otherwise(0.0)
    return points.select("n", F.when(F.col("n") > 0, out).otherwise(0.0).alias("entropy"))
