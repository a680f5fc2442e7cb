"""Queries on labelled test sets, stability, model comparison and table reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import comparison as C
from atlasmill.operators import evaluation as E
from atlasmill.operators import pairs as M
from atlasmill.operators import ranking as R
from atlasmill.registry import query

P = f"WITH {A.PAIRS_SQL}"
#: two models over the same pairs, the second with another score
MODELS = f"{P}, models AS (SELECT 'one' AS model, fold, source, target, score, y IS NOT DISTINCT FROM 1 AS positive FROM pairs UNION ALL SELECT 'two', fold, source, target, abs(score - 0.5), y IS NOT DISTINCT FROM 1 FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY score DESC, source, target) AS rank FROM models)"
TWO = f"{P}, a AS (SELECT source, target, row_number() OVER (ORDER BY score DESC, source, target) AS rank FROM pairs), b AS (SELECT source, target, row_number() OVER (ORDER BY round(score, 2) DESC, source, target) AS rank FROM pairs), j AS (SELECT a.rank AS ra, b.rank AS rb FROM a JOIN b USING (source, target) WHERE a.rank <= 400 AND b.rank <= 400)"
CURVE = "g AS (SELECT i, 1 + i * 499 / 20.0::DOUBLE AS n FROM range(21) t(i))"
#: copies of a positive in a resample
COPIES = "CAST(('0x' || substr(md5('7|' || resample || '|' || source || '|' || target), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
POISSON = "CASE " + " ".join(f"WHEN u < {p:.8f} THEN {k}" for k, p in enumerate(C.POISSON)) + f" ELSE {len(C.POISSON)} END"
DRAWN = f"drawn AS (SELECT * FROM (SELECT *, {POISSON} AS copies FROM (SELECT *, {COPIES} AS u FROM known CROSS JOIN range(5) t(resample))) WHERE copies > 0)"
HITS = f"{MODELS}, h AS (SELECT *, row_number() OVER (PARTITION BY model, target ORDER BY score DESC, source) AS r FROM models), known AS (SELECT *, r - dense_rank() OVER (PARTITION BY model, target ORDER BY score DESC) + 1 AS rn FROM h WHERE positive)"

#: the reference's production values (conf/base/run_comparison/parameters.yml, defaults in evaluations.py)
TIMES, N_MAX, N_MAX_NEGATIVE, POINTS, FOLD_POINTS, K_MAX = 100, 100_000, 1_000_000, 1000, 100, 200
#: both models with positives and negatives, ranked in each fold
FULL = f"{P}, models AS (SELECT 'one' AS model, fold, source, target, score, y FROM pairs UNION ALL SELECT 'two', fold, source, target, abs(score - 0.5), y FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY score DESC, source, target) AS rank FROM models)"
FULL_HITS = f"{FULL}, h AS (SELECT *, row_number() OVER (PARTITION BY model, fold, target ORDER BY score DESC, source) AS r FROM models), known AS (SELECT *, r - dense_rank() OVER (PARTITION BY model, fold, target ORDER BY score DESC) + 1 AS rn FROM h WHERE y = 1)"


def _grid_sql(n_max, points):
    return f"g AS (SELECT p, 1 + p * {n_max - 1} / {points - 1}.0::DOUBLE AS n FROM range({points}) t(p))"


def _within(n_max, points):
    return f"(rank - 1) * {points - 1} <= p * {n_max - 1}"


def _redrawn_sql(order):
    """``drawn`` from ``known``: as many draws with replacement as a group has rows."""
    u = "CAST(('0x' || substr(md5('7|' || resample || '|' || model || '|' || fold || '|' || i), 1, 8)) AS BIGINT)"
    return f"placed AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY {order}) AS i, count(*) OVER (PARTITION BY model, fold) AS size FROM known), picked AS (SELECT model, fold, resample, {u} * size // 4294967296 + 1 AS i, count(*) AS copies FROM placed CROSS JOIN range({TIMES}) t(resample) GROUP BY ALL), drawn AS (SELECT placed.*, resample, copies FROM placed JOIN picked USING (model, fold, i))"


def _recall_sql(y, n_max, points=POINTS):
    return f"{FULL}, {_grid_sql(n_max, points)} SELECT model, fold, round(n, 6) AS n, round(count(*) FILTER (WHERE {_within(n_max, points)}) / count(*)::DOUBLE, 9) AS recall FROM r CROSS JOIN g WHERE y = {y} GROUP BY ALL"


def _recall_bootstrap_sql(y, n_max):
    return f"{FULL}, {_grid_sql(n_max, POINTS)}, known AS (SELECT * FROM r WHERE y = {y}), {_redrawn_sql('rank')}, c AS (SELECT model, fold, resample, n, sum(CASE WHEN {_within(n_max, POINTS)} THEN copies ELSE 0 END) / sum(copies)::DOUBLE AS v FROM drawn CROSS JOIN g GROUP BY ALL) SELECT model, round(n, 6) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM c GROUP BY model, n"


def _pairs(spark, d):
    return A.pairs(spark, d)


def _models(spark, d):
    p = A.pairs(spark, d).withColumn("positive", F.coalesce(F.col("y") == 1, F.lit(False))).select("fold", "source", "target", "score", "positive")
    return p.withColumn("model", F.lit("one")).unionByName(p.withColumn("model", F.lit("two")).withColumn("score", F.abs(F.col("score") - 0.5)))


def _ranked_models(spark, d):
    return C.rank_within(_models(spark, d), ["model", "fold"], R.by_score(), "rank")


def _two(spark, d):
    p = A.pairs(spark, d).select("source", "target", "score")
    return R.global_rank(p), R.global_rank(p.withColumn("score", F.round("score", 2)))


@query(f"{P}, r AS (SELECT *, row_number() OVER (ORDER BY source, target) AS rank FROM pairs), l AS (SELECT score, lag(score) OVER (ORDER BY rank) AS b FROM r) SELECT (SELECT count(*) FROM pairs WHERE split = 'TRAIN') AS train_rows, (SELECT count(*) FROM l WHERE score > b) AS breaks")
def evl_01_table_checks(spark, d):
    p = _pairs(spark, d)
    ranked = M.rank_rows(p, [F.col("source"), F.col("target")], "rank")
    train = E.train_rows_in(p, p.filter("split = 'TRAIN'")).agg(F.count(F.lit(1)).alias("train_rows"))
    return train.crossJoin(E.score_breaks(ranked).agg(F.count(F.lit(1)).alias("breaks")))


@query(f"{P} SELECT source, target, 1 AS y FROM pairs WHERE y = 1 UNION ALL SELECT source, target, 0 FROM pairs WHERE y = 0")
def evl_02_labelled_pairs(spark, d):
    p = _pairs(spark, d).select("source", "target", F.coalesce(F.col("y") == 1, F.lit(False)).alias("pos"), F.coalesce(F.col("y") == 0, F.lit(False)).alias("neg"))
    return E.labelled_pairs(p, "pos", "neg").select("source", "target", "y")


@query(f"{P} SELECT source, target FROM pairs WHERE target IN (SELECT target FROM pairs WHERE y = 1 AND fold = 0) AND (y IS NOT DISTINCT FROM 1 AND fold = 0 OR NOT (y IS NOT DISTINCT FROM 0))")
def evl_03_positive_targets(spark, d):
    p = _pairs(spark, d).withColumn("pos", F.coalesce((F.col("y") == 1) & (F.col("fold") == 0), F.lit(False))).withColumn("gone", F.col("y") == 0)
    return E.restrict_to_positive_targets(p, "pos", ["gone"]).select("source", "target")


@query(f"{P}, a AS (SELECT *, row_number() OVER (ORDER BY score DESC, source, target) AS rank FROM pairs), k AS (SELECT *, row_number() OVER (ORDER BY rank) - 1 AS i FROM a WHERE y = 1) SELECT source, target, rank, rank - i AS non_pos_rank, (rank - i - 1) / (SELECT count(*) FROM pairs WHERE y IS DISTINCT FROM 1)::DOUBLE AS non_pos_quantile FROM k")
def evl_04_positive_quantiles(spark, d):
    p = R.global_rank(_pairs(spark, d)).withColumn("pos", F.coalesce(F.col("y") == 1, F.lit(False)))
    return E.positive_quantiles(p, "pos").select("source", "target", "rank", "non_pos_rank", "non_pos_quantile")


@query(f"{TWO} SELECT source, target FROM a JOIN b USING (source, target) WHERE a.rank <= 400 AND b.rank <= 400")
def evl_05_overlap(spark, d):
    return E.overlap_at(list(_two(spark, d)), 400)


@query(f"{P}, t AS (SELECT *, row_number() OVER (ORDER BY score DESC, source, target) AS rank FROM pairs WHERE y IS NOT NULL) SELECT n, count(*) FILTER (WHERE y = 1 AND rank <= n) / count(*) FILTER (WHERE y = 1)::DOUBLE AS recall FROM t CROSS JOIN (VALUES (10::BIGINT), (100), (1000)) v(n) GROUP BY n")
def evl_10_recall_on_labels(spark, d):
    return R.recall_at(_pairs(spark, d).filter("y is not null"), [10, 100, 1000])


@query(f"{TWO} SELECT count(*) / 400.0::DOUBLE AS commonality FROM j")
def evl_11_commonality(spark, d):
    return R.commonality(*_two(spark, d), 400)


@query(f"{TWO}, k AS (SELECT row_number() OVER (ORDER BY ra) AS x, row_number() OVER (ORDER BY rb) AS y FROM j) SELECT round(corr(x, y), 6) AS stat FROM k")
def evl_12_spearman(spark, d):
    return E.spearman_at(*_two(spark, d), 400).select(F.round("stat", 6).alias("stat"))


@query(f"{TWO} SELECT round((SELECT count(*) FROM (SELECT ra FROM j INTERSECT SELECT rb FROM j)) * (SELECT count(*) FROM (SELECT source, target FROM a WHERE rank <= 400 UNION SELECT source, target FROM b WHERE rank <= 400)) / 160000.0::DOUBLE, 6) AS stat")
def evl_13_hypergeometric(spark, d):
    return E.hypergeometric_at(*_two(spark, d), 400).select(F.round("stat", 6).alias("stat"))


@query(f"{TWO}, k AS (SELECT row_number() OVER (ORDER BY ra) AS x, row_number() OVER (ORDER BY rb) AS y FROM j), s AS (SELECT abs(corr(x, y)) AS s, count(*) / 400.0::DOUBLE AS c FROM k) SELECT round(2 * s * c / (s + c), 6) AS rank_commonality FROM s")
def evl_14_rank_commonality(spark, d):
    a, b = _two(spark, d)
    value = E.rank_commonality(E.spearman_at(a, b, 400).first()["stat"], R.commonality(a, b, 400).first()[0])
    return spark.createDataFrame([(value,)], "rank_commonality double").select(F.round("rank_commonality", 6).alias("rank_commonality"))


@query(f"{P}, m AS (SELECT fold, target AS metric, avg(score) AS value FROM pairs GROUP BY ALL) SELECT metric, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std, round(median(value), 9) AS median, round(min(value), 9) AS min, round(max(value), 9) AS max FROM m GROUP BY metric")
def evl_15_fold_statistics(spark, d):
    m = _pairs(spark, d).groupBy("fold", F.col("target").alias("metric")).agg(F.avg("score").alias("value"))
    return E.aggregate_folds(m).select("metric", *[F.round(c, 9).alias(c) for c in ("mean", "std", "median", "min", "max")])


@query(f"{P}, k AS (SELECT * FROM pairs WHERE split = 'TEST') SELECT target, count(*) AS n, count(*) FILTER (WHERE y = 1) AS pos FROM (SELECT d.source, e.target, k.y FROM (SELECT DISTINCT source FROM k) d CROSS JOIN (SELECT DISTINCT target FROM k) e LEFT JOIN pairs k ON k.source = d.source AND k.target = e.target WHERE k.split = 'TEST') GROUP BY target")
def cmp_01_dense(spark, d):
    test = _pairs(spark, d).filter("split = 'TEST'").withColumn("pos", F.coalesce(F.col("y") == 1, F.lit(False)))
    return C.sparse(test, ["pos"]).dense().groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count_if("pos").alias("pos"))


@query(f"{P}, k AS (SELECT source, target FROM pairs WHERE split = 'TEST') SELECT s.source, t.target FROM (SELECT DISTINCT source FROM k) s CROSS JOIN (SELECT DISTINCT target FROM k) t EXCEPT FROM k")
def cmp_02_excluded(spark, d):
    return C.sparse(_pairs(spark, d).filter("split = 'TEST'"), []).excluded


@query(f"""{P}, a AS (SELECT * FROM pairs WHERE fold <> 0), b AS (SELECT * FROM pairs WHERE fold <> 1), ax AS (SELECT s.source, t.target FROM (SELECT DISTINCT source FROM a) s CROSS JOIN (SELECT DISTINCT target FROM a) t EXCEPT SELECT source, target FROM a), bx AS (SELECT s.source, t.target FROM (SELECT DISTINCT source FROM b) s CROSS JOIN (SELECT DISTINCT target FROM b) t EXCEPT SELECT source, target FROM b)
SELECT NOT EXISTS ((SELECT source FROM a EXCEPT SELECT source FROM b) UNION ALL (SELECT source FROM b EXCEPT SELECT source FROM a)) AS same_axes, NOT EXISTS ((FROM ax EXCEPT FROM bx) UNION ALL (FROM bx EXCEPT FROM ax)) AS same_pairs""")
def cmp_03_equality(spark, d):
    p = _pairs(spark, d)
    a, b = C.sparse(p.filter("fold <> 0"), []), C.sparse(p.filter("fold <> 1"), [])
    return spark.createDataFrame([(C.same_rows(a.drugs, b.drugs), C.same_excluded(a, b))], "same_axes boolean, same_pairs boolean")


@query(f"{P} SELECT source, target, y IS NOT DISTINCT FROM 1 AS positive FROM pairs WHERE fold = 2")
def cmp_04_harmonized(spark, d):
    p = _pairs(spark, d).withColumn("positive", F.coalesce(F.col("y") == 1, F.lit(False)))
    return C.combine([C.sparse(p, ["positive"], F.col("fold") != k) for k in (0, 1)]).dense()


@query(f"{P} SELECT source, target, y IS NOT DISTINCT FROM 1 AS positive, CASE WHEN score > 0.5 THEN score END AS score FROM pairs WHERE fold = 2 AND (y IS NULL OR y IN (0, 1))")
def cmp_05_combined_predictions(spark, d):
    p = _pairs(spark, d).withColumn("positive", F.coalesce(F.col("y") == 1, F.lit(False)))
    common = C.combine([C.sparse(p, ["positive"], F.col("fold") != k) for k in (0, 1)])
    return C.restrict(common, p.filter("score > 0.5").select("source", "target", "score"))


@query(f"{MODELS} SELECT model, target, round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std FROM (SELECT model, fold, target, max(score) AS m FROM models GROUP BY ALL) GROUP BY ALL")
def cmp_07_curve_statistics(spark, d):
    best = _models(spark, d).groupBy("model", "fold", "target").agg(F.max("score").alias("m"))
    return C.curve_statistics(best, ["model", "target"], "m").select("model", "target", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"{MODELS}, {CURVE} SELECT model, fold, round(n, 6) AS n, round(count(*) FILTER (WHERE (rank - 1) * 20 <= i * 499) / count(*)::DOUBLE, 9) AS recall FROM r CROSS JOIN g WHERE positive GROUP BY ALL")
def cmp_09_recall_curve(spark, d):
    return C.recall_curve(_ranked_models(spark, d), ["model", "fold"], 500, 21).withColumn("n", F.round("n", 6)).withColumn("recall", F.round("recall", 9))


@query(f"{MODELS}, {CURVE}, known AS (SELECT * FROM r WHERE positive), {DRAWN}, c AS (SELECT model, fold, resample, n, sum(CASE WHEN (rank - 1) * 20 <= i * 499 THEN copies ELSE 0 END) / sum(copies)::DOUBLE AS v FROM drawn CROSS JOIN g GROUP BY ALL) SELECT model, round(n, 6) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM c GROUP BY model, n")
def cmp_10_recall_bootstrap(spark, d):
    drawn = C.resampled(_ranked_models(spark, d).filter("positive"), 5, 7)
    curves = C.recall_curve(drawn, ["model", "fold", "resample"], 500, 21, weight=F.col("copies"))
    return C.curve_statistics(curves, ["model", "n"], "recall").select("model", *[F.round(c, 6).alias(c) for c in ("n", "mean", "std")])


@query(f"{HITS} SELECT model, k, round(count(*) FILTER (WHERE rn <= k) / count(*)::DOUBLE, 9) AS hit FROM known CROSS JOIN range(1, 31) t(k) GROUP BY ALL")
def cmp_11_hit_curve(spark, d):
    pos = C.ranks_against_negatives(_models(spark, d), ["model", "target"])
    return C.hit_curve(pos, ["model"], 30).withColumn("hit", F.round("hit", 9))


@query(f"{HITS}, {DRAWN}, c AS (SELECT model, resample, k, sum(CASE WHEN rn <= k THEN copies ELSE 0 END) / sum(copies)::DOUBLE AS v FROM drawn CROSS JOIN range(1, 31) t(k) GROUP BY ALL) SELECT model, k, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM c GROUP BY ALL")
def cmp_12_hit_bootstrap(spark, d):
    pos = C.ranks_against_negatives(_models(spark, d), ["model", "target"])
    return C.hit_bootstrap(pos, ["model"], 30, 5, 7).select("model", "k", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"{MODELS}, {CURVE}, c AS (SELECT model, fold, n, count(*) FILTER (WHERE (rank - 1) * 20 <= i * 499) / count(*)::DOUBLE AS v FROM r CROSS JOIN g WHERE positive GROUP BY ALL) SELECT fold, round(n, 6) AS n, round(max(v) FILTER (WHERE model = 'one'), 9) AS one, round(max(v) FILTER (WHERE model = 'two'), 9) AS two FROM c GROUP BY fold, n")
def cmp_16_recall_by_fold(spark, d):
    wide = C.recall_curve(_ranked_models(spark, d), ["model", "fold"], 500, 21).groupBy("fold", F.round("n", 6).alias("n")).pivot("model", ["one", "two"]).agg(F.max("recall"))
    return wide.withColumn("one", F.round("one", 9)).withColumn("two", F.round("two", 9))


@query(f"{P}, {CURVE} SELECT round(n, 6) AS n, round(least(1.0, n / (SELECT count(*) FROM pairs)::DOUBLE), 9) AS recall FROM g")
def cmp_17_random_recall(spark, d):
    return C.random_recall(C.grid(spark, 500, 21), _pairs(spark, d).count()).select(F.round("n", 6).alias("n"), F.round("recall", 9).alias("recall"))


def _full_models(spark, d, y=1):
    p = A.pairs(spark, d).withColumn("positive", F.coalesce(F.col("y") == y, F.lit(False))).select("fold", "source", "target", "score", "positive")
    return p.withColumn("model", F.lit("one")).unionByName(p.withColumn("model", F.lit("two")).withColumn("score", F.abs(F.col("score") - 0.5)))


def _full_ranked(spark, d, y=1):
    return C.rank_within(_full_models(spark, d, y), ["model", "fold"], R.by_score(), "rank")


def _full_recall(spark, d, y, n_max):
    return C.recall_curve(_full_ranked(spark, d, y), ["model", "fold"], n_max, POINTS).withColumn("n", F.round("n", 6)).withColumn("recall", F.round("recall", 9))


def _full_recall_bootstrap(spark, d, y, n_max):
    ranked, totals = C.first_ranks(_full_models(spark, d, y), ["model", "fold"], n_max)
    curves = C.redrawn_recall(ranked, ["model", "fold"], n_max, POINTS, TIMES, 7, totals=totals)
    return C.curve_statistics(curves, ["model", "n"], "recall").select("model", *[F.round(c, 6).alias(c) for c in ("n", "mean", "std")])


@query(_recall_sql(1, N_MAX))
def cmp_09_recall_curve_full(spark, d):
    return _full_recall(spark, d, 1, N_MAX)


@query(_recall_sql(0, N_MAX_NEGATIVE))
def cmp_09_negative_recall_full(spark, d):
    return _full_recall(spark, d, 0, N_MAX_NEGATIVE)


@query(_recall_bootstrap_sql(1, N_MAX))
def cmp_10_recall_bootstrap_full(spark, d):
    return _full_recall_bootstrap(spark, d, 1, N_MAX)


@query(_recall_bootstrap_sql(0, N_MAX_NEGATIVE))
def cmp_10_negative_bootstrap_full(spark, d):
    return _full_recall_bootstrap(spark, d, 0, N_MAX_NEGATIVE)


@query(f"{FULL_HITS} SELECT model, fold, k, round(count(*) FILTER (WHERE rn <= k) / count(*)::DOUBLE, 9) AS hit FROM known CROSS JOIN range({K_MAX + 1}) t(k) GROUP BY ALL")
def cmp_11_hit_curve_full(spark, d):
    pos = C.ranks_against_negatives(_full_models(spark, d), ["model", "fold", "target"])
    return C.hit_curve(pos, ["model", "fold"], K_MAX, k_min=0).withColumn("hit", F.round("hit", 9))


@query(f"{FULL_HITS}, {_redrawn_sql('target, source')}, c AS (SELECT model, fold, resample, k, sum(CASE WHEN rn <= k THEN copies ELSE 0 END) / sum(copies)::DOUBLE AS v FROM drawn CROSS JOIN range({K_MAX + 1}) t(k) GROUP BY ALL) SELECT model, k, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM c GROUP BY ALL")
def cmp_12_hit_bootstrap_full(spark, d):
    pos = C.ranks_against_negatives(_full_models(spark, d), ["model", "fold", "target"])
    curves = C.redrawn_hits(pos, ["model", "fold"], [F.col("target"), F.col("source")], K_MAX, TIMES, 7, k_min=0)
    return C.curve_statistics(curves, ["model", "k"], "hit").select("model", "k", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(f"{FULL}, {_grid_sql(N_MAX, FOLD_POINTS)}, c AS (SELECT model, fold, n, count(*) FILTER (WHERE {_within(N_MAX, FOLD_POINTS)}) / count(*)::DOUBLE AS v FROM r CROSS JOIN g WHERE y = 1 GROUP BY ALL) SELECT fold, round(n, 6) AS n, round(max(v) FILTER (WHERE model = 'one'), 9) AS one, round(max(v) FILTER (WHERE model = 'two'), 9) AS two FROM c GROUP BY fold, n")
def cmp_16_recall_by_fold_full(spark, d):
    wide = C.recall_curve(_full_ranked(spark, d), ["model", "fold"], N_MAX, FOLD_POINTS).groupBy("fold", F.round("n", 6).alias("n")).pivot("model", ["one", "two"]).agg(F.max("recall"))
    return wide.withColumn("one", F.round("one", 9)).withColumn("two", F.round("two", 9))


#: three models, for all pairs of models
THREE = f"{P}, models AS (SELECT 'one' AS model, fold, source, target, score FROM pairs UNION ALL SELECT 'two', fold, source, target, abs(score - 0.5) FROM pairs UNION ALL SELECT 'three', fold, source, target, -abs(score - 0.75) FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY model, fold ORDER BY score DESC, source, target) AS rank FROM models)"


def _three_ranked(spark, d):
    p = A.pairs(spark, d).select("fold", "source", "target", "score")
    scores = {"one": F.col("score"), "two": F.abs(F.col("score") - 0.5), "three": -F.abs(F.col("score") - 0.75)}
    return C.rank_within(p.select("fold", "source", "target", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])).alias("m")).select("fold", "source", "target", "m.*"), ["model", "fold"], R.by_score(), "rank")


@query(f"{THREE}, g AS (SELECT CAST(round(p * {N_MAX} / {POINTS - 1}.0::DOUBLE) AS BIGINT) AS n FROM range({POINTS}) t(p)), e AS (SELECT model, fold, 'source' AS entity, source AS id, rank FROM r UNION ALL SELECT model, fold, 'target', target, rank FROM r), a AS (SELECT model, fold, entity, count(DISTINCT id) AS size FROM e GROUP BY ALL), k AS (SELECT model, fold, entity, n, id, count(*) AS c FROM e JOIN g ON rank <= n GROUP BY ALL), s AS (SELECT *, c / sum(c) OVER (PARTITION BY model, fold, entity, n) AS q FROM k), h AS (SELECT model, fold, entity, n, sum(-q * ln(q)) AS h FROM s GROUP BY ALL), v AS (SELECT model, entity, n, coalesce(h, 0) / ln(greatest(2, size)) AS v FROM a CROSS JOIN g LEFT JOIN h USING (model, fold, entity, n)) SELECT model, entity, n, round(avg(v), 6) + 0 AS mean, round(stddev_pop(v), 6) AS std FROM v GROUP BY ALL")
def cmp_13_entropy_full(spark, d):
    ranked = _three_ranked(spark, d)
    curves = [C.entropy_curve(ranked, c, N_MAX, POINTS).withColumn("entity", F.lit(c)) for c in ("source", "target")]
    out = C.curve_statistics(curves[0].unionByName(curves[1]), ["model", "entity", "n"], "entropy")
    return out.select("model", "entity", "n", (F.round("mean", 6) + 0).alias("mean"), F.round("std", 6).alias("std"))


@query(f"{P}, g AS (SELECT CAST(round(p * {N_MAX} / {POINTS - 1}.0::DOUBLE) AS BIGINT) AS n FROM range({POINTS}) t(p)), a AS (SELECT count(DISTINCT source) AS size FROM pairs WHERE fold = 0), q AS (SELECT n, size, n // size + CASE WHEN j < n % size THEN 1 ELSE 0 END AS c FROM g CROSS JOIN a CROSS JOIN range(100000) t(j) WHERE j < size) SELECT n, round(coalesce(sum(CASE WHEN c > 0 THEN -(c / n) * ln(c / n) END) / ln(greatest(2, max(size))), 0), 6) + 0 AS entropy FROM q GROUP BY n")
def cmp_13_maximal_entropy_full(spark, d):
    size = A.pairs(spark, d).filter("fold = 0").select("source").distinct().count()
    return C.maximal_entropy(C.entropy_grid(spark, N_MAX, POINTS), size).select("n", (F.round("entropy", 6) + 0).alias("entropy"))


@query(f"{THREE}, g AS (SELECT CAST(round(1 + p * {N_MAX_NEGATIVE - 1} / {POINTS - 1}.0::DOUBLE) AS BIGINT) AS n FROM range({POINTS}) t(p)), j AS (SELECT a.model AS one, b.model AS other, a.fold AS fold, greatest(a.rank, b.rank) AS m FROM r a JOIN r b ON a.fold = b.fold AND a.source = b.source AND a.target = b.target AND a.model < b.model), v AS (SELECT one, other, fold, n, count(*) FILTER (WHERE m <= n) / n::DOUBLE AS v FROM j CROSS JOIN g GROUP BY one, other, fold, n) SELECT one, other, n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM v GROUP BY ALL")
def cmp_14_commonality_full(spark, d):
    curves = C.commonality_curve(_three_ranked(spark, d), N_MAX_NEGATIVE, POINTS)
    return C.curve_statistics(curves, ["one", "other", "n"], "commonality").select("one", "other", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


VECTORS = "v AS (SELECT 'SUPP:' || s_suppkey AS id, [(s_suppkey % 7) / 7.0::DOUBLE, (s_suppkey % 5) / 5.0::DOUBLE] AS e FROM supplier UNION ALL SELECT 'PART:' || p_partkey, [(p_partkey % 7) / 7.0::DOUBLE, (p_partkey % 5) / 5.0::DOUBLE] FROM part)"
WEIGHTS = [[0.5, -1.0, 0.25, 2.0], [1.5, 0.5, -0.75, 0.0], [0.0, 0.25, 1.0, -0.5]]


def _vectors(spark, d):
    def part(name, key, prefix):
        k = F.col(key)
        return A.read(spark, d, name).select(F.concat(F.lit(prefix), k.cast("string")).alias("id"), F.array((k % 7) / F.lit(7.0), (k % 5) / F.lit(5.0)).alias("embedding"))

    return part("supplier", "s_suppkey", "SUPP:").unionByName(part("part", "p_partkey", "PART:"))


@query(f"WITH {VECTORS} SELECT id, name, round(e[1], 6) AS first FROM (SELECT 'SUPP:' || s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT 'NATION:' || n_nationkey, n_name FROM nation) JOIN v USING (id)")
def mat_01_enriched(spark, d):
    n = A.nodes(spark, d)
    lists = [n.filter("id like 'SUPP:%'").select("id", "name", F.lit(True).alias("is_drug")), n.filter("id like 'NATION:%'").select("id", "name")]
    return M.enrich(lists, _vectors(spark, d)).select("id", "name", F.round(F.get("embedding", F.lit(0)), 6).alias("first"))


@query(f"{P}, {VECTORS}, z AS (SELECT source, target, " + ", ".join(f"exp(list_dot_product(s.e || t.e, {w}::DOUBLE[])) AS z{i}" for i, w in enumerate(WEIGHTS)) + " FROM pairs JOIN v s ON s.id = source JOIN v t ON t.id = target) SELECT source, target, round(z0 / (z0 + z1 + z2), 6) AS not_treat, round(z1 / (z0 + z1 + z2), 6) AS treat, round(z2 / (z0 + z1 + z2), 6) AS unknown FROM z")
def mat_04_scores(spark, d):
    names = ["not_treat", "treat", "unknown"]
    out = M.score_pairs(_pairs(spark, d).select("source", "target"), _vectors(spark, d), WEIGHTS, names)
    return out.select("source", "target", *[F.round(c, 6).alias(c) for c in names])


@query(f"{P}, a AS (SELECT source, target, row_number() OVER (ORDER BY score DESC, source, target) / count(*) OVER ()::DOUBLE AS a, rank() OVER (PARTITION BY target ORDER BY score DESC) / (SELECT count(DISTINCT source) FROM pairs)::DOUBLE AS b, rank() OVER (PARTITION BY source ORDER BY score DESC) / (SELECT count(DISTINCT target) FROM pairs)::DOUBLE AS c FROM pairs) SELECT source, target, round(pow(a, -0.05) + pow(b, -0.05) + pow(c, -0.05), 6) AS transformed FROM a")
def mat_07_uniform_preset(spark, d):
    return M.transform(_pairs(spark, d), "uniform").select("source", "target", F.round("transformed", 6).alias("transformed"))


@query(f"{P} SELECT split, count(*) AS n, count(*) FILTER (WHERE split = 'TEST') AS ranked, count(*) FILTER (WHERE split = 'TRAIN') AS training FROM pairs GROUP BY split")
def mat_08_with_training_rows(spark, d):
    p = _pairs(spark, d)
    out = M.append_training(M.transform(p.filter("split = 'TEST'"), "almost_pure"), p.filter("split = 'TRAIN'"))
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("rank").alias("ranked"), F.count_if("is_training").alias("training"))


@query(f"{P}, r AS (SELECT score, row_number() OVER (ORDER BY score DESC, source, target) AS rank FROM pairs) SELECT rank, score FROM r WHERE rank IN (1, 5, 10)")
def mat_10_rank_scores(spark, d):
    return M.scores_at_ranks(R.global_rank(_pairs(spark, d)), [1, 5, 10])


@query(f"{P} SELECT 'run' AS key, 'nightly' AS value UNION ALL SELECT 'folds', CAST(count(DISTINCT fold) AS VARCHAR) FROM pairs UNION ALL SELECT 'pairs', CAST(count(*) AS VARCHAR) FROM pairs")
def mat_12_run_info(spark, d):
    n, folds = _pairs(spark, d).agg(F.count(F.lit(1)), F.count_distinct("fold")).first()
    return E.run_info(spark, {"run": "nightly", "folds": folds, "pairs": n})


@query(f"{P} SELECT CAST(floor(score * 8) AS BIGINT) + 1 AS bin, count(*) AS n FROM pairs GROUP BY 1")
def mat_13_score_histogram(spark, d):
    return E.histogram(_pairs(spark, d), "score", 0.0, 1.0, 8)


@query(f"{P}, q AS (SELECT * FROM (VALUES ('SUPP:1', NULL), (NULL, (SELECT min(target) FROM pairs)), ('SUPP:2', (SELECT max(target) FROM pairs))) t(s, t)) SELECT CASE WHEN t IS NULL THEN 'drug' WHEN s IS NULL THEN 'disease' ELSE 'pair' END AS kind, source, target FROM q JOIN (SELECT * FROM (SELECT DISTINCT source FROM pairs) CROSS JOIN (SELECT DISTINCT target FROM pairs)) ON source = coalesce(s, source) AND target = coalesce(t, target)")
def mat_15_inference_pairs(spark, d):
    p = _pairs(spark, d)
    first, last = p.agg(F.min("target"), F.max("target")).first()
    asked = spark.createDataFrame([("SUPP:1", None), (None, first), ("SUPP:2", last)], "source string, target string")
    return M.inference_pairs(asked, p.select("source").distinct(), p.select("target").distinct())


LINKS = f"WITH {A.EDGES_SQL}, sub AS (SELECT DISTINCT subject AS child, object AS parent FROM edges WHERE predicate IN ('biolink:part_of', 'biolink:located_in'))"


def _links(spark, d):
    return A.edges(spark, d).filter(F.col("predicate").isin("biolink:part_of", "biolink:located_in")).select(F.col("subject").alias("child"), F.col("object").alias("parent")).distinct()


@query(f"{LINKS}, own AS (SELECT 'NATION:' || n_nationkey AS id FROM nation) SELECT id, id AS relative FROM own UNION SELECT id, parent FROM own JOIN sub ON child = id UNION SELECT id, child FROM own JOIN sub ON parent = id")
def ker_02_relatives(spark, d):
    ids = A.nodes(spark, d).filter("id like 'NATION:%'").select("id")
    return M.with_relatives(ids, _links(spark, d))


@query(f"{P}, d AS (SELECT DISTINCT source FROM pairs WHERE y = 1), e AS (SELECT DISTINCT target FROM pairs WHERE y = 1) SELECT d.source, e.target, coalesce(p.y = 1, false) AS known, coalesce(p.score > 0.5, false) AS predicted FROM d CROSS JOIN e LEFT JOIN pairs p USING (source, target)")
def ker_03_known_pairs(spark, d):
    p = _pairs(spark, d)
    known = p.filter("y = 1").select("source", "target")
    return M.known_and_predicted(known, p.filter("score > 0.5").select("source", "target", F.lit(True).alias("predicted")))


@query(f"{P} SELECT source, count(*) FILTER (WHERE score > 0.5) AS removed FROM pairs WHERE y = 1 GROUP BY source")
def ker_05_removed(spark, d):
    p = _pairs(spark, d)
    judged = M.with_predictions(p.filter("y = 1").select("source", "target"), p.filter("score > 0.5").select("source", "target", F.lit(True).alias("predicted")))
    return judged.groupBy("source").agg(F.count_if("predicted").alias("removed"))
