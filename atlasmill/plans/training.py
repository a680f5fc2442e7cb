"""Queries on training data for pair models and on node metrics of the connectivity report."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import hierarchy as H
from atlasmill.operators import training as M
from atlasmill.plans.curation import _u
from atlasmill.plans.graph import COMPONENTS, KG, _located
from atlasmill.plans.ranking import P, drawn_sql
from atlasmill.registry import query

DRUG, DISEASE = ["biolink:Drug"], ["biolink:Disease"]
GT = f"{P}, gt AS (SELECT source, target, y, 'kg' || (fold % 2) AS upstream_data_source FROM pairs WHERE y IS NOT NULL)"
#: A part of the nodes, so that some pairs lose an end; and vectors for some of them.
SOME = "kept AS (SELECT 'SUPP:' || s_suppkey AS id, s_suppkey % 5 <> 0 AS fits FROM supplier WHERE s_suppkey % 7 <> 0 UNION ALL SELECT 'PART:' || p_partkey, TRUE FROM part WHERE p_partkey % 3 <> 0)"
VECTORS = "vectors AS (SELECT 'SUPP:' || vec_id AS id, embedding AS e FROM embeddings UNION ALL SELECT 'PART:' || vec_id, embedding FROM embeddings)"


def _truth(spark, d):
    return A.pairs(spark, d).filter("y is not null").select("source", "target", "y", F.concat(F.lit("kg"), (F.col("fold") % 2).cast("string")).alias("upstream_data_source"))


def _some(spark, d):
    supplier = A.read(spark, d, "supplier").filter("s_suppkey % 7 <> 0").select(F.concat(F.lit("SUPP:"), F.col("s_suppkey").cast("string")).alias("id"), F.when(F.col("s_suppkey") % 5 != 0, F.array(F.lit("biolink:Drug"))).otherwise(F.array(F.lit("biolink:Gene"))).alias("all_categories"))
    part = A.read(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("id"), F.array(F.lit("biolink:Disease")).alias("all_categories"))
    return supplier.union(part)


def _vectors(spark, d):
    e = A.read(spark, d, "embeddings")
    key = lambda prefix: e.select(F.concat(F.lit(prefix), F.col("vec_id").cast("string")).alias("id"), F.col("embedding").alias("topological_embedding"))
    return key("SUPP:").union(key("PART:"))


@query(f"{GT} SELECT source, target, y FROM gt WHERE upstream_data_source = 'kg0' GROUP BY ALL")
def mdl_01_from_sources(spark, d):
    truth = _truth(spark, d)
    return M.from_sources(truth.union(truth), ["kg0"]).select("source", "target", "y")


@query(f"""{GT}, {SOME}, j AS (SELECT gt.*, s.fits AS a, t.fits AS b FROM gt LEFT JOIN kept s ON s.id = source LEFT JOIN kept t ON t.id = target)
SELECT * FROM (VALUES (1, 'positive'), (0, 'negative')) v(y, label) JOIN LATERAL (SELECT round(count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) / count(*), 6) AS in_kg, round(count(*) FILTER (WHERE a AND b) / count(*), 6) AS final FROM j WHERE j.y = v.y) ON TRUE""")
def mdl_02_retention(spark, d):
    row = M.valid_pairs(_some(spark, d), _truth(spark, d), DRUG + DISEASE)[1]
    one = lambda y, name: row.select(F.lit(y).alias("y"), F.lit(name).alias("label"), *[F.round(f"{name}_pairs_retained_{s}_pct", 6).alias(s) for s in ("in_kg", "final")])
    return one(1, "positive").union(one(0, "negative"))


@query(f"{GT}, {SOME} SELECT source, target FROM gt WHERE source IN (SELECT id FROM kept) AND target IN (SELECT id FROM kept)")
def mdl_03_existing_pairs(spark, d):
    return M.existing_pairs(_truth(spark, d), _some(spark, d)).select("source", "target")


@query(f"{GT}, {VECTORS} SELECT source, target, s.e[1] AS s1, t.e[64] AS t64 FROM gt LEFT JOIN vectors s ON s.id = source LEFT JOIN vectors t ON t.id = target")
def mdl_04_attached_vectors(spark, d):
    return M.attach_embeddings(_truth(spark, d), _vectors(spark, d)).select("source", "target", F.get("source_embedding", F.lit(0)).alias("s1"), F.get("target_embedding", F.lit(63)).alias("t64"))


@query(f"{GT}, {SOME}, known AS (SELECT source AS id FROM gt UNION SELECT target FROM gt WHERE y = 1) SELECT id, starts_with(id, 'SUPP') AS is_drug, starts_with(id, 'PART') AS is_disease, id IN (SELECT id FROM known) AS in_ground_pos FROM kept WHERE fits")
def mdl_05_sampling_nodes(spark, d):
    return M.sampling_nodes(_some(spark, d), _truth(spark, d), DRUG, DISEASE).select("id", "is_drug", "is_disease", "in_ground_pos")


AREAS = "g AS (SELECT 'PART:' || p_partkey AS id, lower(p_type) AS areas FROM part WHERE p_partkey % 4 <> 0)"


@query(f"{GT}, {AREAS}, f AS (SELECT * FROM (VALUES (0, 'steel'), (1, 'brass')) v(fold, area)) SELECT source, target, fold, CASE WHEN contains(areas, area) THEN 'TEST' ELSE 'TRAIN' END AS split FROM gt JOIN g ON id = target CROSS JOIN f UNION ALL SELECT source, target, 2, 'TRAIN' FROM gt")
def mdl_08_area_split(spark, d):
    listed = A.read(spark, d, "part").filter("p_partkey % 4 <> 0").select(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("id"), "p_type")
    truth = _truth(spark, d).select("source", "target")
    return M.with_full_fold(M.area_split(truth, listed, "p_type", ["Steel", "BRASS"]), truth, 2)


@query(f"{GT}, h AS (SELECT fold, source, row_number() OVER (PARTITION BY fold ORDER BY md5('6|' || fold || '|' || source), source) AS r, count(*) OVER (PARTITION BY fold) AS n FROM (SELECT DISTINCT source FROM gt) CROSS JOIN (VALUES (0), (1)) v(fold)) SELECT h.fold, source, target, CASE WHEN r <= greatest(1, round_even(n * 0.3, 0)) THEN 'TEST' ELSE 'TRAIN' END AS split FROM gt JOIN h USING (source)")
def mdl_09_drug_holdout(spark, d):
    return M.drug_holdout(_truth(spark, d).select("source", "target"), 2, 0.3, 6)


def _drawn(end: str, stays: str, names: str) -> str:
    first = _u(f"concat('8|{end}|', k.source, '|', k.target, '|', copy)")
    pair = "l.name AS source, t.target" if end == "source" else "t.source, l.name AS target"
    return f"""SELECT '{end}' AS replaced, copy, draw, t.source AS s, t.target AS t, {pair} FROM (SELECT *, (CAST(floor(u * n) AS BIGINT) + draw) % n AS at FROM (SELECT k.source, k.target, copy, n, {first} AS u, unnest(range(0, least(n, has + 1))) AS draw
FROM (SELECT source, target FROM gt WHERE y = 1) k CROSS JOIN range(1, 3) c(copy) JOIN (SELECT {stays}, count(*) AS has FROM gt GROUP BY {stays}) h USING ({stays}) CROSS JOIN (SELECT count(*) AS n FROM {names}))) t JOIN {names} l ON l.at = t.at"""


@query(f"""{GT}, ls AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS at FROM (SELECT DISTINCT source AS name FROM pairs)), lt AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS at FROM (SELECT DISTINCT target AS name FROM pairs)),
drawn AS ({_drawn('source', 'target', 'ls')} UNION ALL {_drawn('target', 'source', 'lt')}), ok AS (SELECT *, row_number() OVER (PARTITION BY replaced, copy, s, t ORDER BY draw) AS r FROM drawn WHERE NOT EXISTS (SELECT 1 FROM gt WHERE gt.source = drawn.source AND gt.target = drawn.target))
SELECT replaced, copy, source, target FROM ok WHERE r = 1""")
def mdl_10_replacement_sample(spark, d):
    p = A.pairs(spark, d)
    return M.replacement_sample(_truth(spark, d), p.select("source").distinct(), p.select("target").distinct(), 2, 8)


@query(f"""{GT}, listed AS (SELECT fold, CASE WHEN contains(lower(p_type), area) THEN 'TEST' ELSE 'TRAIN' END AS split, 'PART:' || p_partkey AS target FROM part CROSS JOIN (VALUES (0, 'steel'), (1, 'brass')) v(fold, area)),
pos AS (SELECT DISTINCT fold, split, source, target FROM gt JOIN listed USING (target) WHERE y = 1), {drawn_sql("CAST(9 + fold AS VARCHAR)", 1, "fold, split")}
SELECT fold, split, source, target FROM f WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM gt WHERE gt.source = f.source AND gt.target = f.target)""")
def mdl_10_area_sample(spark, d):
    listed = A.read(spark, d, "part").select(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("id"), "p_type")
    truth, areas = _truth(spark, d), ["Steel", "BRASS"]
    folds = M.area_split(truth.select("source", "target"), listed, "p_type", areas)
    diseases = M.area_split(listed.select(F.col("id").alias("target")), listed, "p_type", areas)
    return M.area_sample(truth, folds, A.pairs(spark, d).select("source"), diseases, 1, 9)


@query(f"""{GT}, pos AS (SELECT DISTINCT fold, source, target FROM pairs WHERE y = 1), listed AS (SELECT fold, target FROM range(3) f(fold) CROSS JOIN (SELECT DISTINCT target FROM pairs)), {drawn_sql("CAST(5 + fold AS VARCHAR)", 2, "fold")}
SELECT source, target, y, split, fold FROM pairs WHERE y IS NOT NULL UNION ALL SELECT source, target, 2, 'TRAIN', fold FROM f WHERE r <= 2""")
def mdl_11_enriched_folds(spark, d):
    p = A.pairs(spark, d)
    return M.enrich_folds(p.filter("y is not null"), 3, p.select("source").distinct(), p.select("target").distinct(), 2, 5)


@query("SELECT vec_id, embedding[1] AS f0, embedding[2] AS f1, embedding[3] AS f2 FROM embeddings")
def mdl_12_flat_vectors(spark, d):
    return M.flat(A.read(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", 3, "f")


@query(f"{P} SELECT source, target, round((score - (SELECT avg(score) FROM pairs WHERE split = 'TRAIN')) / (SELECT stddev_pop(score) FROM pairs WHERE split = 'TRAIN'), 6) AS score FROM pairs WHERE split = 'TEST'")
def mdl_13_scaled(spark, d):
    p = A.pairs(spark, d)
    return M.scale(p.filter("split = 'TEST'"), M.fit_scaler(p.filter("split = 'TRAIN'"), ["score"])).select("source", "target", F.round("score", 6).alias("score"))


@query(f"{P} SELECT 'above_' || k AS candidate, round(avg(CASE WHEN (score >= k / 10.0) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs CROSS JOIN range(1, 10) t(k) WHERE y IS NOT NULL AND split = 'TRAIN' GROUP BY k")
def mdl_14_search(spark, d):
    found = M.search(A.pairs(spark, d).filter("split = 'TRAIN'"), {f"above_{k}": (F.col("score") >= k / 10).cast("int") for k in range(1, 10)})
    return found.withColumn("accuracy", F.round("accuracy", 6))


def _features(spark, d):
    item = A.read(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", (F.col("l_quantity") * (1 - F.col("l_discount")) > 24).cast("int").alias("y"), F.when(F.col("l_orderkey") % 5 == 0, "TEST").otherwise("TRAIN").alias("split"))
    return item, ["l_quantity", "l_discount", "l_tax"]


@query()
def mdl_15_ensemble(spark, d):
    """Forest and boosted trees have no SQL form; a test compares accuracy on held-out orders."""
    item, columns = _features(spark, d)
    models = M.train_ensemble(item.filter("split = 'TRAIN'"), columns, 1)
    return M.split_metrics(M.mean_probability(item, models, columns)).select("split", "accuracy", "macro_f1")


@query(f"""{P}, c AS (SELECT split, y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM pairs WHERE y IS NOT NULL), f AS (SELECT split, l, 2 * count(*) FILTER (WHERE y = l AND p = l) / (count(*) FILTER (WHERE y = l) + count(*) FILTER (WHERE p = l)) AS f1 FROM c CROSS JOIN (VALUES (0), (1)) v(l) GROUP BY ALL)
SELECT split, round((SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0 END) FROM c WHERE c.split = f.split), 6) AS accuracy, round(avg(f1), 6) AS macro_f1 FROM f GROUP BY split""")
def mdl_16_split_metrics(spark, d):
    p = A.pairs(spark, d).filter("y is not null").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return M.split_metrics(p).select("split", F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


# --- node metrics of the connectivity report ---


@query(f"{COMPONENTS} SELECT component, size, component_rank FROM r")
def con_03_size_ranked(spark, d):
    return _located(spark, d)[1].select("component", "size", "component_rank").distinct()


CORE = "core AS (SELECT DISTINCT 'SUPP:' || s_suppkey AS id, 'drug' AS ec_core_category FROM supplier WHERE s_suppkey % 2 = 0)"


def _core(spark, d):
    mapping = A.nodes(spark, d).filter("category = 'biolink:Drug' and cast(split(id, ':')[1] as long) % 2 = 0").select(F.col("id").alias("normalized_id"), "category")
    return H.core_categories(_located(spark, d)[1].select("id", "component"), mapping)


@query(f"{COMPONENTS}, {CORE} SELECT n.id, component, ec_core_category FROM n JOIN r USING (k) LEFT JOIN core ON core.id = n.id")
def con_04_core_categories(spark, d):
    return _core(spark, d)


@query(f"{COMPONENTS}, {CORE} SELECT n.id, component, ec_core_category, n.id IN (SELECT 'NATION:' || CAST(n_nationkey AS BIGINT) FROM nation) AS is_ontology_connected FROM n JOIN r USING (k) LEFT JOIN core ON core.id = n.id")
def con_07_node_metrics(spark, d):
    part_of = A.edges(spark, d).filter("predicate = 'biolink:part_of'")
    nodes, _ = _located(spark, d)
    return H.node_metrics(_core(spark, d), H.touches(nodes.select("id"), part_of, "is_ontology_connected"))
