"""Analytic queries over releases: sources, core-entity lists, components, key nodes, trends."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import graph
from atlasmill.operators import hierarchy as H
from atlasmill.operators import ranking as R
from atlasmill.plans.dashboard import _n, _typed
from atlasmill.plans.graph import KG, MAP_SQL, TYPED, _mapping
from atlasmill.plans.hierarchy import CONCEPT, DOWN, INSTANCE, below
from atlasmill.registry import query

STARS = f"""{KG}, star AS (SELECT subject AS id, object AS hub FROM edges WHERE predicate = 'biolink:located_in' UNION ALL SELECT id, id FROM nodes WHERE NOT (id LIKE 'SUPP:%' OR id LIKE 'CUST:%')),
sizes AS (SELECT hub, count(*) AS size, min(id) AS component FROM star GROUP BY hub),
comps AS (SELECT id, component_rank, size FROM star JOIN (SELECT hub, size, row_number() OVER (ORDER BY size DESC, component) - 1 AS component_rank FROM sizes) USING (hub))"""
LISTED = "listed AS (SELECT DISTINCT 'CUST:' || (o_custkey * 2) AS id FROM orders)"
PAIR_RANK = f"WITH {A.PAIRS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, source, target) AS rank FROM pairs)"


def _listed(spark, d):
    return A.read(spark, d, "orders").select(F.concat(F.lit("CUST:"), (F.col("o_custkey") * 2).cast("string")).alias("id")).distinct()


def _located(spark, d):
    return A.edges(spark, d).filter("predicate = 'biolink:located_in'")


def _components(spark, d):
    return graph.components(A.nodes(spark, d), _located(spark, d)).select("id", "component_rank", "size")


def _success(spark, d):
    """Nodes of the drug list with their prefix, kg and whether the normaliser knew them."""
    m = _mapping(spark, d).select("id", F.col("normalization_struct.normalized_id").isNotNull().alias("success"))
    return A.nodes(spark, d).join(m, "id").select("id", "category", "success", F.get("upstream_data_source", F.lit(0)).alias("kg"), F.split_part("id", F.lit(":"), F.lit(1)).alias("prefix"))


SUCCESS = f"{KG}, {MAP_SQL}, s AS (SELECT n.id, category, normalized_id IS NOT NULL AS success, upstream_data_source[1] AS kg, split_part(n.id, ':', 1) AS prefix FROM nodes n JOIN mapping m ON m.id = n.id)"


@query(f"{KG}, a AS (SELECT kg, count(*) AS n_nodes FROM (SELECT unnest(upstream_data_source) AS kg FROM nodes) GROUP BY kg), b AS (SELECT upstream AS kg, count(*) AS n_edges, count(knowledge_level) AS with_level, count(DISTINCT predicate) AS predicates FROM edges GROUP BY 1) SELECT upper(kg[1]) || kg[2:] AS kg, n_nodes, n_edges, predicates, round(with_level / n_edges::DOUBLE, 6) AS level_rate FROM a LEFT JOIN b USING (kg)")
def dsh_02_kg_summary(spark, d):
    n = A.nodes(spark, d).select(F.explode("upstream_data_source").alias("kg")).groupBy("kg").agg(F.count(F.lit(1)).alias("n_nodes"))
    e = A.edges(spark, d).groupBy(F.col("upstream").alias("kg")).agg(F.count(F.lit(1)).alias("n_edges"), F.count("knowledge_level").alias("with_level"), F.count_distinct("predicate").alias("predicates"))
    return n.join(e, "kg", "left").select(F.initcap("kg").alias("kg"), "n_nodes", "n_edges", "predicates", F.round(F.try_divide(F.col("with_level").cast("double"), F.col("n_edges")), 6).alias("level_rate"))


@query(f"{KG} SELECT DISTINCT upstream AS kg, CASE upstream WHEN 'kg0' THEN 'reference' ELSE 'contributed' END AS kind FROM edges")
def dsh_03_kg_list(spark, d):
    return A.edges(spark, d).select(F.col("upstream").alias("kg")).distinct().withColumn("kind", F.when(F.col("kg") == "kg0", "reference").otherwise("contributed"))


@query(f"{TYPED} SELECT upstream AS kg, predicate, subject_category, object_category, count(*) AS n FROM typed GROUP BY ALL")
def dsh_04_kg_predicates(spark, d):
    return _typed(spark, d).groupBy(F.col("upstream").alias("kg"), "predicate", "subject_category", "object_category").agg(_n())


@query(f"{KG} SELECT upstream_data_source[1] AS kg, category, count(*) AS n FROM nodes GROUP BY ALL")
def dsh_04_kg_categories(spark, d):
    return A.nodes(spark, d).groupBy(F.get("upstream_data_source", F.lit(0)).alias("kg"), "category").agg(_n())


@query(f"{TYPED}, {LISTED} SELECT l.id, CASE WHEN subject = l.id THEN 'out' ELSE 'in' END AS direction, predicate, CASE WHEN subject = l.id THEN object_category ELSE subject_category END AS other, count(*) AS n FROM typed JOIN listed l ON subject = l.id OR object = l.id GROUP BY ALL")
def dsh_06_list_edges(spark, d):
    typed, ids = _typed(spark, d), _listed(spark, d)
    out = typed.join(ids, typed["subject"] == ids["id"]).select("id", F.lit("out").alias("direction"), "predicate", F.col("object_category").alias("other"))
    into = typed.filter("subject <> object").join(ids, F.col("object") == ids["id"]).select("id", F.lit("in").alias("direction"), "predicate", F.col("subject_category").alias("other"))
    return out.unionByName(into).groupBy("id", "direction", "predicate", "other").agg(_n())


@query(f"{KG}, {LISTED} SELECT CASE WHEN n.id IS NULL THEN 'missing' ELSE 'included' END AS name, count(*) AS value FROM listed LEFT JOIN nodes n USING (id) GROUP BY 1")
def dsh_10_inclusion(spark, d):
    have = A.nodes(spark, d).select("id", F.lit("included").alias("name"))
    return _listed(spark, d).join(have, "id", "left").groupBy(F.coalesce("name", F.lit("missing")).alias("name")).agg(F.count(F.lit(1)).alias("value"))


@query(f"{SUCCESS} SELECT prefix, count(*) FILTER (WHERE success) AS normalized, round(count(*) FILTER (WHERE success) / count(*)::DOUBLE, 6) AS rate FROM s GROUP BY prefix")
def dsh_11_rates(spark, d):
    ok = F.count_if("success")
    return _success(spark, d).groupBy("prefix").agg(ok.alias("normalized"), F.round(ok / F.count(F.lit(1)), 6).alias("rate"))


@query(f"{SUCCESS} SELECT kg, prefix, category, success, count(*) AS n, count(DISTINCT id) AS ids FROM s GROUP BY ALL UNION ALL SELECT 'merged', prefix, category, success, count(*), count(DISTINCT id) FROM s GROUP BY ALL")
def dsh_12_normalization_cube(spark, d):
    s = _success(spark, d)
    sides = s.withColumn("kg", F.explode(F.array("kg", F.lit("merged"))))
    return sides.groupBy("kg", "prefix", "category", "success").agg(_n(), F.count_distinct("id").alias("ids"))


@query(f"{SUCCESS}, {LISTED} (SELECT 'unnormalized' AS reason, id FROM s WHERE NOT success ORDER BY id LIMIT 5) UNION ALL (SELECT 'missing', id FROM listed WHERE id NOT IN (SELECT id FROM nodes) ORDER BY id LIMIT 5)")
def dsh_13_errors(spark, d):
    failed = _success(spark, d).filter("not success").select("id").orderBy("id").limit(5).withColumn("reason", F.lit("unnormalized"))
    absent = _listed(spark, d).join(A.nodes(spark, d), "id", "left_anti").orderBy("id").limit(5).withColumn("reason", F.lit("missing"))
    return failed.unionByName(absent)


@query(f"{SUCCESS} SELECT kg, prefix, id FROM (SELECT *, row_number() OVER (PARTITION BY kg, prefix ORDER BY id) AS r FROM s WHERE NOT success) WHERE r <= 3")
def dsh_14_failed_examples(spark, d):
    # sorted and cut by partial windows first (WindowGroupLimit), so that a large group is not moved whole
    r = F.row_number().over(W.partitionBy("kg", "prefix").orderBy("id"))
    return _success(spark, d).filter("not success").withColumn("r", r).filter("r <= 3").select("kg", "prefix", "id")


#: the reference's production values: services/kg_dashboard/Makefile and component_nodes.sql
MAX_ERRORS, MAX_EXAMPLES, MAX_MINOR = 1000, 100, 50


@query(f"{SUCCESS}, {LISTED} (SELECT 'unnormalized' AS reason, id FROM s WHERE NOT success ORDER BY id LIMIT {MAX_ERRORS}) UNION ALL (SELECT 'missing', id FROM listed WHERE id NOT IN (SELECT id FROM nodes) ORDER BY id LIMIT {MAX_ERRORS})")
def dsh_13_errors_full(spark, d):
    failed = _success(spark, d).filter("not success").select("id").orderBy("id").limit(MAX_ERRORS).withColumn("reason", F.lit("unnormalized"))
    absent = _listed(spark, d).join(A.nodes(spark, d), "id", "left_anti").orderBy("id").limit(MAX_ERRORS).withColumn("reason", F.lit("missing"))
    return failed.unionByName(absent)


@query(f"{SUCCESS} SELECT kg, prefix, id FROM (SELECT *, row_number() OVER (PARTITION BY kg, prefix ORDER BY id) AS r FROM s WHERE NOT success) WHERE r <= {MAX_EXAMPLES}")
def dsh_14_failed_examples_full(spark, d):
    r = F.row_number().over(W.partitionBy("kg", "prefix").orderBy("id"))
    return _success(spark, d).filter("not success").withColumn("r", r).filter(F.col("r") <= MAX_EXAMPLES).select("kg", "prefix", "id")


@query(f"{KG} SELECT primary_knowledge_source AS source, upstream AS target, count(*) AS value FROM edges GROUP BY ALL")
def dsh_16_source_flows(spark, d):
    return A.edges(spark, d).groupBy(F.col("primary_knowledge_source").alias("source"), F.col("upstream").alias("target")).agg(F.count(F.lit(1)).alias("value"))


BUCKET = "CASE WHEN size = 1 THEN '1' WHEN size < 10 THEN '2-9' WHEN size < 100 THEN '10-99' ELSE '100+' END"


@query(f"{STARS} SELECT {BUCKET} AS bucket, count(DISTINCT component_rank) AS components, count(*) AS nodes FROM comps GROUP BY 1")
def dsh_18_component_buckets(spark, d):
    sizes = _components(spark, d).groupBy("component_rank").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy(F.expr(BUCKET).alias("bucket")).agg(F.count(F.lit(1)).alias("components"), F.sum("size").alias("nodes"))


@query(f"{STARS} SELECT CASE WHEN list_contains(all_categories, 'biolink:ChemicalEntity') THEN 'drugs' WHEN list_contains(all_categories, 'biolink:BiologicalEntity') THEN 'biology' ELSE 'rest' END AS kind, count(*) AS n FROM nodes JOIN comps USING (id) WHERE component_rank = 0 GROUP BY 1")
def dsh_19_largest_composition(spark, d):
    has = lambda c: F.array_contains("all_categories", c)
    kind = F.when(has("biolink:ChemicalEntity"), "drugs").when(has("biolink:BiologicalEntity"), "biology").otherwise("rest")
    first = _components(spark, d).filter("component_rank = 0").select("id")
    return A.nodes(spark, d).join(first, "id").groupBy(kind.alias("kind")).agg(_n())


@query(f"{STARS}, {LISTED}, chosen AS (SELECT DISTINCT component_rank FROM comps WHERE component_rank < 3 UNION SELECT component_rank FROM comps JOIN listed USING (id)) SELECT component_rank, count(*) AS n FROM comps WHERE component_rank IN (SELECT component_rank FROM chosen) GROUP BY 1")
def dsh_20_shown_components(spark, d):
    c = _components(spark, d)
    chosen = c.filter("component_rank < 3").select("component_rank").union(c.join(_listed(spark, d), "id", "left_semi").select("component_rank")).distinct()
    return c.join(chosen, "component_rank", "left_semi").groupBy("component_rank").agg(_n())


@query(f"{STARS}, {LISTED}, chosen AS (SELECT DISTINCT component_rank FROM comps WHERE component_rank BETWEEN 1 AND {MAX_MINOR} UNION SELECT component_rank FROM comps JOIN listed USING (id) WHERE component_rank > 0) SELECT component_rank, count(*) AS n FROM comps WHERE component_rank IN (SELECT component_rank FROM chosen) GROUP BY 1")
def dsh_20_shown_components_full(spark, d):
    return shown_components(_components(spark, d), _listed(spark, d), MAX_MINOR)


def shown_components(components, core, minor):
    """(component_rank, n) of the ``minor`` largest components besides the largest, and of all others besides it with a core entity."""
    c = components.filter("component_rank > 0")
    chosen = c.filter(F.col("component_rank") <= minor).select("component_rank").union(c.join(core, "id", "left_semi").select("component_rank")).distinct()
    return c.join(chosen, "component_rank", "left_semi").groupBy("component_rank").agg(_n())


@query(f"{STARS} SELECT component_rank, string_agg(DISTINCT upstream, ',' ORDER BY upstream) AS sources, count(*) AS n FROM edges JOIN comps ON subject = id WHERE predicate = 'biolink:located_in' AND component_rank > 0 GROUP BY 1")
def dsh_21_minor_sources(spark, d):
    minor = _components(spark, d).filter("component_rank > 0").select(F.col("id").alias("subject"), "component_rank")
    return _located(spark, d).join(minor, "subject").groupBy("component_rank").agg(F.array_join(F.array_sort(F.collect_set("upstream")), ",").alias("sources"), _n())


@query(f"{KG} SELECT category, len(upstream_data_source) AS sources, count(*) AS n FROM nodes GROUP BY ALL")
def dsh_22_node_metrics(spark, d):
    return A.nodes(spark, d).groupBy("category", F.size("upstream_data_source").cast("long").alias("sources")).agg(_n())


@query(f"{KG}, k AS (SELECT unnest(string_split('REGION:1|NATION:3|SUPP:2', '|')) AS id) SELECT k.id, n.name, count(DISTINCT CASE WHEN subject = k.id THEN object ELSE subject END) AS neighbours FROM k JOIN nodes n USING (id) JOIN edges ON subject = k.id OR object = k.id GROUP BY ALL")
def dsh_23_key_nodes(spark, d):
    k = spark.createDataFrame([("REGION:1|NATION:3|SUPP:2",)], "ids string").select(F.explode(F.split("ids", "\\|")).alias("id"))
    e = A.edges(spark, d)
    ends = e.select(F.col("subject").alias("id"), F.col("object").alias("nb")).unionByName(e.select(F.col("object").alias("id"), F.col("subject").alias("nb")))
    return ends.join(F.broadcast(k), "id").groupBy("id").agg(F.count_distinct("nb").alias("neighbours")).join(A.nodes(spark, d).select("id", "name"), "id")


@query(f"{DOWN} SELECT root, other, count(DISTINCT nb) AS n FROM (SELECT root, object AS nb FROM below JOIN edges ON subject = id UNION ALL SELECT root, subject FROM below JOIN edges ON object = id) JOIN (SELECT id AS nb, category AS other FROM nodes) USING (nb) GROUP BY ALL")
def dsh_25_key_node_categories(spark, d):
    e, b = A.edges(spark, d), below(spark, d).select("root", "id")
    nb = e.select(F.col("subject").alias("id"), F.col("object").alias("nb")).unionByName(e.select(F.col("object").alias("id"), F.col("subject").alias("nb"))).join(b, "id").select("root", "nb").distinct()
    return nb.join(A.nodes(spark, d).select(F.col("id").alias("nb"), F.col("category").alias("other")), "nb").groupBy("root", "other").agg(_n())


@query(f"{DOWN} SELECT root, upstream, primary_knowledge_source, count(*) AS n FROM below JOIN edges ON subject = id GROUP BY ALL")
def dsh_26_key_node_sources(spark, d):
    b = below(spark, d).select("root", F.col("id").alias("subject"))
    return A.edges(spark, d).join(b, "subject").groupBy("root", "upstream", "primary_knowledge_source").agg(_n())


@query(f"{TYPED} SELECT 'nodes' AS stage, count(*) AS n FROM nodes UNION ALL SELECT 'edges', count(*) FROM edges UNION ALL SELECT 'typed', count(*) FROM typed")
def dsh_28_stage_counts(spark, d):
    stages = {"nodes": A.nodes(spark, d), "edges": A.edges(spark, d), "typed": _typed(spark, d)}
    return graph.union_all([f.agg(_n()).withColumn("stage", F.lit(name)) for name, f in stages.items()])


@query(f"{PAIR_RANK} SELECT target, round(avg(score), 9) AS mean_score, max(score) AS max_score, count(*) FILTER (WHERE rank <= 10) AS top_10, count(*) FILTER (WHERE rank <= 100) AS top_100 FROM r GROUP BY target")
def dsh_29_disease_scores(spark, d):
    return R.frequent_table(R.global_rank(A.pairs(spark, d)), "target", [10, 100]).withColumn("mean_score", F.round("mean_score", 9))


@query(f"{KG}, t AS (SELECT predicate AS source, count(*) AS n FROM edges GROUP BY 1) SELECT CASE WHEN n * 20 < (SELECT max(n) FROM t) THEN 'Other' ELSE source END AS source, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1")
def dsh_31_folded_network(spark, d):
    t = A.edges(spark, d).groupBy("predicate").agg(_n())
    most = t.agg(F.max("n").alias("most"))
    return t.crossJoin(F.broadcast(most)).groupBy(F.when(F.col("n") * 20 < F.col("most"), "Other").otherwise(F.col("predicate")).alias("source")).agg(F.sum("n").alias("n"))


@query(f"{TYPED}, allowed AS (SELECT 'biolink:Drug' AS s, 'biolink:treats' AS p, 'biolink:Disease' AS o) SELECT CASE WHEN p IS NULL THEN 'unrecognised' ELSE 'recognised' END AS kind, count(*) AS n, count(DISTINCT subject_category || predicate || object_category) AS types FROM typed LEFT JOIN allowed ON s = subject_category AND p = predicate AND o = object_category GROUP BY 1")
def dsh_33_recognised(spark, d):
    allowed = spark.createDataFrame([("biolink:Drug", "biolink:treats", "biolink:Disease", "recognised")], "subject_category string, predicate string, object_category string, kind string")
    key = ["subject_category", "predicate", "object_category"]
    types = _typed(spark, d).groupBy(*key).agg(_n()).join(F.broadcast(allowed), key, "left")
    return types.groupBy(F.coalesce("kind", F.lit("unrecognised")).alias("kind")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))


@query(f"{KG} SELECT primary_knowledge_source, round(100.0::DOUBLE * count(*) FILTER (WHERE predicate IN ('biolink:affects', 'biolink:treats')) / count(*), 4) AS instance_pct, round(100.0::DOUBLE * count(*) FILTER (WHERE predicate = 'biolink:part_of') / count(*), 4) AS concept_pct FROM edges GROUP BY 1")
def dsh_34_level_shares(spark, d):
    c = H.level_counts(A.edges(spark, d), "primary_knowledge_source", INSTANCE, CONCEPT)
    return c.select("primary_knowledge_source", *[F.round(100.0 * F.col(x) / F.col("total"), 4).alias(f"{x}_pct") for x in ("instance", "concept")])


@query(f"{KG}, s AS (SELECT upstream, CASE knowledge_level WHEN 'knowledge_assertion' THEN 1.0 WHEN 'prediction' THEN -0.5 ELSE 0.0 END::DOUBLE AS v, count(*) AS n FROM edges GROUP BY ALL) SELECT upstream, round(sum(v * n) / sum(n), 6) AS score FROM s GROUP BY 1")
def dsh_35_weighted_scores(spark, d):
    v = F.when(F.col("knowledge_level") == "knowledge_assertion", 1.0).when(F.col("knowledge_level") == "prediction", -0.5).otherwise(0.0)
    s = A.edges(spark, d).groupBy("upstream", v.alias("v")).agg(_n())
    return s.groupBy("upstream").agg(F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 6).alias("score"))


@query(f"{STARS}, c AS (SELECT component_rank, split_part(id, ':', 1) AS prefix, count(*) AS n FROM comps GROUP BY ALL) SELECT component_rank, string_agg(prefix, ',' ORDER BY n DESC, prefix) AS prefixes FROM c GROUP BY 1")
def dsh_37_component_prefixes(spark, d):
    c = _components(spark, d).groupBy("component_rank", F.split_part("id", F.lit(":"), F.lit(1)).alias("prefix")).agg(_n())
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "prefix")))
    return c.groupBy("component_rank").agg(F.array_join(F.transform(ordered, lambda x: x["prefix"]), ",").alias("prefixes"))


@query(f"{STARS} SELECT max(size) AS largest, round(max(size) / count(*)::DOUBLE, 6) AS share, count(DISTINCT component_rank) AS components, count(*) FILTER (WHERE size = 1) AS isolated FROM comps")
def dsh_39_headline(spark, d):
    c = _components(spark, d).groupBy("component_rank").agg(F.count(F.lit(1)).alias("size"))
    return c.agg(F.max("size").alias("largest"), F.round(F.max("size") / F.sum("size"), 6).alias("share"), F.count(F.lit(1)).alias("components"), F.count_if(F.col("size") == 1).alias("isolated"))
