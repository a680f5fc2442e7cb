"""Queries on hierarchies, core entities and statement levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import graph
from atlasmill.operators import hierarchy as H
from atlasmill.operators import pairs as M
from atlasmill.plans.graph import KG, MAP_SQL, TYPED, _mapping
from atlasmill.registry import query

INSTANCE, CONCEPT = ["biolink:affects", "biolink:treats"], ["biolink:part_of"]
LEVEL = "CASE WHEN predicate IN ('biolink:affects', 'biolink:treats') THEN 'instance' WHEN predicate = 'biolink:part_of' THEN 'concept' ELSE 'other' END"
DOWN = f"""{KG}, links AS (SELECT DISTINCT subject AS child, object AS parent FROM edges WHERE predicate IN ('biolink:part_of', 'biolink:located_in')),
roots AS (SELECT id FROM nodes WHERE category = 'biolink:NamedThing'),
below AS (SELECT id AS root, id, 0 AS depth FROM roots UNION ALL SELECT parent, child, 1 FROM links JOIN roots ON id = parent UNION ALL SELECT b.parent, a.child, 2 FROM links a JOIN links b ON a.parent = b.child JOIN roots ON id = b.parent)"""
CORE = "core AS (SELECT 'CUST:' || o_custkey AS id, 'EC:' || (o_custkey % 50) AS core_id FROM orders)"


def links(spark, d):
    return A.edges(spark, d).filter(F.col("predicate").isin("biolink:part_of", "biolink:located_in")).select(F.col("subject").alias("child"), F.col("object").alias("parent")).distinct()


def roots(spark, d):
    return A.nodes(spark, d).filter("category = 'biolink:NamedThing'").select("id")


def below(spark, d):
    return H.descendants(links(spark, d), roots(spark, d))


def _core(spark, d):
    k = F.col("o_custkey")
    return A.read(spark, d, "orders").select(F.concat(F.lit("CUST:"), k.cast("string")).alias("id"), F.concat(F.lit("EC:"), (k % 50).cast("string")).alias("core_id"))


@query(f"{KG} SELECT primary_knowledge_source, count(*) FILTER (WHERE {LEVEL} = 'instance') AS instance, count(*) FILTER (WHERE {LEVEL} = 'concept') AS concept, count(*) AS total FROM edges GROUP BY ALL")
def hie_05_level_counts(spark, d):
    return H.level_counts(A.edges(spark, d), "primary_knowledge_source", INSTANCE, CONCEPT)


@query(f"{KG} SELECT category, concept_level, count(*) AS n FROM (SELECT category, id IN (SELECT subject FROM edges WHERE {LEVEL} = 'concept' UNION SELECT object FROM edges WHERE {LEVEL} = 'concept') AS concept_level FROM nodes) GROUP BY ALL")
def hie_06_concept_nodes(spark, d):
    concept = H.statement_levels(A.edges(spark, d), INSTANCE, CONCEPT).filter("level = 'concept'")
    return H.touches(A.nodes(spark, d), concept, "concept_level").groupBy("category", "concept_level").agg(F.count(F.lit(1)).alias("n"))


@query(f"{DOWN}, own AS (SELECT id FROM roots) SELECT id, id AS relative FROM own UNION SELECT id, child FROM own JOIN links ON parent = id")
def hie_07_one_hop(spark, d):
    return M.with_relatives(roots(spark, d), links(spark, d))


@query(f"{DOWN} SELECT root, id, depth FROM below")
def hie_09_key_descendants(spark, d):
    return below(spark, d)


@query(f"{DOWN}, groups AS (SELECT id, id AS grouping FROM nodes WHERE category = 'biolink:GeographicLocation' AND id < 'NATION:2') SELECT n.id, coalesce(a.grouping, b.grouping, 'other') AS grouping FROM nodes n LEFT JOIN groups a ON a.id = n.id LEFT JOIN links l ON l.child = n.id LEFT JOIN groups b ON b.id = l.parent")
def hie_11_fill_down(spark, d):
    groups = A.nodes(spark, d).filter("category = 'biolink:GeographicLocation' and id < 'NATION:2'").select("id", F.col("id").alias("grouping"))
    return H.fill_down(A.nodes(spark, d), links(spark, d), groups)


@query(f"{DOWN} SELECT id, count(*) AS n FROM (SELECT parent AS id, child AS c FROM links UNION SELECT b.parent, a.child FROM links a JOIN links b ON a.parent = b.child) GROUP BY id")
def hie_12_descendant_counts(spark, d):
    return H.descendant_counts(links(spark, d))


@query(f"{KG}, {MAP_SQL} SELECT id, len(c) AS n, c[1] AS first FROM (SELECT n.id, CASE WHEN CAST(split_part(n.id, ':', 2) AS BIGINT) % 3 = 1 THEN ['biolink:Drug'] ELSE all_categories END AS c FROM nodes n WHERE n.id LIKE 'SUPP:%' AND n.id <> 'SUPP:5' UNION ALL SELECT 'SUPP:5', [])")
def nrm_03_category_chain(spark, d):
    m = _mapping(spark, d).select("id", F.col("normalization_struct.normalized_categories").alias("normalized"))
    n = A.nodes(spark, d).filter("id like 'SUPP:%'").withColumn("all_categories", F.when(F.col("id") != "SUPP:5", F.col("all_categories")))
    out = n.join(m, "id", "left").withColumn("c", F.coalesce("normalized", "all_categories", F.array().cast("array<string>")))
    return out.select("id", F.size("c").cast("long").alias("n"), F.get("c", F.lit(0)).alias("first"))


@query(f"WITH {CORE} SELECT core_id, count(DISTINCT id) AS n FROM core GROUP BY core_id")
def nrm_05_core_nodes(spark, d):
    return H.core_ids(_core(spark, d)).groupBy("core_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'CUST:' || o_custkey AS id, min(o_orderpriority) AS core_id FROM orders GROUP BY 1")
def nrm_06_core_mapping(spark, d):
    m = A.read(spark, d, "orders").select(F.concat(F.lit("CUST:"), F.col("o_custkey").cast("string")).alias("id"), F.col("o_orderpriority").alias("core_id"))
    return H.core_ids(m, strict=False)


@query(f"{KG}, {MAP_SQL} SELECT n.category, m.normalized_id IS NOT NULL AS success, 'nodes' AS source_table, count(*) AS n FROM nodes n LEFT JOIN mapping m USING (id) GROUP BY ALL")
def nrm_09_node_summary(spark, d):
    m = _mapping(spark, d).select("id", F.col("normalization_struct.normalized_id").alias("to"))
    out = A.nodes(spark, d).join(m, "id", "left").groupBy("category", F.col("to").isNotNull().alias("success")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("source_table", F.lit("nodes"))


@query(f"WITH {MAP_SQL} SELECT normalized_id IS NULL AS missing, count(*) AS n FROM mapping GROUP BY 1")
def nrm_13_cache_statistics(spark, d):
    m = _mapping(spark, d)
    return m.groupBy(F.col("normalization_struct.normalized_id").isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query(f"{KG} SELECT id FROM nodes WHERE NOT list_contains(upstream_data_source, 'kg2') OR category = 'biolink:Disease'")
def flt_06_node_filters(spark, d):
    n = A.nodes(spark, d)
    keep = {"sources": ~F.array_contains("upstream_data_source", "kg2") | (F.col("category") == "biolink:Disease")}
    return graph.filter_chain(n, keep, ["id"])[0].select("id")


@query(f"{TYPED} SELECT subject, predicate, object, count(*) AS n FROM typed WHERE NOT (subject_category = 'biolink:Drug' AND predicate = 'biolink:related_to') GROUP BY ALL")
def flt_07_edge_filters(spark, d):
    typed = graph.with_categories(A.edges(spark, d), A.nodes(spark, d))
    keep = {"triples": ~((F.col("subject_category") == "biolink:Drug") & (F.col("predicate") == "biolink:related_to"))}
    kept = graph.filter_chain(typed, keep, ["subject", "predicate", "object"])[0]
    return kept.groupBy("subject", "predicate", "object").agg(F.count(F.lit(1)).alias("n"))
