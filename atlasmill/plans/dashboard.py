"""Analytic queries over the released graph."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import graph
from atlasmill.plans.graph import KG, TYPED
from atlasmill.registry import query


def _n():
    return F.count(F.lit(1)).alias("n")


def _typed(spark, d):
    return graph.with_categories(A.edges(spark, d), A.nodes(spark, d))


@query(f"{KG}, x AS (SELECT subject AS id, object AS nb FROM edges UNION ALL SELECT object, subject FROM edges WHERE subject <> object), g AS (SELECT id, count(*) AS degree FROM x GROUP BY id) SELECT count(*) AS n_nodes, CAST(sum(degree) AS BIGINT) AS ends, max(degree) AS most, CAST(quantile_cont(degree, 0.5) AS DOUBLE) AS median FROM g")
def dsh_01_degree_metrics(spark, d):
    e = A.edges(spark, d)
    ends = e.select(F.col("subject").alias("id")).union(e.filter("subject <> object").select("object"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return degree.agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("degree").alias("ends"), F.max("degree").alias("most"), F.expr("percentile_cont(0.5) within group (order by degree)").alias("median"))


@query(f"{TYPED} SELECT subject_category, predicate, object_category, primary_knowledge_source, count(*) AS n, string_agg(DISTINCT upstream, ',' ORDER BY upstream) AS upstreams FROM typed GROUP BY ALL")
def dsh_05_merged_edge_cube(spark, d):
    return _typed(spark, d).groupBy("subject_category", "predicate", "object_category", "primary_knowledge_source").agg(_n(), F.array_join(F.array_sort(F.collect_set("upstream")), ",").alias("upstreams"))


@query(f"{KG} SELECT category, split_part(id, ':', 1) AS prefix, array_to_string(upstream_data_source, ',') AS upstreams, count(*) AS n FROM nodes GROUP BY ALL")
def dsh_05_merged_node_cube(spark, d):
    return A.nodes(spark, d).groupBy("category", F.split_part("id", F.lit(":"), F.lit(1)).alias("prefix"), F.array_join("upstream_data_source", ",").alias("upstreams")).agg(_n())


@query(f"{TYPED} SELECT category, direction, other, count(*) AS n FROM (SELECT 'out' AS direction, subject_category AS category, object_category AS other FROM typed UNION ALL SELECT 'in', object_category, subject_category FROM typed) GROUP BY ALL")
def dsh_07_connected_categories(spark, d):
    t = _typed(spark, d)
    both = t.select(F.lit("out").alias("direction"), F.col("subject_category").alias("category"), F.col("object_category").alias("other")).union(t.select(F.lit("in"), "object_category", "subject_category"))
    return both.groupBy("category", "direction", "other").agg(_n())


@query(f"{KG}, x AS (SELECT subject AS id, object AS nb FROM edges UNION SELECT object, subject FROM edges) SELECT n.id, count(DISTINCT nb) AS neighbours FROM nodes n LEFT JOIN x ON n.id = x.id AND x.nb <> n.id WHERE category = 'biolink:Drug' GROUP BY n.id")
def dsh_08_neighbour_counts(spark, d):
    e = A.edges(spark, d)
    both = e.select(F.col("subject").alias("id"), F.col("object").alias("nb")).union(e.select("object", "subject")).filter("id <> nb").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("neighbours"))
    return A.nodes(spark, d).filter("category = 'biolink:Drug'").select("id").join(both, "id", "left").select("id", F.coalesce("neighbours", F.lit(0)).alias("neighbours"))


@query(f"{KG}, x AS (SELECT n.id, e.subject FROM nodes n LEFT JOIN edges e ON n.id = e.subject WHERE category = 'biolink:Disease' OR category = 'biolink:Drug') SELECT id, count(*) AS n FROM x GROUP BY id")
def dsh_09_edge_counts(spark, d):
    out = A.edges(spark, d).groupBy(F.col("subject").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return A.nodes(spark, d).filter("category in ('biolink:Disease', 'biolink:Drug')").select("id").join(out, "id", "left").select("id", F.coalesce("n", F.lit(1)).alias("n"))


@query(f"{KG}, a AS (SELECT s, count(*) AS nodes FROM (SELECT unnest(upstream_data_source) AS s FROM nodes) GROUP BY s), b AS (SELECT upstream AS s, count(*) AS edges FROM edges GROUP BY 1) SELECT coalesce(a.s, b.s) AS source, coalesce(nodes, 0) AS n_nodes, coalesce(edges, 0) AS n_edges FROM a FULL JOIN b ON a.s = b.s")
def dsh_15_upstream_sources(spark, d):
    a = A.nodes(spark, d).select(F.explode("upstream_data_source").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n_nodes"))
    b = A.edges(spark, d).groupBy(F.col("upstream").alias("source")).agg(F.count(F.lit(1)).alias("n_edges"))
    return a.join(b, "source", "full").fillna(0)


SCORE_SQL = "(CASE knowledge_level WHEN 'knowledge_assertion' THEN 1.0 WHEN 'prediction' THEN -0.5 ELSE 0 END + CASE agent_type WHEN 'manual_agent' THEN 1.0 WHEN 'automated_agent' THEN -0.25 ELSE 0 END) / 2"


@query(f"{KG} SELECT primary_knowledge_source, coalesce(knowledge_level, 'not_provided') AS knowledge_level, coalesce(agent_type, 'not_provided') AS agent_type, count(*) AS n, round(avg({SCORE_SQL}), 6) AS score FROM edges GROUP BY ALL")
def dsh_17_epistemic_scores(spark, d):
    level = F.when(F.col("knowledge_level") == "knowledge_assertion", 1.0).when(F.col("knowledge_level") == "prediction", -0.5).otherwise(0.0)
    agent = F.when(F.col("agent_type") == "manual_agent", 1.0).when(F.col("agent_type") == "automated_agent", -0.25).otherwise(0.0)
    none = F.lit("not_provided")
    return A.edges(spark, d).groupBy("primary_knowledge_source", F.coalesce("knowledge_level", none).alias("knowledge_level"), F.coalesce("agent_type", none).alias("agent_type")).agg(_n(), F.round(F.avg((level + agent) / 2), 6).alias("score"))


@query("""WITH RECURSIVE r AS (SELECT p_partkey AS root, p_partkey AS id, 0 AS depth FROM part WHERE p_partkey BETWEEN 1 AND 7 UNION ALL SELECT r.root, p_partkey, depth + 1 FROM r JOIN part ON p_partkey // 2 = r.id WHERE depth < 20)
SELECT root, count(DISTINCT id) AS descendants, count(DISTINCT l_suppkey) AS connected FROM r LEFT JOIN lineitem ON l_partkey = id GROUP BY root""")
def dsh_24_key_node_stats(spark, d):
    from atlasmill.functions.closure import closure

    part = A.read(spark, d, "part").select("p_partkey")
    below = closure(part.select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent")).filter("parent > 0")).filter("ancestor between 1 and 7").select(F.col("ancestor").alias("root"), F.col("descendant").alias("id"))
    keyed = below.union(part.filter("p_partkey between 1 and 7").select("p_partkey", "p_partkey"))
    item = A.read(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), "l_suppkey").distinct()
    return keyed.join(item, "id", "left").groupBy("root").agg(F.count_distinct("id").alias("descendants"), F.count_distinct("l_suppkey").alias("connected"))


@query(f"{KG}, r AS (SELECT predicate, subject, object, row_number() OVER (PARTITION BY predicate ORDER BY subject, object) AS r FROM (SELECT DISTINCT predicate, subject, object FROM edges)) SELECT predicate, subject, object FROM r WHERE r <= 10")
def dsh_27_example_edges(spark, d):
    w = W.partitionBy("predicate").orderBy("subject", "object")
    return A.edges(spark, d).select("predicate", "subject", "object").distinct().withColumn("r", F.row_number().over(w)).filter("r <= 10").drop("r")


@query(f"{TYPED} SELECT source, target, count(*) AS n FROM (SELECT subject_category AS source, predicate AS target FROM typed UNION ALL SELECT predicate, 'to ' || object_category FROM typed) GROUP BY ALL HAVING count(*) > 5")
def dsh_30_sankey(spark, d):
    t = _typed(spark, d)
    flows = t.select(F.col("subject_category").alias("source"), F.col("predicate").alias("target")).union(t.select("predicate", F.concat(F.lit("to "), "object_category")))
    return flows.groupBy("source", "target").agg(_n()).filter("n > 5")


@query(f"{KG} SELECT predicate, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share FROM edges GROUP BY predicate")
def dsh_32_shares(spark, d):
    counts = A.edges(spark, d).groupBy("predicate").agg(_n())
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("all"))), F.lit(True)).select("predicate", "n", F.round(100.0 * F.col("n") / F.col("all"), 6).alias("share"))


@query("WITH c AS (SELECT p_type AS t, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, t) AS r FROM c) SELECT CASE WHEN r <= 3 THEN t ELSE 'Other' END AS kind, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1")
def dsh_36_top_and_other(spark, d):
    counts = A.read(spark, d, "part").groupBy(F.col("p_type").alias("t")).agg(_n())
    ranked = counts.withColumn("r", F.row_number().over(W.orderBy(F.desc("n"), "t")))
    return ranked.groupBy(F.when(F.col("r") <= 3, F.col("t")).otherwise("Other").alias("kind")).agg(F.sum("n").alias("n"))


@query(f"{TYPED}, c AS (SELECT subject_category, primary_knowledge_source, count(*) AS n FROM typed GROUP BY ALL) SELECT subject_category, arg_min(primary_knowledge_source, (-n, primary_knowledge_source)) AS main_source, string_agg(primary_knowledge_source, ',' ORDER BY n DESC, primary_knowledge_source) AS sources FROM c GROUP BY 1")
def dsh_38_modal_source(spark, d):
    c = _typed(spark, d).groupBy("subject_category", "primary_knowledge_source").agg(_n())
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("primary_knowledge_source").alias("s"))))
    out = c.groupBy("subject_category").agg(listed.alias("l"))
    return out.select("subject_category", F.col("l")[0]["s"].alias("main_source"), F.array_join(F.transform("l", lambda x: x["s"]), ",").alias("sources"))
