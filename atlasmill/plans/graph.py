"""Queries on graph building: normalisation, union, hierarchy, filters, connectivity, validation, standardisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.functions.closure import closure, vocabulary
from atlasmill.operators import checks, graph
from atlasmill.registry import query

KG = f"WITH {A.NODES_SQL}, {A.EDGES_SQL}"
#: a third of the drugs move to the drug of half their number, a third map to themselves, a third are unknown
MAP_SQL = "mapping AS (SELECT 'SUPP:' || s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'SUPP:' || (s_suppkey // 2) WHEN 1 THEN 'SUPP:' || s_suppkey END AS normalized_id FROM supplier)"
ENDS = "ends AS (SELECT subject AS id FROM edges UNION SELECT object FROM edges)"


def _mapping(spark, d):
    k = F.col("s_suppkey")
    to = F.when(k % 3 == 0, F.concat(F.lit("SUPP:"), F.expr("s_suppkey div 2").cast("string"))).when(k % 3 == 1, F.concat(F.lit("SUPP:"), k.cast("string")))
    return A.read(spark, d, "supplier").select(F.concat(F.lit("SUPP:"), k.cast("string")).alias("id"), F.struct(to.alias("normalized_id"), F.when(k % 3 == 1, F.array(F.lit("biolink:Drug"))).cast("array<string>").alias("normalized_categories")).alias("normalization_struct"))


@query(f"WITH {MAP_SQL} SELECT id AS original_id, coalesce(normalized_id, id) AS normalized_id, normalized_id IS NOT NULL AS normalization_success FROM mapping")
def nrm_01_unpack_mapping(spark, d):
    return graph.unpack_mapping(_mapping(spark, d)).drop("normalized_categories")


@query(f"""{KG}, {MAP_SQL}, n AS (SELECT DISTINCT e.*, m.normalized_id AS ms FROM edges e LEFT JOIN mapping m ON e.subject = m.id)
SELECT coalesce(ms, subject) AS subject, predicate, count(*) AS n, count(*) FILTER (WHERE ms IS NOT NULL) AS ok FROM n GROUP BY ALL""")
def nrm_02_normalize_edges(spark, d):
    out = graph.normalize_edges(A.edges(spark, d), _mapping(spark, d))
    return out.groupBy("subject", "predicate").agg(F.count(F.lit(1)).alias("n"), F.count_if("subject_normalization_success").alias("ok"))


@query(f"""{KG}, {MAP_SQL}, j AS (SELECT coalesce(m.normalized_id, n.id) AS id, n.id AS original_id, n.category, m.normalized_id IS NOT NULL AS normalization_success FROM nodes n LEFT JOIN mapping m ON n.id = m.id)
SELECT id, original_id, category, normalization_success FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY original_id) AS r FROM j) WHERE r = 1""")
def nrm_04_normalize_nodes(spark, d):
    return graph.normalize_nodes(A.nodes(spark, d), _mapping(spark, d)).select("id", "original_id", "category", "normalization_success")


@query(f"{KG}, {ENDS} SELECT id FROM ends WHERE id NOT IN (SELECT id FROM nodes WHERE category <> 'biolink:Disease')")
def nrm_07_missing_nodes(spark, d):
    return graph.missing_nodes(A.edges(spark, d), A.nodes(spark, d).filter("category <> 'biolink:Disease'"))


@query(f"""{KG}, {MAP_SQL}, r AS (SELECT 'subject' AS role, subject AS id, upstream FROM edges UNION ALL SELECT 'object', object, upstream FROM edges)
SELECT role, upstream, m.normalized_id IS NOT NULL AS success, count(*) AS n FROM r LEFT JOIN mapping m ON r.id = m.id GROUP BY ALL""")
def nrm_08_normalization_summary(spark, d):
    e = A.edges(spark, d)
    roles = e.select(F.lit("subject").alias("role"), F.col("subject").alias("original_id"), "upstream").unionByName(e.select(F.lit("object").alias("role"), F.col("object").alias("original_id"), "upstream"))
    flat = graph.unpack_mapping(_mapping(spark, d)).select("original_id", "normalization_success")
    return roles.join(flat, "original_id", "left").groupBy("role", "upstream", F.coalesce("normalization_success", F.lit(False)).alias("success")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT 'CUST:' || o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)")
def nrm_10_cache_misses(spark, d):
    keys = A.read(spark, d, "orders").select(F.concat(F.lit("CUST:"), F.col("o_custkey").cast("string")).alias("key"))
    cache = A.read(spark, d, "customer").filter("c_custkey % 4 <> 0").select(F.concat(F.lit("CUST:"), F.col("c_custkey").cast("string")).alias("key"), F.lit("x").alias("api"))
    return graph.cache_misses(keys, cache, "x")


@query("SELECT o_orderkey, c_acctbal AS value FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON o_custkey = c_custkey")
def nrm_12_cache_lookup(spark, d):
    keys = A.read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    cache = A.read(spark, d, "customer").filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"), F.lit("x").alias("api"))
    return graph.cache_lookup(keys, cache.union(cache), "x").select("o_orderkey", "value")


@query("SELECT count(*) AS n, count(s_acctbal) AS with_s, count(c_acctbal) AS with_c FROM (SELECT s_nationkey AS k, s_acctbal, NULL AS c_acctbal FROM supplier UNION ALL SELECT c_nationkey, NULL, c_acctbal FROM customer)")
def uni_01_union_by_name(spark, d):
    s, c = A.read(spark, d, "supplier"), A.read(spark, d, "customer")
    both = graph.union_all([s.select(F.col("s_nationkey").alias("k"), "s_acctbal"), c.select(F.col("c_nationkey").alias("k"), "c_acctbal")])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("s_acctbal").alias("with_s"), F.count("c_acctbal").alias("with_c"))


@query(f"""{KG}, s AS (SELECT subject, predicate, object, string_agg(DISTINCT primary_knowledge_source, '|' ORDER BY primary_knowledge_source) AS sources FROM edges GROUP BY ALL)
SELECT e.subject, e.predicate, e.object, primary_knowledge_source, upstream, CAST(sum(num_references) AS BIGINT) AS num_references, count(DISTINCT publication) AS n_publications, sources
FROM edges e JOIN s ON e.subject = s.subject AND e.predicate = s.predicate AND e.object = s.object GROUP BY ALL""")
def uni_02_unify_edges(spark, d):
    out = graph.unify_edges(A.edges(spark, d))
    return out.select("subject", "predicate", "object", "primary_knowledge_source", "upstream", "num_references", "n_publications", F.array_join("primary_knowledge_sources", "|").alias("sources"))


@query(f"""{KG}, {ENDS} SELECT id, min(name) AS name, min(category) AS category, array_to_string(list_sort(list_distinct(flatten(list(upstream_data_source)))), '|') AS upstream FROM nodes WHERE id IN (SELECT id FROM ends) GROUP BY id""")
def uni_03_unify_nodes(spark, d):
    n = A.nodes(spark, d)
    return graph.unify_nodes(n.union(n), A.edges(spark, d)).select("id", "name", "category", F.array_join("upstream_data_source", "|").alias("upstream"))


@query(f"""{KG} SELECT subject, predicate, object, CAST(sum(num_references) AS BIGINT) AS num_references, max(num_sentences) AS num_sentences,
string_agg(DISTINCT primary_knowledge_source, '|' ORDER BY primary_knowledge_source) AS sources, coalesce(string_agg(DISTINCT publication, '|' ORDER BY publication), '') AS publications FROM edges GROUP BY ALL""")
def uni_05_collapse_edges(spark, d):
    out = graph.collapse_edges(A.edges(spark, d))
    return out.select("subject", "predicate", "object", "num_references", "num_sentences", F.array_join("sources", "|").alias("sources"), F.array_join("publications", "|").alias("publications"))


@query(f"""{KG}, v AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {len(A.ancestors(c, A.CATEGORY_PARENT)) - 1})" for c in A.CATEGORY_PARENT)}) t(c, depth))
SELECT id, arg_min(c, (-depth, c)) AS category FROM (SELECT id, unnest(all_categories) AS c FROM nodes) JOIN v USING (c) GROUP BY id""")
def hie_03_most_specific_category(spark, d):
    return graph.most_specific(A.nodes(spark, d), vocabulary(spark, A.CATEGORY_PARENT))


@query(f"""{KG}, b AS (SELECT * FROM (VALUES {", ".join(f"('{p}', '{a}')" for p in A.PREDICATE_PARENT for a in A.ancestors(p, A.PREDICATE_PARENT)[1:])}) t(predicate, general))
SELECT predicate, count(*) AS n FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x JOIN b ON x.predicate = b.predicate WHERE x.subject = e.subject AND x.object = e.object AND b.general = e.predicate) GROUP BY predicate""")
def hie_04_drop_redundant(spark, d):
    return graph.drop_redundant(A.edges(spark, d), vocabulary(spark, A.PREDICATE_PARENT)).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS c, p_partkey // 2 AS p FROM part WHERE p_partkey // 2 > 0), r AS (SELECT c, p, 1 AS depth FROM e UNION ALL SELECT r.c, e.p, depth + 1 FROM r JOIN e ON r.p = e.c)
SELECT p AS ancestor, count(*) AS descendants, CAST(max(depth) AS BIGINT) AS deepest FROM r GROUP BY p""")
def hie_08_closure(spark, d):
    e = A.read(spark, d, "part").select(F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent")).filter("parent > 0")
    return closure(e).groupBy("ancestor").agg(F.count(F.lit(1)).alias("descendants"), F.max("depth").cast("long").alias("deepest"))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT p_partkey // 2 FROM part)")
def hie_10_leaves(spark, d):
    p = A.read(spark, d, "part").select(F.col("p_partkey").alias("id"))
    return p.join(p.select(F.expr("id div 2").alias("id")), "id", "left_anti")


@query(f"{KG} SELECT category, count(*) AS n FROM nodes WHERE list_has_any(upstream_data_source, ['kg0']) GROUP BY category")
def flt_01_keep_sources(spark, d):
    return A.nodes(spark, d).filter(graph.keep_any("upstream_data_source", ["kg0"])).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(f"{KG} SELECT knowledge_level, count(*) AS n FROM edges WHERE NOT knowledge_level IN ('prediction') GROUP BY ALL")
def flt_02_drop_values(spark, d):
    return A.edges(spark, d).filter(graph.drop_values("knowledge_level", ["prediction"])).groupBy("knowledge_level").agg(F.count(F.lit(1)).alias("n"))


@query(f"{KG} SELECT category, count(*) AS n FROM nodes WHERE NOT list_has_any(all_categories, ['biolink:Gene', 'biolink:Drug']) OR list_has_any(upstream_data_source, ['kg2']) GROUP BY category")
def flt_03_drop_overlap(spark, d):
    return A.nodes(spark, d).filter(graph.drop_overlap("all_categories", ["biolink:Gene", "biolink:Drug"], "upstream_data_source", ["kg2"])).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


TYPED = f"{KG}, typed AS (SELECT e.*, s.category AS subject_category, o.category AS object_category FROM edges e JOIN nodes s ON e.subject = s.id JOIN nodes o ON e.object = o.id)"


@query(f"{TYPED} SELECT subject_category, predicate, object_category, count(*) AS n FROM typed WHERE NOT (subject_category = 'biolink:Drug' AND predicate = 'biolink:affects' AND object_category = 'biolink:Disease') GROUP BY ALL")
def flt_04_drop_triples(spark, d):
    typed = graph.with_categories(A.edges(spark, d), A.nodes(spark, d))
    return typed.filter(graph.drop_triples([("biolink:Drug", "biolink:affects", "biolink:Disease")])).groupBy("subject_category", "predicate", "object_category").agg(F.count(F.lit(1)).alias("n"))


@query(f"{KG} SELECT category, count(*) AS n FROM nodes WHERE list_has_any(upstream_data_source, ['kg2']) OR list_has_any(all_categories, ['biolink:Gene']) GROUP BY category")
def flt_05_removed_rows(spark, d):
    kept, removed = graph.filter_chain(A.nodes(spark, d), {"source": graph.keep_any("upstream_data_source", ["kg0", "kg1"]), "category": ~graph.keep_any("all_categories", ["biolink:Gene"])}, ["id"])
    return removed.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(f"{KG}, {ENDS} SELECT category, count(*) AS n FROM nodes WHERE id NOT IN (SELECT subject FROM edges WHERE predicate = 'biolink:treats' UNION SELECT object FROM edges WHERE predicate = 'biolink:treats') GROUP BY category")
def flt_08_floating_nodes(spark, d):
    return graph.drop_floating(A.nodes(spark, d), A.edges(spark, d).filter("predicate = 'biolink:treats'"))[1].groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(f"{TYPED} SELECT predicate, count(*) AS n FROM typed WHERE NOT (subject_category = 'biolink:Drug' AND object_category = 'biolink:Disease') GROUP BY ALL")
def flt_09_no_drug_disease(spark, d):
    return graph.drop_drug_disease(graph.with_categories(A.edges(spark, d), A.nodes(spark, d))).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey FROM customer WHERE CAST('0x' || substr(md5('7|' || c_custkey), 1, 8) AS BIGINT) < CAST(floor(0.1 * 4294967296) AS BIGINT)")
def flt_10_hash_sample(spark, d):
    return graph.hash_sample(A.read(spark, d, "customer"), ["c_custkey"], 0.1, 7).select("c_custkey")


@query("SELECT p_partkey FROM part WHERE p_size = 3 AND p_brand = 'Brand#11'")
def flt_11_equals(spark, d):
    return graph.equals(A.read(spark, d, "part"), {"p_size": 3, "p_brand": "Brand#11", "absent": 1}).select("p_partkey")


@query(f"{KG} SELECT count(*) AS n FROM (SELECT DISTINCT least(subject, object), greatest(subject, object) FROM edges WHERE subject <> object)")
def con_01_simple_pairs(spark, d):
    return graph.simple_pairs(A.edges(spark, d)).agg(F.count(F.lit(1)).alias("n"))


LOCATED = "n AS (SELECT 'CUST:' || c_custkey AS id, CAST(c_nationkey AS BIGINT) AS k FROM customer UNION ALL SELECT 'SUPP:' || s_suppkey, s_nationkey FROM supplier UNION ALL SELECT 'NATION:' || CAST(n_nationkey AS BIGINT), n_nationkey FROM nation)"
COMPONENTS = f"WITH {LOCATED}, c AS (SELECT k, min(id) AS component, count(*) AS size FROM n GROUP BY k), r AS (SELECT *, row_number() OVER (ORDER BY size DESC, component) - 1 AS component_rank FROM c)"


def _located(spark, d):
    n = A.nodes(spark, d).filter("category in ('biolink:Gene', 'biolink:Drug') or id like 'NATION:%'")
    return n, graph.components(n, A.edges(spark, d).filter("predicate = 'biolink:located_in'"))


@query(f"{COMPONENTS} SELECT n.id, component, size, component_rank FROM n JOIN r USING (k)")
def con_02_components(spark, d):
    return _located(spark, d)[1].select("id", "component", "size", "component_rank")


@query(f"{COMPONENTS} SELECT count(*) AS components, max(size) AS largest, round(max(size) / sum(size), 6) AS lcc_fraction, round(sum(size / (SELECT sum(size) FROM c) * size / (SELECT max(size) FROM c)), 6) AS weighted FROM c")
def con_05_connectivity_metrics(spark, d):
    sizes = _located(spark, d)[1].groupBy("component").agg(F.first("size").alias("size"))
    n, most = F.sum("size"), F.max("size")
    return sizes.agg(F.count(F.lit(1)).alias("components"), most.alias("largest"), F.round(most / n, 6).alias("lcc_fraction"), F.round(F.sum(F.col("size").cast("double") * F.col("size")) / n / most, 6).alias("weighted"))


@query(f"{COMPONENTS} SELECT component, size, md5(string_agg(id, ',' ORDER BY id)) AS digest FROM n JOIN r USING (k) GROUP BY ALL")
def con_06_component_digest(spark, d):
    return _located(spark, d)[1].groupBy("component", "size").agg(F.md5(F.concat_ws(",", F.sort_array(F.collect_list("id")))).alias("digest"))


@query(f"{KG} SELECT predicate, count(*) FILTER (WHERE NOT regexp_matches(subject, '^[A-Z]+:[0-9]+$')) AS bad_subject, count(*) FILTER (WHERE primary_knowledge_source LIKE 'infores:%') AS known_source, count(*) FILTER (WHERE contains(coalesce(knowledge_level, ''), 'assertion')) AS asserted FROM edges GROUP BY predicate")
def val_10_edge_counters(spark, d):
    return A.edges(spark, d).groupBy("predicate").agg(F.count_if(~checks.is_curie("subject")).alias("bad_subject"), F.count_if(F.col("primary_knowledge_source").startswith("infores:")).alias("known_source"), F.count_if(F.coalesce(checks.contains_any("knowledge_level", ["ASSERTION"]), F.lit(False))).alias("asserted"))


@query(f"{KG}, {ENDS}, m AS (SELECT id, split_part(id, ':', 1) AS prefix FROM ends WHERE id NOT IN (SELECT id FROM nodes WHERE category <> 'biolink:Disease')) SELECT prefix, count(*) AS n, array_to_string(list_sort(list(id))[1:3], '|') AS examples FROM m GROUP BY prefix")
def val_07_missing_by_prefix(spark, d):
    return checks.missing_by_prefix(A.edges(spark, d), A.nodes(spark, d).filter("category <> 'biolink:Disease'"))


@query(f"{TYPED} SELECT subject_category, predicate, object_category, count(*) AS n, predicate IN ('biolink:treats', 'biolink:located_in') AS valid FROM typed GROUP BY ALL")
def val_09_edge_types(spark, d):
    typed = graph.with_categories(A.edges(spark, d), A.nodes(spark, d))
    allowed = spark.createDataFrame([("biolink:Drug", "biolink:treats", "biolink:Disease"), ("biolink:Drug", "biolink:located_in", "biolink:GeographicLocation"), ("biolink:Gene", "biolink:located_in", "biolink:GeographicLocation")], "subject_category string, predicate string, object_category string")
    return checks.edge_type_census(typed, allowed)


@query(f"{KG} SELECT s AS infores FROM (SELECT primary_knowledge_source AS s FROM edges UNION SELECT upstream FROM edges)")
def doc_01_provenance_ids(spark, d):
    e = A.edges(spark, d)
    return e.select(F.col("primary_knowledge_source").alias("infores")).union(e.select("upstream")).distinct()


@query("SELECT e_type AS event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (SELECT event_type AS e_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1")
def trf_16_nested_links(spark, d):
    return A.read(spark, d, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query("""WITH p AS (SELECT l_suppkey AS s, l_partkey AS o, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY ALL), a AS (SELECT l_suppkey AS s, count(DISTINCT l_orderkey) AS nx FROM lineitem GROUP BY ALL), b AS (SELECT l_partkey AS o, count(DISTINCT l_orderkey) AS ny FROM lineitem GROUP BY ALL)
SELECT s, o, round((log2(greatest(nx, ny)) - log2(n)) / (log2(7.4e8) - log2(least(nx, ny))), 6) AS ngd FROM p JOIN a USING (s) JOIN b USING (o)""")
def trf_05_google_distance(spark, d):
    item = A.read(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("o"), "l_orderkey")
    n = lambda keys, name: item.groupBy(*keys).agg(F.count_distinct("l_orderkey").alias(name))
    joined = n(["s", "o"], "n").join(n(["s"], "nx"), "s").join(n(["o"], "ny"), "o")
    distance = (F.log2(F.greatest("nx", "ny")) - F.log2("n")) / (F.log2(F.lit(7.4e8)) - F.log2(F.least("nx", "ny")))
    return joined.select("s", "o", F.round(distance, 6).alias("ngd"))


@query(f"{KG} SELECT id, name, array_to_string(all_categories, chr(31)) AS all_categories FROM nodes")
def src_14_kgx_nodes(spark, d):
    from atlasmill.sources.tables import to_kgx

    return to_kgx(A.nodes(spark, d), ["id", "name", "all_categories"])


@query("SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT%' AND o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END AS urgent_open FROM orders")
def trf_15_status_flags(spark, d):
    flag = F.col("o_orderpriority").contains("URGENT") & F.col("o_orderstatus").isin("F", "O")
    return A.read(spark, d, "orders").select("o_orderkey", F.when(flag, 1).otherwise(0).alias("urgent_open"))


@query("SELECT p_partkey, substr(p_type, 1, 1) AS l1, CASE WHEN length(p_type) >= 3 THEN substr(p_type, 1, 3) END AS l2, CASE WHEN length(p_type) >= 7 THEN substr(p_type, 1, 7) END AS l5 FROM part")
def ent_09_code_levels(spark, d):
    level = lambda n: F.when(F.length("p_type") >= n, F.substring("p_type", 1, n))
    return A.read(spark, d, "part").select("p_partkey", F.substring("p_type", 1, 1).alias("l1"), level(3).alias("l2"), level(7).alias("l5"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'matching' END AS kind FROM (SELECT DISTINCT l_partkey AS k FROM lineitem) a FULL JOIN (SELECT p_partkey + 7 AS k FROM part) b ON a.k = b.k) GROUP BY kind""")
def ent_03_merge_statistics(spark, d):
    a = A.read(spark, d, "lineitem").select(F.col("l_partkey").alias("k")).distinct().withColumn("l", F.lit(1))
    b = A.read(spark, d, "part").select((F.col("p_partkey") + 7).alias("k")).withColumn("r", F.lit(1))
    kind = F.when(F.col("l").isNull(), "right_only").when(F.col("r").isNull(), "left_only").otherwise("matching")
    return a.join(b, "k", "full").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 0 THEN upper(p_brand) END, p_brand) AS brand FROM part")
def ent_02_patch_columns(spark, d):
    p = A.read(spark, d, "part")
    patch = p.filter("p_size % 2 = 0").select("p_partkey", F.upper("p_brand").alias("patch"))
    return p.join(patch, "p_partkey", "left").select("p_partkey", F.coalesce("patch", "p_brand").alias("brand"))
