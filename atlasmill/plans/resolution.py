"""Queries on identifier and name resolution, raw-source cleaning and source documentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import curation as U
from atlasmill.operators import resolution as N
from atlasmill.registry import query


def _key(prefix, column):
    return F.concat(F.lit(prefix), F.col(column).cast("long").cast("string"))


@query("SELECT DISTINCT p_brand AS key, CASE WHEN p_brand LIKE '%1' THEN NULL ELSE 'N:' || lower(p_brand) END AS value FROM part")
def nrm_11_batch_resolver(spark, d):
    return N.resolve_batches(A.read(spark, d, "part").select(F.col("p_brand").alias("key")), "key", lambda names: [None if n.endswith("1") else "N:" + n.lower() for n in names], 10)


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN 'N:' || s_suppkey END AS normalized_id, CASE WHEN s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0 THEN 'a|b' ELSE 'biolink:NamedThing' END AS categories FROM supplier")
def nrm_14_json_paths(spark, d):
    k = F.col("s_suppkey")
    body = F.to_json(F.struct(F.struct(_key("N:", "s_suppkey").alias("identifier")).alias("id"), F.when(k % 3 != 0, F.array(F.lit("a"), F.lit("b"))).alias("type")))
    asked = A.read(spark, d, "supplier").select("s_suppkey", F.when(k % 4 != 0, body).alias("response"))
    return N.normalized_response(asked, "response", "$.id.identifier", "$.type", "biolink:NamedThing").select("s_suppkey", "normalized_id", F.array_join("normalized_categories", "|").alias("categories"))


ATTRIBUTES = "a AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE s_nationkey % 3 WHEN 0 THEN 'MedScan ID' WHEN 1 THEN 'UMLS ID' ELSE 'Note' END AS name, s_suppkey || '.5' AS value FROM supplier), n AS (SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) || ',' || (n_nationkey + 5) AS attributes FROM nation)"


def _attributes(spark, d):
    k = F.col("s_nationkey") % 3
    attributes = A.read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.when(k == 0, "MedScan ID").when(k == 1, "UMLS ID").otherwise("Note").alias("name"), F.concat(F.col("s_suppkey").cast("string"), F.lit(".5")).alias("value"))
    nation = A.read(spark, d, "nation")
    own = F.col("n_nationkey").cast("long")
    nodes = nation.select(own.cast("string").alias("id"), F.col("n_name").alias("name"), F.concat(F.lit("{"), own.cast("string"), F.lit(","), (own + 5).cast("string"), F.lit("}")).alias("attributes"), _key("urn:", "n_nationkey").alias("urn"), F.when(own % 2 == 0, "Drug").otherwise("Place").alias("nodetype"))
    manual_ids = attributes.filter("cast(id as long) % 2 = 0").select(F.concat(F.lit("M:"), "id").alias("id"), F.col("value").alias("identifier"))
    manual_names = nation.filter("n_nationkey % 10 = 3").select(F.col("n_name").alias("name"), _key("X:", "n_nationkey").alias("id"))
    return attributes, nodes, manual_ids, manual_names, {"UMLS ID": "UMLS:", "MedScan ID": "MS:"}


RESOLVED = f"""WITH {ATTRIBUTES}, by_id AS (SELECT id AS attribute_id, name, value, 'M:' || id AS normalized_id FROM a WHERE name = 'MedScan ID' AND CAST(id AS BIGINT) % 2 = 0),
by_name AS (SELECT unnest([CAST(n_nationkey AS VARCHAR), CAST(n_nationkey + 5 AS VARCHAR)]) AS attribute_id, 'Manual ID' AS name, 'X:' || CAST(n_nationkey AS BIGINT) AS value, 'X:' || CAST(n_nationkey AS BIGINT) AS normalized_id FROM nation WHERE n_nationkey % 10 = 3),
plain AS (SELECT id AS attribute_id, name, CASE name WHEN 'UMLS ID' THEN 'UMLS:' || id WHEN 'MedScan ID' THEN 'MS:' || id ELSE value END AS value, CASE WHEN name = 'Note' THEN value END AS normalized_id FROM a WHERE id NOT IN (SELECT attribute_id FROM by_id UNION SELECT attribute_id FROM by_name)),
resolved AS (SELECT * FROM plain UNION ALL SELECT * FROM by_id UNION ALL SELECT * FROM by_name)"""


@query(f"{RESOLVED} SELECT * FROM resolved")
def pre_05_attribute_ids(spark, d):
    return N.attribute_ids(*_attributes(spark, d))


@query(f"{RESOLVED}, f AS (SELECT CAST(CAST(n_nationkey AS BIGINT) AS VARCHAR) AS id, n_nationkey AS k, (SELECT min(normalized_id) FROM resolved WHERE attribute_id IN (CAST(n_nationkey AS VARCHAR), CAST(n_nationkey + 5 AS VARCHAR))) AS m FROM nation) SELECT id, coalesce(m, 'urn:' || CAST(k AS BIGINT)) AS final_id, CASE WHEN k % 2 = 0 THEN 'biolink:Drug' ELSE '' END AS category FROM f")
def pre_06_one_id_per_node(spark, d):
    attributes, nodes, *rest = _attributes(spark, d)
    return N.one_id_per_node(nodes, N.attribute_ids(attributes, nodes, *rest), {"Drug": "biolink:Drug"}).select("id", "final_id", "category")


@query("""WITH e AS (SELECT l_suppkey AS inkey, l_partkey AS outkey, l_returnflag AS predicate FROM lineitem), n AS (SELECT 'G:' || (s_suppkey // 2) AS id, min('S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')) AS original FROM supplier WHERE s_suppkey IN (SELECT inkey FROM e) GROUP BY 1 UNION ALL SELECT 'P:' || p_partkey, 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') FROM part WHERE p_partkey IN (SELECT outkey FROM e))
SELECT DISTINCT s.id AS subject, predicate, o.id AS object FROM e JOIN n s ON s.original = 'S' || lpad(CAST(inkey AS VARCHAR), 9, '0') JOIN n o ON o.original = 'P' || lpad(CAST(outkey AS VARCHAR), 9, '0')""")
def pre_09_connected_graph(spark, d):
    own = lambda prefix, c: F.concat(F.lit(prefix), F.lpad(F.col(c).cast("string"), 9, "0"))
    edges = A.read(spark, d, "lineitem").select(own("S", "l_suppkey").alias("inkey"), own("P", "l_partkey").alias("outkey"), F.col("l_returnflag").alias("predicate"))
    suppliers = A.read(spark, d, "supplier").select(F.concat(F.lit("G:"), F.expr("s_suppkey div 2").cast("string")).alias("id"), own("S", "s_suppkey").alias("original"))
    parts = A.read(spark, d, "part").select(_key("P:", "p_partkey").alias("id"), own("P", "p_partkey").alias("original"))
    return N.connected_graph(suppliers.union(parts), edges)[1].select("subject", "predicate", "object")


@query("""WITH e AS (SELECT unnest([c_nationkey, c_nationkey + 100]) AS x, c_custkey % 50 AS y, c_mktsegment AS kind FROM customer)
SELECT DISTINCT 'MONDO:' || lpad(CAST(CAST(x AS BIGINT) AS VARCHAR), 7, '0') AS subject, CASE kind WHEN 'BUILDING' THEN 'biolink:treats' WHEN 'MACHINERY' THEN 'biolink:contraindicated_in' ELSE 'biolink:related_to' END AS predicate, 'MONDO:' || lpad(CAST(y AS VARCHAR), 7, '0') AS object FROM e""")
def pre_02_grouped_edges(spark, d):
    own = F.col("c_nationkey").cast("long")
    raw = A.read(spark, d, "customer").select(F.concat_ws("_", own.cast("string"), (own + 100).cast("string")).alias("x"), (F.col("c_custkey") % 50).cast("string").alias("y"), F.col("c_mktsegment").alias("kind"))
    rule = U.first_rule([(F.col("kind") == "BUILDING", F.lit("biolink:treats")), (F.col("kind") == "MACHINERY", F.lit("biolink:contraindicated_in"))], F.lit("biolink:related_to"))
    return N.grouped_edges(raw, ["x", "y"]).select(U.padded_curie("MONDO", "x", 7).alias("subject"), rule.alias("predicate"), U.padded_curie("MONDO", "y", 7).alias("object")).distinct()


NAMED = "named AS (SELECT s_suppkey AS ID, CASE WHEN s_suppkey % 5 = 0 THEN 'new' || (s_suppkey % 20) END AS new_id, CASE WHEN s_nationkey % 2 = 0 THEN 'N:' || CAST(s_nationkey AS BIGINT) END AS curie FROM supplier), medical AS (SELECT *, coalesce(new_id, curie) AS normalized_curie FROM named WHERE coalesce(new_id, curie) IS NOT NULL)"


def _medical(spark, d):
    names = A.read(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), _key("N:", "n_nationkey").alias("curie"))
    raw = A.read(spark, d, "supplier").join(A.read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("ID"), F.col("n_name").alias("name"), F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("new"), (F.col("s_suppkey") % 20).cast("string"))).alias("new_id"))
    return N.resolve_names(raw, names)


@query(f"WITH {NAMED} SELECT ID, curie FROM named")
def pre_10_resolved_names(spark, d):
    return _medical(spark, d).select("ID", "curie")


@query(f"WITH {NAMED} SELECT ID, normalized_curie, count(*) OVER (PARTITION BY normalized_curie) AS n_same FROM medical")
def pre_11_medical_nodes(spark, d):
    return N.medical_nodes(_medical(spark, d)).select("ID", "normalized_curie", "n_same")


@query(f"WITH {NAMED} SELECT l_orderkey, l_linenumber, s.normalized_curie AS SourceId, t.normalized_curie AS TargetId FROM lineitem JOIN medical s ON s.ID = l_suppkey JOIN medical t ON t.ID = l_linenumber")
def pre_11_medical_edges(spark, d):
    edges = A.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("Source"), F.col("l_linenumber").cast("long").alias("Target"))
    return N.medical_edges(N.medical_nodes(_medical(spark, d)), edges).select("l_orderkey", "l_linenumber", "SourceId", "TargetId")


@query("SELECT p_partkey, CASE WHEN p_size <= 25 THEN 'small ' || p_size ELSE 'Not resolved' END AS tag FROM part")
def pre_13_tags(spark, d):
    tags = spark.range(1, 26).select(F.col("id").cast("int").alias("p_size"), F.concat(F.lit("small "), F.col("id").cast("string")).alias("tag"))
    return N.tag(A.read(spark, d, "part").select("p_partkey", "p_size"), tags, "p_size", ["tag"]).select("p_partkey", "tag")


# --- documentation of knowledge sources ---

ENTRIES = """infores AS (SELECT 'infores:' || lower(n_name) AS id, 'infores' AS source, unnest(['name', 'region']) AS property, unnest([n_name, CAST(n_regionkey AS VARCHAR)]) AS value FROM nation WHERE n_nationkey % 2 = 0),
registry AS (SELECT CASE WHEN n_nationkey = 3 THEN 'infores:three' ELSE 'infores:' || lower(n_name) END AS id, 'kgregistry' AS source, unnest(['name', 'key']) AS property, unnest(['reg|' || n_name, CAST(n_nationkey AS VARCHAR)]) AS value FROM nation WHERE n_nationkey % 3 = 0)"""
WANTED = "wanted AS (SELECT 'infores:' || lower(n_name) AS id FROM nation UNION SELECT 'infores:three')"


def _entries(spark, d):
    n = A.read(spark, d, "nation").select("n_name", F.col("n_nationkey").cast("string").alias("key"), F.col("n_regionkey").cast("string").alias("region"), F.col("n_nationkey").alias("k"))
    none = spark.createDataFrame([], "original string, mapped string")
    renamed = n.filter("k = 3").select(F.col("n_name").alias("original"), F.lit("infores:three").alias("mapped"))
    infores = N.registry_entries(n.filter("k % 2 = 0").withColumn("name", F.col("n_name")).withColumn("n_name", F.concat(F.lit("infores:"), "n_name")), none, "n_name", "infores", ["name", "region"])
    registry = N.registry_entries(n.filter("k % 3 = 0").withColumn("name", F.concat(F.lit("reg|"), "n_name")), renamed, "n_name", "kgregistry", ["name", "key"])
    return infores, registry, n.select(F.concat(F.lit("infores:"), F.lower("n_name")).alias("id")).union(renamed.select("mapped"))


@query(f"WITH {ENTRIES} SELECT * FROM infores UNION ALL SELECT * FROM registry")
def doc_02_registry_entries(spark, d):
    infores, registry, _ = _entries(spark, d)
    return infores.unionByName(registry)


@query(f"WITH {ENTRIES}, {WANTED}, m AS (SELECT id, source, property, CASE WHEN property = 'region' THEN 'late' ELSE value END AS value FROM infores UNION ALL SELECT * FROM registry) SELECT id, coalesce(source, 'default') AS source, coalesce(property, 'name') AS property, CASE WHEN source IS NULL THEN id ELSE value END AS value FROM wanted LEFT JOIN m USING (id)")
def doc_03_merged_entries(spark, d):
    infores, registry, wanted = _entries(spark, d)
    return N.merge_entries([infores, registry, infores.filter("property = 'region'").withColumn("value", F.lit("late"))], wanted)


@query(f"""WITH {ENTRIES}, {WANTED}, m AS (SELECT * FROM infores UNION ALL SELECT * FROM registry), p AS (SELECT id, coalesce(max(value) FILTER (WHERE source = 'infores' AND property = 'name'), max(value) FILTER (WHERE source = 'kgregistry' AND property = 'name'), 'Unknown') AS name, coalesce(max(value) FILTER (WHERE property = 'key'), 'Unknown') AS key FROM wanted LEFT JOIN m USING (id) GROUP BY id)
SELECT id, '| ' || replace(name, '|', '\\|') || ' | ' || key || ' |' AS line FROM p""")
def doc_04_source_table(spark, d):
    infores, registry, wanted = _entries(spark, d)
    return N.markdown(N.source_table(N.merge_entries([infores, registry], wanted), ["name", "key"], ["infores", "kgregistry", "reusabledata"]), ["name", "key"])
