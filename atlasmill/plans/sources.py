"""Queries on source mappings, graph-store exports, ontology flags and lists, made-up datasets, walks and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import fabricate as B
from atlasmill.operators import graph
from atlasmill.operators import ontology as O
from atlasmill.operators import source_maps as S
from atlasmill.operators import tuning, walks
from atlasmill.plans.curation import _u
from atlasmill.plans.graph import KG
from atlasmill.registry import query
from atlasmill.sources import tables

DEPTHS = {"biolink:NamedThing": 0, "biolink:ChemicalEntity": 1, "biolink:Drug": 2, "biolink:BiologicalEntity": 1, "biolink:Disease": 2}
CATEGORIES = "CASE p_size % 3 WHEN 0 THEN 'biolink:NamedThing|biolink:Disease' WHEN 1 THEN 'biolink:Drug|biolink:ChemicalEntity|other:X' ELSE '' END"
SPECIFIC = "CASE p_size % 3 WHEN 0 THEN 'biolink:Disease' WHEN 1 THEN 'biolink:Drug' END"
ALL = f"nullif({CATEGORIES}, '')"


def _part(spark, d):
    size = F.col("p_size") % 3
    category = F.when(size == 0, "biolink:NamedThing|biolink:Disease").when(size == 1, "biolink:Drug|biolink:ChemicalEntity|other:X").otherwise("")
    return A.read(spark, d, "part").select(F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("description"), category.alias("category"), F.concat_ws("|", "p_brand", "p_type").alias("equivalent_identifiers"))


def _lines(spark, d):
    text = lambda c: F.col(c).cast("string")
    return A.read(spark, d, "lineitem").select(
        F.concat(F.lit("SUPP:"), text("l_suppkey")).alias("subject"), F.concat(F.lit("rel_"), F.col("l_returnflag")).alias("predicate"), F.concat(F.lit("PART:"), text("l_partkey")).alias("object"),
        F.col("l_linestatus").alias("primary_knowledge_source"), F.concat_ws("|", "l_returnflag", "l_linestatus").alias("aggregator_knowledge_source"), F.concat_ws("|", F.concat(F.lit("PMID:"), text("l_orderkey")), F.concat(F.lit("PMID:"), text("l_linenumber"))).alias("publications"),
        F.col("l_quantity").cast("long").cast("string").alias("score"), F.col("l_linenumber").cast("long").cast("string").alias("n"), F.col("l_linestatus").alias("agent_type"),
    )


def _shown(df):
    """Arrays as text, so that both engines show them alike."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


NODE_COLUMNS = ["id", "name", "category", "description", "equivalent_identifiers", "all_categories", "labels", "upstream_data_source"]


@query(f"SELECT 'PART:' || p_partkey AS id, p_name AS name, {SPECIFIC} AS category, p_brand AS description, p_brand || '|' || p_type AS equivalent_identifiers, {ALL} AS all_categories, {ALL} AS labels, 'robokop' AS upstream_data_source, v AS version FROM part CROSS JOIN (VALUES ('c5ec1f282158182f'), ('30fd1bfc18cd5ccb'), ('30fd1bfc18cd5ccb.1')) t(v)")
def trf_07_robokop_nodes(spark, d):
    raw = _part(spark, d)
    old = raw.withColumnsRenamed({"id": "id:ID", "name": "name:string", "description": "description:string", "category": "category:LABEL", "equivalent_identifiers": "equivalent_identifiers:string[]"})
    made = [S.standard(old if v.startswith("c5") else raw, table(), S.NODE, DEPTHS).withColumn("version", F.lit(v)) for v, table in S.ROBOKOP_NODES.items()]
    return _shown(graph.union_all(made).select(*NODE_COLUMNS, "version"))


LINES = "l AS (SELECT 'SUPP:' || l_suppkey AS subject, 'rel_' || l_returnflag AS predicate, 'PART:' || l_partkey AS object, l_linestatus AS pks, l_returnflag || '|' || l_linestatus AS aks, 'PMID:' || l_orderkey || '|PMID:' || l_linenumber AS pubs, CAST(CAST(l_quantity AS BIGINT) AS FLOAT) AS score, CAST(l_linenumber AS INT) AS n FROM lineitem)"


@query(f"WITH {LINES} SELECT subject, predicate, object, pks AS primary_knowledge_source, aks AS aggregator_knowledge_source, pubs AS publications, score AS has_confidence_score, CASE v WHEN 'new' THEN 'q' ELSE CAST(NULL AS VARCHAR) END AS onset_qualifier, CAST(NULL AS VARCHAR) AS subject_aspect_qualifier, CAST(NULL AS INT) AS num_references, pks AS agent_type, v AS version FROM l CROSS JOIN (VALUES ('old'), ('new')) t(v)")
def trf_07_robokop_edges(spark, d):
    raw = _lines(spark, d)
    none = F.lit(None).cast("string")
    new = raw.withColumn("Combined_score", F.col("score")).withColumns({c: none for c in {*S.ROBOKOP_EDGES["30fd1bfc18cd5ccb"]().take.values()} - {*raw.columns, "Combined_score"}}).withColumn("onset_qualifier", F.lit("q"))
    legacy = S.ROBOKOP_EDGES["c5ec1f282158182f"]()
    old = raw.withColumn("Combined_score:string", F.col("score")).withColumnsRenamed({"subject": "subject:START_ID", "predicate": "predicate:TYPE", "object": "object:END_ID", "aggregator_knowledge_source": "aggregator_knowledge_source:string[]", "publications": "publications:string[]", "primary_knowledge_source": "primary_knowledge_source:string", "agent_type": "agent_type:string"})
    old = old.withColumns({c: none for c in {*legacy.take.values()} - {*old.columns}})
    made = S.standard(old, legacy, S.EDGE).withColumn("version", F.lit("old")).unionByName(S.standard(new, S.ROBOKOP_EDGES["30fd1bfc18cd5ccb.1"](), S.EDGE).withColumn("version", F.lit("new")))
    return _shown(made.select("subject", "predicate", "object", "primary_knowledge_source", "aggregator_knowledge_source", "publications", "has_confidence_score", "onset_qualifier", "subject_aspect_qualifier", "num_references", "agent_type", "version"))


@query(f"SELECT 'PART:' || p_partkey AS id, CASE v WHEN 'V5.7' THEN 'PART:' || p_partkey ELSE p_name END AS name, {SPECIFIC} AS category, CASE v WHEN 'V5.2' THEN p_brand END AS description, {ALL} AS all_categories, 'spoke' AS upstream_data_source, v AS version FROM part CROSS JOIN (VALUES ('V5.7'), ('V5.2')) t(v)")
def trf_08_spoke_nodes(spark, d):
    raw = _part(spark, d)
    made = S.standard(raw.union(raw), S.SPOKE_NODES["V5.7"](), S.NODE, DEPTHS).withColumn("version", F.lit("V5.7")).unionByName(S.standard(raw, S.SPOKE_NODES["V5.2"](), S.NODE, DEPTHS).withColumn("version", F.lit("V5.2")))
    return _shown(made.select("id", "name", "category", "description", "all_categories", "upstream_data_source", "version"))


@query(f"WITH {LINES} SELECT DISTINCT subject, 'biolink:' || predicate AS predicate, object, 'spoke' AS upstream_data_source, CAST(NULL AS FLOAT) AS affinity FROM l UNION ALL SELECT subject, predicate, object, 'spoke', NULL FROM l")
def trf_08_spoke_edges(spark, d):
    raw = _lines(spark, d)
    both = [S.standard(raw, S.SPOKE_EDGES[v](), S.EDGE) for v in ("V5.7", "V5.2")]
    return _shown(graph.union_all(both).select("subject", "predicate", "object", "upstream_data_source", "affinity"))


@query(f"WITH {LINES} SELECT 'PART:' || p_partkey AS id, {CATEGORIES} AS category, {ALL} AS all_categories, {ALL} AS labels, p_name AS name, 'primekg' AS upstream_data_source, (SELECT count(*) FROM l WHERE object = 'PART:' || p_partkey) AS n_edges, (SELECT max(pubs) FROM l WHERE object = 'PART:' || p_partkey) AS publications FROM part")
def trf_09_primekg(spark, d):
    raw = _lines(spark, d).withColumns({c: F.lit(None).cast("string") for c in ("subject_aspect_qualifier", "object_aspect_qualifier", "object_direction_qualifier", "knowledge_level")})
    edges = S.standard(raw, S.PRIMEKG_EDGES["2.1"](), S.EDGE)
    by_end = edges.groupBy(F.col("object").alias("id")).agg(F.count(F.lit(1)).alias("n_edges"), F.max(F.array_join("publications", "|")).alias("publications"))
    nodes = _shown(S.standard(_part(spark, d), S.PRIMEKG_NODES["2.1"](), S.NODE).select("id", "category", "all_categories", "labels", "name", "upstream_data_source"))
    return nodes.join(by_end, "id", "left").withColumn("n_edges", F.coalesce("n_edges", F.lit(0)))


@query(f"WITH {LINES} SELECT subject, predicate, object, n AS num_references, n AS num_sentences, pubs AS publications, 'embiology' AS upstream_data_source, CAST(NULL AS VARCHAR) AS primary_knowledge_source FROM l UNION ALL SELECT 'PART:' || p_partkey, {CATEGORIES}, {ALL}, NULL, NULL, p_brand || '|' || p_type, 'embiology', NULL FROM part")
def trf_10_embiology(spark, d):
    edges = _shown(S.standard(_lines(spark, d).withColumn("num_references", F.col("n")).withColumn("num_sentences", F.col("n")), S.EMBIOLOGY_EDGES["latest"](), S.EDGE).select("subject", "predicate", "object", "num_references", "num_sentences", "publications", "upstream_data_source", "primary_knowledge_source"))
    nodes = _shown(S.standard(_part(spark, d).withColumn("all_categories", F.col("category")), S.EMBIOLOGY_NODES["latest"](), S.NODE))
    none = F.lit(None)
    return edges.union(nodes.select("id", "category", "all_categories", none, none, "equivalent_identifiers", "upstream_data_source", none))


MEDICAL = "m AS (SELECT CASE WHEN p_partkey % 5 <> 0 THEN 'C:' || (p_partkey // 2) END AS c, p_name AS label, p_type AS types FROM part)"


@query(f"WITH {MEDICAL}, e AS (SELECT DISTINCT 'C:' || l_suppkey AS s, 'biolink::' || l_returnflag AS p, 'C:' || l_partkey AS o FROM lineitem WHERE l_suppkey % 4 <> 0) SELECT c AS subject, 'node' AS predicate, min(label || '|' || types) AS object, 'ec_medical' AS upstream_data_source, NULL AS publications FROM m WHERE c IS NOT NULL GROUP BY c UNION ALL SELECT s, p, o, 'ec_medical', 'medical team' FROM e")
def trf_11_medical(spark, d):
    k = F.col("p_partkey")
    raw = A.read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.when(k % 5 != 0, F.concat(F.lit("C:"), F.expr("cast(p_partkey div 2 as string)"))).alias("normalized_curie"), F.col("p_name").alias("label"), F.col("p_type").alias("types"))
    nodes = S.standard(raw, S.medical_node_table(once=False), S.NODE).groupBy(F.col("id").alias("subject")).agg(F.lit("node").alias("predicate"), F.min(F.concat("name", F.lit("|"), F.col("all_categories")[0])).alias("object"), F.lit("ec_medical").alias("upstream_data_source"), F.lit(None).cast("string").alias("publications"))
    lines = A.read(spark, d, "lineitem").select(F.when(F.col("l_suppkey") % 4 != 0, F.concat(F.lit("C:"), F.col("l_suppkey").cast("string"))).alias("SourceId"), F.concat(F.lit("C:"), F.col("l_partkey").cast("string")).alias("TargetId"), F.col("l_returnflag").alias("Label"))
    edges = S.standard(lines, S.medical_edge_table(), S.EDGE)
    return nodes.union(_shown(edges.select("subject", "predicate", "object", "upstream_data_source", "publications")))


@query("WITH e AS (SELECT 'C:' || l_suppkey AS subject, 'EC:' || l_suppkey AS subject_ec_id, 'D:' || l_partkey AS object, l_linenumber FROM lineitem) SELECT subject, subject_ec_id, object, l_linenumber, 'off_label' AS predicate, 1 AS y FROM e UNION ALL SELECT DISTINCT x, NULL, NULL, NULL, 'id', NULL FROM (SELECT subject AS x FROM e UNION ALL SELECT object FROM e)")
def trf_13_off_label(spark, d):
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    raw = A.read(spark, d, "lineitem").select(text("C:", "l_suppkey").alias("curie_drug"), text("EC:", "l_suppkey").alias("ec_drug_id"), text("D:", "l_partkey").alias("curie_disease"), "l_linenumber")
    edges, ids = S.off_label_pairs(raw)
    none = F.lit(None)
    return edges.select("subject", "subject_ec_id", "object", "l_linenumber", "predicate", "y").union(ids.select("id", none, none, none, F.lit("id"), none))


@query("SELECT 'drug' AS list, 'T:' || s_suppkey AS id, CAST(s_suppkey AS VARCHAR) AS ec_id, 'biolink:Drug' AS category, CAST(NULL AS VARCHAR) AS object FROM supplier UNION ALL SELECT 'disease', 'D:' || p_partkey, NULL, 'biolink:Disease', NULL FROM part UNION ALL SELECT 'indication', 'T:' || l_suppkey, CAST(l_suppkey AS VARCHAR), 'JaM', 'D:' || l_partkey FROM lineitem UNION ALL SELECT DISTINCT 'ids', x, NULL, NULL, NULL FROM (SELECT 'T:' || l_suppkey AS x FROM lineitem UNION ALL SELECT 'D:' || l_partkey FROM lineitem)")
def trf_17_lists(spark, d):
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    drugs = S.drug_nodes(A.read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), text("T:", "s_suppkey").alias("translator_id")))
    diseases = S.disease_nodes(A.read(spark, d, "part").select(text("D:", "p_partkey").alias("id")))
    edges, ids = S.indication_pairs(A.read(spark, d, "lineitem").select(text("T:", "l_suppkey").alias("translator_id"), F.col("l_suppkey").cast("string").alias("ec_id"), text("D:", "l_partkey").alias("target")))
    none = F.lit(None).cast("string")
    out = drugs.select(F.lit("drug").alias("list"), "id", "ec_id", "category", none.alias("object")).union(diseases.select(F.lit("disease"), "id", none, "category", none))
    return out.union(edges.select(F.lit("indication"), "subject", "subject_ec_id", "predicate", "object")).union(ids.select(F.lit("ids"), "id", none, none, none))


@query(f"{KG} SELECT id, category AS label, 'name|category|description' AS keys, coalesce(name, '') || '|' || category AS values, array_to_string(upstream_data_source, '|') AS arrays FROM nodes")
def src_15_graph_nodes(spark, d):
    raw = A.nodes(spark, d).withColumn("description", F.lit(None).cast("string")).withColumn("publications", F.lit(None).cast("array<string>"))
    return tables.graph_nodes(raw).select("id", "label", F.array_join("property_keys", "|").alias("keys"), F.array_join("property_values", "|").alias("values"), F.array_join(F.col("array_property_values")[0], "|").alias("arrays"))


@query(f"{KG} SELECT subject, object, split_part(predicate, ':', 2) AS label, publication AS publications FROM edges")
def src_15_graph_edges(spark, d):
    raw = A.edges(spark, d).withColumn("upstream_data_source", F.array("upstream")).withColumn("publications", F.array("publication")).withColumn("aggregator_knowledge_source", F.lit(None).cast("array<string>"))
    return tables.graph_edges(raw).select("subject", "object", "label", F.col("publications")[0].alias("publications"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def src_16_live_rows(spark, d):
    return tables.live_rows(A.read(spark, d, "orders").withColumn("deleted", F.col("o_orderstatus") == "F"), ["o_orderkey"]).select("o_orderkey")


# --- ontology: a tree of parts (parent: the key over ten) ---

#: names of subsets and forms of references that the made-up terms have, by the term's number
MARKS = ["clingen", "susceptibility_match", "mondo_subtype", "disease_grouping", "obsoletion_candidate", "ordo_subtype_of_a_disorder", "ordo_disorder", "icd10_billable"]
TERMS = """t AS (SELECT p_partkey AS k, CASE p_partkey WHEN 1 THEN 'MONDO:0004995' WHEN 2 THEN 'MONDO:0005267' WHEN 3 THEN 'MONDO:0021166' WHEN 4 THEN 'MONDO:0002025' WHEN 5 THEN 'MONDO:0045024' ELSE 'MONDO:X' || p_partkey END AS id, p_name FROM part WHERE p_partkey > 0),
up AS (SELECT t.k, x.k AS above FROM t JOIN t x ON x.k > 0 AND x.k IN (t.k // 10, t.k // 100, t.k // 1000, t.k // 10000, t.k // 100000))"""


def _terms(spark, d):
    k = F.col("p_partkey").cast("long")
    named = F.concat(F.lit("MONDO:X"), k.cast("string"))
    for number, root in enumerate(O.ROOTS.values(), 1):
        named = F.when(k == number, root).otherwise(named)
    terms = A.read(spark, d, "part").filter("p_partkey > 0").select(k.alias("k"), named.alias("id"), "p_name")
    links = terms.select(F.col("id").alias("child"), F.expr("k div 10").alias("up")).join(terms.select(F.col("k").alias("up"), F.col("id").alias("parent")), "up").select("child", "parent")
    marks = F.element_at(F.array(*[F.lit(m) for m in MARKS]), (F.col("k") % 31 + 1).cast("int"))
    subset = terms.filter(f"k % 31 < {len(MARKS)}").select(F.col("id").alias("subject"), F.lit("inSubset").alias("predicate"), marks.alias("object"))
    m, n = F.col("k") % 7, F.col("k").cast("string")
    code = F.when(m == 0, F.concat(F.lit("OMIMPS:"), n)).when(m == 1, F.concat(F.lit("OMIM:"), n)).when(m == 2, F.concat(F.lit("ICD10CM:A"), n, F.lit(".1"))).when(m == 3, F.lit("ICD10CM:A0-A9")).when(m == 4, F.concat(F.lit("ICD10CM:A"), n))
    return terms, links, subset.union(terms.filter("k % 7 < 5").select("id", F.lit("xref"), code))


def _flag_sql() -> str:
    subset = {n: f"k % 31 IN ({', '.join(str(MARKS.index(x)) for x in s if x in MARKS) or '-1'})" for n, s in O.SUBSETS.items()}
    refs = {n: f"k % 7 = {i}" for i, n in enumerate(["omimps", "omim", "icd_category", "icd_chapter_code", "icd_chapter_header"])}
    roots = {n: f"(k = {i} OR EXISTS (SELECT 1 FROM up WHERE up.k = t.k AND above = {i}))" for i, n in enumerate(O.ROOTS, 1)}
    more = {"orphanet_subtype_descendant": "EXISTS (SELECT 1 FROM up WHERE up.k = t.k AND above % 31 = 5)", "omimps_descendant": "EXISTS (SELECT 1 FROM up WHERE up.k = t.k AND above % 7 = 0)", "grouping_subset_ancestor": "EXISTS (SELECT 1 FROM up WHERE above = t.k AND up.k % 31 = 3)", "leaf": "t.k NOT IN (SELECT above FROM up)", "leaf_direct_parent": "t.k IN (SELECT x.k // 10 FROM t x WHERE x.k NOT IN (SELECT above FROM up))"}
    return ", ".join(f"{sql} AS {n}" for n, sql in (subset | refs | roots | more).items())


@query(f"WITH {TERMS} SELECT id, {_flag_sql()} FROM t")
def ent_30_all_flags(spark, d):
    terms, links, triples = _terms(spark, d)
    return O.disease_flags(terms.select("id"), triples, links)


@query(f"WITH {TERMS}, f AS (SELECT id, {_flag_sql()} FROM t) SELECT id, leaf OR (leaf_direct_parent AND (omim OR omimps_descendant OR icd_category OR orphanet_disorder OR orphanet_subtype)) OR icd_category OR orphanet_disorder OR clingen OR omim AS included FROM f")
def ent_24_included(spark, d):
    terms, links, triples = _terms(spark, d)
    return O.disease_flags(terms.select("id"), triples, links).select("id", O.included_disease().alias("included"))


@query(f"WITH {TERMS} SELECT 'label' AS kind, id, p_name AS a, NULL AS b FROM t UNION ALL SELECT 'version', 'mondo.owl', 'v' || (SELECT count(*) FROM t), NULL UNION ALL SELECT 'obsolete', id, 'MONDO:X' || (k + 1) || '|MONDO:X' || (k + 2), CASE WHEN k % 22 = 0 THEN 'MONDO:X1' ELSE '' END FROM t WHERE k % 11 = 0")
def ent_31_ontology_tables(spark, d):
    terms, _, _ = _terms(spark, d)
    row = lambda df, p, o: df.select(F.col("id").alias("subject"), F.lit(p).alias("predicate"), o.alias("object"))
    old = terms.filter("k % 11 = 0")
    other = lambda n: F.concat(F.lit("MONDO:X"), (F.col("k") + n).cast("string"))
    triples = row(terms, "label", F.col("p_name")).union(row(old, "deprecated", F.lit("true"))).union(row(terms.filter("k % 11 = 1"), "deprecated", F.lit("false"))).union(row(old, "replaced_by", other(2))).union(row(old, "replaced_by", other(1))).union(row(old.filter("k % 22 = 0"), "consider", F.lit("MONDO:X1")))
    triples = triples.union(spark.createDataFrame([("mondo.owl", "type", "Ontology"), ("mondo.owl", "versionIRI", f"v{terms.count()}"), ("other", "label", "x")], "subject string, predicate string, object string"))
    none = F.lit(None).cast("string")
    out = O.term_labels(triples, "MONDO:").select(F.lit("label").alias("kind"), "id", F.col("label").alias("a"), none.alias("b"))
    return out.union(O.ontology_versions(triples).select(F.lit("version"), "ontology", "version", none)).union(O.obsolete_terms(triples, "MONDO:").select(F.lit("obsolete"), "id", "replacements", "considers"))


@query("SELECT s_suppkey AS id, upper(substr(s_name, 1, 1)) || lower(substr(s_name, 2)) AS name, 'Abc|Def ghi' AS synonyms, CASE WHEN s_suppkey % 2 = 0 THEN 'T' || s_suppkey END AS translator_id, s_suppkey % 3 = 0 AS is_fda_generic_drug FROM supplier WHERE s_name NOT IN (SELECT s_name FROM supplier WHERE s_suppkey = 4)")
def ent_12_final_drug_list(spark, d):
    raw = A.read(spark, d, "supplier")
    curated = raw.select(F.col("s_suppkey").alias("id"), F.lower("s_name").alias("name"), F.array(F.lit(" abc"), F.lit("DEF ghi ")).alias("synonyms"))
    curie = raw.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("translator_id"))
    generic = raw.filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.lit(True).alias("is_fda_generic_drug"))
    out = [r["s_name"].lower() for r in raw.filter("s_suppkey = 4").select("s_name").collect()]  # one row
    return _shown(O.merge_drug_lists(curated, [curie, generic], ["id", "name", "synonyms", "translator_id", "is_fda_generic_drug"], out))


BAND = "CASE WHEN {v} < 1 THEN '<1 in 100,000' WHEN {v} < 10 THEN '1-9 in 100,000' WHEN {v} < 100 THEN '10-99 in 100,000' WHEN {v} < 1000 THEN '100-999 in 100,000' WHEN {v} < 10000 THEN '1,000-9,999 in 100,000' ELSE printf('%.2f', {v}) || ' in 100,000' END"


@query(f"WITH e AS (SELECT l_suppkey AS id, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey * 1000 / 8e9 * 100000 ELSE l_orderkey / 1000000.0::DOUBLE * 100000 * (CASE WHEN l_linenumber % 3 = 0 THEN 0.25 ELSE 1 END) END AS v FROM lineitem), c AS (SELECT id, {BAND.format(v='v')} AS b, count(*) AS n FROM e GROUP BY ALL), m AS (SELECT id, b, row_number() OVER (PARTITION BY id ORDER BY n DESC, b) AS r FROM c) SELECT e.id, {BAND.format(v='avg(v)')} AS mean_band, {BAND.format(v='min(v)')} AS least_band, max(m.b) AS mode_band FROM e JOIN m ON m.id = e.id AND r = 1 GROUP BY e.id")
def ent_33_prevalence(spark, d):
    line, none = F.col("l_linenumber"), F.lit(None).cast("double")
    raw = A.read(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.when(line % 2 == 0, "number").otherwise("share").alias("kind"), F.when(line % 2 == 0, F.col("l_orderkey") * 1000.0).otherwise(F.col("l_orderkey").cast("double")).alias("num"), F.lit(1e6).alias("den"), F.when((line % 2 == 1) & (line % 3 == 0), F.lit(25.0)).alias("sub"), none.alias("grp"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    v = raw.select("id", O.prevalence_100k("kind", "num", "den", "sub", "grp").alias("v"), "file", "row")
    mean, least, mode = (O.prevalence_consensus(v, "id", "v", s, unclear_above=None, order=["file", "row"]).withColumnRenamed("prevalence", f"{n}_band") for n, s in (("mean", "mean"), ("least", "lowest"), ("mode", "mode")))
    return mean.join(least, "id").join(mode, "id")


# --- made-up datasets ---


@query(f"""WITH n AS (SELECT count(*) AS n FROM supplier), r AS (SELECT unnest(range(0, (SELECT n FROM n))) AS row), nodes AS (SELECT row, 'N:' || lpad(CAST(row + 1 AS VARCHAR), 6, '0') AS id, CASE WHEN {_u("concat('3|nodes.kind|', row)")} < 0.75 THEN 'a' ELSE 'b' END AS kind FROM r),
e AS (SELECT row, CAST(floor({_u("concat('3|edges.subject|', row)")} * (SELECT n FROM n)) AS BIGINT) AS place, {_u("concat('3|edges.weight?|', row)")} AS u FROM (SELECT unnest(range(0, (SELECT n * 2 FROM n))) AS row))
SELECT 'node' AS kind, id, kind AS value FROM nodes UNION ALL SELECT 'edge', 'N:' || lpad(CAST(place + 1 AS VARCHAR), 6, '0'), CASE WHEN u >= 0.25 THEN CAST(row % 7 AS VARCHAR) END FROM e""")
def fab_09_instructions(spark, d):
    n = A.read(spark, d, "supplier").count()
    plan = {
        "edges": {"num_rows": "@_double.num_rows", "columns": {"subject": {"type": "reference", "from": "nodes.id"}, "weight": {"type": "expression", "sql": "cast(row % 7 as string)", "nulls": 0.25}}},
        "_double": {"num_rows": 2 * n, "columns": {"id": {"type": "id"}}},
        "nodes": {"num_rows": "@base.num_rows", "columns": {"id": {"type": "id", "prefix": "N:", "width": 6}, "kind": {"type": "choice", "values": ["a", "b"], "weights": [3, 1]}}},
    }
    made = B.datasets(spark, plan, 3, {"base": A.read(spark, d, "supplier")})
    return made["nodes"].select(F.lit("node").alias("kind"), "id", F.col("kind").alias("value")).union(made["edges"].select(F.lit("edge"), "subject", "weight"))


_CLASSES = [(c, a) for c in A.CATEGORY_PARENT for a in A.ancestors(c, A.CATEGORY_PARENT)]
_SLOTS = [("biolink:related_to", "biolink:NamedThing", "biolink:NamedThing"), ("biolink:treats", "biolink:ChemicalEntity", "biolink:Disease"), ("biolink:located_in", "biolink:BiologicalEntity", "biolink:GeographicLocation")]


@query(f"""WITH c(name, ancestor) AS (VALUES {', '.join(map(str, _CLASSES))}), s(predicate, domain, range_) AS (VALUES {', '.join(map(str, _SLOTS))}), t AS (SELECT DISTINCT a.name AS sc, predicate, b.name AS oc FROM s JOIN c a ON a.ancestor = domain JOIN c b ON b.ancestor = range_),
k AS (SELECT *, md5('5|' || sc || '|' || predicate || '|' || oc || '|' || n) AS key FROM t CROSS JOIN (SELECT row_number() OVER () AS n FROM region)) SELECT 'S:' || key AS subject, predicate, 'O:' || key AS object, sc AS subject_category, oc AS object_category FROM k""")
def fab_10_sample_graph(spark, d):
    triples = B.valid_predicates(spark.createDataFrame(_SLOTS, "predicate string, domain string, range string"), spark.createDataFrame(_CLASSES, "name string, ancestor string"))
    nodes, edges = B.sample_graph(triples, A.read(spark, d, "region").count(), 5)
    return graph.with_categories(edges, nodes)


# --- walks and tuning ---


@query(f"{KG}, b AS (SELECT DISTINCT subject AS u, object AS v FROM edges UNION SELECT object, subject FROM edges), n AS (SELECT u, count(*) AS n FROM b WHERE u <> v GROUP BY u) SELECT u AS id, 2 AS walks, 4 AS nodes, TRUE AS linked FROM n")
def emb_04_walks(spark, d):
    """Two walks of four nodes from every node, each step along an edge."""
    pairs = graph.simple_pairs(A.edges(spark, d))
    found = walks.random_walks(pairs, 4, 2, 9)
    step = found.select("start", "walk", (F.col("step") + 1).alias("step"), F.col("node").alias("before"))
    pair = found.join(step, ["start", "walk", "step"]).select("start", F.least("node", "before").alias("u"), F.greatest("node", "before").alias("v"))
    linked = pair.join(pairs.withColumn("ok", F.lit(True)), ["u", "v"], "left").groupBy("start").agg(F.coalesce(F.min("ok"), F.lit(False)).alias("linked"), (F.count("ok") == F.count(F.lit(1))).alias("whole"))
    return found.groupBy("start").agg(F.count_distinct("walk").cast("int").alias("walks"), F.count_distinct("step").cast("int").alias("nodes")).join(linked, "start").select(F.col("start").alias("id"), "walks", "nodes", (F.col("linked") & F.col("whole")).alias("linked"))


@query()
def mdl_14_gaussian_search(spark, d):
    """(weight, limit, accuracy) of a rule on order lines, all that the search tried; every batch is judged in one pass."""
    lines = A.read(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("q"), F.col("l_discount").alias("x"), (F.col("l_quantity") * (1 - F.col("l_discount")) > 24).alias("y"))

    def score(batch):
        row = lines.agg(*[F.avg(((F.col("q") - p["weight"] * F.col("x") > p["limit"]) == F.col("y")).cast("double")).alias(str(k)) for k, p in enumerate(batch)]).first()
        return [row[str(k)] for k in range(len(batch))]

    _, _, tried = tuning.gaussian_search(score, {"weight": (0.0, 1.0), "limit": (0.0, 1.0)}, calls=20, seed=1)
    return spark.createDataFrame([(p["weight"], p["limit"], v) for p, v in tried], "weight double, limit double, accuracy double")
