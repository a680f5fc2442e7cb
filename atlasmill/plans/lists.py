"""Queries on drug and disease lists, reports, projections and made-up scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import fabricate as B
from atlasmill.operators import lists as L
from atlasmill.operators import pairs as X
from atlasmill.operators import standardize as S
from atlasmill.plans.curation import _u
from atlasmill.plans.ranking import P
from atlasmill.registry import query

# --- drug lists ---

LABELS = "labels_of AS (SELECT l_suppkey AS id, CASE l_returnflag WHEN 'A' THEN 'ANDA' WHEN 'R' THEN ' bla' ELSE 'NDA' END || l_linenumber AS number, l_linestatus AS status FROM lineitem)"


def _labels(spark, d):
    kind = F.when(F.col("l_returnflag") == "A", "ANDA").when(F.col("l_returnflag") == "R", " bla").otherwise("NDA")
    own = A.read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.collect_list(F.struct(F.concat(kind, F.col("l_linenumber").cast("string")).alias("application_number"), F.col("l_linestatus").alias("marketing_status"))).alias("rows"))
    return A.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id")).join(own, "id", "left")


@query(f"WITH {LABELS} SELECT s_suppkey AS id, count(l.id) AS n_labels, count(l.id) > 0 AS is_generic, coalesce(bool_or(number LIKE ' bla%'), FALSE) AS is_biologic, coalesce(bool_or(number LIKE 'ANDA%'), FALSE) AS is_anda, coalesce(string_agg(DISTINCT status, '|' ORDER BY status), '') AS marketing_status FROM supplier LEFT JOIN labels_of l ON l.id = s_suppkey GROUP BY s_suppkey")
def ent_06_label_flags(spark, d):
    return _labels(spark, d).select("id", *[c.alias(n) for n, c in L.label_flags("rows").items()])


@query(f"""WITH {LABELS}, book AS (SELECT p_size % 10 AS bla, CASE p_size % 3 WHEN 0 THEN '351(k) biosimilar' ELSE '351(a)' END AS kind FROM part), f AS (SELECT id, string_agg(DISTINCT kind, '|' ORDER BY kind) AS bla_types, bool_or(kind LIKE '%biosimilar') AS is_biosimilar FROM labels_of JOIN book ON bla = CAST(right(number, 1) AS INT) GROUP BY id)
SELECT s_suppkey AS id, coalesce(bla_types, '') AS bla_types, coalesce(is_biosimilar, FALSE) AS is_biosimilar FROM supplier LEFT JOIN f ON f.id = s_suppkey""")
def ent_07_biosimilars(spark, d):
    book = A.read(spark, d, "part").select(F.concat(F.lit("BLA00"), (F.col("p_size") % 10).cast("string")).alias("bla_number"), F.when(F.col("p_size") % 3 == 0, " 351(k) Biosimilar").otherwise("351(a)").alias("bla_type"))
    drugs = _labels(spark, d).withColumn("numbers", F.transform("rows", lambda r: r["application_number"]))
    return L.biosimilars(drugs, "numbers", book, ["351(k) biosimilar "]).select("id", "bla_types", "is_biosimilar")


@query("SELECT s_suppkey, coalesce((SELECT bool_or(l_linestatus = 'O') FROM lineitem WHERE l_suppkey = s_suppkey), FALSE) AS is_otc FROM supplier")
def ent_08_status(spark, d):
    status = A.read(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), (F.col("l_linestatus") == "O").alias("is_otc"))
    return L.with_status(A.read(spark, d, "supplier").select("s_suppkey"), status, "s_suppkey", "is_otc")


@query("SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS INT) END AS place FROM supplier")
def ent_13_typed_drugs(spark, d):
    raw = A.read(spark, d, "supplier").select(F.concat(F.lit(" "), F.col("s_suppkey").cast("string")).alias("id"), F.concat("s_name", F.lit(" ")).alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey").cast("int").cast("string")).otherwise(" ").alias("place"))
    return L.typed(raw, {"id": "long", "name": "string", "place": "int"}, ["id", "name"])


# --- disease lists ---


@query("""WITH names AS (SELECT 'P' || p_partkey AS id, 'disease of ' || p_partkey AS name FROM part), s AS (SELECT id, FALSE AS viable FROM names WHERE CAST(substr(id, 2) AS INT) % 4 = 0), kept AS (SELECT 'P' || (CAST(substr(id, 2) AS INT) // 2) AS parent FROM s WHERE CAST(substr(id, 2) AS INT) % 8 = 0)
SELECT id, coalesce(id IN (SELECT parent FROM kept), FALSE) AS viable, FALSE AS added FROM s UNION ALL SELECT parent, TRUE, TRUE FROM kept WHERE parent NOT IN (SELECT id FROM s) AND parent IN (SELECT id FROM names)""")
def ent_15_collapsed_parents(spark, d):
    k = F.col("p_partkey")
    part = A.read(spark, d, "part")
    names = part.select(F.concat(F.lit("P"), k.cast("string")).alias("id"), F.concat(F.lit("Disease of "), k.cast("string")).alias("name"))
    note = F.concat(F.lit('parent is "'), F.expr("p_partkey div 2").cast("string"), F.lit(' of DISEASE" here'))
    listed = part.filter("p_partkey % 4 = 0").select(F.concat(F.lit("P"), k.cast("string")).alias("id"), F.lit(False).alias("viable"), F.when(k % 8 == 0, "YES").otherwise("NO").alias("keep_parent"), note.alias("notes"))
    return L.collapse_parents(listed, names).select("id", "viable", "added")


@query("SELECT s_suppkey AS id, r_name AS area, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END, 0.0) AS prevalence, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN 'x' END, 'none') AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20")
def ent_16_merged_lists(spark, d):
    s = A.read(spark, d, "supplier").withColumnRenamed("s_suppkey", "id")
    places = A.read(spark, d, "nation").filter("n_nationkey < 20").join(A.read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("area"))
    area = s.join(places, "s_nationkey").select("id", "area")
    return L.merge_lists(s.select("id"), [(area, "inner"), (s.filter("id % 3 = 0").select("id", F.col("s_acctbal").alias("prevalence")), "left"), (s.filter("id % 2 = 0").select("id", F.lit("x").alias("label")), "left")], "id", {"prevalence": 0.0, "label": "none"})


@query("SELECT p_partkey, coalesce(p_size > 45, FALSE) OR regexp_matches(p_type, 'COCC|POX$|steel virus', 'i') OR p_size % 10 = 3 AS is_infectious_disease FROM part")
def ent_17_infectious(spark, d):
    name = F.when(F.col("p_size") % 10 == 3, F.concat("p_type", F.lit(" FEVER"))).otherwise(F.col("p_type"))
    return A.read(spark, d, "part").select("p_partkey", name.alias("name"), (F.col("p_size") > 45).alias("pathogen")).select("p_partkey", L.infectious("name", "pathogen").alias("is_infectious_disease"))


@query("SELECT CAST(p_partkey AS BIGINT) AS id, p_size % 2 = 0 AS is_treatable, p_retailprice AS prevalence FROM part")
def ent_20_typed_diseases(spark, d):
    raw = A.read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_size") % 2 == 0, " TRUE").otherwise("false ").alias("is_treatable"), F.col("p_retailprice").cast("string").alias("prevalence"))
    return L.typed(raw, {"id": "long", "is_treatable": "boolean", "prevalence": "double"}, ["id"])


# The tree of diseases: parts below 600, each under the one of a tenth of its number; every third is named after its grandparent.
TREE = "tree AS (SELECT p_partkey AS k, 'D:' || p_partkey AS id, CASE WHEN p_partkey >= 10 THEN 'D:' || (p_partkey // 10) END AS parent, CASE WHEN p_partkey >= 100 AND p_partkey % 3 = 0 THEN 'Illness ' || (p_partkey // 100) || ', type ' || p_partkey WHEN p_partkey % 3 = 1 THEN 'Illness ' || (p_partkey + 1) || ' type ' || p_partkey ELSE 'Illness ' || p_partkey END AS label FROM part WHERE p_partkey < 600)"
MATCHED = f"WITH {TREE}, matched AS (SELECT t.id AS disease_id, t.label, p.id AS parent_id, lower(p.label) AS parent_label FROM tree t JOIN tree p ON p.k = t.k // 100 WHERE t.k >= 100 AND t.k % 3 = 0 AND p.k % 3 <> 1)"


def _tree(spark, d):
    k = F.col("p_partkey")
    part = A.read(spark, d, "part").filter("p_partkey < 600")
    word = lambda c: c.cast("string")
    label = F.when((k >= 100) & (k % 3 == 0), F.concat(F.lit("Illness "), word(F.expr("p_partkey div 100")), F.lit(", type "), word(k))).when(k % 3 == 1, F.concat(F.lit("Illness "), word(k + 1), F.lit(" type "), word(k))).otherwise(F.concat(F.lit("Illness "), word(k)))
    labels = part.select(F.concat(F.lit("D:"), word(k)).alias("disease_id"), label.alias("label"))
    links = part.filter("p_partkey >= 10").select(F.concat(F.lit("D:"), word(k)).alias("child"), F.concat(F.lit("D:"), word(F.expr("p_partkey div 10"))).alias("parent"))
    return labels, links


def _matched(spark, d):
    return L.subtypes(*_tree(spark, d), {"comma": r"(.+), type \d+$", "plain": r"(.+) type \d+$"})


@query(f"{MATCHED} SELECT *, 'comma' AS pattern FROM matched")
def ent_22_subtypes(spark, d):
    return _matched(spark, d)


@query(f"{MATCHED} SELECT disease_id AS subset_id, label AS subset_label, parent_id AS subset_group_id, parent_label AS subset_group_label, count(*) OVER (PARTITION BY parent_label) AS other_subsets_count FROM matched")
def ent_23_subtype_counts(spark, d):
    return L.subtype_counts(_matched(spark, d))


@query(f"{MATCHED}, m AS (SELECT k, id FROM tree WHERE k % 2 = 0), c AS (SELECT parent AS id, count(*) AS n FROM tree WHERE parent IS NOT NULL GROUP BY 1) SELECT t.id, t.k % 5 = 0 AS grouped, coalesce(CASE WHEN t.k % 2 = 0 THEN t.k END, 0) AS metric, coalesce(n, 0) AS n, parent_id AS subset_group_id FROM tree t LEFT JOIN c ON c.id = t.id LEFT JOIN matched ON disease_id = t.id")
def ent_27_merged_metrics(spark, d):
    labels, links = _tree(spark, d)
    base = labels.select(F.col("disease_id").alias("id"))
    k = F.split("id", ":")[1].cast("long")
    groupings = base.filter(k % 5 == 0).withColumn("grouped", F.lit(True))
    metrics = base.filter(k % 2 == 0).withColumn("metric", k).union(spark.createDataFrame([("", 1)], "id string, metric long"))
    members = L.subtype_counts(_matched(spark, d)).select("subset_id", "subset_group_id")
    return L.merge_metrics(base, groupings, metrics, links.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n")), members, "id", {"grouped": False, "metric": 0, "n": 0})


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'ab|c_d_e|x_y' WHEN 1 THEN '' ELSE 'p_' || p_size END AS tokens, p_partkey % 2 = 0 AS flag FROM part")
def ent_28_clean_tokens(spark, d):
    k = F.col("p_partkey")
    raw = A.read(spark, d, "part").select("p_partkey", F.when(k % 3 == 0, " C d-E| AB |x y").when(k % 3 == 1, "  ").otherwise(F.concat(F.lit("P_"), F.col("p_size").cast("string"))).alias("t"), F.when(k % 2 == 0, " True").when(k % 5 == 0, "no").alias("f"))
    return raw.select("p_partkey", L.clean_tokens("t").alias("tokens"), L.clean_flag("f").alias("flag"))


TRIPLES = f"""WITH {TREE}, triples AS (SELECT id AS subject, 'xref' AS predicate, CASE k % 4 WHEN 0 THEN 'ICD10CM:A' || (k % 9) || '.1' WHEN 1 THEN 'ICD10CM:A0-A9' WHEN 2 THEN 'ICD10CM:A' || (k % 9) ELSE 'OMIMPS:' || k END AS object FROM tree UNION ALL SELECT id, 'xref', 'OMIM:' || (k % 7) FROM tree WHERE k % 2 = 0 UNION ALL SELECT id, 'inSubset', 'grouping' FROM tree WHERE k % 17 = 0),
up AS (SELECT t.id, x.id AS above FROM tree t JOIN tree x ON x.k IN (t.k // 10, t.k // 100) AND x.k > 0), grouping_ids AS (SELECT subject AS id FROM triples WHERE predicate = 'inSubset'), ps AS (SELECT subject AS id FROM triples WHERE object LIKE 'OMIMPS:%')"""


def _triples(spark, d):
    labels, links = _tree(spark, d)
    own = labels.select(F.col("disease_id").alias("subject"), F.split("disease_id", ":")[1].cast("long").alias("k"))
    k = F.col("k")
    code = F.when(k % 4 == 0, F.concat(F.lit("ICD10CM:A"), (k % 9).cast("string"), F.lit(".1"))).when(k % 4 == 1, "ICD10CM:A0-A9").when(k % 4 == 2, F.concat(F.lit("ICD10CM:A"), (k % 9).cast("string"))).otherwise(F.concat(F.lit("OMIMPS:"), k.cast("string")))
    triples = own.select("subject", F.lit("xref").alias("predicate"), code.alias("object")).union(own.filter("k % 2 = 0").select("subject", F.lit("xref"), F.concat(F.lit("OMIM:"), (k % 7).cast("string")))).union(own.filter("k % 17 = 0").select("subject", F.lit("inSubset"), F.lit("grouping")))
    return triples, labels.select(F.col("disease_id").alias("id")), links


@query(f"{TRIPLES} SELECT subject AS id, string_agg(DISTINCT object, '; ' ORDER BY object) AS crossreferences FROM triples WHERE predicate = 'xref' AND subject IN (SELECT id FROM up) GROUP BY subject")
def ent_29_ontology_values(spark, d):
    triples, ids, links = _triples(spark, d)
    return L.ontology_values(triples, links.select(F.col("child").alias("id")), "xref", "crossreferences")


@query(f"""{TRIPLES} SELECT id, id IN (FROM grouping_ids) AS grouping_subset, id IN (SELECT above FROM up WHERE up.id IN (FROM grouping_ids)) AS grouping_ancestor, id IN (FROM ps) AS omimps, id IN (SELECT id FROM up WHERE above IN (FROM ps)) AS omimps_descendant, k % 2 = 0 AS omim,
id NOT IN (SELECT above FROM up) AS leaf, id IN (SELECT parent FROM tree WHERE parent IS NOT NULL AND id NOT IN (SELECT above FROM up)) AS leaf_parent, id IN (SELECT id FROM up WHERE above = 'D:3') AS under_three, k % 4 = 0 AS icd_category, k % 4 = 1 AS icd_chapter_code, k % 4 = 2 AS icd_chapter_header FROM tree""")
def ent_30_filter_flags(spark, d):
    triples, ids, links = _triples(spark, d)
    grouping, series = L.in_subset(triples, "grouping"), L.with_reference(triples, "^OMIMPS:")
    members = {"grouping_subset": grouping, "grouping_ancestor": L.above(links, grouping), "omimps": series, "omimps_descendant": L.below(links, series), "omim": L.with_reference(triples, "^OMIM:"), "leaf": L.leaves(ids, links), "leaf_parent": L.leaf_parents(ids, links), "under_three": L.below(links, spark.createDataFrame([("D:3",)], "id string"))}
    return L.flag_members(ids, members | {name: L.with_reference(triples, form) for name, form in L.ICD_FORMS.items()})


@query(f"{MATCHED} SELECT DISTINCT parent_id AS subject, 'inSubset' AS predicate, 'subtype_group' AS object FROM matched")
def ent_32_subset_rows(spark, d):
    return L.subset_rows(_matched(spark, d), "subtype_group")


# --- reports, projection, made-up scores ---


@query(f"{P} SELECT 'sources' AS report, count(DISTINCT source) AS n FROM pairs UNION ALL SELECT 'known', count(*) FROM pairs WHERE y IS NOT NULL")
def mat_14_reports(spark, d):
    made = X.reports(A.pairs(spark, d), [("sources", lambda m: m.select("source").distinct()), ("known", lambda m: m.filter("y is not null"))])
    return made["sources"].agg(F.lit("sources").alias("report"), F.count(F.lit(1)).alias("n")).union(made["known"].agg(F.lit("known"), F.count(F.lit(1))))


@query()
def emb_06_projection(spark, d):
    """Principal components have no SQL form; a test checks shape and variance."""
    reduced = S.reduce_vectors(A.read(spark, d, "embeddings").select("vec_id", "label", "embedding"), "embedding", 2)
    return reduced.select("vec_id", "label", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))


_A, _B = _u("concat('9|a|', s_suppkey)"), _u("concat('9|b|', s_suppkey)")


@query(f"SELECT s_suppkey, round(5 + 10 * {_A}, 6) AS uniform, round(100 + 15 * sqrt(-2 * ln(1 - {_A})) * cos(2 * pi() * {_B}), 6) AS normal, round(-3 * ln(1 - {_A}), 6) AS exponential FROM supplier")
def fab_04_distributions(spark, d):
    a, b = B.share(9, "a", "s_suppkey"), B.share(9, "b", "s_suppkey")
    return A.read(spark, d, "supplier").select("s_suppkey", F.round(B.uniform(a, 5, 15), 6).alias("uniform"), F.round(B.normal(a, b, 100, 15), 6).alias("normal"), F.round(B.exponential(a, 3), 6).alias("exponential"))


@query("SELECT c || '-' || r AS pair FROM (VALUES ('x'), ('y')) a(c) CROSS JOIN (SELECT r_name AS r FROM region)")
def fab_07_products(spark, d):
    return A.read(spark, d, "region").select(F.explode(B.crossed(["x", "y"], F.array("r_name"))).alias("p")).select(F.concat_ws("-", "p.a", "p.b").alias("pair"))


_S = _u("concat('2|score|', source, '|', target)")


@query(f"{P} SELECT source, target, round(CASE y WHEN 1 THEN pow({_S}, 0.1) WHEN 0 THEN 1 - pow(1 - {_S}, 0.1) ELSE {_S} END, 6) AS made FROM pairs")
def fab_11_scores(spark, d):
    u = B.share(2, "score", "source", "target")
    return A.pairs(spark, d).select("source", "target", F.round(B.skewed_score(u, F.col("y") == 1, F.col("y") == 0, 10), 6).alias("made"))
