"""Queries on validation, fabrication, standardisation, text vectors, raw-source cleaning and curated lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlasmill import adapters as A
from atlasmill.operators import checks as V
from atlasmill.operators import curation as U
from atlasmill.operators import fabricate as B
from atlasmill.operators import standardize as S
from atlasmill.plans.graph import KG
from atlasmill.registry import query


def _n(name="n"):
    return F.count(F.lit(1)).alias(name)


def _u(sql: str) -> str:
    """SQL of the number in [0, 1) that ``fabricate.share`` gives for the same joined text."""
    return f"(CAST(('0x' || substr(md5({sql}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


# --- validation ---


@query("SELECT 'curie' AS rule, count(*) AS n FROM customer WHERE NOT regexp_matches(c_name, '^[A-Za-z_][A-Za-z0-9_.-]*:[^\\s:][^\\s]*$') UNION ALL SELECT 'outer_space', count(*) FILTER (WHERE regexp_matches(c_mktsegment, '^\\s|\\s$')) FROM customer UNION ALL SELECT 'segment', count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) FROM customer UNION ALL SELECT 'range', count(*) FILTER (WHERE NOT c_acctbal BETWEEN 0 AND 5000) FROM customer")
def val_01_rule_violations(spark, d):
    c = A.read(spark, d, "customer")
    return V.violations(c, {"curie": V.is_curie("c_name"), "outer_space": ~V.has_outer_space("c_mktsegment"), "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "range": F.col("c_acctbal").between(0, 5000)})


@query(f"{KG} SELECT 'prefix' AS rule, count(*) FILTER (WHERE NOT starts_with(predicate, 'biolink:')) AS n FROM edges UNION ALL SELECT 'pipes', count(*) FILTER (WHERE contains(publication, '|')) FROM edges")
def val_02_vocabulary(spark, d):
    return V.violations(A.edges(spark, d), {"prefix": V.starts_with_vocabulary("predicate"), "pipes": ~F.col("publication").contains("|")})


@query(f"{KG} SELECT 'known_prefix' AS rule, count(*) FILTER (WHERE NOT (contains(lower(id), 'supp') OR contains(lower(id), 'part'))) AS n FROM nodes")
def val_04_known_prefix(spark, d):
    return V.violations(A.nodes(spark, d), {"known_prefix": V.contains_any("id", ["Supp", "PART"])})


@query(f"{KG} SELECT 'level' AS rule, count(*) FILTER (WHERE NOT contains(knowledge_level, 'assertion')) AS n FROM edges UNION ALL SELECT 'agent', count(*) FILTER (WHERE NOT contains(agent_type, 'manual')) FROM edges")
def val_05_levels_and_agents(spark, d):
    return V.violations(A.edges(spark, d), {"level": V.contains_any("knowledge_level", ["assertion"], fold=False), "agent": V.contains_any("agent_type", ["manual"], fold=False)})


@query("WITH b AS (SELECT CAST(p_size AS VARCHAR) AS v FROM part WHERE NOT p_size BETWEEN 5 AND 45) SELECT (SELECT count(*) FROM b) AS n, (SELECT count(DISTINCT v) FROM b) AS distinct, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT v FROM b ORDER BY v LIMIT 10)) AS examples")
def val_06_range_examples(spark, d):
    return V.violation_examples(A.read(spark, d, "part"), "p_size", F.col("p_size").between(5, 45)).withColumn("examples", F.array_join("examples", ","))


@query(f"{KG} SELECT category, split_part(id, ':', 1) AS prefix, count(*) AS n, split_part(id, ':', 1) IN ('SUPP', 'REGION') AS preferred FROM nodes WHERE category IN ('biolink:Drug', 'biolink:Disease') GROUP BY ALL")
def val_08_preferred_prefixes(spark, d):
    rules = spark.createDataFrame([("biolink:Drug", "SUPP"), ("biolink:Disease", "MONDO")], "category string, prefix string")
    return V.preferred_prefixes(A.nodes(spark, d), rules)


@query("SELECT * FROM (VALUES ('missing', 'n_code'), ('superfluous', 'n_name'), ('superfluous', 'n_regionkey'), ('superfluous', 'n_comment')) t(issue, column_name) WHERE column_name IN (SELECT column_name FROM duckdb_columns() WHERE table_name = 'nation') OR issue = 'missing'")
def val_11_schema_differences(spark, d):
    n = A.read(spark, d, "nation")
    found = V.schema_differences(n, {"n_nationkey": dict(n.dtypes)["n_nationkey"], "n_code": "string"})
    return spark.createDataFrame([(issue, c) for issue, columns in found.items() for c in columns], "issue string, column_name string")


@query("SELECT 'carriage_return' AS issue, 0 AS n UNION ALL SELECT 'column_count', count(*) FILTER (WHERE s_suppkey % 5 = 0) FROM supplier UNION ALL SELECT 'outer_space', count(*) FILTER (WHERE s_suppkey % 7 = 0) FROM supplier UNION ALL SELECT 'header_lines', 1")
def val_12_file_issues(spark, d):
    k = F.col("s_suppkey")
    cell = F.when(k % 7 == 0, F.concat(F.lit(" "), "s_name")).otherwise(F.col("s_name"))
    lines = A.read(spark, d, "supplier").select(F.concat_ws("\t", k.cast("string"), cell, F.when(k % 5 == 0, F.lit("more"))).alias("value"))
    return V.file_issues(lines.union(spark.createDataFrame([("id\tname",)], "value string")), ["id", "name"])


# --- fabrication ---


@query("SELECT CAST(i - 1 AS BIGINT) AS row, 'D:' || lpad(CAST(i AS VARCHAR), 9, '0') AS id FROM (SELECT row_number() OVER () AS i FROM orders)")
def fab_01_ids(spark, d):
    return B.ids(spark, A.read(spark, d, "orders").count(), "D:", 9)


@query(f"SELECT s_suppkey, CASE WHEN u < 0.5 THEN 'a' WHEN u < 0.75 THEN 'b' ELSE 'c' END AS label FROM (SELECT s_suppkey, {_u('''concat('4|label|', s_suppkey)''')} AS u FROM supplier)")
def fab_02_weighted_choice(spark, d):
    return A.read(spark, d, "supplier").select("s_suppkey", B.choice(B.share(4, "label", "s_suppkey"), ["a", "b", "c"], [2, 1, 1]).alias("label"))


_PICK = _u("concat('4|tags#|', s_suppkey)")


@query(f"SELECT s_suppkey, coalesce((SELECT string_agg(v, ',' ORDER BY h) FROM (SELECT v, md5('4|tags|' || s_suppkey || '|' || v) AS h, row_number() OVER (ORDER BY md5('4|tags|' || s_suppkey || '|' || v)) AS r FROM (VALUES ('x'), ('y'), ('z')) t(v)) WHERE r <= floor({_PICK} * 4)), '') AS tags FROM supplier")
def fab_03_arrays(spark, d):
    return A.read(spark, d, "supplier").select("s_suppkey", F.array_join(B.some_of(["x", "y", "z"], 4, "tags", 3, "s_suppkey"), ",").alias("tags"))


@query("SELECT s_suppkey, CAST((CAST(('0x' || md5(CAST(s_suppkey AS VARCHAR))) AS UHUGEINT) % 13) AS BIGINT) AS bucket, CASE s_nationkey WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'many' END AS word FROM supplier")
def fab_05_buckets_and_maps(spark, d):
    return A.read(spark, d, "supplier").select("s_suppkey", B.md5_bucket("s_suppkey", 13).alias("bucket"), B.mapped("s_nationkey", {1: "one", 2: "two"}, "many").alias("word"))


@query(f"SELECT s_suppkey, CAST(DATE '2020-01-01' + CAST(floor(u * 366) AS INTEGER) AS VARCHAR) AS day, CASE WHEN u >= 0.25 THEN s_name END AS name FROM (SELECT *, {_u('''concat('4|day|', s_suppkey)''')} AS u FROM supplier)")
def fab_06_days_and_nulls(spark, d):
    u = B.share(4, "day", "s_suppkey")
    return A.read(spark, d, "supplier").select("s_suppkey", B.day(u, "2020-01-01", "2020-12-31").cast("string").alias("day"), B.with_nulls(F.col("s_name"), u, 0.25).alias("name"))


# --- standardisation ---


@query("SELECT 'SUPP:' || s_suppkey AS id, s_name AS name, 'biolink:Drug' AS category, 2 AS n_categories, 'raw' AS source FROM supplier WHERE s_suppkey % 4 <> 0")
def trf_02_standard_nodes(spark, d):
    k = F.col("s_suppkey")
    raw = A.read(spark, d, "supplier").select(F.when(k % 4 != 0, F.concat(F.lit("SUPP:"), k.cast("string"))).alias("curie"), F.col("s_name").alias("name"), F.lit("Drug").alias("kind"), F.lit("biolink:Drug|biolink:NamedThing").alias("kinds"))
    out = S.standard_nodes(raw.union(raw), "raw", {"id": F.col("curie"), "category": S.prefixed("kind"), "all_categories": S.pieces("kinds")}, once=True)
    return out.select("id", "name", "category", F.size("all_categories").alias("n_categories"), F.get("upstream_data_source", F.lit(0)).alias("source"))


@query("SELECT 'biolink:' || lower(l_returnflag) AS predicate, count(DISTINCT (l_suppkey, l_partkey)) AS n FROM lineitem GROUP BY 1")
def trf_03_standard_edges(spark, d):
    raw = A.read(spark, d, "lineitem").select(F.lower("l_returnflag").alias("mode"), F.col("l_suppkey").cast("string").alias("subject"), F.col("l_partkey").cast("string").alias("object"))
    return S.standard_edges(raw, "raw", {"predicate": S.prefixed("mode")}, once=True).groupBy("predicate").agg(_n())


@query("WITH e AS (SELECT l_suppkey AS s, l_partkey AS o, array_agg(DISTINCT l_returnflag) AS agg, count(DISTINCT l_orderkey) AS refs FROM lineitem GROUP BY ALL) SELECT s, o, refs AS num_references FROM e WHERE NOT (len(agg) = 1 AND agg[1] = 'R') OR refs >= 2")
def trf_04_literature_filter(spark, d):
    e = A.read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("o")).agg(F.collect_set("l_returnflag").alias("aggregator_knowledge_source"), F.collect_set(F.col("l_orderkey").cast("string")).alias("publications"))
    out = S.literature_filter(e, "R", F.array_size("publications") >= 2)
    return out.select("s", "o", F.col("num_references").cast("long").alias("num_references"))


@query("SELECT l_suppkey, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY k) AS r FROM (SELECT DISTINCT l_suppkey, l_orderkey AS k FROM lineitem)) WHERE r <= 4 GROUP BY 1")
def trf_06_sorted_ids(spark, d):
    j = A.read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.to_json(F.collect_set("l_orderkey")).alias("j"))
    return j.select("l_suppkey", F.array_join(S.sorted_ids("j", 4), ",").alias("ids"))


@query(f"WITH {A.PAIRS_SQL}, e AS (SELECT DISTINCT source, target FROM pairs WHERE y = 1) SELECT 'edges' AS part, count(*) AS n FROM e UNION ALL SELECT 'nodes', count(*) FROM (SELECT source FROM e UNION SELECT target FROM e)")
def trf_12_trial_edges(spark, d):
    edges, ends = S.trial_edges(A.pairs(spark, d).filter("y = 1"), "biolink:in_clinical_trials_for")
    return edges.agg(_n()).withColumn("part", F.lit("edges")).unionByName(ends.agg(_n()).withColumn("part", F.lit("nodes")))


@query(f"WITH {A.PAIRS_SQL} SELECT source, target, y FROM pairs WHERE y IN (0, 1)")
def trf_14_ground_truth(spark, d):
    p = A.pairs(spark, d)
    build = {"pairs": lambda positives, negatives: S.ground_truth(positives, negatives)}
    return S.dispatch(build, "pairs", S.PAIR, positives=p.filter("y = 1"), negatives=p.filter("y = 0"))


# --- text keys and vectors ---


@query("SELECT s_suppkey, substr(s_name || CAST(s_nationkey AS VARCHAR), 1, 12) AS key FROM supplier")
def emb_02_text_key(spark, d):
    return A.read(spark, d, "supplier").select("s_suppkey", S.text_key(["s_name", "s_nationkey"], 12).alias("key"))


@query("SELECT count(*) AS n, count(*) AS unit FROM part")
def emb_03_hashed_texts(spark, d):
    v = A.read(spark, d, "part").select(S.hashed_encoder("p_name", 16).alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    return v.select(F.round(norm, 6).alias("m")).agg(_n(), F.count_if(F.col("m").isin(0.0, 1.0)).alias("unit"))


@query(f"{KG} SELECT id, CASE WHEN id LIKE 'SUPP:%' THEN CAST(split_part(id, ':', 2) AS DOUBLE) END AS first FROM nodes")
def emb_05_parsed_vectors(spark, d):
    k = F.col("s_suppkey").cast("string")
    texts = A.read(spark, d, "supplier").select(F.concat(F.lit("SUPP:"), k).alias("id"), F.concat(F.lit("["), k, F.lit(", 0.5]")).alias("embedding"))
    return S.with_vectors(A.nodes(spark, d).select("id"), texts).select("id", F.get("embedding", F.lit(0)).cast("double").alias("first"))


# --- raw sources ---


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'MONDO:' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') WHEN p_size < 20 THEN 'HP:' || p_partkey ELSE 'X:' || p_partkey END AS id, concat_ws('|', CASE WHEN p_size < 10 THEN 'small' END, CASE WHEN p_partkey % 2 = 0 THEN 'even' END) AS labels FROM part")
def pre_01_curie_rules(spark, d):
    k = F.col("p_partkey").cast("string")
    raw = U.strip_suffixes(A.read(spark, d, "part").withColumnRenamed("p_size", "p_size:int"))
    rules = [(F.col("p_size") < 10, U.padded_curie("MONDO", "p_partkey", 7)), (F.col("p_size") < 20, F.concat(F.lit("HP:"), k))]
    return raw.select("p_partkey", U.first_rule(rules, F.concat(F.lit("X:"), k)).alias("id"), U.flag_labels({"small": F.col("p_size") < 10, "even": F.col("p_partkey") % 2 == 0}).alias("labels"))


@query(f"{KG} SELECT subject, count(*) AS n FROM (SELECT subject FROM edges UNION ALL SELECT object FROM edges WHERE predicate <> 'biolink:treats' AND subject <> object) GROUP BY 1")
def pre_07_both_directions(spark, d):
    e = A.edges(spark, d).select("subject", "object", "predicate")
    return U.both_directions(e, F.col("predicate") == "biolink:treats").groupBy("subject").agg(_n())


@query(f"{KG} SELECT subject, predicate, count(num_sentences) AS num_sentences, count(DISTINCT publication) AS num_references FROM edges GROUP BY ALL")
def pre_08_references(spark, d):
    return U.reference_summary(A.edges(spark, d), ["subject", "predicate"], "num_sentences", "publication")


@query("WITH b AS (SELECT l_suppkey, max((l_returnflag = 'R')::INT) AS r, max((l_returnflag = 'A' AND l_quantity > 45)::INT) AS a, max((l_quantity > 10)::INT) AS q FROM lineitem GROUP BY 1) SELECT l_suppkey, a, CASE WHEN a = 1 THEN 0 ELSE r END AS r, CASE WHEN a = 1 OR r = 1 THEN 0 ELSE q END AS q FROM b")
def pre_12_best_outcome(spark, d):
    flag = F.col("l_returnflag")
    rows = A.read(spark, d, "lineitem").select("l_suppkey", (flag == "R").cast("int").alias("r"), ((flag == "A") & (F.col("l_quantity") > 45)).cast("int").alias("a"), (F.col("l_quantity") > 10).cast("int").alias("q"))
    return U.best_outcome(rows, ["l_suppkey"], ["a", "r", "q"])


# --- curated lists ---


@query("SELECT p_name, CASE WHEN len(string_split(p_name, ' ')) = 2 THEN p_name || '|' || split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || '|' || split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) ELSE p_name END AS terms FROM part")
def ent_01_search_terms(spark, d):
    return A.read(spark, d, "part").select("p_name", F.array_join(U.search_terms("p_name"), "|").alias("terms"))


@query("WITH w AS (SELECT DISTINCT lower(split_part(p_type, ' ', 1)) AS name FROM part), t AS (SELECT DISTINCT p_type AS phrase FROM part) SELECT name, phrase FROM w JOIN t ON list_contains(string_split(lower(phrase), ' '), name)")
def ent_04_contained_names(spark, d):
    p = A.read(spark, d, "part")
    names = p.select(F.lower(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("name")).distinct()
    return U.contained_names(names, p.select(F.col("p_type").alias("phrase")).distinct())


@query("SELECT p_partkey, p_partkey % 3 = 0 AS combination FROM part")
def ent_05_combinations(spark, d):
    text = F.when(F.col("p_partkey") % 3 == 0, "aspirin and codeine").otherwise("sandalwood")
    return A.read(spark, d, "part").select("p_partkey", text.alias("t")).select("p_partkey", U.is_combination("t").alias("combination"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS found FROM supplier")
def ent_10_by_name_or_synonym(spark, d):
    s = A.read(spark, d, "supplier")
    k = F.col("s_suppkey")
    names = s.filter("s_suppkey % 2 = 0 or s_suppkey % 3 = 0").select(k.cast("string").alias("id"), F.when(k % 2 == 0, F.col("s_name")).otherwise("-").alias("name"), F.when(k % 2 == 0, F.array(F.lit("-"))).otherwise(F.array(F.upper("s_name"))).alias("synonyms"))
    return U.by_name_or_synonym(s.select("s_suppkey", F.col("s_name").alias("name")), names).select("s_suppkey", "found")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'b' ELSE 'a' END AS id, upper(substr(s_name, 1, 1)) || lower(substr(s_name, 2)) AS name FROM supplier")
def ent_11_candidates(spark, d):
    k = F.col("s_suppkey")
    c = F.array(F.struct(F.lit("a").alias("id"), F.lit("Gene").alias("category")), F.struct(F.lit("b").alias("id"), F.when(k % 2 == 0, "Drug").otherwise("Gene").alias("category")))
    return A.read(spark, d, "supplier").withColumn("c", c).select("s_suppkey", U.choose_candidate("c", ["Drug"]).alias("id"), U.capitalized("s_name").alias("name"))


@query("SELECT o_custkey, min(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 1 AS flag FROM orders GROUP BY 1")
def ent_14_conflicts(spark, d):
    word = F.when(F.col("o_orderstatus") == "F", "Yes ").when(F.col("o_orderstatus") == "O", "no").otherwise("Maybe")
    o = A.read(spark, d, "orders").withColumn("w", word).select("o_custkey", U.yes_no("w").alias("flag"))
    return U.conflict_is_false(o, "o_custkey", "flag")


@query("SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE 'SUPP:' || s_suppkey END AS id, count(*) AS n FROM supplier GROUP BY 1")
def ent_18_migrated_reviews(spark, d):
    k = F.col("s_suppkey")
    reviews = A.read(spark, d, "supplier").select(F.concat(F.lit("SUPP:"), k.cast("string")).alias("id"), "s_name", k)
    known = reviews.filter(k % 3 != 0).select("id").union(spark.createDataFrame([("new",)], "id string"))
    obsolete = reviews.filter(k % 3 == 0).select("id", F.lit("new").alias("replacement"))
    return U.migrate(reviews, known, obsolete).groupBy("id").agg(_n())


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'curated' ELSE s_name END AS s_name, s_nationkey FROM supplier")
def ent_19_overlay(spark, d):
    s = A.read(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    top = s.select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 0, "curated").alias("s_name"))
    return U.overlay(s, top, "s_suppkey")


@query("SELECT p_partkey, 'ICD10CM:' || CASE WHEN length(c) > 3 THEN substr(c, 1, 3) || '.' || substr(c, 4) ELSE c END AS id, (p_size > 40 OR p_size < 5) AND NOT p_partkey % 2 = 0 AS grouped, CASE p_partkey % 3 WHEN 0 THEN 'x|y' WHEN 1 THEN 'other' ELSE '' END AS members, CASE WHEN p_size < 1 THEN 'ultra rare' WHEN p_size < 50 THEN 'rare' ELSE 'common' END AS prevalence FROM (SELECT *, 'A' || CAST(p_partkey AS VARCHAR) AS c FROM part)")
def ent_21_disease_rules(spark, d):
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, "txg_x;txg_other;txg_y;mondo_z").when(k % 3 == 1, "txg_other").otherwise("mondo_z")
    p = A.read(spark, d, "part").withColumn("c", F.concat(F.lit("A"), k.cast("string"))).withColumn("s", text)
    grouped = U.group_by_evidence((F.col("p_size") > 40) | (F.col("p_size") < 5), k % 2 == 0)
    return p.select("p_partkey", U.icd_curie("c").alias("id"), grouped.alias("grouped"), U.subset_members("s", "txg").alias("members"), U.prevalence_bucket(F.col("p_size")).alias("prevalence"))


@query("WITH c AS (SELECT o_custkey, o_orderstatus AS l, count(*) AS n FROM orders GROUP BY ALL) SELECT o_custkey, CASE WHEN n >= 2 THEN l ELSE 'unsure' END AS label FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, l) AS r FROM c) WHERE r = 1")
def ent_34_majority(spark, d):
    o = A.read(spark, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("label"))
    return U.majority_label(o, "o_custkey", "label", 2, "unsure")


@query("SELECT 'added' AS change, 's_suppkey' AS column, count(*) FILTER (WHERE s_suppkey % 10 = 1) AS n FROM supplier UNION ALL SELECT 'removed', 's_suppkey', count(*) FILTER (WHERE s_suppkey % 10 = 0) FROM supplier UNION ALL SELECT 'changed', 's_name', count(*) FILTER (WHERE s_suppkey % 10 = 2) FROM supplier")
def ent_35_release_diff(spark, d):
    s = A.read(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    new = s.filter(k % 10 != 0).withColumn("s_name", F.when(k % 10 == 2, "renamed").otherwise(F.col("s_name")))
    return U.release_diff(s.filter(k % 10 != 1), new, "s_suppkey").drop("examples")
