"""Views of the star-schema tables as a knowledge graph (nodes, edges, pairs), as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATEGORY_PARENT = {
    "biolink:NamedThing": None,
    "biolink:ChemicalEntity": "biolink:NamedThing",
    "biolink:Drug": "biolink:ChemicalEntity",
    "biolink:BiologicalEntity": "biolink:NamedThing",
    "biolink:Disease": "biolink:BiologicalEntity",
    "biolink:Gene": "biolink:BiologicalEntity",
    "biolink:GeographicLocation": "biolink:NamedThing",
}
PREDICATE_PARENT = {"biolink:related_to": None, "biolink:affects": "biolink:related_to", "biolink:treats": "biolink:affects", "biolink:located_in": "biolink:related_to", "biolink:part_of": "biolink:related_to"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ancestors(name: str, parents: dict[str, str | None]) -> list[str]:
    """``name`` and everything above it."""
    out = []
    while name is not None:
        out.append(name)
        name = parents.get(name)
    return out


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, category, all_categories, upstream_data_source."""
    parts = [("supplier", "s_suppkey", "s_name", "SUPP", "biolink:Drug"), ("part", "p_partkey", "p_name", "PART", "biolink:Disease"), ("customer", "c_custkey", "c_name", "CUST", "biolink:Gene"), ("nation", "n_nationkey", "n_name", "NATION", "biolink:GeographicLocation"), ("region", "r_regionkey", "r_name", "REGION", "biolink:NamedThing")]
    frames = []
    for table, key, name, prefix, category in parts:
        k = F.col(key).cast("long")
        sources = F.when(k % 3 == 0, F.array(F.lit("kg0"), F.lit("kg1"))).when(k % 3 == 1, F.array(F.lit("kg1"))).otherwise(F.array(F.lit("kg2")))
        frames.append(read(spark, sf_dir, table).select(F.concat(F.lit(prefix + ":"), k.cast("string")).alias("id"), F.col(name).alias("name"), F.lit(category).alias("category"), F.array(*[F.lit(c) for c in ancestors(category, CATEGORY_PARENT)]).alias("all_categories"), sources.alias("upstream_data_source")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subject, predicate, object, primary_knowledge_source, knowledge_level, agent_type, publication, upstream, num_references, num_sentences."""
    item = read(spark, sf_dir, "lineitem")
    key = lambda prefix, col: F.concat(F.lit(prefix + ":"), F.col(col).cast("long").cast("string"))
    drug = item.select(
        key("SUPP", "l_suppkey").alias("subject"),
        F.when(F.col("l_returnflag") == "R", "biolink:treats").when(F.col("l_returnflag") == "A", "biolink:affects").otherwise("biolink:related_to").alias("predicate"),
        key("PART", "l_partkey").alias("object"),
        F.when(F.col("l_linestatus") == "O", "infores:open").otherwise("infores:final").alias("primary_knowledge_source"),
        F.when(F.col("l_linenumber") % 3 == 0, "knowledge_assertion").when(F.col("l_linenumber") % 3 == 1, "prediction").alias("knowledge_level"),
        F.when(F.col("l_linenumber") % 2 == 0, "manual_agent").otherwise("automated_agent").alias("agent_type"),
        F.concat(F.lit("PMID:"), (F.col("l_orderkey") % 97).cast("string")).alias("publication"),
        F.concat(F.lit("kg"), (F.col("l_orderkey") % 3).cast("string")).alias("upstream"),
        F.col("l_linenumber").cast("long").alias("num_references"),
        F.col("l_quantity").cast("long").alias("num_sentences"),
    )

    def place(table: str, prefix: str, own: str, predicate: str, at: str, other: str) -> DataFrame:
        none = F.lit(None).cast("string")
        return read(spark, sf_dir, table).select(key(prefix, own).alias("subject"), F.lit(predicate).alias("predicate"), key(at, other).alias("object"), F.lit("infores:geo").alias("primary_knowledge_source"), none.alias("knowledge_level"), none.alias("agent_type"), none.alias("publication"), F.lit("kg0").alias("upstream"), F.lit(1).cast("long").alias("num_references"), F.lit(None).cast("long").alias("num_sentences"))

    return drug.unionByName(place("supplier", "SUPP", "s_suppkey", "biolink:located_in", "NATION", "s_nationkey")).unionByName(place("customer", "CUST", "c_custkey", "biolink:located_in", "NATION", "c_nationkey")).unionByName(place("nation", "NATION", "n_nationkey", "biolink:part_of", "REGION", "n_regionkey"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of drug (supplier) and disease (part) of an order line, once: source, target, score (with ties), y (1, 0 or null), split, fold."""
    both = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("s"), F.col("l_partkey").cast("long").alias("p")).distinct()
    h = (F.col("s") * 7919 + F.col("p") * 104729) % 10007
    return both.select(
        F.concat(F.lit("SUPP:"), F.col("s").cast("string")).alias("source"),
        F.concat(F.lit("PART:"), F.col("p").cast("string")).alias("target"),
        (F.floor(h / 10).cast("double") / 1000.0).alias("score"),
        F.when(h % 17 == 0, 1).when(h % 5 == 0, 0).alias("y"),
        F.when((F.col("s") + F.col("p")) % 4 == 0, "TRAIN").otherwise("TEST").alias("split"),
        ((F.col("s") * 31 + F.col("p")) % 3).cast("long").alias("fold"),
    )


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _node_sql(table: str, key: str, name: str, prefix: str, category: str) -> str:
    return f"SELECT '{prefix}:' || CAST({key} AS BIGINT) AS id, {name} AS name, '{category}' AS category, {_list(ancestors(category, CATEGORY_PARENT))} AS all_categories, CASE CAST({key} AS BIGINT) % 3 WHEN 0 THEN ['kg0', 'kg1'] WHEN 1 THEN ['kg1'] ELSE ['kg2'] END AS upstream_data_source FROM {table}"


NODES_SQL = "nodes AS (" + " UNION ALL ".join(_node_sql(*x) for x in [("supplier", "s_suppkey", "s_name", "SUPP", "biolink:Drug"), ("part", "p_partkey", "p_name", "PART", "biolink:Disease"), ("customer", "c_custkey", "c_name", "CUST", "biolink:Gene"), ("nation", "n_nationkey", "n_name", "NATION", "biolink:GeographicLocation"), ("region", "r_regionkey", "r_name", "REGION", "biolink:NamedThing")]) + ")"
EDGES_SQL = """edges AS (
SELECT 'SUPP:' || CAST(l_suppkey AS BIGINT) AS subject, CASE l_returnflag WHEN 'R' THEN 'biolink:treats' WHEN 'A' THEN 'biolink:affects' ELSE 'biolink:related_to' END AS predicate, 'PART:' || CAST(l_partkey AS BIGINT) AS object,
 CASE l_linestatus WHEN 'O' THEN 'infores:open' ELSE 'infores:final' END AS primary_knowledge_source, CASE l_linenumber % 3 WHEN 0 THEN 'knowledge_assertion' WHEN 1 THEN 'prediction' END AS knowledge_level,
 CASE WHEN l_linenumber % 2 = 0 THEN 'manual_agent' ELSE 'automated_agent' END AS agent_type, 'PMID:' || (l_orderkey % 97) AS publication, 'kg' || (l_orderkey % 3) AS upstream, CAST(l_linenumber AS BIGINT) AS num_references, CAST(l_quantity AS BIGINT) AS num_sentences FROM lineitem
UNION ALL SELECT 'SUPP:' || CAST(s_suppkey AS BIGINT), 'biolink:located_in', 'NATION:' || CAST(s_nationkey AS BIGINT), 'infores:geo', NULL, NULL, NULL, 'kg0', 1, NULL FROM supplier
UNION ALL SELECT 'CUST:' || CAST(c_custkey AS BIGINT), 'biolink:located_in', 'NATION:' || CAST(c_nationkey AS BIGINT), 'infores:geo', NULL, NULL, NULL, 'kg0', 1, NULL FROM customer
UNION ALL SELECT 'NATION:' || CAST(n_nationkey AS BIGINT), 'biolink:part_of', 'REGION:' || CAST(n_regionkey AS BIGINT), 'infores:geo', NULL, NULL, NULL, 'kg0', 1, NULL FROM nation)"""
PAIRS_SQL = """pairs AS (SELECT 'SUPP:' || s AS source, 'PART:' || p AS target, CAST(h // 10 AS DOUBLE) / 1000.0 AS score, CASE WHEN h % 17 = 0 THEN 1 WHEN h % 5 = 0 THEN 0 END AS y, CASE WHEN (s + p) % 4 = 0 THEN 'TRAIN' ELSE 'TEST' END AS split, (s * 31 + p) % 3 AS fold
FROM (SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS s, CAST(l_partkey AS BIGINT) AS p, (CAST(l_suppkey AS BIGINT) * 7919 + CAST(l_partkey AS BIGINT) * 104729) % 10007 AS h FROM lineitem))"""
