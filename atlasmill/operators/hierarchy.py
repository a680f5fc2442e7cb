"""Levels of statement, descendants and groupings along hierarchies, and checks on normalised core entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.closure import closure


def statement_levels(edges: DataFrame, instance: list[str], concept: list[str]) -> DataFrame:
    """Edges with ``level``: instance, concept or other, by lists of predicates (bounded by the vocabulary)."""
    return edges.withColumn("level", F.when(F.col("predicate").isin(instance), "instance").when(F.col("predicate").isin(concept), "concept").otherwise("other"))


def level_counts(edges: DataFrame, by: str, instance: list[str], concept: list[str]) -> DataFrame:
    """(by, instance, concept, total) counts of edges."""
    level = statement_levels(edges, instance, concept)
    return level.groupBy(by).agg(F.count_if(F.col("level") == "instance").alias("instance"), F.count_if(F.col("level") == "concept").alias("concept"), F.count(F.lit(1)).alias("total"))


def touches(nodes: DataFrame, edges: DataFrame, out: str) -> DataFrame:
    """Nodes with ``out``: whether an edge has them as an end."""
    ends = edges.select(F.col("subject").alias("id")).union(edges.select("object")).distinct().withColumn(out, F.lit(True))
    return nodes.join(ends, "id", "left").withColumn(out, F.coalesce(out, F.lit(False)))


def descendants(links: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, id, depth) of everything below the roots, each once at its least depth, the roots themselves at 0."""
    below = closure(links, max_depth=max_depth).select(F.col("ancestor").alias("root"), F.col("descendant").alias("id"), F.col("depth").cast("int").alias("depth"))
    return roots.select(F.col("id").alias("root"), "id", F.lit(0).alias("depth")).distinct().unionByName(below.join(roots.select(F.col("id").alias("root")).distinct(), "root", "left_semi"))


def fill_down(ids: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, grouping): every group of the id or of an ancestor; ids without one are in 'other'."""
    reach = descendants(links, groups.select("id"))
    given = reach.join(groups.select(F.col("id").alias("root"), "grouping"), "root").select("id", "grouping").distinct()
    return ids.select("id").join(given, "id", "left").withColumn("grouping", F.coalesce("grouping", F.lit("other")))


def descendant_counts(links: DataFrame) -> DataFrame:
    """(id, n): how many distinct descendants each ancestor has."""
    return closure(links).groupBy(F.col("ancestor").alias("id")).agg(F.count(F.lit(1)).alias("n"))


def core_conflicts(mapping: DataFrame) -> DataFrame:
    """Ids that were given more than one core id."""
    return mapping.groupBy("id").agg(F.min("core_id").alias("a"), F.max("core_id").alias("b")).filter("a <> b").select("id")


def core_ids(mapping: DataFrame, strict: bool = True) -> DataFrame:
    """(id, core_id) once an id, the smallest core id of several; with ``strict`` several are an error."""
    if strict:
        bad = [r["id"] for r in core_conflicts(mapping).orderBy("id").limit(5).collect()]
        if bad:
            raise ValueError(f"more than one core id for {', '.join(bad)}")
    return mapping.groupBy("id").agg(F.min("core_id").alias("core_id"))


def core_categories(assignments: DataFrame, mapping: DataFrame) -> DataFrame:
    """Nodes with ``ec_core_category``: drug, disease or null."""
    core = F.when(F.col("category") == "biolink:Drug", "drug").when(F.col("category") == "biolink:Disease", "disease")
    return assignments.join(mapping.select(F.col("normalized_id").alias("id"), core.alias("ec_core_category")).distinct(), "id", "left")


def node_metrics(components: DataFrame, ontology: DataFrame) -> DataFrame:
    """The node tables of the connectivity report side by side."""
    return components.join(ontology, "id", "left")
