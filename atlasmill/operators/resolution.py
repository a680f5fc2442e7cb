"""Resolving identifiers and names of raw sources, and cleaning the graphs built from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.operators.standardize import least_row

UNRESOLVED = "Not resolved"


def resolve_batches(keys: DataFrame, column: str, resolver: Callable[[list[str]], list[str | None]], batch_size: int, out: str = "value") -> DataFrame:
    """Distinct non-null keys with the resolver's answers, asked in lists of at most ``batch_size`` in each task."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                answers = resolver(part[column].tolist())
                if len(answers) != len(part):
                    raise ValueError(f"{len(answers)} answers to {len(part)} keys")
                yield pd.DataFrame({column: part[column].to_numpy(), out: pd.Series(answers, dtype=object).to_numpy()})

    return keys.select(column).filter(F.col(column).isNotNull()).distinct().mapInPandas(ask, f"`{column}` string, `{out}` string")


def normalized_response(responses: DataFrame, response: str, id_path: str, categories_path: str, default: str) -> DataFrame:
    """``normalized_id`` and ``normalized_categories`` by JSON paths; without an answer the id is null and the category the default."""
    found = F.from_json(F.get_json_object(response, categories_path), "array<string>")
    return responses.withColumn("normalized_id", F.get_json_object(response, id_path)).withColumn("normalized_categories", F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default))))


def listed(column: str) -> Column:
    """Items of a text like ``{1,2}``."""
    return F.split(F.regexp_replace(column, "[{}]", ""), ",")


def attribute_ids(attributes: DataFrame, nodes: DataFrame, manual_ids: DataFrame, manual_names: DataFrame, prefixes: dict[str, str], manual: str = "MedScan ID") -> DataFrame:
    """(attribute_id, name, value, normalized_id): known kinds of identifiers get their prefix and lose what follows a point.

    Attributes with a manual id (by value) or whose node has one (by name) have only that.
    """
    prefix = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    known = F.col("name").isin(list(prefixes))
    stem = F.concat(F.element_at(prefix, F.col("name")), F.split("value", r"\.").getItem(0))
    plain = attributes.select(F.col("id").alias("attribute_id"), "name", F.when(known, stem).otherwise(F.col("value")).alias("value"), F.when(~known, F.col("value")).alias("normalized_id"))
    by_id = attributes.filter(F.col("name") == manual).join(manual_ids.select(F.col("identifier").alias("value"), F.col("id").alias("curie")), "value").select(F.col("id").alias("attribute_id"), "name", "value", F.coalesce("curie", "value").alias("normalized_id")).distinct()
    by_name = manual_names.join(nodes.select("name", "attributes"), "name").select(F.explode(listed("attributes")).alias("attribute_id"), F.lit("Manual ID").alias("name"), F.col("id").alias("value"), F.col("id").alias("normalized_id"))
    replaced = by_id.select("attribute_id").union(by_name.select("attribute_id")).distinct()
    return plain.join(replaced, "attribute_id", "left_anti").unionByName(by_id).unionByName(by_name)


def one_id_per_node(nodes: DataFrame, resolved: DataFrame, categories: dict[str, str]) -> DataFrame:
    """Nodes with the least normalized id of their attributes (else their own urn) as ``final_id``, and the category of their type."""
    links = nodes.select("id", F.explode(listed("attributes")).alias("attribute_id"))
    found = links.join(resolved.filter("normalized_id is not null"), "attribute_id").groupBy("id").agg(F.min("normalized_id").alias("normalized_id"))
    kinds = F.create_map(*[F.lit(x) for pair in categories.items() for x in pair])
    return nodes.join(found, "id", "left").withColumn("final_id", F.coalesce("normalized_id", "urn")).withColumn("category", F.coalesce(F.element_at(kinds, F.col("nodetype")), F.lit("")))


def connected_graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that an edge touches, once for each id (the least original one), and edges between them, once for each triple."""
    ends = edges.select("inkey").union(edges.select("outkey")).distinct().withColumnRenamed("inkey", "original")
    kept = least_row(nodes.join(ends, "original", "left_semi").select("id", "original", *[c for c in nodes.columns if c not in ("id", "original")]), ["id"])
    mapped = edges
    for end, name in (("inkey", "subject"), ("outkey", "object")):
        mapped = mapped.join(kept.select(F.col("original").alias(end), F.col("id").alias(name)), end)
    return kept, least_row(mapped, ["subject", "predicate", "object"])


def grouped_edges(edges: DataFrame, ends: list[str], separator: str = "_") -> DataFrame:
    """One edge for each combination of the ids that an end groups."""
    for end in ends:
        edges = edges.withColumn(end, F.explode(F.split(end, separator)))
    return edges


def resolve_names(df: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """``df`` with the columns of a dictionary of names (one row a name), null where the name is not in it."""
    return df.join(least_row(names, [column]), column, "left")


def medical_nodes(df: DataFrame) -> DataFrame:
    """Resolved nodes with ``normalized_curie`` (the given new id, else the found one) and ``n_same``, the nodes that share it."""
    found = df.withColumn("normalized_curie", F.coalesce("new_id", "curie")).filter("normalized_curie is not null")
    return found.join(found.groupBy("normalized_curie").agg(F.count(F.lit(1)).alias("n_same")), "normalized_curie")


def medical_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the curies of both ends; edges without one are dropped."""
    for end, out in (("Source", "SourceId"), ("Target", "TargetId")):
        edges = edges.join(nodes.select(F.col("ID").alias(end), F.col("normalized_curie").alias(out)), end)
    return edges


def tag(df: DataFrame, tags: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Tags looked up by key; a missing one is ``Not resolved``."""
    return df.join(tags.select(key, *columns), key, "left").fillna(UNRESOLVED, columns)


# --- documentation of knowledge sources: (id, source, property, value) in long form ---


def registry_entries(registry: DataFrame, mapping: DataFrame, id_column: str, source: str, properties: list[str]) -> DataFrame:
    """(id, source, property, value) of a registry; its ids are mapped, else taken without their prefix."""
    own = F.concat(F.lit("infores:"), F.regexp_replace(F.lower(F.col(id_column)), "^infores:", ""))
    mapped = registry.join(mapping.select(F.col("original").alias(id_column), F.col("mapped").alias("__to")), id_column, "left").withColumn("id", F.coalesce("__to", own))
    return mapped.select("id", *[F.col(p).cast("string").alias(p) for p in properties]).unpivot(["id"], properties, "property", "value").select("id", F.lit(source).alias("source"), "property", "value")


def merge_entries(entries: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """The wanted ids with their entries, a later list winning for each source and property; ids without any get one default entry."""
    ranked = [e.withColumn("__at", F.lit(k)) for k, e in enumerate(entries)]
    every = ranked[0]
    for e in ranked[1:]:
        every = every.unionByName(e)
    merged = every.groupBy("id", "source", "property").agg(F.max(F.struct("__at", "value"))["value"].alias("value"))
    return wanted.select("id").distinct().join(merged, "id", "left").withColumn("source", F.coalesce("source", F.lit("default"))).withColumn("property", F.coalesce("property", F.lit("name"))).withColumn("value", F.when(F.col("source") == "default", F.col("id")).otherwise(F.col("value")))


def source_table(entries: DataFrame, properties: list[str], sources: list[str], default: str = "Unknown") -> DataFrame:
    """One row for each id with its properties, each from the first source that has it."""
    ordered = F.coalesce(*[F.max(F.when((F.col("source") == s) & (F.col("property") == F.col("__p")), F.col("value"))) for s in sources], F.lit(default))
    long = entries.withColumn("__p", F.explode(F.lit(properties))).groupBy("id", "__p").agg(ordered.alias("v"))
    return long.groupBy("id").agg(*[F.max(F.when(F.col("__p") == p, F.col("v"))).alias(p) for p in properties])


def markdown(table: DataFrame, columns: list[str]) -> DataFrame:
    """(id, line): a line of a Markdown table for each row; bars in values are escaped."""
    cells = [F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]
    return table.select("id", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
