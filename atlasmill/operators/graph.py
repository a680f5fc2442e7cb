"""Normalisation, union and deduplication, filters, hierarchy rules and connectivity of graph tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.components import connected_components
from atlasmill.functions.lineage import materialize

# --- normalisation ---


def unpack_mapping(mapping: DataFrame) -> DataFrame:
    """(original_id, normalized_id, normalized_categories, normalization_success) of (id, normalization_struct)."""
    s = F.col("normalization_struct")
    return mapping.select(F.col("id").alias("original_id"), F.coalesce(s["normalized_id"], F.col("id")).alias("normalized_id"), s["normalized_categories"].alias("normalized_categories"), s["normalized_id"].isNotNull().alias("normalization_success"))


def normalize_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Both endpoints mapped; originals and success flags kept; equal rows once.

    The mapping has one row an id, so rows are equal after it if they were before: repeats go first, narrow.
    """
    flat = unpack_mapping(mapping).dropDuplicates()
    out = edges.dropDuplicates()
    for end in ("subject", "object"):
        side = flat.select(F.col("original_id").alias(end), F.col("normalized_id").alias("__to"), F.col("normalization_success").alias("__ok"))
        out = out.join(side, end, "left").withColumn(f"original_{end}", F.col(end)).withColumn(end, F.coalesce("__to", end)).withColumn(f"{end}_normalization_success", F.coalesce("__ok", F.lit(False))).drop("__to", "__ok")
    return out


def normalize_nodes(nodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row for each normalised id, of the smallest original id; categories fall back to the node's own, then to none."""
    flat = unpack_mapping(mapping).withColumnRenamed("original_id", "id")
    joined = nodes.join(flat, "id", "left")
    cats = F.when(F.size("normalized_categories") > 0, F.col("normalized_categories")).when(F.size("all_categories") > 0, F.col("all_categories")).otherwise(F.array().cast("array<string>"))
    joined = joined.withColumn("original_id", F.col("id")).withColumn("id", F.coalesce("normalized_id", "id")).withColumn("all_categories", cats).withColumn("normalization_success", F.coalesce("normalization_success", F.lit(False))).drop("normalized_id", "normalized_categories")
    first = W.partitionBy("id").orderBy("original_id")
    return joined.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Endpoint ids that no node has."""
    ends = edges.select(F.col("subject").alias("id")).union(edges.select(F.col("object").alias("id"))).distinct()
    return ends.join(nodes.select("id"), "id", "left_anti")


def cache_misses(keys: DataFrame, cache: DataFrame, api: str) -> DataFrame:
    return keys.select("key").distinct().join(cache.filter(F.col("api") == api).select("key"), "key", "left_anti")


def cache_lookup(keys: DataFrame, cache: DataFrame, api: str) -> DataFrame:
    """Keys with the cached value; a key that is cached twice has its least value."""
    held = cache.filter(F.col("api") == api).groupBy("key").agg(F.min("value").alias("value"))
    return keys.join(held, "key", "left")


# --- union and deduplication ---


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unify_edges(edges: DataFrame) -> DataFrame:
    """One row for each (subject, predicate, object, source, upstream) with the sources of its triple."""
    key = ["subject", "predicate", "object", "primary_knowledge_source", "upstream"]
    one = edges.groupBy(*key).agg(F.sum("num_references").alias("num_references"), F.count_distinct("publication").alias("n_publications"))
    sources = edges.groupBy("subject", "predicate", "object").agg(F.array_sort(F.collect_set("primary_knowledge_source")).alias("primary_knowledge_sources"))
    return one.join(sources, ["subject", "predicate", "object"])


def unify_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row an id (first values by name, united arrays), only nodes with an edge."""
    merged = nodes.groupBy("id").agg(F.min_by("name", F.coalesce("name", F.lit(""))).alias("name"), F.min("category").alias("category"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("upstream_data_source")))).alias("upstream_data_source"))
    ends = edges.select(F.col("subject").alias("id")).union(edges.select(F.col("object").alias("id"))).distinct()
    return merged.join(ends, "id", "left_semi")


def collapse_edges(edges: DataFrame) -> DataFrame:
    """(subject, predicate, object) once: per source first (references summed, sentences' maximum), then over sources, with a JSON map by source."""
    spo = ["subject", "predicate", "object"]
    pks = F.coalesce("primary_knowledge_source", F.lit("unknown"))
    # a publication that many rows of a source repeat is one row before anything is gathered
    once = edges.withColumn("pks", pks).groupBy(*spo, "pks", "publication").agg(F.sum("num_references").alias("num_references"), F.max("num_sentences").alias("num_sentences"))
    first = once.groupBy(*spo, "pks").agg(F.sum("num_references").alias("num_references"), F.max("num_sentences").alias("num_sentences"), F.array_sort(F.collect_list("publication")).alias("publications"))
    detail = F.map_from_entries(F.array_sort(F.collect_list(F.struct("pks", F.struct("num_references", "num_sentences", "publications")))))
    whole = first.groupBy(*spo).agg(F.sum("num_references").alias("num_references"), F.max("num_sentences").alias("num_sentences"), F.array_sort(F.collect_list("pks")).alias("sources"), F.to_json(detail).alias("source_edge_properties"))
    named = edges.select(*spo, "publication").distinct().groupBy(*spo).agg(F.array_sort(F.collect_list("publication")).alias("publications"))
    return whole.join(named, spo)


# --- filters: frames in, kept rows out; a null condition drops the row ---


def keep_any(column: str, values: list[str]) -> Column:
    return F.exists(column, lambda x: x.isin(values))


def drop_values(column: str, values: list[str]) -> Column:
    return ~F.col(column).isin(values)


def drop_overlap(column: str, values: list[str], source: str, spared: list[str]) -> Column:
    listed = lambda v: F.array(*[F.lit(x) for x in v])
    return ~F.arrays_overlap(F.col(column), listed(values)) | F.arrays_overlap(F.col(source), listed(spared))


def drop_triples(patterns: list[tuple[str, str, str]], columns: tuple[str, str, str] = ("subject_category", "predicate", "object_category")) -> Column:
    out = F.lit(True)
    for p in patterns:
        out = out & ~reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(columns, p, strict=True)])
    return out


def filter_chain(df: DataFrame, filters: dict[str, Column], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): removed rows are those whose key no kept row has."""
    kept = reduce(lambda d, f: d.filter(f), filters.values(), df)
    gone = df.select(*keys).distinct().join(kept.select(*keys).distinct(), keys, "left_anti")
    return kept, df.join(gone, keys)


def with_categories(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose endpoints are both nodes, with the endpoints' categories."""
    out = edges
    for end in ("subject", "object"):
        out = out.join(nodes.select(F.col("id").alias(end), F.col("category").alias(f"{end}_category")), end)
    return out


def drop_floating(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    ends = edges.select(F.col("subject").alias("id")).union(edges.select(F.col("object").alias("id"))).distinct()
    return nodes.join(ends, "id", "left_semi"), nodes.join(ends, "id", "left_anti")


def drop_drug_disease(edges: DataFrame, drugs: str = "biolink:Drug", diseases: str = "biolink:Disease") -> DataFrame:
    """Edges that do not connect a drug and a disease, in either direction."""
    s, o = F.col("subject_category"), F.col("object_category")
    return edges.filter(~(((s == drugs) & (o == diseases)) | ((s == diseases) & (o == drugs))))


def equals(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Rows equal in all given columns; columns that are not there are skipped."""
    return reduce(lambda d, kv: d.filter(F.col(kv[0]) == F.lit(kv[1])), [(k, v) for k, v in wanted.items() if k in df.columns], df)


def hash_sample(df: DataFrame, keys: list[str], share: float, seed: int = 0) -> DataFrame:
    """A reproducible share of the keys by md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(share * (1 << 32)))


# --- hierarchy rules ---


def most_specific(nodes: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, category): the deepest of all categories, ties to the smaller name; unknown names are ignored."""
    depth = vocabulary.filter("name = ancestor").select(F.col("name").alias("c"), "depth")
    return nodes.select("id", F.explode("all_categories").alias("c")).join(F.broadcast(depth), "c").groupBy("id").agg(F.min_by("c", F.struct(-F.col("depth"), F.col("c"))).alias("category"))


def drop_redundant(edges: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Edges of whose predicate no strict descendant connects the same endpoints."""
    below = vocabulary.filter("name <> ancestor").select(F.col("name").alias("predicate"), F.col("ancestor").alias("general"))
    covered = edges.select("subject", "predicate", "object").distinct().join(F.broadcast(below), "predicate").select("subject", "object", F.col("general").alias("predicate")).distinct()
    return edges.join(covered, ["subject", "predicate", "object"], "left_anti")


# --- connectivity ---


def simple_pairs(edges: DataFrame) -> DataFrame:
    return edges.filter("subject <> object").select(F.least("subject", "object").alias("u"), F.greatest("subject", "object").alias("v")).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component, component_rank, size): isolated nodes are components; rank 0 is the largest, ties by least id."""
    found = connected_components(simple_pairs(edges)).withColumnRenamed("node", "id")
    placed = nodes.select("id").distinct().join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = materialize(placed.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component-sizes")
    return placed.join(rank_rows(sizes, [F.col("size").desc(), F.col("component")], "component_rank"), "component")


def rank_rows(df: DataFrame, order: list[Column], out: str, keep: list[str] | None = None) -> DataFrame:
    """Gapless position from 0 along a total order, without a single-task window: range partitions, then offsets. Of the columns, those of ``keep`` are written (None: all)."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    cut = materialize(placed if keep is None else placed.select(*keep, "__p", "__i"), "ranked")
    counts = cut.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    before = counts.withColumn("__base", F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return cut.join(F.broadcast(before.drop("__n")), "__p").withColumn(out, (F.col("__i") - F.col("__first") + F.col("__base")).cast("long")).drop("__p", "__i", "__first", "__base")
