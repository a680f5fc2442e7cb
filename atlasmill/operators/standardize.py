"""Raw sources to standard nodes, edges and pairs: projections by rules, literature support, text keys and vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: standard columns and their types
NODE = {"id": "string", "name": "string", "category": "string", "all_categories": "array<string>", "upstream_data_source": "array<string>"}
EDGE = {"subject": "string", "predicate": "string", "object": "string", "primary_knowledge_source": "string", "aggregator_knowledge_source": "array<string>", "publications": "array<string>", "upstream_data_source": "array<string>"}
PAIR = {"source": "string", "target": "string", "y": "int"}


def project(df: DataFrame, rules: dict[str, Column], schema: dict[str, str]) -> DataFrame:
    """The columns of ``schema`` in order, by rule, else the column of that name, else null; always of the schema's type."""
    return df.select(*[(rules[c] if c in rules else F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])


def pieces(column: str, separator: str = "|") -> Column:
    """A delimited text as an array; a null or empty text is null."""
    return F.when(F.length(column) > 0, F.split(column, "\\Q" + separator + "\\E"))


def prefixed(column: str, prefix: str = "biolink:") -> Column:
    """The value with the prefix, once."""
    return F.when(F.col(column).startswith(prefix), F.col(column)).otherwise(F.concat(F.lit(prefix), column))


def standard_nodes(df: DataFrame, source: str, rules: dict[str, Column], once: bool = False) -> DataFrame:
    """Nodes of one source; rows without an id leave, and with ``once`` an id stays once (its least row)."""
    out = project(df, {"upstream_data_source": F.array(F.lit(source)), **rules}, NODE).filter(F.col("id").isNotNull())
    return least_row(out, ["id"]) if once else out


def standard_edges(df: DataFrame, source: str, rules: dict[str, Column], once: bool = False) -> DataFrame:
    """Edges of one source; rows without an end or a predicate leave."""
    out = project(df, {"upstream_data_source": F.array(F.lit(source)), **rules}, EDGE).dropna(subset=["subject", "predicate", "object"])
    return least_row(out, ["subject", "predicate", "object"]) if once else out


def least_row(df: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key, the least by all columns, with partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row")).select(*[F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in df.columns])


def ground_truth(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """(source, target, y) of positives and negatives."""
    return positives.select("source", "target", F.lit(1).alias("y")).unionByName(negatives.select("source", "target", F.lit(0).alias("y")))


def trial_edges(trials: DataFrame, predicate: str) -> tuple[DataFrame, DataFrame]:
    """(edges, ids of their ends) of (source, target) rows."""
    edges = trials.select(F.col("source").alias("subject"), F.lit(predicate).alias("predicate"), F.col("target").alias("object")).dropna().distinct()
    return edges, edges.select(F.col("subject").alias("id")).union(edges.select("object")).distinct()


def literature_filter(edges: DataFrame, text_mined: str, supported: Column, publications: str = "publications") -> DataFrame:
    """Edges with ``num_references``; those whose only aggregator is ``text_mined`` stay if ``supported`` holds (null: they leave)."""
    only = (F.size("aggregator_knowledge_source") == 1) & (F.get("aggregator_knowledge_source", F.lit(0)) == text_mined)
    counted = edges.withColumn("num_references", F.coalesce(F.array_size(F.array_distinct(publications)), F.lit(0)))
    return counted.filter(~F.coalesce(only, F.lit(False)) | supported)


def sorted_ids(column: str, most: int) -> Column:
    """The first ``most`` ids, in order, of a JSON list of numbers."""
    return F.slice(F.array_sort(F.from_json(column, "array<bigint>")), 1, most)


def dispatch(transformers: dict[str, Callable[..., DataFrame]], name: str, schema: dict[str, str], **inputs) -> DataFrame:
    """Run a named transformer and check that it gives the wanted columns and types."""
    if name not in transformers:
        raise ValueError(f"no transformer {name}; there are {', '.join(sorted(transformers))}")
    out = transformers[name](**inputs)
    wrong = {c: t for c, t in schema.items() if dict(out.dtypes).get(c) != t}
    if wrong:
        raise ValueError(f"{name} gives no columns {wrong}")
    return out


def text_key(columns: list[str], length: int) -> Column:
    """The columns joined and cut: the key under which a text's embedding is cached."""
    return F.substring(F.concat_ws("", *columns), 1, length)


def hashed_encoder(column: str, size: int) -> Column:
    """An offline text encoder: signed counts of hashed lower-case words, of length one unless empty."""
    words = F.filter(F.split(F.lower(F.coalesce(column, F.lit(""))), "\\s+"), lambda w: w != "")
    slots = F.transform(words, lambda w: F.struct(F.pmod(F.xxhash64(w), F.lit(size)).alias("i"), F.when(F.pmod(F.hash(w), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("x")))
    sums = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.aggregate(F.filter(slots, lambda s: s["i"] == k), F.lit(0.0), lambda a, s: a + s["x"]))
    norm = F.sqrt(F.aggregate(sums, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(sums, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def with_vectors(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Nodes with ``embedding`` parsed from (id, embedding as JSON text); null where there is none."""
    return nodes.join(texts.select("id", F.from_json("embedding", "array<float>").alias("embedding")), "id", "left")


def reduce_vectors(df: DataFrame, column: str, size: int) -> DataFrame:
    """Principal components of an array column (skipped if it is no longer than ``size``); rows without a vector leave."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    have = df.filter(F.col(column).isNotNull())
    first = have.select(F.size(column).alias("n")).first()
    if first is None or first["n"] <= size:
        return have
    vectors = have.withColumn("__v", array_to_vector(F.col(column).cast("array<double>")))
    model = PCA(k=size, inputCol="__v", outputCol="__p").fit(vectors)
    return model.transform(vectors).withColumn(column, vector_to_array("__p")).drop("__v", "__p")
