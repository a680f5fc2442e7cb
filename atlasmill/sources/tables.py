"""Readers and writers: lazy files, versions, fold paths, graph exports."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize, new_path

SEPARATOR = "\x1f"


def load(spark: SparkSession, path: str, file_format: str = "parquet", schema: str | None = None, empty_if_missing: bool = False, **options) -> DataFrame:
    """A lazy scan; a missing path gives an empty frame of ``schema`` if asked for."""
    reader = spark.read.format(file_format).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as e:
        if empty_if_missing and schema and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, **options)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, mode="overwrite")


def best_version(versions: list[str], pattern: str) -> str:
    """The highest semantic version that ``pattern`` (a version or its beginning, or 'latest') allows."""
    number = lambda v: tuple(int(x) for x in re.findall(r"\d+", v)[:3])
    fits = [v for v in versions if pattern in ("latest", v) or v.lstrip("v").startswith(pattern.lstrip("v") + ".")]
    if not fits:
        raise ValueError(f"no version fits {pattern!r}: {sorted(versions)}")
    return max(fits, key=number)


def expand_braces(path: str) -> list[str]:
    """``a/{0,1}/b`` and ``a/{0..3}/b`` as a list of paths."""
    found = re.search(r"\{([^{}]*)\}", path)
    if not found:
        return [path]
    inner = found.group(1)
    span = re.fullmatch(r"(\d+)\.\.(\d+)", inner)
    items = [str(k) for k in range(int(span[1]), int(span[2]) + 1)] if span else inner.split(",")
    return [p for i in items for p in expand_braces(path[: found.start()] + i + path[found.end() :])]


def read_folds(spark: SparkSession, paths: dict[str, str], file_format: str = "parquet") -> DataFrame:
    """One frame of all models' folds with columns ``model`` and ``fold``."""
    out = None
    for model, path in paths.items():
        for fold, one in enumerate(expand_braces(path)):
            df = load(spark, one, file_format).withColumn("model", F.lit(model)).withColumn("fold", F.lit(fold))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def to_kgx(df: DataFrame, columns: list[str], separator: str = SEPARATOR) -> DataFrame:
    """The given columns, arrays joined by ``separator``."""
    kinds = dict(df.dtypes)
    return df.select(*[F.array_join(c, separator).alias(c) if kinds[c].startswith("array") else F.col(c) for c in columns])


def register_external(df: DataFrame, path: str, table: str) -> None:
    """Write Parquet and register it as an external table."""
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_partitioned(df: DataFrame, path: str, by: str = "api") -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def graph_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes for a graph store: ``label`` (the category) and the names and values of string and of array properties, in one order."""
    strings, arrays = ["name", "category", "description"], ["upstream_data_source", "publications"]
    out = nodes.select("id", *strings, *arrays).withColumn("label", F.col("category"))
    for prefix, names in (("", strings), ("array_", arrays)):
        out = out.withColumn(f"{prefix}properties", F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))]))
        out = out.withColumn(f"{prefix}property_keys", F.map_keys(f"{prefix}properties")).withColumn(f"{prefix}property_values", F.map_values(f"{prefix}properties"))
    return out


def graph_edges(edges: DataFrame) -> DataFrame:
    """Edges for a graph store: ``label`` is the predicate without its prefix. Whoever inserts them takes one partition if the store locks nodes."""
    columns = ["subject", "predicate", "object", "upstream_data_source", "publications", "aggregator_knowledge_source"]
    return edges.select(*columns).withColumn("label", F.get(F.split("predicate", ":", 2), F.lit(1)))


def live_rows(df: DataFrame, unique: list[str]) -> DataFrame:
    """The rows that are not ``deleted``; nulls in ``deleted`` or, among what is left, null or repeated values of ``unique`` raise."""
    if not df.filter("deleted is null").isEmpty():
        raise ValueError("deleted has nulls")
    live = df.filter("not deleted")
    for c in unique:
        bad = live.groupBy(c).agg(F.count(F.lit(1)).alias("__n")).filter(F.col(c).isNull() | (F.col("__n") > 1)).limit(5).collect()
        if bad:
            raise ValueError(f"{c} is null or not unique: {[r[0] for r in bad]}")
    return live


def read_zipped_json(spark: SparkSession, path: str, member: str, records: str | None = None) -> DataFrame:
    """The records of one JSON member of zip archives (``path`` may name several), found at ``records`` (names between dots, else the whole is the list).

    Archives are read by tasks, one a task, and the records come out as JSON lines whose schema Spark infers.
    """
    import io
    import json
    import zipfile

    def unpack(batches):
        import pandas as pd

        for pdf in batches:
            lines = []
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    found = json.loads(archive.read(member))
                for name in records.split(".") if records else []:
                    found = found[name]
                lines += [json.dumps(r) for r in (found if isinstance(found, list) else [found])]
            yield pd.DataFrame({"value": lines})

    lines = materialize(spark.read.format("binaryFile").load(path).select("content").mapInPandas(unpack, "value string"), "zipped-json")
    if lines.isEmpty():
        return lines
    path = new_path(spark, "json")
    lines.write.text(path)
    return spark.read.json(path)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """(subject, predicate, object) of N-Triples files; names lose their angle brackets, literals their quotes, types and languages; other lines are skipped."""
    pattern = r"^\s*(\S+)\s+(\S+)\s+(.+?)\s*\.\s*$"
    rows = spark.read.text(path).filter(F.col("value").rlike(pattern) & ~F.col("value").rlike(r"^\s*#"))
    bare = lambda c: F.when(c.startswith("<"), F.regexp_replace(c, "^<|>$", "")).when(c.startswith('"'), F.regexp_replace(F.regexp_extract(c, r'^"((?:[^"\\]|\\.)*)"', 1), r"\\(.)", "$1")).otherwise(c)
    return rows.select(*[bare(F.regexp_extract("value", pattern, k)).alias(n) for k, n in ((1, "subject"), (2, "predicate"), (3, "object"))])
