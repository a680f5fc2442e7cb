"""Validation of graph files: violations by rule, as expressions and detail tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CURIE = "^[A-Za-z_][A-Za-z0-9_.-]*:[^\\s:][^\\s]*$"


def is_curie(column: str) -> Column:
    return F.col(column).rlike(CURIE)


def has_outer_space(column: str) -> Column:
    return F.col(column).rlike("^\\s|\\s$")


def contains_any(column: str, words: list[str], fold: bool = True) -> Column:
    """Substring test; with ``fold`` without regard to ASCII case."""
    text = F.lower(column) if fold else F.col(column)
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w.lower() if fold else w)
    return out


def edge_type_census(edges: DataFrame, allowed: DataFrame) -> DataFrame:
    """Counts by (subject category, predicate, object category) and whether the type is allowed."""
    key = ["subject_category", "predicate", "object_category"]
    counts = edges.select(*[F.coalesce(k, F.lit("unknown")).alias(k) for k in key]).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(allowed.withColumn("valid", F.lit(True)), key, "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


def missing_by_prefix(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Endpoint ids without a node, by prefix, with up to three examples."""
    from atlasmill.operators.graph import missing_nodes

    gone = missing_nodes(edges, nodes).withColumn("prefix", F.split_part("id", F.lit(":"), F.lit(1)))
    least = W.partitionBy("prefix").orderBy("id")  # cut to three a prefix in each task, before rows meet
    shown = gone.withColumn("__n", F.row_number().over(least)).filter("__n <= 3").groupBy("prefix").agg(F.array_join(F.array_sort(F.collect_list("id")), "|").alias("examples"))
    return gone.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).join(shown, "prefix").select("prefix", "n", "examples")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): rows that break each rule, in one pass; a null outcome is no violation."""
    row = df.agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    return row.unpivot([], list(rules), "rule", "n")


def violation_examples(df: DataFrame, column: str, ok: Column, most: int = 10) -> DataFrame:
    """(n, distinct, examples) of a column's values that break a rule; examples are the ``most`` smallest.

    The values are counted first, so that what is gathered is one row a value, and only the report's rows are collected.
    """
    values = df.filter(~ok).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    shown = values.filter("value is not null").orderBy("value").limit(most).agg(F.array_sort(F.collect_list("value")).alias("examples"))
    return values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("value").alias("distinct")).crossJoin(shown)


def starts_with_vocabulary(column: str, prefix: str = "biolink:") -> Column:
    return F.col(column).startswith(prefix)


def preferred_prefixes(nodes: DataFrame, preferred: DataFrame) -> DataFrame:
    """(category, prefix, n, preferred) for nodes, by (category, prefix) pairs; categories without any preference are left out."""
    counts = nodes.groupBy("category", F.split_part("id", F.lit(":"), F.lit(1)).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    ruled = counts.join(F.broadcast(preferred.select("category").distinct()), "category", "left_semi")
    return ruled.join(F.broadcast(preferred.withColumn("preferred", F.lit(True))), ["category", "prefix"], "left").withColumn("preferred", F.coalesce("preferred", F.lit(False)))


def schema_differences(df: DataFrame, wanted: dict[str, str]) -> dict[str, list[str]]:
    """Missing, superfluous and wrongly typed columns, from the schema alone."""
    have = dict(df.dtypes)
    return {"missing": [c for c in wanted if c not in have], "superfluous": [c for c in have if c not in wanted], "typed": [c for c, t in wanted.items() if c in have and have[c] != t]}


def file_issues(lines: DataFrame, header: list[str], separator: str = "\t") -> DataFrame:
    """(issue, n) of a delimited file's lines (column ``value``): carriage returns, column counts, spaces around cells, header rows.

    Lines are judged one by one, so files are read in splits; the header line is one that equals the wanted header.
    """
    cells = F.split("value", separator.replace("|", "\\|"))
    is_header = F.regexp_replace("value", "\r$", "") == separator.join(header)
    data = ~is_header
    issues = {
        "carriage_return": F.col("value").contains("\r"),
        "column_count": data & (F.size(cells) != len(header)),
        "outer_space": data & F.exists(cells, lambda c: c.rlike("^ | $")),
        "header_lines": is_header,
    }
    row = lines.agg(*[F.count_if(c).alias(n) for n, c in issues.items()])
    return row.unpivot([], list(issues), "issue", "n")
