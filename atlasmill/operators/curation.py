"""Curated entity lists and raw-source cleaning as column rules and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def flag_labels(flags: dict[str, Column]) -> Column:
    """The names of the flags that hold, joined by ``|``; empty if none does."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()])), "|")


def strip_suffixes(df: DataFrame, separator: str = ":") -> DataFrame:
    """Column names without a type suffix (``id:ID`` is ``id``)."""
    return df.withColumnsRenamed({c: c.split(separator)[0] for c in df.columns if separator in c and c.split(separator)[0]})


def padded_curie(prefix: str, column: str, width: int) -> Column:
    return F.concat(F.lit(prefix + ":"), F.lpad(F.col(column).cast("string"), width, "0"))


def first_rule(rules: list[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first rule that holds: one projection in place of a scan for each rule."""
    out = default
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def both_directions(edges: DataFrame, directed: Column) -> DataFrame:
    """Edges, and the undirected ones a second time with ends exchanged; loops are not repeated."""
    back = F.array(F.struct("subject", "object"), F.struct(F.col("object").alias("subject"), F.col("subject").alias("object")))
    there = F.array(F.struct("subject", "object"))
    rest = [c for c in edges.columns if c not in ("subject", "object")]
    return edges.select(F.explode(F.when(directed | (F.col("subject") == F.col("object")), there).otherwise(back)).alias("__e"), *rest).select("__e.*", *rest)


def reference_summary(references: DataFrame, by: list[str], sentence: str, reference: str) -> DataFrame:
    """Sentences and distinct references for each edge; references are made distinct before they meet."""
    pairs = references.groupBy(*by, reference).agg(F.count(sentence).alias("__s"))
    return pairs.groupBy(*by).agg(F.sum("__s").alias("num_sentences"), F.count(reference).alias("num_references"))


def best_outcome(df: DataFrame, by: list[str], outcomes: list[str]) -> DataFrame:
    """Each outcome's maximum for a key, with only the first that is set in the order given kept."""
    best = df.groupBy(*by).agg(*[F.max(o).alias(o) for o in outcomes])
    before, columns = F.lit(False), []
    for o in outcomes:
        is_set = F.coalesce(F.col(o) == 1, F.lit(False))
        columns.append(F.when(is_set & ~before, 1).otherwise(0).alias(o))
        before = before | is_set
    return best.select(*by, *columns)


def search_terms(column: str) -> Column:
    """A term and, for two words, "a, b" and "b, a"."""
    words = F.split(column, " ")
    a, b = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    return F.when(F.size(words) == 2, F.array(F.col(column), F.concat_ws(", ", a, b), F.concat_ws(", ", b, a))).otherwise(F.array(F.col(column)))


def contained_names(names: DataFrame, phrases: DataFrame) -> DataFrame:
    """(name, phrase) where the name is a run of whole words of the phrase, by an equi-join on word runs, not all pairs.

    Runs are as long as names are: the lengths that occur are the only ones cut from phrases.
    """
    words = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")
    keyed = names.select("name", words("name").alias("__w")).filter(F.size("__w") > 0).select("name", F.size("__w").alias("__n"), F.array_join("__w", " ").alias("__k")).distinct()
    lengths = keyed.select("__n").distinct()
    runs = phrases.select("phrase", words("phrase").alias("__w")).crossJoin(lengths).filter(F.size("__w") >= F.col("__n"))
    starts = runs.select("phrase", "__w", "__n", F.explode(F.sequence(F.lit(1), F.size("__w") - F.col("__n") + 1)).alias("__i"))
    cut = starts.select("phrase", "__n", F.array_join(F.slice("__w", F.col("__i"), F.col("__n")), " ").alias("__k")).distinct()
    return cut.join(keyed, ["__n", "__k"]).select("name", "phrase").distinct()


def is_combination(column: str) -> Column:
    return F.col(column).rlike(r"(?i)\s(and|with)\s|[+/;]")


def by_name_or_synonym(items: DataFrame, names: DataFrame) -> DataFrame:
    """Items with ``found``: the least id of (id, name, synonyms) by name, else by a synonym, without regard to case."""
    own = names.groupBy(F.lower("name").alias("__k")).agg(F.min("id").alias("__by_name"))
    other = names.select("id", F.explode("synonyms").alias("s")).groupBy(F.lower("s").alias("__k")).agg(F.min("id").alias("__by_synonym"))
    keyed = items.withColumn("__k", F.lower("name"))
    return keyed.join(own, "__k", "left").join(other, "__k", "left").withColumn("found", F.coalesce("__by_name", "__by_synonym")).drop("__k", "__by_name", "__by_synonym")


def choose_candidate(candidates: str, accepted: list[str]) -> Column:
    """The id of the first candidate (id, category) with an accepted category, else of the first."""
    good = F.filter(candidates, lambda c: c["category"].isin(accepted))
    return F.coalesce(F.get(good, F.lit(0))["id"], F.get(F.col(candidates), F.lit(0))["id"])


def capitalized(column: str) -> Column:
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(F.expr(f"substring({column}, 2)")))


def yes_no(column: str) -> Column:
    """yes: true; no and maybe: false; else null."""
    t = F.lower(F.trim(column))
    return F.when(t == "yes", True).when(t.isin("no", "maybe"), False)


def conflict_is_false(df: DataFrame, key: str, flag: str) -> DataFrame:
    """One row a key: the flag if all rows agree, else false."""
    return df.groupBy(key).agg((F.coalesce(F.min(F.col(flag).cast("int")), F.lit(0)) == 1).alias(flag))


def migrate(reviews: DataFrame, known: DataFrame, obsolete: DataFrame) -> DataFrame:
    """Reviews of known ids, and those of obsolete ids under their replacement; what still is unknown raises."""
    lost = reviews.join(known, "id", "left_anti")
    moved = lost.join(obsolete.select("id", "replacement"), "id").withColumn("id", F.col("replacement")).drop("replacement")
    out = reviews.join(known, "id", "left_semi").unionByName(moved)
    bad = out.join(known, "id", "left_anti").unionByName(lost.join(obsolete, "id", "left_anti")).limit(5).collect()
    if bad:
        raise ValueError("unknown ids: " + ", ".join(sorted(str(r["id"]) for r in bad)))
    return out


def overlay(base: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """The base with the top's values where they are not null."""
    shared = [c for c in top.columns if c != key]
    joined = base.join(top.select(key, *[F.col(c).alias(f"__top_{c}") for c in shared]), key, "left")
    return joined.select(key, *[F.coalesce(f"__top_{c}", c).alias(c) if c in shared else F.col(c) for c in base.columns if c != key])


def icd_curie(column: str) -> Column:
    """A code with a dot after its third character as a CURIE."""
    return F.concat(F.lit("ICD10CM:"), F.when(F.length(column) > 3, F.concat(F.substring(column, 1, 3), F.lit("."), F.expr(f"substring({column}, 4)"))).otherwise(F.col(column)))


def group_by_evidence(positive: Column, negative: Column) -> Column:
    """Any positive and no negative; nulls count as no."""
    return F.coalesce(positive, F.lit(False)) & ~F.coalesce(negative, F.lit(False))


def subset_members(column: str, grouping: str, separator: str = ";") -> Column:
    """The members of ``grouping`` among ``grouping_member`` parts, without 'other' if there are others."""
    parts = F.filter(F.split(column, separator), lambda p: p.startswith(grouping + "_"))
    names = F.transform(parts, lambda p: F.substring(p, len(grouping) + 2, 1 << 20))
    named = F.filter(names, lambda n: n != "other")
    return F.array_join(F.when(F.size(named) > 0, named).otherwise(names), "|")


def prevalence_bucket(per_100k: Column) -> Column:
    return F.when(per_100k < 1, "ultra rare").when(per_100k < 50, "rare").when(per_100k >= 50, "common")


def majority_label(votes: DataFrame, key: str, label: str, least: int, default: str) -> DataFrame:
    """The label of at least ``least`` votes of a key (the most frequent, ties to the smaller name), else the default."""
    counts = votes.groupBy(key, label).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("__n")).alias("m"), F.col(label).alias("l"))).alias("b"))
    return best.select(key, F.when(-F.col("b.m") >= least, F.col("b.l")).otherwise(F.lit(default)).alias(label))


def release_diff(old: DataFrame, new: DataFrame, key: str, examples: int = 5) -> DataFrame:
    """(change, column, n, examples): rows added and removed and, for common columns, changed values as texts."""
    shared = [c for c in old.columns if c in new.columns and c != key]

    def unfold(df: DataFrame, name: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias(name)) for c in [key, *shared]])
        return df.select(F.col(key), F.explode(cells).alias("__c")).select(key, "__c.column", F.col(f"__c.{name}").alias(name), F.lit(True).alias(f"in_{name}"))

    both = unfold(old, "was").join(unfold(new, "is"), [key, "column"], "full")
    row = F.col("column") == key
    change = F.when(row & F.col("in_was").isNull(), "added").when(row & F.col("in_is").isNull(), "removed").when(~row & F.col("in_was") & F.col("in_is") & ~F.col("was").eqNullSafe(F.col("is")), "changed")
    found = both.withColumn("change", change).filter("change is not null").select("change", "column", F.col(key).cast("string").alias("id"))
    place = F.row_number().over(W.partitionBy("change", "column").orderBy("id"))
    shown = found.withColumn("r", place).filter(F.col("r") <= examples).groupBy("change", "column").agg(F.array_join(F.array_sort(F.collect_list("id")), "|").alias("examples"))
    return found.groupBy("change", "column").agg(F.count(F.lit(1)).alias("n")).join(shown, ["change", "column"])
