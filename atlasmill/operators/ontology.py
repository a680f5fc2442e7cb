"""Flags, labels, versions and retired terms of an ontology given as triples (subject, predicate, object), and lists made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.closure import closure
from atlasmill.functions.lineage import materialize
from atlasmill.operators.lists import ICD_FORMS, leaf_parents, leaves

# Subsets, roots and reference forms behind the flags of a disease.
SUBSETS = {
    "clingen": ["clingen"],
    "susceptibility": ["susceptibility_match"],
    "mondo_subtype": ["mondo_subtype"],
    "grouping_subset": ["ordo_group_of_disorders", "disease_grouping", "harrisons_view", "rare_grouping"],
    "obsoletion_candidate": ["obsoletion_candidate"],
    "orphanet_subtype": ["ordo_subtype_of_a_disorder"],
    "orphanet_disorder": ["ordo_disorder"],
    "icd_billable": ["icd10_billable"],
}
ROOTS = {"cardiovascular": "MONDO:0004995", "heart_disorder": "MONDO:0005267", "inflammatory": "MONDO:0021166", "psychiatric": "MONDO:0002025", "cancer_or_benign_tumor": "MONDO:0045024"}
FORMS = {"omimps": r"^OMIMPS:", "omim": r"^OMIM:", **ICD_FORMS}
BELOW = {"orphanet_subtype_descendant": "orphanet_subtype", "omimps_descendant": "omimps"}
ABOVE = {"grouping_subset_ancestor": "__groups"}


def disease_flags(ids: DataFrame, triples: DataFrame, links: DataFrame, more_groupings: list[str] | None = None) -> DataFrame:
    """(id, 23 flags): subsets and references by one pass over the triples, descent by one closure.

    ``links``: (child, parent); ``more_groupings``: further subsets that make a term a grouping.
    """
    subsets = SUBSETS | {"grouping_subset": [*SUBSETS["grouping_subset"], *(more_groupings or [])]}
    has = lambda cond: F.coalesce(F.bool_or(cond), F.lit(False))
    direct = [has((F.col("predicate") == "inSubset") & F.col("object").isin(s)).alias(n) for n, s in subsets.items()]
    direct += [has((F.col("predicate") == "xref") & F.col("object").rlike(p)).alias(n) for n, p in FORMS.items()]
    direct.append(has((F.col("predicate") == "inSubset") & F.col("object").isin(SUBSETS["grouping_subset"])).alias("__groups"))  # ancestors are those of the common groupings
    own = triples.filter(F.col("predicate").isin("inSubset", "xref")).groupBy(F.col("subject").alias("id")).agg(*direct)
    up = closure(links)
    marked = own.select("id", *{*BELOW.values(), *ABOVE.values()})
    roots = F.array(*[F.lit(r) for r in ROOTS.values()])
    at = up.join(marked.withColumnRenamed("id", "ancestor"), "ancestor", "left").filter(F.array_contains(roots, F.col("ancestor")) | reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in BELOW.values()]))
    under = at.groupBy(F.col("descendant").alias("id")).agg(*[has(F.col("ancestor") == r).alias(n) for n, r in ROOTS.items()], *[has(F.col(c)).alias(n) for n, c in BELOW.items()])
    over = up.join(marked.withColumnRenamed("id", "descendant"), "descendant").groupBy(F.col("ancestor").alias("id")).agg(*[has(F.col(c)).alias(n) for n, c in ABOVE.items()])
    true = F.lit(True)
    edge = leaves(ids, links).withColumn("leaf", true)
    parents = leaf_parents(ids, links).withColumn("leaf_direct_parent", true)
    out = ids.select("id")
    for part in (own, under, over, edge, parents):
        out = out.join(part, "id", "left")
    flags = [*subsets, *FORMS, *ROOTS, *BELOW, *ABOVE, "leaf", "leaf_direct_parent"]
    itself = {n: F.col("id") == r for n, r in ROOTS.items()}  # a root is below itself, a subset's member is not
    return out.select("id", *[(F.coalesce(F.col(f), F.lit(False)) | itself.get(f, F.lit(False))).alias(f) for f in flags])


def included_disease() -> Column:
    """Whether a disease is included, by its flags: a leaf, a clinical entry, or the parent of a leaf with an entry of its own."""
    c = F.col
    entry = c("omim") | c("omimps_descendant") | c("icd_category") | c("orphanet_disorder") | c("orphanet_subtype")
    return c("leaf") | (c("leaf_direct_parent") & entry) | c("icd_category") | c("orphanet_disorder") | c("clingen") | c("omim")


def term_labels(triples: DataFrame, prefix: str) -> DataFrame:
    """(id, label) of the terms of one vocabulary."""
    return triples.filter((F.col("predicate") == "label") & F.col("subject").startswith(prefix)).select(F.col("subject").alias("id"), F.col("object").alias("label"))


def ontology_versions(triples: DataFrame) -> DataFrame:
    """(version, ontology, title) of each ontology in the triples, null where one is not given."""
    value = lambda p, out: triples.filter(F.col("predicate") == p).select(F.col("subject").alias("ontology"), F.col("object").alias(out))
    them = triples.filter((F.col("predicate") == "type") & (F.col("object") == "Ontology")).select(F.col("subject").alias("ontology"))
    return them.join(value("versionIRI", "version"), "ontology", "left").join(value("title", "title"), "ontology", "left").select("version", "ontology", "title")


def obsolete_terms(triples: DataFrame, prefix: str, separator: str = "|") -> DataFrame:
    """(id, label, replacements, considers) of the deprecated terms of one vocabulary; several values are joined in order."""
    own = triples.filter(F.col("subject").startswith(prefix))
    joined = lambda p: F.array_join(F.array_sort(F.collect_set(F.when(F.col("predicate") == p, F.col("object")))), separator)
    gone = F.bool_or((F.col("predicate") == "deprecated") & (F.col("object") == "true"))
    rows = own.filter(F.col("predicate").isin("label", "deprecated", "replaced_by", "consider")).groupBy(F.col("subject").alias("id"))
    return rows.agg(gone.alias("gone"), F.min(F.when(F.col("predicate") == "label", F.col("object"))).alias("label"), joined("replaced_by").alias("replacements"), joined("consider").alias("considers")).filter("gone").drop("gone")


def merge_drug_lists(curated: DataFrame, parts: list[DataFrame], columns: list[str], exceptions: list[str]) -> DataFrame:
    """The curated list with the columns of each part (by id, left), without the listed names, names and synonyms capitalised."""
    out = reduce(lambda a, b: a.join(b, "id", "left"), parts, curated)
    big = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))
    out = out.filter(~F.col("name").isin(exceptions) | F.col("name").isNull()).withColumn("is_fda_generic_drug", F.coalesce("is_fda_generic_drug", F.lit(False)))
    return out.withColumn("name", big(F.col("name"))).withColumn("synonyms", F.transform("synonyms", lambda s: big(F.trim(s)))).select(*columns)


#: People of the world in the prevalence of counts.
WORLD = 8e9
BANDS = [(1, "<1"), (10, "1-9"), (100, "10-99"), (1000, "100-999"), (10000, "1,000-9,999")]


def prevalence_100k(kind: str, numerator: str, denominator: str, subtype_percent: str, subgroup: str) -> Column:
    """Prevalence in 100,000: a count among all people, or a share (of a subgroup, where its size is given); a percentage of a primary disease scales both."""
    of_subtype = F.coalesce(F.col(subtype_percent) / 100, F.lit(1.0))
    of_subgroup = F.coalesce(F.col(subgroup) / WORLD, F.lit(1.0))
    count = F.col(numerator) / WORLD * 100_000 * of_subtype
    return F.when(F.col(kind) == "number", count).otherwise(F.try_divide(F.col(numerator), F.col(denominator)) * of_subgroup * 100_000 * of_subtype)


def prevalence_band(value: Column) -> Column:
    # two digits of the number as it is stored, halves to even; Java's %.2f would round what it prints at full length
    out = F.concat(F.call_function("format_number", value, F.lit("0.00")), F.lit(" in 100,000"))
    for limit, name in reversed(BANDS):
        out = F.when(value < limit, f"{name} in 100,000").otherwise(out)
    return F.when(value.isNotNull(), out)


def prevalence_consensus(estimates: DataFrame, key: str, value: str, strategy: str = "mean", unclear_above: float | None = 100_000, order: list[str] | None = None) -> DataFrame:
    """(key, prevalence) of several estimates: the band of their mean (above ``unclear_above``, if given, it is UNCLEAR), the commonest band (ties to the smaller name) or that of the least.

    A mean is that of the exact sum; if ``order`` names columns (a total order within a key), it is that of doubles added in this order.
    """
    band = prevalence_band(F.col(value))
    if strategy == "mode":
        counts = estimates.groupBy(key, band.alias("b")).agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "b"))["b"].alias("prevalence"))
    if strategy == "lowest":
        return estimates.groupBy(key).agg(F.min(value).alias("v")).select(key, prevalence_band(F.col("v")).alias("prevalence"))
    if strategy != "mean":
        raise ValueError(f"unknown strategy {strategy}")
    # summed as decimals: a mean half way between two printed numbers must not depend on the order of its rows
    exact = F.col(value).try_cast("decimal(28,10)")
    mean = F.when(F.count(exact) == F.count(value), F.avg(exact).cast("double")).otherwise(F.avg(value))
    shown = lambda v: F.when(v > F.lit(unclear_above), "UNCLEAR").otherwise(prevalence_band(v))
    if order is None:
        return estimates.groupBy(key).agg(mean.alias("v")).select(key, shown(F.col("v")).alias("prevalence"))
    # no order of the sum takes a mean further than this from the exact one; only where that could be seen are rows put in order
    off = F.sum(F.abs(value)) * 2.0**-52 + 1e-9
    off = F.when(F.count(exact) == F.count(value), off).otherwise(float("inf"))
    means = materialize(estimates.groupBy(key).agg(mean.alias("v"), off.alias("__off"), F.count(value).alias("__n")), "means")
    seen = ~shown(F.col("v") - F.col("__off")).eqNullSafe(shown(F.col("v") + F.col("__off")))
    near = materialize(means.filter(seen).select(key, "__n"), "near")
    if near.isEmpty():
        return means.select(key, shown(F.col("v")).alias("prevalence"))
    along = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = estimates.join(near, key).select(key, "__n", F.sum(value).over(along).alias("__sum"), F.row_number().over(along).alias("__i"))
    added = rows.groupBy(key).agg((F.max_by("__sum", "__i") / F.max("__n")).alias("__v"))
    return means.join(added, key, "left").select(key, shown(F.coalesce("__v", "v")).alias("prevalence"))
