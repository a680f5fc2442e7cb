"""Drug and disease lists: label flags, list merges, subtypes, ontology attributes and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.closure import closure

# Words of names of infectious diseases.
INFECTIOUS = "infection|bacterial|viral|virus|fungal|abscess|pneumoni|cocc|staph|strep|gonorr|parasit|tubercul|polio|candid|toxoplasm|syphilis|latent|herpe|fever|mycobact|pox$|poxvirus"


def typed(df: DataFrame, types: dict[str, str], required: list[str]) -> DataFrame:
    """The columns of a list, trimmed, empty as null, cast; what cannot be cast or lacks a required value fails at run time."""
    cells = {c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in types}
    cast = {c: F.when(cells[c].isNotNull() & cells[c].try_cast(t).isNull(), F.raise_error(F.concat(F.lit(f"{c} is no {t}: "), cells[c])).cast(t)).otherwise(cells[c].try_cast(t)) for c, t in types.items()}
    checked = {c: F.when(cast[c].isNull(), F.raise_error(F.lit(f"{c} is missing")).cast(types[c])).otherwise(cast[c]) if c in required else cast[c] for c in types}
    return df.select(*[v.alias(c) for c, v in checked.items()])


def label_flags(labels: str) -> dict[str, Column]:
    """Flags of an array of (application_number, marketing_status) structs of a drug's matched labels."""
    number = lambda r: F.lower(F.coalesce(F.trim(r["application_number"].cast("string")), F.lit("")))
    rows = F.coalesce(F.col(labels), F.expr("array()").cast("array<struct<application_number:string,marketing_status:string>>"))
    return {
        "n_labels": F.size(rows),
        "is_generic": F.size(rows) > 0,
        "is_biologic": F.exists(rows, lambda r: number(r).startswith("bla")),
        "is_anda": F.exists(rows, lambda r: number(r).startswith("anda")),
        "marketing_status": F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["marketing_status"]))), "|"),
    }


def bla_number(column: str) -> Column:
    """The digits of a licence number without leading zeros; null without digits."""
    digits = F.regexp_replace(F.col(column).cast("string"), r"\D", "")
    return F.when(digits != "", F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0")))


def biosimilars(drugs: DataFrame, numbers: str, book: DataFrame, allowed: list[str]) -> DataFrame:
    """Drugs (id, array of application numbers) with the sorted licence types of their numbers and whether one is allowed."""
    types = book.select(bla_number("bla_number").alias("__bla"), F.lower(F.trim("bla_type")).alias("__type")).filter("__bla is not null").distinct()
    asked = drugs.select("id", F.explode(numbers).alias("__n")).select("id", bla_number("__n").alias("__bla")).distinct()
    found = asked.join(types, "__bla").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("__type")), "|").alias("bla_types"), F.bool_or(F.col("__type").isin([a.lower().strip() for a in allowed])).alias("is_biosimilar"))
    return drugs.join(found, "id", "left").withColumn("bla_types", F.coalesce("bla_types", F.lit(""))).withColumn("is_biosimilar", F.coalesce("is_biosimilar", F.lit(False)))


def with_status(drugs: DataFrame, status: DataFrame, key: str, flag: str, default: bool = False) -> DataFrame:
    """A flag of a second list; drugs that it does not hold get the default."""
    return drugs.join(status.groupBy(key).agg(F.bool_or(flag).alias(flag)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(default)))


def token_key(column: Column) -> Column:
    """Words in upper case, sorted: equal keys are what a token-sort similarity of 100 means."""
    words = F.filter(F.split(F.regexp_replace(F.upper(column), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def collapse_parents(strategic: DataFrame, names: DataFrame) -> DataFrame:
    """Listed diseases and the parents that notes of kept rows quote: parents become viable, new ones are added.

    ``strategic``: id, viable, keep_parent, notes. ``names``: id, name. Quotes without an equal name are ignored.
    """
    quoted = F.nullif(F.split("notes", '"').getItem(1), F.lit(""))
    notes = strategic.filter("keep_parent = 'YES' and notes like '%\"%'").select(token_key(quoted).alias("__key")).distinct()
    parents = names.select("id", token_key(F.col("name")).alias("__key")).join(notes, "__key").select("id").distinct().withColumn("__parent", F.lit(True))
    merged = strategic.join(parents, "id", "full")
    return merged.withColumn("viable", F.coalesce("__parent", "viable")).withColumn("added", F.col("keep_parent").isNull() & F.col("__parent").isNotNull()).drop("__parent")


def merge_lists(base: DataFrame, lists: list[tuple[DataFrame, str]], key: str, defaults: dict[str, object]) -> DataFrame:
    """``base`` joined with each list in the way given (left, inner), and defaults where a value is missing."""
    for other, how in lists:
        base = base.join(other, key, how)
    return base.fillna(defaults)


def merge_metrics(base: DataFrame, groupings: DataFrame, metrics: DataFrame, counts: DataFrame, members: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Groupings, metrics with counts (full outer, keys neither null nor empty) and subtype membership beside the base list."""
    keyed = [d.filter(F.col(key) != "") for d in (metrics, counts)]
    return base.join(groupings, key, "left").join(keyed[0].join(keyed[1], key, "full"), key, "left").join(members.filter("subset_id <> ''").withColumnRenamed("subset_id", key), key, "left").fillna(defaults)


def infectious(name: str, pathogen: str) -> Column:
    return F.coalesce(F.col(pathogen), F.lit(False)) | F.coalesce(F.col(name).rlike(f"(?i){INFECTIOUS}"), F.lit(False))


def subtypes(labels: DataFrame, links: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(disease_id, label, parent_id, parent_label, pattern) of diseases whose label is a pattern around an ancestor's label.

    ``patterns`` have one group, the parent's label; the first in order whose parent is an ancestor counts.
    ``links``: (child, parent).
    """
    tried = F.array(*[F.struct(F.lit(k).alias("at"), F.lit(name).alias("pattern"), F.when(F.col("label").rlike(f"^(?:{p})"), F.lower(F.trim(F.regexp_extract("label", f"^(?:{p})", 1)))).alias("parent_label")) for k, (name, p) in enumerate(patterns.items())])
    asked = labels.select("disease_id", "label", F.explode(tried).alias("t")).select("disease_id", "label", "t.*").filter("parent_label is not null")
    known = labels.groupBy(F.lower("label").alias("parent_label")).agg(F.max("disease_id").alias("parent_id"))
    above = closure(links).select(F.col("descendant").alias("disease_id"), F.col("ancestor").alias("parent_id"))
    fits = asked.join(known, "parent_label").join(above, ["disease_id", "parent_id"], "left_semi")
    return fits.groupBy("disease_id", "label").agg(F.min(F.struct("at", "parent_id", "parent_label", "pattern")).alias("m")).select("disease_id", "label", "m.parent_id", "m.parent_label", "m.pattern")


def subtype_counts(matched: DataFrame) -> DataFrame:
    counts = matched.filter("parent_label <> ''").groupBy("parent_label").agg(F.count(F.lit(1)).alias("other_subsets_count"))
    return matched.join(counts, "parent_label").select(F.col("disease_id").alias("subset_id"), F.col("label").alias("subset_label"), F.col("parent_id").alias("subset_group_id"), F.col("parent_label").alias("subset_group_label"), "other_subsets_count")


def subset_rows(matched: DataFrame, subset: str) -> DataFrame:
    """(subject, predicate, object) declaring each parent a member of the subset."""
    return matched.select(F.col("parent_id").alias("subject"), F.lit("inSubset").alias("predicate"), F.lit(subset).alias("object")).distinct()


def clean_tokens(column: str, repair: bool = True) -> Column:
    """Lower-case words of a list between bars: whole words first, then (if repaired) the others with ``_`` for what is no word character."""
    word = lambda p: p.rlike(r"^(?U)\w+$")
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), r"\|"), lambda p: F.trim(p))
    good = F.transform(F.filter(parts, word), F.lower)
    mended = F.transform(F.filter(parts, lambda p: ~word(p)), lambda p: F.regexp_replace(F.lower(p), r"(?U)\W", "_"))
    return F.when(F.trim(F.coalesce(F.col(column), F.lit(""))) == "", "").otherwise(F.array_join(F.concat(good, mended) if repair else good, "|"))


def clean_flag(column: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(column).cast("string"))) == "true", F.lit(False))


def ontology_values(triples: DataFrame, ids: DataFrame, predicate: str, out: str, separator: str = "; ") -> DataFrame:
    """(id, out): the sorted distinct values of a predicate of each id that has one."""
    own = triples.filter(F.col("predicate") == predicate).join(ids.select(F.col("id").alias("subject")), "subject", "left_semi")
    return own.groupBy(F.col("subject").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("object")), separator).alias(out))


def flag_members(ids: DataFrame, members: dict[str, DataFrame]) -> DataFrame:
    """One boolean column for each set of ids."""
    for name, frame in members.items():
        ids = ids.join(frame.select("id").distinct().withColumn(name, F.lit(True)), "id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return ids


def in_subset(triples: DataFrame, subset: str) -> DataFrame:
    return triples.filter((F.col("predicate") == "inSubset") & (F.col("object") == subset)).select(F.col("subject").alias("id"))


def with_reference(triples: DataFrame, pattern: str) -> DataFrame:
    """Ids with a cross reference that a pattern finds."""
    return triples.filter((F.col("predicate") == "xref") & F.col("object").rlike(pattern)).select(F.col("subject").alias("id"))


def below(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Ids with an ancestor among the roots."""
    return closure(links).join(roots.select(F.col("id").alias("ancestor")), "ancestor", "left_semi").select(F.col("descendant").alias("id")).distinct()


def above(links: DataFrame, members: DataFrame) -> DataFrame:
    """Ids with a descendant among the members."""
    return closure(links).join(members.select(F.col("id").alias("descendant")), "descendant", "left_semi").select(F.col("ancestor").alias("id")).distinct()


def leaves(ids: DataFrame, links: DataFrame) -> DataFrame:
    return ids.join(links.select(F.col("parent").alias("id")), "id", "left_anti").select("id")


def leaf_parents(ids: DataFrame, links: DataFrame) -> DataFrame:
    return links.join(leaves(ids, links).withColumnRenamed("id", "child"), "child", "left_semi").select(F.col("parent").alias("id")).distinct()


# Forms of ICD-10 codes. A category has a point, a chapter code a dash, a chapter header neither.
ICD_FORMS = {"icd_category": r"^ICD10\S*:[^-]*\.[^-]*$", "icd_chapter_code": r"^ICD10\S*:[^.]*-[^.]*$", "icd_chapter_header": r"^ICD10\S*:[^.-]*$"}
