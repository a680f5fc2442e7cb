"""Training data for pair models: valid pairs, embeddings, splits, sampled unknowns, scaling, ensembles and their metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.operators.comparison import rank_within
from atlasmill.operators.fabricate import share
from atlasmill.operators.graph import rank_rows
from atlasmill.operators.ranking import negative_sample
from atlasmill.operators.standardize import least_row

#: Label of a sampled pair of which nothing is known.
UNKNOWN = 2


def from_sources(pairs: DataFrame, sources: list[str], column: str = "upstream_data_source") -> DataFrame:
    """Pairs of the given sources, once for each (source, target); all pairs as they are where the column is missing."""
    return least_row(pairs.filter(F.col(column).isin(sources)), ["source", "target"]) if column in pairs.columns else pairs


def existing_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of which both ends are nodes."""
    ids = nodes.select("id")
    return pairs.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def valid_pairs(nodes: DataFrame, pairs: DataFrame, categories: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pairs whose ends are nodes of the wanted categories, and one row of retention ratios, 1 where there is nothing to retain."""
    fits = nodes.groupBy("id").agg(F.bool_or(F.coalesce(F.arrays_overlap("all_categories", F.lit(categories)), F.lit(False))).alias("fits"))
    seen = pairs.filter("y in (0, 1)")
    for end in ("source", "target"):
        seen = seen.join(fits.select(F.col("id").alias(end), F.col("fits").alias(f"__{end}")), end, "left")
    in_kg = F.col("__source").isNotNull() & F.col("__target").isNotNull()
    in_categories = F.coalesce(F.col("__source") & F.col("__target"), F.lit(False))
    ratios = []
    for name, y in (("positive", 1), ("negative", 0)):
        rows = F.count_if(F.col("y") == y)
        for stage, kept in (("in_kg", in_kg), ("in_categories", in_categories), ("final", in_kg & in_categories)):
            ratios.append(F.coalesce(F.try_divide(F.count_if((F.col("y") == y) & kept), rows), F.lit(1.0)).alias(f"{name}_pairs_retained_{stage}_pct"))
    return seen.filter(in_kg & in_categories).select(pairs.columns), seen.agg(*ratios)


def attach_embeddings(pairs: DataFrame, nodes: DataFrame, column: str = "topological_embedding") -> DataFrame:
    """Pairs with ``source_embedding`` and ``target_embedding``."""
    for end in ("source", "target"):
        pairs = pairs.join(nodes.select(F.col("id").alias(end), F.col(column).cast("array<float>").alias(f"{end}_embedding")), end, "left")
    return pairs


def sampling_nodes(nodes: DataFrame, pairs: DataFrame, drugs: list[str], diseases: list[str]) -> DataFrame:
    """Drug and disease nodes with ``is_drug``, ``is_disease`` and ``in_ground_pos``: the source of any pair or the target of a positive one."""
    known = pairs.select(F.col("source").alias("id")).union(pairs.filter("y = 1").select("target")).distinct().withColumn("in_ground_pos", F.lit(True))
    flagged = nodes.withColumn("is_drug", F.arrays_overlap("all_categories", F.lit(drugs))).withColumn("is_disease", F.arrays_overlap("all_categories", F.lit(diseases)))
    return flagged.filter("is_drug or is_disease").join(known, "id", "left").withColumn("in_ground_pos", F.coalesce("in_ground_pos", F.lit(False)))


def with_full_fold(folds: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """The folds, and fold ``n`` of all pairs for training."""
    return folds.unionByName(pairs.withColumn("split", F.lit("TRAIN")).withColumn("fold", F.lit(n).cast(folds.schema["fold"].dataType)))


def area_split(pairs: DataFrame, diseases: DataFrame, grouping: str, areas: list[str]) -> DataFrame:
    """One fold for each area: pairs of listed diseases, TEST if the grouping contains the area in any case."""
    if grouping not in diseases.columns:
        raise ValueError(f"no grouping {grouping} in the disease list")
    listed = pairs.join(diseases.select(F.col("id").alias("target"), F.lower(F.coalesce(grouping, F.lit(""))).alias("__areas")), "target")
    fold = F.posexplode(F.array(*[F.lit(a.lower()) for a in areas])).alias("fold", "__area")
    return listed.select("*", fold).withColumn("split", F.when(F.col("__areas").contains(F.col("__area")), "TEST").otherwise("TRAIN")).drop("__areas", "__area")


def drug_holdout(pairs: DataFrame, n_splits: int = 1, test_size: float = 0.1, seed: int = 0) -> DataFrame:
    """``n_splits`` folds; in each all pairs of a share of the drugs, first in md5 order, are TEST (one drug at least)."""
    drugs = pairs.select("source").distinct()
    most = max(1, round(drugs.count() * test_size))
    folds = []
    for fold in range(n_splits):
        order = [F.md5(F.concat_ws("|", F.lit(f"{seed}|{fold}"), "source")), F.col("source")]
        held = rank_rows(drugs, order, "__rank").filter(F.col("__rank") < most).select("source", F.lit("TEST").alias("split"))
        folds.append(pairs.join(held, "source", "left").withColumn("split", F.coalesce("split", F.lit("TRAIN"))).withColumn("fold", F.lit(fold)))
    return reduce(DataFrame.unionByName, folds)


def replacement_sample(known: DataFrame, drugs: DataFrame, diseases: DataFrame, each: int, seed: int = 0) -> DataFrame:
    """For each positive pair, ``each`` times: one pair with another drug and one with another disease, not in ``known``.

    The first entity from a drawn position of the ranked list on, round the end, that gives an unknown pair
    counts; only an end known with all entities has none. Nothing is crossed and no position is tried: known
    positions of an end that stays are runs, and a drawn one leads to the first place after its run.
    """
    asked = known.filter("y = 1").select("source", "target").distinct().withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(each))))
    pairs = known.select("source", "target").distinct()
    found = []
    for end, stays, entities in (("source", "target", drugs), ("target", "source", diseases)):
        listed = rank_rows(entities.select(F.col(end).alias("__new")).distinct(), [F.col("__new")], "__at")
        n = F.lit(listed.count()).cast("long")
        held = pairs.join(listed, F.col(end) == F.col("__new")).select(stays, "__at")
        held = rank_within(held, [stays], [F.col("__at")], "__r").select(stays, "__at", (F.col("__at") - F.col("__r")).alias("__run"))
        runs = held.groupBy(stays, "__run").agg(F.min("__at").alias("__from"), F.max("__at").alias("__upto"))
        heads = runs.filter("__from = 0").select(stays, F.col("__upto").alias("__head"))
        around = F.coalesce(F.col("__head") + 1, F.lit(0))
        after = F.when(F.col("__upto") < n - 1, F.col("__upto") + 1).when(around < n, around)
        runs = runs.join(heads, stays, "left").select(stays, "__run", after.alias("__after"))
        first = F.floor(share(seed, end, "source", "target", "copy") * n).cast("long")
        drawn = asked.withColumn("__at", first).join(held, [stays, "__at"], "left")
        met = drawn.filter("__run is not null").join(runs, [stays, "__run"]).select("source", "target", "copy", F.col("__after").alias("__at"))
        places = drawn.filter("__run is null").select("source", "target", "copy", "__at").unionByName(met)
        found.append(places.join(listed, "__at").select(F.lit(end).alias("replaced"), "copy", *[F.col("__new" if c == end else c).alias(c) for c in ("source", "target")]))
    return found[0].unionByName(found[1])


def area_sample(known: DataFrame, folds: DataFrame, drugs: DataFrame, diseases: DataFrame, each: int, seed: int = 0) -> DataFrame:
    """Unknown pairs for the folds of an area split: (fold, split, source, target), for training with diseases outside of the fold's area, for testing with those in it.

    ``folds``: (source, target, fold, split) of the known pairs; ``diseases``: (target, fold, split) of every disease.
    """
    out = []
    for fold, split in sorted((r["fold"], r["split"]) for r in diseases.select("fold", "split").distinct().collect()):  # a few rows a fold
        here = (F.col("fold") == fold) & (F.col("split") == split)
        positives = folds.filter(here).join(known.filter("y = 1").select("source", "target").distinct(), ["source", "target"], "left_semi").select("source", "target")
        drawn = negative_sample(positives, drugs, diseases.filter(here).select("target"), each, seed + fold)
        free = drawn.join(known.select("source", "target").distinct(), ["source", "target"], "left_anti")
        out.append(free.select(F.lit(fold).alias("fold"), F.lit(split).alias("split"), "source", "target"))
    return reduce(DataFrame.unionByName, out)


def enrich_folds(folds: DataFrame, n: int, drugs: DataFrame, diseases: DataFrame, each: int, seed: int = 0) -> DataFrame:
    """The folds, each with unknown pairs of its own added to its training rows."""
    out = folds.select("source", "target", "y", "split", "fold")
    added = []
    for fold in range(n):
        known = folds.filter(F.col("fold") == fold).filter("y = 1").select("source", "target")
        drawn = negative_sample(known, drugs, diseases, each, seed + fold)
        added.append(drawn.select("source", "target", F.lit(UNKNOWN).alias("y"), F.lit("TRAIN").alias("split"), F.lit(fold).cast(folds.schema["fold"].dataType).alias("fold")))
    return reduce(DataFrame.unionByName, added, out)


def flat(df: DataFrame, column: str, size: int, prefix: str) -> DataFrame:
    """One column for each component of a vector."""
    return df.select("*", *[F.get(column, F.lit(i)).alias(f"{prefix}{i}") for i in range(size)]).drop(column)


def fit_scaler(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, from training rows in one pass."""
    row = train.agg(*[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in fitted.items()})


def search(df: DataFrame, candidates: dict[str, Column]) -> DataFrame:
    """(candidate, accuracy) of predicted labels, all candidates in one pass over the labelled rows."""
    row = df.filter("y in (0, 1)").agg(*[F.avg((p == F.col("y")).cast("double")).alias(name) for name, p in candidates.items()])
    return row.unpivot([], list(candidates), "candidate", "accuracy")


def train_ensemble(train: DataFrame, features: list[str], seed: int = 0) -> list[Model]:
    """A forest and boosted trees on labelled rows."""
    vectors = train.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in features])).alias("features"), F.col("y").cast("double").alias("label"))
    return [RandomForestClassifier(seed=seed, numTrees=20).fit(vectors), GBTClassifier(seed=seed, maxIter=10).fit(vectors)]


def mean_probability(df: DataFrame, models: list[Model], features: list[str], out: str = "probability") -> DataFrame:
    """The mean of the models' probabilities of label 1, and ``predicted``, the likelier label."""
    scored = df.withColumn("features", array_to_vector(F.array(*[F.col(c).cast("double") for c in features])))
    for k, model in enumerate(models):
        made = model.copy().setProbabilityCol(f"__p{k}").setRawPredictionCol(f"__r{k}").setPredictionCol(f"__y{k}")
        scored = made.transform(scored)
    mean = sum((vector_to_array(f"__p{k}")[1] for k in range(1, len(models))), vector_to_array("__p0")[1]) / len(models)
    return scored.withColumn(out, mean).select(*df.columns, out).withColumn("predicted", (F.col(out) >= 0.5).cast("int"))


def split_metrics(df: DataFrame, predicted: str = "predicted") -> DataFrame:
    """(split, accuracy, macro_f1) from the confusion counts; a label without true or predicted rows counts as F1 0 if it occurs."""
    counts = df.groupBy("split", F.col("y").alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    one_label = counts.select("split", F.explode(F.array_distinct(F.array("t", "p"))).alias("label"), (F.col("t") == F.col("p")).alias("right"), "n")
    by_label = one_label.groupBy("split", "label").agg(F.sum(F.when(F.col("right"), 2 * F.col("n")).otherwise(0)).alias("hit2"), F.sum(F.when(F.col("right"), 2 * F.col("n")).otherwise(F.col("n"))).alias("both"))
    macro = by_label.groupBy("split").agg(F.avg(F.col("hit2") / F.col("both")).alias("macro_f1"))
    accuracy = counts.groupBy("split").agg((F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    return accuracy.join(macro, "split")
