"""URL filter: rules first, boosted trees on lexical features for what no rule covers.

All of it is DataFrame work and Spark's own tree learner in the JVM. The rules label the URLs they
cover; a gradient-boosted ensemble learns from a bounded sample of those (``SAMPLE`` rows expected,
chosen by a hash of id and URL) and judges the rest. Suffix statistics are smoothed block rates of
the host's last label, of the first path segment and of the file extension, hashed into ``SLOTS``
slots so that their table is bounded; they are counted over all labelled rows.

The table is read three times: for the rates, for the sample (which is written, so that the rounds of
boosting read only that) and for the verdicts.

Nulls: a null URL, or one without ``://``, has an empty host and path, and the model's verdict on
empty features; null ids are kept. With no labelled URL every verdict is allow; with one kind of label,
that label. Repeated rows get the same verdict. Very long URLs are used whole. An empty table gives
an empty result. Input columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.llm.common import without

SAMPLE = 20_000
SLOTS = 512
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "host_entropy", "n_params", "n_labels", "n_hyphens", "tail_rate", "head_rate", "ext_rate"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, start, what in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest is tested first, as it wraps the others
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(at + start)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits a character, by code points."""
    chars = F.split(text, "")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    bits = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - F.when(share(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(F.length(text) > 0, bits).otherwise(0.0)


def _parts(df: DataFrame, url_col: str) -> DataFrame:
    url, host, path = F.coalesce(F.col(url_col), F.lit("")), F.col("host"), F.col("path")
    count = lambda text, what: F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))
    bare = F.regexp_replace(path, "[0-9]", "")
    slot = lambda text, kind: F.pmod(F.xxhash64(text, F.lit(kind)), F.lit(SLOTS)).cast("int")
    return (
        df.withColumn("__url_length", F.length(url).cast("double"))
        .withColumn("__host_length", F.length(host).cast("double"))
        .withColumn("__path_length", F.length(path).cast("double"))
        .withColumn("__depth", count(path, "/").cast("double"))
        .withColumn("__digit_ratio", (F.length(path) - F.length(bare)) / F.greatest(F.length(path), F.lit(1)))
        .withColumn("__entropy", _entropy(path))
        .withColumn("__host_entropy", _entropy(host))
        .withColumn("__n_params", (count(url, "=") + count(url, "&")).cast("double"))
        .withColumn("__n_labels", (count(host, ".") + 1).cast("double"))
        .withColumn("__n_hyphens", (count(host, "-") + count(path, "-")).cast("double"))
        .withColumn("__tail", slot(F.substring_index(host, ".", -1), "tail"))
        .withColumn("__head", slot(F.regexp_extract(path, "^/([^/]*)", 1), "head"))
        .withColumn("__ext", slot(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1), "ext"))
    )


def _rates(labelled: DataFrame) -> tuple[int, int, dict[str, Column]]:
    """(labelled rows, blocked ones, a literal array of ``SLOTS`` smoothed block rates for each kind of suffix), by one pass."""
    kinds = ("tail", "head", "ext")
    slots = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"__{k}").alias("slot")) for k in kinds]))
    rows = labelled.select("__label", slots.alias("s")).groupBy("s.kind", "s.slot").agg(F.count(F.lit(1)).alias("n"), F.sum("__label").alias("bad")).collect()  # 3 * SLOTS rows at most
    n, bad = (int(sum(r[c] for r in rows if r["kind"] == "tail")) for c in ("n", "bad"))
    prior = bad / max(1, n)
    out = {}
    for kind in kinds:
        rate = [prior] * SLOTS
        for r in rows:
            if r["kind"] == kind:
                rate[r["slot"]] = (r["bad"] + 10 * prior) / (r["n"] + 10)
        out[kind] = F.array(*[F.lit(round(r, 9)) for r in rate])
    return n, bad, out


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE, rounds: int = 10, depth: int = 3) -> DataFrame:
    """Every row with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (the trees' probability)."""
    made = ["host", "path", "rule", "verdict", "block_score"]
    pages = without(pages, made)
    own = pages.columns
    cut = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    parts = _parts(cut.withColumn("rule", rule).withColumn("__by_rule", verdict), url_col)
    labelled = parts.filter("rule is not null").withColumn("__label", (F.col("__by_rule") == "block").cast("double"))
    n, bad, rates = _rates(labelled)
    if not n or bad in (0, n):
        lone = F.lit("block" if n and bad == n else "allow")
        return parts.select(*own, "host", "path", "rule", F.coalesce("__by_rule", lone).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    ready = lambda df: VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__x").transform(
        df.select("*", *[F.element_at(rates[k], F.col(f"__{k}") + 1).alias(f"__{k}_rate") for k in rates])
    )
    share = int(min(1.0, sample / n) * (1 << 20))
    chosen = ready(labelled.filter(F.pmod(F.xxhash64(id_col, url_col), F.lit(1 << 20)) < share)).select(*[f"__{f}" for f in FEATURES], "__label")
    learn = VectorAssembler(inputCols=[f"__{f}" for f in FEATURES], outputCol="__x").transform(materialize(chosen.coalesce(8), "url-sample"))
    model = GBTClassifier(featuresCol="__x", labelCol="__label", predictionCol="__p", maxIter=rounds, maxDepth=depth, seed=7).setProbabilityCol("__prob").setRawPredictionCol("__raw").fit(learn.select("__x", "__label"))
    scored = model.transform(ready(parts))
    bad_score = F.element_at(vector_to_array(F.col("__prob")), 2)
    learnt = F.when(F.col("__p") > 0.5, "block").otherwise("allow")
    return scored.select(*own, "host", "path", "rule", F.coalesce("__by_rule", learnt).alias("verdict"), bad_score.alias("block_score"))
