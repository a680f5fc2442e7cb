"""Quality rules with thresholds that adapt to each language and source.

Base counts come from one pass over the whole texts. Three ratios of them (symbols per word,
characters per word, repeated lines per line; as integers in thousandths) go into mergeable quantile
sketches: log-linear histograms whose bucket is the value with all but its leading ``PRECISION``
bits cleared, so a sketch is a table (cell, ratio, bucket, count), merging is adding counts, and the
relative error is below 2 ** (1 - PRECISION) whatever the order of merging. A cell is a (language,
source) pair. Its sketch is shrunk towards its parents: ``OF_LANGUAGE`` texts distributed as those of
its language and ``OF_ALL`` as all texts are added to it, so a small cell follows its language and a
large one itself, without a size at which that switches; a language's sketch is shrunk towards all.

A limit is an outer quantile of the cell's sketch, moved out by a multiple of its distance to the
median; where that distance is 0 the limit is the quantile itself (if three quarters of a cell's texts
have no symbols, a text with symbols fails there). Values are compared by bucket. A cell of which much
is junk would widen its own limits, so they are guarded by its language: if the cell's median is within
the language's limit, the cell's limit is at most twice as far from the language's median as that. A
source that is different as a whole, its median beyond the language's limit, keeps its own limits.

Nulls: a null text counts as empty (it fails the base rule); a null language or source is a value of
its own. Ties need no order, as equal values share a bucket. Repeated rows are judged each. Very long
texts are read whole, one slice each. An empty table gives an empty result. Input columns that bear
the name of a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import key_text
from atlasmill.llm.common import small_batches, text_slices, without

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
WINDOW = 5
PRECISION = 8
#: Texts that a cell's sketch gets from its language's and from all texts' distribution.
OF_LANGUAGE, OF_ALL = 64, 16
#: Parts of a text in which shares are counted, so that sketches stay whole numbers.
UNIT = 1 << 16
#: (ratio, numerator, denominator, outer quantile in hundredths from above and from below, multiple of its distance to the median; limited below too)
RATIOS = [
    ("symbols", "n_symbols", "n_words", 25, 6, False),
    ("length", "word_chars", "n_words", 25, 8, True),
    ("dup_lines", "n_dup_lines", "n_lines", 1, 2, False),
]


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at two or more places of the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    window, distinct = code[:n], len(ids)
    for k in range(1, width):
        window = window * len(ids) + code[k : k + n]
        distinct *= len(ids)
        if distinct > 2**62 // max(1, len(ids)):
            window = np.unique(window, return_inverse=True)[1]
            distinct = int(window.max()) + 1
    _, inverse, times = np.unique(window, return_inverse=True, return_counts=True)
    hit = (times > 1)[inverse]
    if not hit.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += hit
    edge[width : n + width] -= hit
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()  # of bytes: exactly the six ASCII white space characters separate
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(joined) - len(joined.translate(None, b"#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _count(batches: Iterator[pa.RecordBatch], text_col: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_slices(batches, text_col):
        found = np.array([base_counts(t or b"") for t in texts], np.int64).reshape(len(texts), len(COUNTS))
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], *[pa.array(found[:, k]) for k in range(len(COUNTS))]], names=[*keep, *COUNTS])


def text_counts(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) and the base counts of every row."""
    small_batches(docs.sparkSession)
    docs = without(docs, COUNTS)
    keep = docs.columns if keep is None else keep
    read = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = T.StructType([*[read.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return read.mapInArrow(lambda it: _count(it, text_col, keep), schema)


def bucket(value: Column, precision: int = PRECISION) -> Column:
    """The sketch's bucket of a non-negative integer: its leading bits."""
    low = F.greatest(F.length(F.bin(value)) - F.lit(precision), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _ratio(top: str, below: str) -> Column:
    return F.expr(f"(1000 * {top}) div greatest({below}, 1)")


def sketches(counted: DataFrame, by: tuple[str, str]) -> DataFrame:
    """(language, source, ratio, bucket, n): one mergeable histogram for each cell and ratio."""
    ratios = F.explode(F.array(*[F.struct(F.lit(name).alias("ratio"), bucket(_ratio(a, b)).alias("bucket")) for name, a, b, *_ in RATIOS]))
    exploded = counted.filter(~base_failed()).select(F.col(by[0]).alias("lang"), F.col(by[1]).alias("source"), ratios.alias("r"))
    return exploded.groupBy("lang", "source", "r.ratio", "r.bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, cell: str) -> DataFrame:
    """(cell, ratio, mid, low, high) of the weighted histograms (cell, ratio, bucket, w): the median and the limits on both sides of it."""
    merged = sketch.groupBy(cell, "ratio", "bucket").agg(F.sum("w").alias("w"))
    part = W.partitionBy(cell, "ratio")
    run = merged.withColumn("upto", F.sum("w").over(part.orderBy("bucket"))).withColumn("whole", F.sum("w").over(part))
    outer = times = F.lit(None).cast("long")
    for name, _, _, hundredths, multiple, _ in RATIOS:
        outer, times = F.when(F.col("ratio") == name, F.lit(hundredths).cast("long")).otherwise(outer), F.when(F.col("ratio") == name, F.lit(multiple).cast("long")).otherwise(times)
    at = lambda share: F.min(F.when(F.col("upto") * 100 >= F.col("whole") * share, F.col("bucket")))
    found = run.groupBy(cell, "ratio").agg(at(outer).alias("under"), at(F.lit(50)).alias("mid"), at(100 - outer).alias("over"))
    return found.select(cell, "ratio", "mid", (F.col("under") - times * (F.col("mid") - F.col("under"))).alias("low"), (F.col("over") + times * (F.col("over") - F.col("mid"))).alias("high"))


def _as_texts(part: list[str], texts: int) -> Column:
    """The weight of each bucket if the whole of its ``part`` were ``texts`` texts."""
    return F.expr(f"{texts * UNIT} * n div sum(n) over (partition by {', '.join(part)})")


def limits(sketch: DataFrame) -> DataFrame:
    """cell (key of language and source), and lowest and highest accepted bucket of each ratio (null: no limit)."""
    keyed = materialize(sketch.select(key_text("lang").alias("lk"), key_text("lang", "source").alias("cell"), "ratio", "bucket", "n"), "sketches")
    of_lang = keyed.groupBy("lk", "ratio", "bucket").agg(F.sum("n").alias("n"))
    of_all = keyed.groupBy("ratio", "bucket").agg(F.sum("n").alias("n")).withColumn("w", _as_texts(["ratio"], OF_ALL)).select("ratio", "bucket", "w")
    language = of_lang.select("lk", "ratio", "bucket", (F.col("n") * UNIT).alias("w")).unionByName(of_lang.select("lk", "ratio").distinct().join(of_all, "ratio"))
    shared = of_lang.withColumn("w", _as_texts(["lk", "ratio"], OF_LANGUAGE)).select("lk", "ratio", "bucket", "w").unionByName(of_lang.select("lk", "ratio").distinct().join(of_all, "ratio"))
    cells = keyed.select("cell", "lk", "ratio").distinct()
    own = keyed.select("cell", "ratio", "bucket", (F.col("n") * UNIT).alias("w")).unionByName(cells.join(shared, ["lk", "ratio"]).drop("lk"))
    around = fences(language, "lk").select("lk", "ratio", F.col("mid").alias("l_mid"), F.col("low").alias("l_low"), F.col("high").alias("l_high"))
    both = fences(own, "cell").join(cells, ["cell", "ratio"]).join(around, ["lk", "ratio"])
    high = F.when(F.col("mid") <= F.col("l_high"), F.least("high", 2 * F.col("l_high") - F.col("l_mid"))).otherwise(F.col("high"))
    low = F.when(F.col("mid") >= F.col("l_low"), F.greatest("low", 2 * F.col("l_low") - F.col("l_mid"))).otherwise(F.col("low"))
    out = []
    for name, *_, below in RATIOS:
        mine = F.col("ratio") == name
        out.append(F.max(F.when(mine, high)).alias(f"{name}_max"))
        out.append(F.max(F.when(mine & F.lit(below), low)).alias(f"{name}_min"))
    return both.groupBy("cell").agg(*out)


def quality_rules(docs: DataFrame, text_col: str = "text", by: tuple[str, str] = ("lang", "source"), keep: list[str] | None = None) -> DataFrame:
    """Every row with its base counts, ``base_failed`` and ``kept``.

    The counts are written once (with the columns ``keep``) into the shared folder, as the sketches
    of all rows must be complete before the first row can be judged.
    """
    results = [*COUNTS, "base_failed", "kept"]
    docs = without(docs, results)
    keep = docs.columns if keep is None else keep
    counted = materialize(text_counts(docs, text_col, list(dict.fromkeys([*keep, *by]))), "quality")
    bounds = materialize(limits(sketches(counted, by)), "quality-limits").withColumnRenamed("cell", "__cell")
    fine = F.lit(True)
    for name, a, b, *_ in RATIOS:
        value = bucket(_ratio(a, b))
        fine = fine & F.coalesce(value <= F.col(f"{name}_max"), F.lit(True)) & F.coalesce(value >= F.col(f"{name}_min"), F.lit(True))
    judged = counted.withColumn("__cell", key_text(*by)).join(bounds, "__cell", "left")
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & fine).select(*keep, *results)
