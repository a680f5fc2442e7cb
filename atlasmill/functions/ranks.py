"""Ranks and running totals that never put one whole key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize


def key_text(*cols: str | Column) -> Column:
    """A non-null string that is equal for equal keys, nulls included (usable in plain equi-joins)."""
    parts = [F.coalesce(F.concat(F.lit("="), F.hex(F.encode((F.col(c) if isinstance(c, str) else c).cast("string"), "UTF-8"))), F.lit("~")) for c in cols]
    return F.concat_ws("|", *parts)


def salts_for(rows: int, per_salt: int = 200_000, least: int = 8) -> int:
    """How many salts keep an average piece at ``per_salt`` rows if one key held them all."""
    return max(least, -(-rows // per_salt))


def running_total(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, salts: int) -> DataFrame:
    """Exclusive running total of ``value`` per ``key`` along (salt, ``order``), in two levels.

    ``key`` must not be null. The salt is a hash of ``order``; a key is summed per salt first, the
    salts' totals are accumulated (``salts`` rows a key at most), and each salt is then a window of
    its own, so a hot key is spread over ``salts`` tasks. Rows equal in ``order`` are interchangeable.
    """
    salt, base, total = f"__salt_{out}", f"__base_{out}", f"__total_{out}"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sums = salted.groupBy(key, salt).agg(F.sum(value).alias(total))
    along = W.partitionBy(key).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(key, salt, F.coalesce(F.sum(total).over(along), F.lit(0)).cast("long").alias(base))
    inner = W.partitionBy(key, salt).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    ranked = salted.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)).cast("long"))
    return ranked.join(offsets, [key, salt]).withColumn(out, F.col(out) + F.col(base)).drop(salt, base)


def dense_position(df: DataFrame, key: str, order: Sequence[str], out: str, salts: int) -> DataFrame:
    """Gapless position from 0 per ``key``, in the manner of :func:`running_total`."""
    one = f"__one_{out}"
    return running_total(df.withColumn(one, F.lit(1).cast("long")), key, order, one, out, salts).drop(one)


def ordered_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str]) -> DataFrame:
    """Exclusive running totals ``{out: column of whole numbers}`` along ``order`` over the whole frame, range by range.

    The frame is sorted into ranges, each is summed, and a range's own running totals start from the sum
    of the ranges before it; one task sees one range, and the table of ranges has a row for each partition.
    ``df`` is read twice: hand over a written table or a small one.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    sums = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__sum_{out}") for out, c in totals.items()])
    ahead = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select("__range", *[F.coalesce(F.sum(f"__sum_{out}").over(ahead), F.lit(0)).alias(f"__base_{out}") for out in totals])
    inner = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    run = ranged.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(out) for out, c in totals.items()])
    based = run.join(F.broadcast(bases), "__range")  # a row for each range
    return based.select(*df.columns, *[(F.col(out) + F.col(f"__base_{out}")).cast("long").alias(out) for out in totals])
