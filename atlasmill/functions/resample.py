"""Bootstrap samples drawn where they are counted: no draw is shuffled or written."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: resamples of a group that a row asks for, and draws at a time (arrays that stay in a core's cache)
EACH, DRAWS = 4, 16_384
_SINES = [int(abs(math.sin(k + 1)) * 2**32) for k in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _digest_heads(prefix: bytes, numbers: np.ndarray, digits: int) -> np.ndarray:
    """:func:`md5_heads` of numbers that all have so many digits."""
    length = len(prefix) + digits
    size = (length + 8) // 64 * 64 + 64
    fixed = bytearray(prefix + bytes(digits) + b"\x80" + bytes(size - length - 9) + (8 * length).to_bytes(8, "little"))
    words: list = [int.from_bytes(fixed[k : k + 4], "little") for k in range(0, size, 4)]
    rest = numbers.astype(np.uint32) if digits < 10 else numbers.astype(np.uint64)
    for k in range(length - 1, len(prefix) - 1, -1):
        after = rest // 10
        digit = (rest - after * 10 + 48).astype(np.uint32)
        words[k // 4] = words[k // 4] + (digit << (8 * (k % 4)))
        rest = after
    state = [np.full(len(numbers), x, np.uint32) for x in _START]
    for block in range(0, len(words), 16):
        a, b, c, d = state
        for k in range(64):
            turn = k // 16
            if turn == 0:
                f, at = d ^ (b & (c ^ d)), k
            elif turn == 1:
                f, at = c ^ (d & (b ^ c)), (5 * k + 1) % 16
            elif turn == 2:
                f, at = b ^ c ^ d, (3 * k + 5) % 16
            else:
                f, at = c ^ (b | ~d), 7 * k % 16
            word = words[block + at]
            f += a
            if isinstance(word, int):
                f += np.uint32((_SINES[k] + word) & 0xFFFFFFFF)
            else:
                f += word
                f += np.uint32(_SINES[k])
            s = _TURNS[turn][k % 4]
            high = f << np.uint32(s)
            f >>= np.uint32(32 - s)
            f |= high
            f += b
            a, b, c, d = d, f, b, c
        state = [x + y for x, y in zip(state, (a, b, c, d), strict=True)]
    return state[0].byteswap().astype(np.uint64)


def md5_heads(prefix: bytes, first: int, last: int) -> np.ndarray:
    """The first 32 bits of the md5 of ``prefix`` and a decimal number, for the numbers from ``first`` up to but not ``last`` (not negative)."""
    parts = []
    while first < last:
        digits = len(str(first))
        upto = min(last, 10**digits)
        parts.append(_digest_heads(prefix, np.arange(first, upto, dtype=np.int64), digits))
        first = upto
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def redrawn_counts(prefix: str, places: np.ndarray, points: int) -> np.ndarray:
    """How often each place below ``points`` (``places`` of the rows in order; greater ones are off the curve) is drawn in as many draws with replacement as there are rows."""
    counts, head = np.zeros(points + 1, np.int64), prefix.encode()
    for first in range(1, len(places) + 1, DRAWS):
        row = (md5_heads(head, first, min(first + DRAWS, len(places) + 1)) * np.uint64(len(places))) >> np.uint64(32)
        counts += np.bincount(places[row.astype(np.int64)], minlength=points + 1)
    return counts[:points]


def _curves(batches: Iterator[pa.RecordBatch], groups: list[str], points: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            places = batch.column("__places")[row].values.to_numpy()
            if batch.column("__rows")[row].is_valid:
                places = np.repeat(places, batch.column("__rows")[row].values.to_numpy())
            name = batch.column("__name")[row].as_py()
            for resample, head in zip(batch.column("__resamples")[row].as_py(), name, strict=True):
                share = np.cumsum(redrawn_counts(head, places, points)) / len(places)
                own = [batch.column(g).take(pa.array(np.full(points, row))) for g in groups]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(points, resample, np.int32)), pa.array(np.arange(points)), pa.array(share)], names=[*groups, "resample", "i", "share"])


def redrawn_curves(listed: DataFrame, groups: Sequence[str], points: int, times: int, seed: int = 0) -> DataFrame:
    """(groups, resample, i, share): the share of a resample's draws at place i or before, for i below ``points``.

    ``listed`` has a row for each group: ``__places``, the places (array<int>, ``points`` if off the curve) of its rows in order, and
    ``__rows``, how many rows in turn have each (null: one each). A resample draws with replacement as often as the group has rows,
    by md5 of seed, resample, group and number of the draw, and is drawn and counted in one task, so draws cost no disk.
    """
    spark, groups = listed.sparkSession, list(groups)
    asked = [list(range(k, min(k + EACH, times))) for k in range(0, times, EACH)]
    asks = F.explode(F.array(*[F.array(*[F.lit(r) for r in part]) for part in asked])).alias("__resamples")
    name = F.transform("__resamples", lambda r: F.concat(F.concat_ws("|", F.lit(str(seed)), r.cast("string"), *[F.col(g).cast("string") for g in groups]), F.lit("|")))
    rows = listed.select(*groups, "__places", "__rows", asks).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("__name", name)
    schema = T.StructType([*[listed.schema[g] for g in groups], T.StructField("resample", T.IntegerType()), T.StructField("i", T.LongType()), T.StructField("share", T.DoubleType())])
    return rows.mapInArrow(lambda batches: _curves(batches, groups, points), schema)
