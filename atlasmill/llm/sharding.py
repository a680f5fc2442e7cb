"""Minimax contiguous sharding of atomic groups (rows of equal text).

Groups are ordered by a 64-bit hash of the text. The smallest capacity for which a greedy pass needs
at most ``shards`` shards is found by binary search; then the cuts are placed, within that capacity,
nearest to even shares. The group sizes are never collected: the driver holds segments of the hash
range (2 ** ``FIRST_BITS`` at first), and only segments in which a cut may still fall, by the bounds
the greedy pass gives for every capacity still open, are split further, down to single groups. So the
result is the exact minimax over groups, and the driver's state is bounded whatever the input.

Only DataFrame operations are used on the rows. Nulls: a null text has size 1 and is grouped with the
empty texts; null ids are kept as they are. Repeated rows stay together and get slots of their own.
A single group larger than an even share makes the capacity its size. An empty table gives an empty
result. Input columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import dense_position, salts_for
from atlasmill.llm.common import without

SHARDS = 16
FIRST_BITS = 16
MORE_BITS = 8
MOST_SPLIT = 1024


def greedy(ends: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Cut positions (indices behind the last group of each shard), or None if ``shards`` do not suffice."""
    cuts, at, base = [], 0, 0
    for _ in range(shards):
        to = int(np.searchsorted(ends, base + capacity, side="right"))
        if to >= len(ends):
            return [*cuts, len(ends)]
        if to == at:
            return None
        cuts.append(to)
        at, base = to, int(ends[to - 1])
    return None


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The smallest largest shard over all contiguous partitions of ``sizes``."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return 0
    total = int(ends[-1])
    low, high = max(int(sizes.max()), -(-total // shards)), total
    while low < high:
        mid = (low + high) // 2
        if greedy(ends, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def even_cuts(sizes: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cut positions within ``capacity``, each as near to an even share of the rest as it can be."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    total, n = int(ends[-1]), len(sizes)
    earliest = [n]  # earliest[k]: the rest from here fits into k shards
    for _ in range(shards):
        earliest.append(int(np.searchsorted(ends, ends[earliest[-1]] - capacity, side="left")))
    cuts, at = [], 0
    for left in range(shards, 0, -1):
        target = ends[at] + (total - ends[at]) / left
        near = int(np.searchsorted(ends, target, side="left"))
        near = near - 1 if near and target - ends[near - 1] < ends[min(near, n)] - target else near
        most = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        at = n if left == 1 else min(max(near, earliest[left - 1], at), most, n)
        cuts.append(at)
    return cuts


def _may_hold_a_cut(sizes: np.ndarray, atomic: np.ndarray, low: int, high: int, shards: int) -> np.ndarray:
    """Segments inside of which a greedy cut can fall for a capacity from ``low`` to ``high``."""
    ends = np.cumsum(sizes)
    total, least = int(ends[-1]), 0
    hit = np.zeros(len(sizes), bool)
    for k in range(1, shards):
        to = int(np.searchsorted(ends, least + low, side="right"))
        least = int(ends[to - 1]) if to else 0
        most = min(total, k * high)
        hit |= (ends > least) & (ends - sizes < most)
    return hit & ~atomic


def boundaries(groups: DataFrame, shards: int, hash_col: str = "__h", size_col: str = "size") -> list[int]:
    """Lowest hash of every shard but the first (equal values: empty shards)."""

    def split(rows: DataFrame, bits: int) -> list[list]:
        at = F.call_function("shiftright", F.col(hash_col), F.lit(64 - bits)) if bits < 64 else F.col(hash_col)
        found = rows.groupBy(at.alias("p")).agg(F.min(hash_col), F.max(hash_col), F.sum(size_col)).collect()
        return [[lo, hi, int(s), bits, p] for p, lo, hi, s in found]

    segments = sorted(split(groups, FIRST_BITS))
    if not segments:
        return []
    while True:
        sizes = np.array([s[2] for s in segments], np.int64)
        atomic = np.array([s[0] == s[1] for s in segments])
        low = max(-(-int(sizes.sum()) // shards), int(sizes[atomic].max(initial=0)))
        capacity = smallest_capacity(sizes, shards)
        if capacity <= low:
            break
        inside = np.flatnonzero(_may_hold_a_cut(sizes, atomic, low, capacity, shards))
        if not len(inside):
            break
        chosen = inside[np.argsort(-sizes[inside], kind="stable")][:MOST_SPLIT]
        new = []
        for bits in sorted({segments[i][3] for i in chosen}):
            prefixes = [segments[i][4] for i in chosen if segments[i][3] == bits]
            prefix = F.call_function("shiftright", F.col(hash_col), F.lit(64 - bits))
            new += split(groups.filter(prefix.isin(prefixes)), bits + MORE_BITS)
        gone = set(chosen.tolist())
        segments = sorted([*new, *[s for i, s in enumerate(segments) if i not in gone]])
    cuts = even_cuts(sizes, capacity, shards)
    return [segments[c][0] if c < len(segments) else None for c in cuts[:-1]]


def minimax_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("__h"))
    rows = materialize(sized, "shard-sizes")
    bounds = [b for b in boundaries(rows, shards) if b is not None]
    shard = F.lit(0)
    for b in bounds:
        shard = shard + F.when(F.col("__h") >= F.lit(b), 1).otherwise(0)
    dealt = rows.withColumn("shard", shard.cast("int"))
    placed = dense_position(dealt, "shard", ["__h", id_col, "text_crc32"], "slot", salts_for(rows.count()))
    return placed.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
