"""Similarity join of texts on word n-grams (Jaccard), by MinHash banding with exact verification.

* One pass over the texts makes the set of n-gram hashes of each text, its 128-bit fingerprint and
  its band hashes; texts with equal sets form one class, whose copies are only counted.
* The classes of one band hash are a bucket. Buckets of the same classes are one (that of the first
  band); its classes are linked to the least of them (a star, not all pairs), and the components of
  the stars say which buckets can share links.
* A component is verified in the cheaper of two exact ways, by the number of texts that have to be
  sent: all its pairs (a dense group of near copies), or the pairs of each of its buckets (a chain of
  chance collisions, however long); there a pair that meets in several buckets counts in its first band.
* Either way the texts, one for each class, are dealt to tiles: up to ``TILE`` classes are one tile,
  more are split into blocks, and a tile takes two of them. Inside a tile the pairs are verified on the
  full n-gram sets, by sparse products; a tile returns one row a class: its links there (copies
  counted) and the least class of its linked group. What several tiles share is joined by a last
  components pass. So no pair is ever written, and no group is in one task.

Band and row counts are the cheapest that find a pair at the threshold with probability ``RECALL``
and let a pair of half that similarity collide with at most ``MOST_FALSE``.

A text with one to ``n - 1`` words has one gram, all its words. Texts without a word (null, empty)
have no grams: they link to nothing and are classes of their own. Repeated rows are copies. Null ids
take part; a class's id is its least id that is not null (classes are told apart by their n-grams, so
repeated or null ids never join two of them). Very long texts are read whole, one slice each; a tile
of long texts has fewer classes. An empty table gives an empty result. Of the input only the id and
the text are read, so columns that bear the name of a result do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.functions.components import connected_components
from atlasmill.functions.lineage import materialize
from atlasmill.llm.common import small_batches, text_key, text_slices

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_FALSE = 0.25
TILE = 256
TILE_GRAMS = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C55)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most_false: float = MOST_FALSE) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that reach ``recall`` at ``threshold`` while a pair of half that similarity collides with at most ``most_false``."""
    best = None
    for rows in range(1, 17):
        hit = threshold**rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        false = 1 - (1 - (threshold / 2) ** rows) ** bands
        if false <= most_false and (best is None or bands * rows < best[0] * best[1]):
            best = bands, rows
    return best or (bands, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the public splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for k, p in enumerate((_P, _P_INVERSE)):
                run = np.full(n, p, np.uint64)
                run[0] = 1
                _powers[k] = np.multiply.accumulate(run)
    return _powers


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, one text after the other, and the start of each text's (one more at the end)."""
    texts = [t or b"" for t in texts]
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = _IS_WORD[buf]
    edge = np.diff(word.astype(np.int8), prepend=0)
    first, behind = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _power_tables(len(buf) + 1)
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], dtype=np.uint64)])
        words = mix((run[behind] - run[first]) * inverse[first] + (behind - first).astype(np.uint64))
    return words, np.searchsorted(first, begins)


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    """The code of the ``n`` words from each word on; the last ``n - 1`` codes are of fewer words."""
    out = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out[: max(0, len(words) - k)] = out[: max(0, len(words) - k)] * _P + words[k:]
    return out


def gram_hashes(texts: list[bytes | None], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts, one text after the other, and the start of each text's (one more at the end)."""
    words, at = word_hashes(texts)
    many = np.diff(at)
    grams_of = np.where(many >= n, many - n + 1, np.minimum(many, 1))
    out_at = np.concatenate([[0], np.cumsum(grams_of)])
    where = np.arange(out_at[-1]) - np.repeat(out_at[:-1] - at[:-1], grams_of)
    grams = rolled(words, n)[where] if len(where) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        for d in np.flatnonzero((many > 0) & (many < n)):
            code = np.uint64(many[d])
            for w in words[at[d] : at[d + 1]]:
                code = code * _P + w
            grams[out_at[d]] = code
        return mix(grams), out_at


def _signatures(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * _P) | np.uint64(1)
    for chunk, texts in text_slices(batches, text_col, 1 << 20):
        grams, at = gram_hashes(texts, n)
        many = np.diff(at)
        some = np.flatnonzero(many)
        start = at[:-1][some]
        node = np.full((len(texts), 2), 0, np.uint64)
        size = np.zeros(len(texts), np.int64)
        least = np.empty((len(some), bands, rows), np.uint64)
        with np.errstate(over="ignore"):
            for k, seed in enumerate(seeds):
                if len(some):
                    least[:, k // rows, k % rows] = np.minimum.reduceat(grams * seed, start)
            code = np.zeros((len(some), bands), np.uint64)
            for r in range(rows):
                code = mix(code * _P + least[:, :, r])
            for d in some:
                own = np.unique(grams[at[d] : at[d + 1]])
                size[d] = len(own)
                node[d] = np.bitwise_xor.reduce(mix(own + np.uint64(77))), np.add.reduce(mix(own ^ np.uint64(0x5555)))
        names = [row.tobytes() for row in node]
        per_row: list[list[int] | None] = [None] * len(texts)
        for d, row in zip(some.tolist(), code.view(np.int64).tolist(), strict=True):
            per_row[d] = row
        yield pa.RecordBatch.from_arrays(
            [chunk.column(id_col), chunk.column("__th"), pa.array([x if m else None for x, m in zip(names, many.tolist(), strict=True)], pa.binary()), pa.array(size), pa.array(per_row, pa.list_(pa.int64()))],
            names=[id_col, "__th", "node", "n_grams", "bands"],
        )


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """(id, hash of the text, node: fingerprint of the n-gram set or null, number of n-grams, band hashes) of every row."""
    small_batches(docs.sparkSession)
    read = docs.select(id_col, text_col, text_key(text_col).alias("__th"))
    schema = T.StructType([read.schema[id_col], read.schema["__th"], T.StructField("node", T.BinaryType()), T.StructField("n_grams", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return read.mapInArrow(lambda it: _signatures(it, id_col, text_col, n, bands, rows), schema)


class _Groups:
    """Union-find over the rows of a tile; the least row leads its group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shared_grams(sets: list[np.ndarray]) -> np.ndarray:
    """Table of intersection sizes of sorted, repeat-free arrays."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    if m <= 4:
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    times = np.bincount(gram)
    useful = times[gram] > 1
    gram, owner = np.unique(gram[useful], return_inverse=True)[1], owner[useful]
    total, width = int(gram.max()) + 1 if len(gram) else 0, max(256, (4 << 20) // m)
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    for low in range(0, total, width):
        a, b = np.searchsorted(gram, [low, low + width])
        dense = np.zeros((m, min(width, total - low)), np.float32)
        dense[owner[a:b], gram[a:b] - low] = 1
        out += np.rint(dense @ dense.T).astype(np.int64)
    return out


def _verify_tile(rows: list[tuple], n: int, threshold: Fraction, within: bool, band: int) -> dict[str, list]:
    """rows: (node, copies, block, text, band hashes), one for each node.

    Links are counted inside the block if the tile is one block's own (``within``), else between its
    two blocks, of which one may have no rows. In a bucket's tile (``band`` not negative) a link
    counts if no earlier band has it.
    """
    names = [r[0] for r in rows]
    copies = np.array([r[1] for r in rows], np.int64)
    block = np.array([r[2] for r in rows])
    grams, at = gram_hashes([r[3] for r in rows], n)
    sets = [np.unique(grams[at[k] : at[k + 1]]) for k in range(len(rows))]
    size = np.array([len(s) for s in sets], np.int64)
    both = shared_grams(sets)
    union = size[:, None] + size[None, :] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    np.fill_diagonal(linked, False)
    count = linked if within else linked & (block[:, None] != block[None, :])
    if band > 0:
        codes = np.array([r[4][:band] for r in rows], np.int64)
        i, j = np.nonzero(count)
        met = (codes[i] == codes[j]).any(axis=1)
        count = count.copy()
        count[i[met], j[met]] = False
    groups = _Groups(len(rows))
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        groups.join(int(i), int(j))
    return {"node": names, "links": (count @ copies).tolist(), "root": [names[groups.find(k)] for k in range(len(rows))]}


UNIT = ["group", "band", "code"]
TILED = [*UNIT, "ti", "tj", "blocks"]


def _verify(batches: Iterator[pa.RecordBatch], n: int, threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by tile; each tile is worked on as soon as it is complete."""
    now, held = None, {}

    def done() -> pa.RecordBatch:
        _, band, _, ti, tj, blocks = now
        found = _verify_tile([held[k] for k in sorted(held)], n, threshold, ti == tj, band)
        whole = band < 0 and blocks == 1
        return pa.RecordBatch.from_arrays([pa.array(found["node"], pa.binary()), pa.array(found["links"], pa.int64()), pa.array(found["root"], pa.binary()), pa.array([whole] * len(held))], names=["node", "links", "root", "whole"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*TILED, "node", "copies", "block", "bands")]
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for k, key in enumerate(zip(*columns[: len(TILED)], strict=True)):
            if key != now:
                if held:
                    yield done()
                now, held = key, {}
            node, copies, block, bands = (c[k] for c in columns[len(TILED) :])
            held[node] = (node, copies, block, texts[k], bands)
    if held:
        yield done()


def _blocks(m: str, grams: str) -> Column:
    """Into how many blocks ``m`` classes with ``grams`` n-grams in all are split."""
    return F.greatest(F.ceil(F.col(m) / TILE), F.least(F.col(m), F.ceil(F.col(grams) / TILE_GRAMS))).cast("int")


def buckets_of(classes: DataFrame) -> DataFrame:
    """(node, n_grams, band, code, least, m, grams): the members of each bucket of two or more classes; of buckets with the same classes that of the first band."""
    banded = classes.select("node", "n_grams", F.posexplode("bands").alias("band", "code"))
    sums = [F.count(F.lit(1)).alias("m"), F.sum("n_grams").alias("grams"), F.min("node").alias("least"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    buckets = banded.groupBy("band", "code").agg(*sums).filter("m > 1")
    first = buckets.groupBy("least", "m", "grams", "x", "y").agg(F.min(F.struct("band", "code")).alias("k")).select("k.band", "k.code", "least", "m", "grams")
    return banded.join(first, ["band", "code"])


def units(members: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """(group, band, code, node, blocks): what is verified together, the whole component (band -1) or each of its buckets."""
    of_bucket = members.filter("node = least").select("band", "code", "m", "grams", "node").join(groups, "node").select("group", "band", "code", "m", _blocks("m", "grams").alias("blocks"))
    sent = of_bucket.groupBy("group").agg(F.sum(F.col("m") * F.col("blocks")).alias("sent"))
    sized = groups.join(classes.select("node", "n_grams"), "node").groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.sum("n_grams").alias("g"))
    way = materialize(sized.select("group", "m", _blocks("m", "g").alias("blocks")).join(sent, "group").select("group", "blocks", (F.col("sent") < F.col("m") * F.col("blocks")).alias("split")), "ways")
    whole = groups.join(way.filter("not split"), "group").select("group", F.lit(-1).alias("band"), F.lit(0).cast("long").alias("code"), "node", "blocks")
    parts = of_bucket.join(way.filter("split").select("group"), "group")
    return whole.unionByName(members.select("node", "band", "code").join(parts, ["band", "code"]).select(*UNIT, "node", "blocks"))


def one_of_null_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` keyed by ``__id`` and ``__th``; of rows without an id one for each text stays, as nothing tells them apart (that is decided before any shuffle)."""
    keyed = docs.withColumn("__id", F.coalesce(F.col(id_col), F.lit(-1)))
    return keyed.filter(F.col(id_col).isNotNull()).unionByName(keyed.filter(F.col(id_col).isNull()).dropDuplicates(["__th"]))


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, __th, node, __class, class_id, n_links) of every row: ``class_id`` is the least id of the rows connected by links (pairs of a Jaccard similarity of ``threshold`` or more), ``n_links`` the number of rows linked to this one; ``__class`` is the class's own key, the least ``node`` in it."""
    exact = Fraction(threshold).limit_denominator(10_000)
    bands, rows = choose_bands(threshold, recall)
    sig = materialize(signatures(docs, id_col, text_col, n, bands, rows), "grams")
    rep = F.min(F.struct(F.coalesce(F.col(id_col), F.lit(-1)).alias("id"), F.col("__th").alias("th")))
    classes = materialize(sig.filter("node is not null").groupBy("node").agg(rep.alias("rep"), F.min(id_col).alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")), "classes")
    members = materialize(buckets_of(classes), "members")
    stars = members.filter("node <> least").select("node", "least").distinct()
    groups = materialize(connected_components(stars, "node", "least", "candidates"), "groups").withColumnRenamed("component", "group")
    asked = units(members, groups, classes).join(classes.select("node", "copies", "rep", "bands"), "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = asked.withColumn("block", block).withColumn("bands", F.when(F.col("band") >= 0, F.col("bands"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wanted = materialize(dealt.select(*UNIT, "node", "copies", "blocks", "block", "bands", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"), F.col("rep.id").alias("__id"), F.col("rep.th").alias("__th")), "wanted")
    ask = wanted.select("__id", "__th").distinct()  # grows with the data: merged at every size, never broadcast
    texts = one_of_null_ids(docs.select(id_col, text_key(text_col).alias("__th"), F.col(text_col).alias("text")), id_col).drop(id_col).hint("merge").join(ask, ["__id", "__th"], "left_semi")
    tiles = wanted.join(texts, ["__id", "__th"]).repartition(*TILED[:5]).sortWithinPartitions(*TILED[:5])
    schema = "node binary, links long, root binary, whole boolean"
    tiled = tiles.select(*TILED, "node", "copies", "block", "bands", "text").mapInArrow(lambda it: _verify(it, n, exact), schema)
    verified = materialize(tiled, "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.min("whole").alias("whole"))
    several = connected_components(verified.filter("not whole"), "node", "root", "joined")
    rooted = links.join(several.select("node", "component"), "node", "left").select("node", "links", F.coalesce("component", F.when(F.col("whole"), F.col("root")).otherwise(F.col("node"))).alias("__class"))
    placed = classes.select("node", "copies", "least_id").join(rooted, "node", "left").withColumn("__class", F.coalesce("__class", "node")).withColumn("links", F.coalesce("links", F.lit(0)))
    named = placed.groupBy("__class").agg(F.min("least_id").alias("class_id"))
    by_node = placed.join(named, "__class").select("node", "__class", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    out = sig.select(id_col, "__th", "node").join(by_node, "node", "left")
    alone = F.col("node").isNull()
    return out.select(id_col, "__th", "node", "__class", F.when(alone, F.col(id_col)).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, one of each class; rows without a word all stay.

    Of a class the row of the least (id, hash of the text) stays, a row with a null id before others.
    """
    own = docs.columns
    found = materialize(similarity_classes(docs, id_col, text_col, **settings).withColumn("__id", F.coalesce(F.col(id_col), F.lit(-1))), "class-rows")
    first = found.filter("node is not null").groupBy("__class").agg(F.min(F.struct("__id", "__th")).alias("s")).select("s.__id", "s.__th")
    keyed = docs.withColumn("__th", text_key(text_col))
    chosen = one_of_null_ids(keyed, id_col).join(first, ["__id", "__th"], "left_semi").dropDuplicates(["__id", "__th"])
    wordless = keyed.filter(~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return chosen.select(own).union(wordless.select(own))
