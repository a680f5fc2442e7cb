"""Mixing sources to target weights, in blocks of words dealt to output shards.

Every source's texts form one stream of words (in a pseudorandom order of rows), which is cut into
blocks of ``BLOCK`` words. A source's target, rounded to blocks, is its number of slots in the mix. The
slots are dealt to the output shards by a multinomial draw for each source: each slot falls into a
uniformly drawn shard, and the counts (source, shard) say how many slots of the source each shard has.
The slots of a source are numbered shard after shard by those counts, and slot i takes block
``perm(i mod n)`` of its n blocks, where perm is a pseudorandom permutation of 0 to n - 1 of that source
and pass (``ROUNDS`` rounds of swap-or-not), so a block is used at most once more than any other of its
source. Slots and blocks are joined by (source, index), and each text's words in a block count as often
as the block is used. ``mix_shards`` gives the shards themselves.

The draws are conditioned on the source's total: the total is fixed to the rounded target, so that the
words taken come within a block of it. Drawn freely, a source of k slots would miss it by 1 / sqrt(k).

Targets: sources, ordered by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and share all
words by weight; a target stops at ``CAP`` times its source's size and the excess goes to the others
by weight. That is one level for all sources, found by running sums over the sources in the order in
which they stop; sums run over ranges of the sorted sources, as sources may be as many as hosts. Three
passes over a source's blocks give exactly its cap, so no text is taken more than ``CAP`` times.

Only DataFrame operations are used. Nulls: a null text has no words; a null source is a source of its
own; null ids are kept. A source without words has target 0. Repeated rows are texts of their own, ties
in the order of rows are between equal rows. Very long texts are cut by blocks like others. All draws
hash the seed and indices, so reruns agree. An empty table gives an empty result. Input columns named
like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import key_text, ordered_totals, running_total, salts_for
from atlasmill.llm.common import without

BLOCK = 64
CAP = 3
SHARDS = 64
SEED = 20240
STEP = 4096
ROUNDS = 12
#: Salts of a source's texts at least.
SALTS = 128
#: Slots that one task draws: a run of ``STEP`` slots is one short row, so the bytes of the runs say nothing about the work.
SLOTS_A_TASK = 1 << 20
SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space: each becomes one letter, and the letters are counted."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, "[^\\x20\\x09-\\x0D]++", "x"), SPACE, "")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source_col: str = "source", cap: int = CAP) -> DataFrame:
    """(key, source_size, weight, target) of each source; ``key`` is its text form, never null."""
    sums = materialize(sized.groupBy(F.col(source_col).alias("s")).agg(F.sum("size").cast("long").alias("source_size")), "mix-sources")
    named = ordered_totals(sums.withColumn("one", F.lit(1).cast("long")), [F.col("s").asc_nulls_last()], {"place": "one"}).drop("one")
    weighed = named.withColumn("weight", F.col("place") % 3 + 1)
    stops = ordered_totals(weighed, [(F.col("source_size") / F.col("weight")).asc(), F.col("s").asc_nulls_last()], {"words_before": "source_size", "weight_before": "weight"})
    capped = F.col("source_size") * cap
    words, weights = F.sum("source_size").alias("words"), F.sum("weight").alias("weights")
    stops = stops.crossJoin(F.broadcast(weighed.agg(words, weights)))  # one row
    level = (F.col("words") - cap * F.col("words_before")) / (F.col("weights") - F.col("weight_before"))
    stops = stops.withColumn("level", level).withColumn("open", capped > F.col("level") * F.col("weight"))
    # the first source, in the order in which they stop, that does not stop sets the level of all that stay open
    final = stops.filter("open").agg(F.min(F.struct("weight_before", "level")).alias("f")).select(F.col("f.level").alias("final"))
    known = stops.crossJoin(F.broadcast(final))  # one row
    stays = F.coalesce(capped <= F.col("final") * F.col("weight"), F.lit(True))
    return known.select(key_text("s").alias("key"), "source_size", F.col("weight").cast("double").alias("weight"), F.when(stays, capped).otherwise(F.col("final") * F.col("weight")).cast("double").alias("target"))


def permuted(place: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 to ``n`` - 1 for each ``key``, by swap-or-not: in each round ``place`` and its partner (their sum is a drawn constant modulo ``n``) are swapped or not, by one bit of a hash of the greater of them."""

    def step(x: Column, k: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, k), n) - x, n)
        return F.when(F.xxhash64(F.greatest(x, partner), key, k, F.lit("swap")) % 2 == 0, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), place, step)


def _spread(runs: DataFrame, total: int, carry: list[str], low: str = "low", high: str = "high") -> DataFrame:
    """One row for each slot from ``low`` to ``high`` of each row, in tasks of about ``SLOTS_A_TASK`` slots."""
    cut = runs.filter(F.col(high) >= F.col(low)).select(*carry, high, F.explode(F.sequence(low, high, F.lit(STEP).cast("long"))).alias(low))
    dealt = cut.repartition(total // SLOTS_A_TASK + 1, *carry, low)
    return dealt.select(*carry, F.explode(F.sequence(low, F.least(F.col(low) + (STEP - 1), F.col(high)))).alias("slot"))


def shard_slots(targets: DataFrame, block: int = BLOCK, cap: int = CAP, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(key, shard, block): one row for each slot of the mix, with the output shard it is in and the block that fills it."""
    plan = targets.filter("source_size > 0").withColumn("n", F.expr(f"(source_size + {block - 1}) div {block}"))
    slots = F.least(F.round(F.col("target") * F.col("n") / F.col("source_size")).cast("long"), F.col("n") * cap)
    plan = materialize(plan.select("key", "n", slots.alias("slots")).filter("slots > 0"), "mix-plan")
    total = plan.agg(F.sum("slots").alias("n")).first()["n"] or 0
    draw = lambda *what: F.xxhash64(F.lit(seed), *what)
    zero = F.lit(0).cast("long")
    thrown = _spread(plan.select("key", zero.alias("low"), (F.col("slots") - 1).alias("high")), total, ["key"]).select("key", F.pmod(draw(F.col("key"), F.col("slot"), F.lit("shard")), F.lit(shards)).cast("int").alias("shard"))
    counts = materialize(thrown.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("many")), "mix-draws")  # ``shards`` rows a source at most
    before = F.coalesce(F.sum("many").over(W.partitionBy("key").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), zero)
    ranges = counts.withColumn("low", before).withColumn("high", before + F.col("many") - 1).join(plan.select("key", "n"), "key")
    slot = _spread(ranges, total, ["key", "shard", "n"])
    turn, place = F.expr("slot div n"), F.expr("slot % n")
    return slot.select("key", "shard", permuted(place, F.col("n"), draw(F.col("key"), turn)).alias("block"))


def _streams(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with their size and the place ``__start`` of their first word in the stream of their source ``key``, targets of the sources)."""
    sized = docs.select(*dict.fromkeys([*keep, id_col]), word_count(F.col(text_col)).alias("size"), key_text(source_col).alias("key"), F.col(source_col).alias("__source"), F.xxhash64(F.lit(SEED), F.col(id_col), F.xxhash64(text_col)).alias("__order"))
    rows = materialize(sized, "mix-sizes")
    targets = materialize(source_targets(rows, "__source"), "mix-targets")
    return materialize(running_total(rows, "key", ["__order", "size"], "size", "__start", salts_for(rows.count(), least=SALTS)), "mix-streams"), targets


def _cut(streamed: DataFrame, block: int) -> DataFrame:
    """(key, __start, block, first, words): the parts of each text in the blocks of its source."""
    parts = streamed.filter("size > 0").select("key", "__start", "size", F.explode(F.sequence(F.expr(f"__start div {block}"), F.expr(f"(__start + size - 1) div {block}"))).alias("block"))
    first = F.greatest(F.col("block") * block, F.col("__start")) - F.col("__start")
    many = F.least((F.col("block") + 1) * block, F.col("__start") + F.col("size")) - F.col("__start") - first
    return parts.select("key", "__start", "block", first.alias("first"), many.alias("words"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, keep: list[str] | None = None, pieces: bool = False, shards: int = SHARDS) -> DataFrame:
    """The columns ``keep`` (the id, if not given) with ``size``, ``source_size``, ``target``, ``taken`` and ``first_shard`` of every row.

    ``first_shard`` is the least output shard that has words of the text (null: none has). With
    ``pieces`` also ``pieces``: (first word, words, uses) of the parts taken, in order.
    """
    made = ["size", "source_size", "target", "taken", "first_shard", "pieces"]
    docs = without(docs, made)
    keep = [id_col] if keep is None else [c for c in keep if c in docs.columns]
    streamed, targets = _streams(docs, id_col, text_col, source_col, keep)
    uses = shard_slots(targets, block, shards=shards).groupBy("key", "block").agg(F.count(F.lit(1)).alias("uses"), F.min("shard").alias("shard"))
    # merged, not broadcast: the uses are exploded from the small target table, so their estimated size says nothing
    used = _cut(streamed, block).hint("merge").join(uses, ["key", "block"])
    measures = [F.sum(F.col("words") * F.col("uses")).alias("taken"), F.min("shard").alias("first_shard")]
    if pieces:
        measures.append(F.sort_array(F.collect_list(F.struct("first", "words", "uses"))).alias("pieces"))
    taken = used.groupBy("key", "__start").agg(*measures).withColumn("__some", F.lit(True))
    joined = streamed.withColumn("__some", F.col("size") > 0).hint("merge").join(taken, ["key", "__start", "__some"], "left").join(targets, "key")
    return joined.select(*keep, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard", *(["pieces"] if pieces else []))


def mix_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """The mix itself, as (shard, key, block, id, first, words): each row is a run of words of one text (from word ``first`` on) in a block of source ``key`` that is in ``shard``; a block that fills several slots is there as often."""
    streamed, targets = _streams(docs, id_col, text_col, source_col, [])
    parts = _cut(streamed, block).join(streamed.filter("size > 0").select("key", "__start", id_col), ["key", "__start"])
    return parts.hint("merge").join(shard_slots(targets, block, shards=shards), ["key", "block"]).select("shard", "key", "block", id_col, "first", "words")


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix, with the columns of ``docs``.

    A text is returned once for each time that any of its words is taken: the first time with all
    words taken at least once, then with those taken at least twice, and so on. A text taken whole
    is returned as it is, of others the taken words are joined by a space. ``n_chars``, if there,
    follows the text.
    """
    own = docs.columns
    mixed = mix_sources(docs, id_col, text_col, source_col, keep=own, pieces=True).filter("taken > 0")
    turn = mixed.withColumn("__turn", F.explode(F.expr("sequence(1, int(array_max(transform(pieces, p -> p.uses))))")))
    now = turn.withColumn("__now", F.expr("filter(pieces, p -> p.uses >= __turn)"))
    words = F.expr("filter(split(translate(`%s`, '\\t\\n\\u000b\\u000c\\r', '     '), ' '), w -> w <> '')" % text_col)
    part = F.concat_ws(" ", F.flatten(F.transform("__now", lambda p: F.slice(F.col("__words"), (p["first"] + 1).cast("int"), p["words"].cast("int")))))
    whole = F.expr("aggregate(__now, 0L, (a, p) -> a + p.words)") == F.col("size")
    out = now.withColumn("__words", words).withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(part))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(own)
