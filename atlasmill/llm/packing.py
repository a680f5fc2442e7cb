"""Best-fit packing of token sequences by bin completion.

Texts are tokenized, closed with an end id and cut into pieces of at most ``CAPACITY`` tokens. Packing
depends on the lengths alone, so it is solved on the histogram of lengths (``CAPACITY`` numbers at
most, whatever the input) and the plan is then dealt out to the pieces by their rank within a length.

The solver's incumbent is best-fit decreasing. If it meets the lower bound, it is optimal. Otherwise
branch and bound completes one bin after the other: the bin of the largest length left, by all its
undominated fillings. A filling takes a number of each length, so equal lengths are one decision, and
is dominated if another item fits beside it or if a larger item can stand for one of its own. A filling
is first used as often as the counts allow, then once. Branches are pruned by the lower bound of what is
left, by the waste that a better solution can still afford, and if the same counts were left before in
as few bins. The search ends when it is exhausted, or when it meets the bound, or after ``STEPS`` steps;
in the last case the best solution found is used and ``proven`` is false, as a smaller one may exist.

The plan (at most a few runs for each distinct length and place) goes to the executors as arrays.

Nulls: a null text counts as empty, its only token is the end id; null ids are kept. Very long texts are
encoded whole and cut into pieces. Repeated rows are packed each; ties in rank are broken by a hash of the
piece. An empty table gives an empty result. Of the input only the id and the text are read, so columns
that bear the name of a result do no harm.
"""

from __future__ import annotations

import json
import os
import re as _re
import struct
import sys
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.functions.lineage import materialize
from atlasmill.functions.ranks import dense_position, salts_for
from atlasmill.llm.common import give_back, small_batches, text_slices

CAPACITY = 4096
END_ID = 1
#: Steps of the search (a few seconds on the driver) and fillings of a bin that are sorted by waste before they are tried.
STEPS, SORTED = 1_000_000, 32
#: Bytes of stretches and ids that a worker remembers, twice (this generation and the last).
BYTES_KEPT = 96 << 20
#: Texts of these characters only (Latin script and general punctuation, without the controls and the
#: dotted I on which libraries differ) are encoded by their stretches between white space.
PLAIN = _re.compile("[\\x00-\\x1b\\x20-\\x84\\x86-\\u012f\\u0131-\\u024f\\u2010-\\u2027\\u2030-\\u205e]*")
#: A stop or comma that belongs to a run of punctuation, which is one word of the tokenizer's.
RUN = _re.compile(r"(?:[^\w\s]|_)[.,]\s")


class WordTokens:
    """Token ids of texts by stretches between white space, each distinct one encoded once by the library.

    That equals encoding the whole text for tokenizers that turn white space into one space, change
    characters one by one otherwise and drop the space when they split; others encode whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer  # by workers only: the driver has no need of it

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        split = [s for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if s["type"] == "Split" and s["invert"] and s["behavior"] == "Removed"]
        self.by_stretch = steps == ["NFC", "Replace", "Lowercase"] and bool(split)
        self.marks = [t["content"] for t in spec["added_tokens"]]
        # a run of letters, and a run of what is neither letter, number nor white space, are words of their own
        self.splits = bool(split) and all(x in split[0]["pattern"].get("Regex", "") for x in (r"[\p{L}]+|", r"|[^\s\p{L}\p{N}]+"))
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.size = 0

    def _encode(self, words: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Make the stretches ``new`` known; with a full memory the generation before the last is forgotten."""
        if self.size > BYTES_KEPT:
            self.before, self.known, self.size = self.known, {}, 0
        before = self.before
        new = new.difference(self.known)
        found = {w: before[w] for w in new if w in before}
        todo = list(new.difference(found)) if found else list(new)
        found.update(zip(todo, self._encode(todo), strict=True))
        self.known.update(found)
        self.size += 150 * len(found) + sum(map(len, found.values())) + sum(map(len, found))

    def _cut(self, text: str) -> list[str] | None:
        """The stretches of a plain text, with stops and commas behind words as stretches of their own; None for other texts."""
        if not self.by_stretch or not PLAIN.fullmatch(text) or any(m in text for m in self.marks):
            return None
        text = text.lower()
        if self.splits and not RUN.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
        return text.split()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self._cut(t) for t in texts]
        new: set[str] = set()
        for words in cut:
            if words:
                new.update(words)
        self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) if words is not None else self._encode([t])[0] for t, words in zip(texts, cut, strict=True)]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _pieces(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, path: str, capacity: int, end_id: int, digest: bool = False) -> Iterator[pa.RecordBatch]:
    machine, end, width = word_tokens(path), np.array([end_id], "<u4").tobytes(), 4 * capacity
    for rows, texts in text_slices(batches, text_col):
        owner, number, ids = [], [], []
        for k, found in enumerate(machine.ids([(t or b"").decode("utf-8", "surrogatepass") for t in texts])):
            all_ids = found + end
            for piece, at in enumerate(range(0, len(all_ids), width)):
                owner.append(k), number.append(piece), ids.append(all_ids[at : at + width])
        number = np.array(number, np.int64)
        yield pa.RecordBatch.from_arrays(
            [rows.column(id_col).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(number * capacity), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64()) if digest else pa.array(ids, pa.binary())],
            names=[id_col, "piece", "start", "length", "ids_crc32" if digest else "ids"],
        )


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """(id, piece, start, length, ids: little-endian unsigned 32-bit) of every piece of every text; with ``digest`` the ids' CRC-32 instead of them."""
    small_batches(docs.sparkSession)
    read = docs.select(id_col, text_col)
    last = T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.BinaryType())
    schema = T.StructType([read.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), last])
    return read.mapInArrow(lambda it: _pieces(it, id_col, text_col, tokenizer, capacity, end_id, digest), schema)


# --- the solver: histograms {length: count} to plans [(lengths of one bin, number of such bins)] ---


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for each length as a cut, the items too large for it, the other large ones, and what of the rest (down to the cut) has no room beside those."""
    if not counts:
        return 0
    x = np.array(sorted(counts), np.int64)
    n = np.array([counts[k] for k in x.tolist()], np.int64)
    many, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * x)])
    half = int(np.searchsorted(2 * x, capacity, side="right"))  # from here on larger than half
    cut = np.concatenate([[0], x[:half]])
    low = np.concatenate([[0], np.arange(half)])
    big = np.searchsorted(x, capacity - cut, side="right")
    room = (many[big] - many[half]) * capacity - (total[big] - total[half])
    rest = total[half] - total[low] - room
    return int((many[-1] - many[half] + np.maximum(0, -(-rest // capacity))).max())


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, equal bins handled together."""
    bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if not bins[room]:
            rooms.insert(bisect_left(rooms, room), room)
        bins[room][items] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if whole := left // fit:
                    put(capacity - fit * length, (length,) * fit, whole)
                if left % fit:
                    put(capacity - left % fit * length, (length,) * (left % fit), 1)
                break
            room = rooms[at]
            items, n = next(iter(bins[room].items()))
            fit = room // length
            if left >= fit:
                used, many = min(n, left // fit), fit
            else:
                used, many = 1, left
            bins[room][items] -= used
            if not bins[room][items]:
                del bins[room][items]
            if not bins[room]:
                rooms.pop(at)
            put(room - many * length, items + (length,) * many, used)
            left -= used * many
    return [(items, n) for group in bins.values() for items, n in group.items()]


class _Spent(Exception):
    """The search has used its steps."""


class _Completion:
    """Branch and bound over the bins of a histogram; ``best`` is a plan with fewer than ``goal`` bins, if one was found."""

    def __init__(self, counts: dict[int, int], capacity: int, goal: int, bound: int, steps: int):
        self.left, self.capacity, self.goal, self.bound, self.steps = dict(counts), capacity, goal, bound, steps
        self.lengths = sorted(counts)
        self.total = sum(x * n for x, n in counts.items())
        self.best: list[tuple[tuple[int, ...], int]] | None = None
        self.now: list[tuple[tuple[int, ...], int]] = []
        self.seen: dict[bytes, int] = {}

    def fillings(self, room: int, afford: int, have: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """(waste, items) of the undominated fillings of ``room`` that waste at most ``afford``, larger items first.

        ``have`` gets the running sums over all lengths; whoever keeps the generator may empty it, then they are summed again.
        """
        lengths, left = self.lengths, self.left
        chosen: list[tuple[int, int]] = []

        def replaceable(waste: int) -> bool:
            """Whether a larger item that is not in the filling can stand for one of it."""
            used = dict(chosen)
            for y, _ in chosen:
                for k in range(bisect_right(lengths, y), bisect_right(lengths, y + waste)):
                    if left[lengths[k]] > used.get(lengths[k], 0):
                        return True
            return False

        def go(room: int, below: int, spare: int) -> Iterator[tuple[int, tuple[int, ...]]]:
            """``spare``: the smallest length of which an item is left out; it must not fit at the end."""
            self.steps -= 1
            if self.steps < 0:
                raise _Spent
            at = min(below, bisect_right(lengths, room)) - 1
            while at >= 0:
                if not have:
                    have.extend(np.concatenate([[0], np.cumsum([x * left[x] for x in lengths])]).tolist())
                if room - have[at + 1] > afford or room - have[at + 1] >= spare:
                    return  # all that is smaller is too little
                x = lengths[at]
                if left[x]:
                    most = min(left[x], room // x)
                    for k in range(most, 0, -1):
                        chosen.append((x, k))
                        yield from go(room - k * x, at, min(spare, x) if k < left[x] else spare)
                        chosen.pop()
                    spare = min(spare, x)
                at -= 1
            if room <= afford and room < spare and not replaceable(room):
                yield room, tuple(x for x, k in chosen for _ in range(k))

        try:
            yield from go(room, len(lengths), self.capacity + 1)
        finally:
            go = None  # it refers to itself, and would stay with its sums until garbage is collected

    def run(self) -> bool:
        """Search; whether the search was exhausted or met the bound."""
        deep = sys.getrecursionlimit()
        sys.setrecursionlimit(max(deep, 10 * sum(1 for _ in self.lengths) + 200_000))
        try:
            self._go(0, 0)
        except _Spent:
            return self.goal <= self.bound
        finally:
            sys.setrecursionlimit(deep)
        return True

    def _go(self, bins: int, waste: int) -> None:
        left = self.left
        rest = {x: left[x] for x in self.lengths if left[x]}
        if not rest:
            if bins < self.goal:
                self.best, self.goal = list(self.now), bins
            return
        # thousands of bins may be open at once, so none keeps anything of the size of the histogram
        self.steps -= 20 + len(rest) // 4
        if self.steps < 0:
            raise _Spent
        state = blake2b(np.array([left[x] for x in self.lengths], np.int64).tobytes(), digest_size=16).digest()
        if self.seen.get(state, bins + 1) <= bins or bins + lower_bound(rest, self.capacity) >= self.goal:
            return
        if len(self.seen) < 100_000:  # a memory only: what is forgotten is searched again
            self.seen[state] = bins
        largest = max(rest)
        del rest
        left[largest] -= 1
        # the generator looks at the counts, so they are as it left them whenever it goes on
        have: list[int] = []
        found = self.fillings(self.capacity - largest, (self.goal - 1) * self.capacity - self.total - waste, have)
        first = sorted(islice(found, SORTED), key=lambda f: (f[0], [-x for x in f[1]]))
        have.clear()
        for spare, items in chain(first, found):
            left[largest] += 1
            if waste + spare <= (self.goal - 1) * self.capacity - self.total:
                used: dict[int, int] = defaultdict(int)
                for x in (largest, *items):
                    used[x] += 1
                most = min(left[x] // n for x, n in used.items())
                have.clear()
                for times in (most, 1) if most > 1 else (1,):
                    for x, n in used.items():
                        left[x] -= n * times
                    self.now.append(((largest, *items), times))
                    self._go(bins + times, waste + spare * times)
                    self.now.pop()
                    for x, n in used.items():
                        left[x] += n * times
                    if self.goal <= self.bound:
                        return
            left[largest] -= 1
        left[largest] += 1


def solve(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[list[tuple[tuple[int, ...], int]], bool]:
    """(plan, whether it is proven that no plan has fewer bins)."""
    counts = {x: n for x, n in counts.items() if n}
    if not counts:
        return [], True
    incumbent, bound = best_fit(counts, capacity), lower_bound(counts, capacity)
    used = sum(n for _, n in incumbent)
    if used == bound:
        return incumbent, True
    search = _Completion(counts, capacity, used, bound, steps)
    proven = search.run()
    return search.best or incumbent, proven


def runs(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan as runs of ranks: ranks from ``rank`` on of a ``length`` go to sequences from ``sequence`` on, at ``offset``."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for items, times in plan:
        offset = 0
        for x in items:
            rows.append((x, rank[x], sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": table[:, 0] * (1 << 44) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _place(batches: Iterator[pa.RecordBatch], plan, own: list[str]) -> Iterator[pa.RecordBatch]:
    p = plan.value
    for b in batches:
        length, rank = b.column("length").to_numpy(zero_copy_only=False), b.column("__rank").to_numpy(zero_copy_only=False)
        at = np.searchsorted(p["key"], length * (1 << 44) + rank, side="right") - 1
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in own], pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])], names=[*own, "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All columns of ``pieces`` (``length`` among them, none over ``capacity``) with ``sequence_id``, ``offset`` and ``proven`` (of the whole plan).

    ``pieces`` is read twice (histogram, placing): hand over a written table.
    """
    own = pieces.columns
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # ``capacity`` rows at most
    solution, proven = solve(counts, capacity)
    give_back()
    plan = pieces.sparkSession.sparkContext.broadcast(runs(solution))
    ranked = dense_position(pieces, "length", [c for c in own if c != "length"], "__rank", salts_for(sum(counts.values())))
    schema = T.StructType([*[pieces.schema[c] for c in own], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*own, "__rank").mapInArrow(lambda it: _place(it, plan, own), schema).withColumn("proven", F.lit(proven))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset, proven): where each piece of each text goes."""
    digests = materialize(token_pieces(docs, tokenizer, id_col, text_col, capacity, digest=True), "pieces")
    return pack(digests, capacity)
