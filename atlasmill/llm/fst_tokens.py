"""Token counts by compiled finite-state machines.

Two machines are compiled from the tokenizer's file, and both run over chunks whose state maps are
composed by a prefix scan. The first is the word splitter: a deterministic automaton of eight states
over character classes (with the lookahead of two characters that contractions and trailing white space
need folded into the class). A batch of texts is one symbol sequence, cut into equal chunks; every
chunk's state map (state before -> state after) is computed for all chunks at once, the maps are composed
by a parallel prefix scan, and a second pass marks where words begin, each chunk starting from its
scanned state.

The second machine is a deterministic transducer over the bytes of a word. Its state holds, for each
suffix of the word that is a proper prefix of a vocabulary entry, the place in the vocabulary's trie, the
last token of the encoding of what is before it, and how many tokens fewer that encoding has; a
transition is annotated with the number of tokens the encoding grows by (it may be negative). By the
compatibility of neighbouring tokens exactly one vocabulary entry can close each prefix, so the sum of the
annotations is the length of the byte-pair encoding. States are compiled when first met and kept.

The transducer has too many states for whole maps, so a chunk's map (state before -> state after, tokens
emitted) is kept for the one state before it that matters. The new words of a batch are one byte sequence,
cut where a word begins (the state there is the first one) and every ``SPAN`` bytes. Inside a long word
the state before a chunk is first taken to be the one that the chunk before it leads to from the first
state (machines of this kind fall into step); all chunks are run, and the maps are composed: where a
chunk's map is not defined for the state that the map before it gives, it is run again for that state.
The scan of the emitted counts gives each word's tokens. Words whose count is known are not run again.

Nulls: a null text counts as empty (0 tokens). Special tokens of the file are recognised inside texts
as the library does by default. Empty and very long texts need no special care (a text is never cut);
repeated rows are counted each; an empty table gives an empty result; input columns named like a
result are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from atlasmill.llm.common import small_batches, text_slices, without

LIMIT = 1024
#: What a worker remembers: bytes of words with their counts, states, and pairs of tokens.
BYTES_KEPT, STATES_KEPT, PAIRS_KEPT = 96 << 20, 250_000, 1_000_000
CHUNKS = 2048
#: Bytes of a chunk of the transducer's sequence, and rounds in which all broken chunks are run again at once.
SPAN, ROUNDS = 64, 4
END = 0x110000
# symbols: letter, number, other, apostrophe of a one- or two-letter contraction, white space inside a
# run, space that joins the next word, other white space that ends a run, end of a text
LETTER, NUMBER, OTHER, APO2, APO3, INNER, JOIN, LAST, STOP = range(9)
# states: fresh, in letters, in numbers, in others, after a joining space, in white space, one or two letters of a contraction to go
FRESH, IN_L, IN_N, IN_O, JOINED, IN_W, TO_GO1, TO_GO2 = range(8)
#: The code points of Unicode's White_Space property.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or INNER (white space) for each code point, STOP for ``END``."""
    out = np.full(END + 1, OTHER, np.uint8)
    for c in range(END):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = INNER
    out[END] = STOP
    return out


@lru_cache(maxsize=1)
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a word begins) of the splitting automaton, at symbol * 8 + state."""
    to, begins = np.zeros((9, 8), np.intp), np.zeros((9, 8), bool)
    for s in range(8):
        runs = {LETTER: (IN_L, (IN_L, JOINED)), NUMBER: (IN_N, (IN_N, JOINED)), OTHER: (IN_O, (IN_O, JOINED)), INNER: (IN_W, (IN_W,)), JOIN: (JOINED, ()), LAST: (FRESH, ()), STOP: (FRESH, ())}
        for symbol, (into, goes_on) in runs.items():
            to[symbol, s], begins[symbol, s] = into, s not in goes_on
        for symbol, left in ((APO2, TO_GO1), (APO3, TO_GO2)):
            inside = s in (IN_O, JOINED)
            to[symbol, s], begins[symbol, s] = (IN_O, False) if inside else (left, True)
        if s in (TO_GO1, TO_GO2):
            to[:, s], begins[:, s] = (FRESH if s == TO_GO1 else TO_GO1), False
            to[STOP, s], begins[STOP, s] = FRESH, True
    return to.ravel(), begins.ravel()


def symbols(code: np.ndarray) -> np.ndarray:
    """The automaton's input for code points (``END`` closes each text)."""
    out = char_classes()[code]
    after = np.append(out[1:], STOP)
    ends_run = (out == INNER) & (after != INNER) & (after != STOP)
    out[ends_run] = np.where(code[ends_run] == 0x20, JOIN, LAST)
    quote = np.flatnonzero(code == 0x27)
    if len(quote):
        far = np.append(code, [END, END])
        one, two = far[quote + 1], far[quote + 2]
        is1 = np.isin(one, [ord(c) for c in "stmd"])
        is2 = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        out[quote[is1]] = APO2
        out[quote[is2]] = APO3
    return out


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), by doubling distances."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    return maps


def word_starts(code: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """Positions where a word begins; the ``END`` of each text counts as one."""
    n = len(code)
    to, begins = splitter()
    width = max(1, -(-n // chunks))
    lanes = -(-n // width)
    sym = np.full(lanes * width, STOP, np.intp)
    sym[:n] = symbols(code)
    columns = np.ascontiguousarray(sym.reshape(lanes, width).T) * 8
    maps = np.tile(np.arange(8, dtype=np.intp), (lanes, 1))
    for col in columns:
        maps = to[maps + col[:, None]]
    state = np.concatenate([[FRESH], scan_maps(maps)[:-1, FRESH]]).astype(np.intp)
    marks = np.empty((width, lanes), bool)
    for k, col in enumerate(columns):
        at = state + col
        marks[k] = begins[at]
        state = to[at]
    return np.flatnonzero(marks.T.ravel()[:n])


class TokenTransducer:
    """The counting transducer of one byte-level byte-pair vocabulary, compiled as far as it is used."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": pre.get("trim_offsets"), "use_regex": True} or spec["normalizer"]:
            raise ValueError("only plain byte-level byte-pair tokenizers can be compiled")
        shown = self._byte_names()
        self.token = {bytes(shown[c] for c in name): k for name, k in model["vocab"].items() if all(c in shown for c in name)}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.rank = {tuple(bytes(shown[c] for c in x) for x in p): r for r, p in enumerate(pairs)}
        self.name = {k: b for b, k in self.token.items()}
        self.special = [t["content"] for t in spec["added_tokens"] if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        if len(self.special) != len(spec["added_tokens"]):
            raise ValueError("added tokens that strip or need whole words cannot be compiled")
        self.children: list[dict[int, int]] = [{}]
        self.closes: list[int] = [-1]
        for text, k in self.token.items():
            at = 0
            for b in text:
                if b not in self.children[at]:
                    self.children[at][b] = len(self.children)
                    self.children.append({})
                    self.closes.append(-1)
                at = self.children[at][b]
            self.closes[at] = k
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, int] = {}
        self.size = 0
        self._forget()

    @staticmethod
    def _byte_names() -> dict[str, int]:
        """The printable character that stands for each byte in byte-level vocabularies."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    def _forget(self) -> None:
        start = ((0, -1, 0),)
        self.states, self.number, self.moves = [start], {start: 0}, [{}]

    def encode_small(self, text: bytes) -> list[bytes]:
        """Byte-pair encoding by definition: merge the best-ranked neighbours, leftmost first."""
        parts = [bytes([b]) for b in text]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get((parts[i], parts[i + 1]), 1 << 60), i))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their texts are encoded together."""
        key = (left, right)
        if (known := self.fits.get(key)) is None:
            a, b = self.name[left], self.name[right]
            known = self.fits[key] = self.encode_small(a + b) == [a, b]
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        alive, closing = [], None
        for node, last, behind in self.states[state]:
            if (child := self.children[node].get(byte)) is None:
                continue
            token = self.closes[child]
            if token >= 0 and closing is None and (last < 0 or self.compatible(last, token)):
                closing = (token, behind + 1)
            if self.children[child]:
                alive.append((child, last, behind))
        token, grown = closing
        after = tuple([(node, last, behind - grown) for node, last, behind in alive] + [(0, token, 0)])
        if (number := self.number.get(after)) is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        move = self.moves[state][byte] = (number, grown)
        return move

    def run(self, chunk: bytes, state: int) -> tuple[int, int]:
        """The chunk's map at one state: (state after, tokens emitted)."""
        total = 0
        for byte in chunk:
            state, grown = self.moves[state].get(byte) or self._compile(state, byte)
            total += grown
        return state, total

    def count_words(self, words: list[bytes], span: int = 0) -> np.ndarray:
        """Tokens of each word: chunk maps, composed by a scan over all chunks of all words."""
        span = span or SPAN
        chunks = [w[at : at + span] for w in words for at in range(0, max(1, len(w)), span)]
        many = np.array([max(1, -(-len(w) // span)) for w in words], np.int64)
        begins = np.concatenate([[0], np.cumsum(many)])[:-1]
        inner = np.ones(len(chunks), bool)
        inner[begins] = False
        before = np.zeros(len(chunks), np.int64)
        after, grown = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)

        def run_again(which: list[int]) -> None:
            for k in which:
                after[k], grown[k] = self.run(chunks[k], int(before[k]))

        for k in np.flatnonzero(inner).tolist():
            before[k] = self.run(chunks[k - 1], 0)[0]
        run_again(range(len(chunks)))
        for _ in range(ROUNDS):
            broken = np.flatnonzero(inner[1:] & (after[:-1] != before[1:])) + 1
            if not len(broken):
                break
            before[broken] = after[broken - 1]
            run_again(broken.tolist())
        else:  # out of step for long: one after the other
            for k in np.flatnonzero(inner).tolist():
                if before[k] != after[k - 1]:
                    before[k] = after[k - 1]
                    run_again([k])
        scanned = np.concatenate([[0], np.cumsum(grown)])
        return scanned[begins + many] - scanned[begins]

    def count_all(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.words))
        if new:
            if self.size > BYTES_KEPT:
                self.words, self.size, new = {}, 0, list(set(words))
            if len(self.states) > STATES_KEPT:
                self._forget()
            if len(self.fits) > PAIRS_KEPT:
                self.fits = {}
            self.words.update(zip(new, self.count_words([w.encode("utf-8", "surrogatepass") for w in new]).tolist(), strict=True))
            self.size += sum(map(len, new)) + 130 * len(new)
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, special tokens included."""
        parts, owner, extra = [], [], [0] * len(texts)
        for k, text in enumerate(texts):
            pieces = [text]
            for mark in self.special:
                if mark in text:
                    pieces = [x for p in pieces for x in p.split(mark)]
            extra[k] = len(pieces) - 1
            parts += pieces
            owner += [k] * len(pieces)
        joined = "\n".join(parts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.intp)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        code[ends] = END
        starts = word_starts(code)
        bounds = starts.tolist()
        bounds.append(len(code))
        words = [joined[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        is_end = code[starts] == END
        counts = np.zeros(len(words), np.int64)
        real = np.flatnonzero(~is_end)
        counts[real] = self.count_all([w for w, e in zip(words, is_end.tolist(), strict=True) if not e])
        upto = np.cumsum(counts)[is_end]
        per_part = np.diff(upto, prepend=0)
        out = np.array(extra, np.int64)
        np.add.at(out, owner, per_part)
        return out.tolist()


@lru_cache(maxsize=2)
def transducer(path: str) -> TokenTransducer:
    with open(path, encoding="utf-8") as f:
        return TokenTransducer(json.load(f))


def _count(batches: Iterator[pa.RecordBatch], text_col: str, path: str, limit: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    machine = transducer(path)
    for rows, texts in text_slices(batches, text_col):
        tokens = machine.count_texts([(t or b"").decode("utf-8", "surrogatepass") for t in texts])
        made = [pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], *made], names=[*keep, "n_bytes", "n_tokens", "over_limit"])


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text", limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    ``tokenizer`` is the path of the tokenizer's JSON file, which every executor's installation has.
    """
    small_batches(docs.sparkSession)
    docs = without(docs, ["n_bytes", "n_tokens", "over_limit"])
    keep = docs.columns if keep is None else keep
    read = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = T.StructType([*[read.schema[c] for c in keep], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return read.mapInArrow(lambda it: _count(it, text_col, tokenizer, limit, keep), schema)
