"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the byte n-grams (``ORDERS``) of the text in which ASCII letters are lower-cased and
every other ASCII character is a word boundary; they are hashed into ``BUCKETS``. A text's vector is
the mean of its subwords' embeddings, the classes' scores are linear in it. Embeddings and weights are
trained together by stochastic gradient descent in numpy on a bounded sample: at most ``TRAIN_DOCS``
labelled rows, spread over the languages, chosen by a hash of id and text; only whole texts are used, and of each
also two short stretches of words, as short texts must be judged too. A fifth of the sample (by
another hash) is left out of training and calibrates: a temperature by likelihood, and the rejection
limit, the score that all but ``LOSE`` of the correctly recognised calibration texts reach (at most
``MOST_LIMIT``). For prediction the product embeddings x weights is one table (BUCKETS x languages),
which is all that executors get.

Nulls: a null text, or one without a letter, is ``und`` with score 0 and rejected. Rows with a null
label or null id are not learned from; a row with a null id counts as held out. Very long texts are read
whole, one slice each. With no labelled row
all is ``und``; with one language every text with a letter gets it. Ties go to the smaller language.
Repeated rows get equal results; an empty table gives an empty result; input columns named like a
result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmill.llm.common import give_back, small_batches, text_slices, without

BUCKETS = 1 << 14
ORDERS = (2, 3, 4)
TRAIN_DOCS = 2000
DIM, EPOCHS, BATCH, RATE = 16, 6, 32, 0.5
LOSE, MOST_LIMIT = 0.0005, 0.5
UND = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def subwords(text: bytes) -> np.ndarray:
    """Bucket counts of a text's subwords (float32, length BUCKETS); stretches without a letter count nothing."""
    code = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    out = np.zeros(BUCKETS, np.int64)
    blank = code == 32
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = code[:m].copy()
        inner = np.zeros(m, bool)
        for k in range(1, n):
            h = h * np.uint32(0x01000193) + code[k : k + m]
            if k < n - 1:
                inner |= blank[k : k + m]
        if n == 2:
            inner = blank[:m] & blank[1 : 1 + m]
        h = (h + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(18)
        out += np.bincount(h[~inner], minlength=BUCKETS)
    return out


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    limit: float

    def scores(self, text: bytes) -> np.ndarray:
        counts = subwords(text)
        mean = counts.astype(np.float32) @ self.table / max(1, counts.sum())
        z = (mean + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _stretches(text: bytes, salt: int) -> list[bytes]:
    """The whole text and two short runs of its words."""
    words = text.split()
    out = [text]
    for k, width in ((1, 4 + salt % 9), (2, 14 + salt % 23)):
        if len(words) > width:
            at = (salt * 2654435761 * k) % (len(words) - width)
            out.append(b" ".join(words[at : at + width]))
    return out


def _featurize(batches: Iterator[pa.RecordBatch], text_col: str, label_col: str) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_slices(batches, text_col):
        labels, marks = rows.column(label_col).to_pylist(), rows.column("__mark").to_pylist()
        out: list[list] = [[], [], [], []]
        for text, label, mark in zip(texts, labels, marks, strict=True):
            for piece in _stretches(text or b"", mark % 1_000_003):
                counts = subwords(piece)
                at = np.flatnonzero(counts)
                if len(at):
                    for column, value in zip(out, (label, mark, at.astype(np.uint16).tobytes(), (counts[at] / counts.sum()).astype(np.float32).tobytes()), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], names=["label", "mark", "at", "share"])


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, most: int = TRAIN_DOCS) -> DataFrame:
    """Subword features of the training sample: about ``most`` rows (expected), an equal number of each language where it has them, and one of each at least."""
    known = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    counts = {r[0]: r[1] for r in known.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    each = max(1, most // max(1, len(counts)))
    if not counts:
        share = F.lit(0)
    else:
        share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, math.ceil((1 << 30) * min(1.0, each / n)))]), F.col(label_col))
    mark = F.xxhash64(F.col(id_col), F.lit("train"))
    chosen = known.withColumn("__mark", F.call_function("shiftrightunsigned", mark, F.lit(1))).filter(F.col("__mark") % (1 << 30) < share)
    small_batches(docs.sparkSession)
    return chosen.select(label_col, text_col, "__mark").mapInArrow(lambda it: _featurize(it, text_col, label_col), "label string, mark long, at binary, share binary")


def train(rows: list[tuple[str, int, bytes, bytes]], seed: int = 11) -> Model:
    """Fit on (label, mark, buckets, shares) rows; rows whose mark is 0 modulo 5 (above the sampling bits) calibrate."""
    langs = sorted({r[0] for r in rows})
    if len(langs) < 2:
        return Model(langs, np.zeros((BUCKETS, max(1, len(langs))), np.float32), np.zeros(max(1, len(langs)), np.float32), 1.0, 0.0)
    number = {x: k for k, x in enumerate(langs)}
    rows = sorted(rows, key=lambda r: (r[1], r[0], r[2], r[3]))
    data = [(number[a], (m >> 31) % 5 == 0, np.frombuffer(at, np.uint16), np.frombuffer(sh, np.float32)) for a, m, at, sh in rows]
    fit, check = [d for d in data if not d[1]], [d for d in data if d[1]]
    fit, check = fit or data, check or data
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(langs)), np.float32)
    steps, total = 0, EPOCHS * -(-len(fit) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit))
        for low in range(0, len(fit), BATCH):
            rate = RATE * (1 - steps / total)
            steps += 1
            grad_out = np.zeros_like(out)
            for k in order[low : low + BATCH]:
                y, _, at, share = fit[k]
                hidden = share @ emb[at]
                z = hidden @ out
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y] -= 1
                grad_out += np.outer(hidden, p)
                emb[at] -= (rate * 20) * share[:, None] * (out @ p)[None, :]
            out -= rate * grad_out
    table = emb @ out
    logits = np.array([d[3] @ table[d[2]] for d in check])
    truth = np.array([d[0] for d in check])

    def softmax(t: float) -> np.ndarray:
        z = logits / t
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    steps_t = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in steps_t]
    temperature = float(steps_t[int(np.argmin(loss))])
    p = softmax(temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    limit = min(MOST_LIMIT, float(np.quantile(right, LOSE))) if len(right) else 0.0
    return Model(langs, table.astype(np.float32), np.zeros(len(langs), np.float32), temperature, limit)


def _predict(batches: Iterator[pa.RecordBatch], text_col: str, model, keep: list[str]) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    for rows, texts in text_slices(batches, text_col):
        letters = pc.fill_null(pc.match_substring_regex(rows.column(text_col), r"\pL"), False).to_pylist()
        lang, score, gone = [], [], []
        for text, has in zip(texts, letters, strict=True):
            if not has or not m.langs:
                lang.append(UND), score.append(0.0), gone.append(True)
                continue
            p = m.scores(text)
            best = int(p.argmax())
            lang.append(m.langs[best]), score.append(float(p[best])), gone.append(bool(p[best] < m.limit))
        yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gone, pa.bool_())], names=[*keep, "lang_pred", "score", "rejected"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """Train on the bounded sample; its features (at most BUCKETS entries a stretch) come to the driver, and what training used is given back."""
    rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in sample(docs, id_col, text_col, label_col).collect()]
    model = train(rows)
    del rows
    give_back()
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with ``held_out``, ``lang_pred``, ``score`` and ``rejected`` of every row."""
    made = ["lang_pred", "score", "rejected"]
    small_batches(docs.sparkSession)
    docs = without(docs, [*made, "held_out"])
    keep = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*dict.fromkeys([*keep, text_col]))
    schema = T.StructType([*[read.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    judged = read.mapInArrow(lambda it: _predict(it, text_col, sent, keep), schema)
    return judged.select(*keep, held_out(id_col).alias("held_out"), *made) if id_col in keep else judged
