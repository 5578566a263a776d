"""Quality scores by naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, a linear hinge-loss
model fitted by dual coordinate descent, and a logistic curve from margins to scores."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import map_texts

#: Indicators are hashed into 2 to this many places.
PLACE_BITS = 16
#: Labelled rows that a model is fitted on at most; those with the smallest hashes of their ids.
SAMPLE_ROWS = 6000
#: Added to the document counts of an indicator in each class.
SMOOTHING = 1.0
#: Cost of a margin error, for the rows of an average class; classes weigh the same together.
COST = 1.0
EPOCHS = 30
THRESHOLD = 0.7
SEED = 7

_SLICE = 1 << 18
_TAIL = re.compile(rb"[^0-9A-Za-z\x80-\xff]*\Z")


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _kind(word: bytes) -> int:
    """A small number for the form of a word: letters, case, length and what it ends with."""
    tail = _TAIL.search(word)[0]
    core = word[:len(word) - len(tail)]
    case = (0 if not core else 1 if core.isdigit() else 2 if core.isupper() and len(core) > 1
            else 3 if core[:1].isupper() else 4 if not any(c < 128 and not chr(c).isalnum() for c in core) else 5)
    end = 0 if not tail else 1 if tail in (b".", b",") else 2 if len(set(tail)) == 1 and len(tail) > 1 else 3
    return (case * 4 + end) * 4 + min(3, len(core) // 5)


def places(text: str | None) -> np.ndarray:
    """The distinct places of a text's indicators, rising: byte bigrams and trigrams; runs of one to three word forms,
    where a word also shows whether it is the one before or came before; shares of word forms; length."""
    raw = (text or "").encode()
    seen = np.zeros(1 << PLACE_BITS, dtype=bool)
    for at in range(0, max(1, len(raw)), _SLICE):
        codes = np.frombuffer(raw[at:at + _SLICE + 2], dtype=np.uint8).astype(np.uint32)
        pairs = codes[:-1] << np.uint32(8) | codes[1:]
        seen[_mix(pairs, 1)] = True
        seen[_mix(pairs[:-1] << np.uint32(8) | codes[2:], 2)] = True
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(ids):
        kinds = np.array([_kind(w) for w in number], dtype=np.int64)[ids]
        first = np.zeros(len(ids), dtype=bool)
        first[np.unique(ids, return_index=True)[1]] = True
        again = np.where(first, 0, 1)
        again[1:][ids[1:] == ids[:-1]] = 2
        forms = kinds * 3 + again
        run = forms
        for n in range(3):
            if n:
                run = run[:-1] * 1009 + forms[n:]
            seen[_mix(run, 10 + n)] = True
        for salt, group in ((20, kinds // 16), (30, (kinds // 4) % 4), (40, again)):
            shares = np.bincount(group) / len(ids)
            seen[_mix(np.arange(len(shares)) * 16 + np.ceil(shares * 10).astype(np.int64), salt)] = True
    seen[_mix(np.array([len(words).bit_length()]), 50)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Weights and squared ratios by place, a bias, and the logistic curve. A constant model has slope 0."""
    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, at: np.ndarray) -> float:
        return float(self.weights[at].sum() / np.sqrt(max(self.squares[at].sum(), 1e-12)) + self.bias)

    def score(self, text: str | None) -> float:
        value = self.slope * self.margin(places(text)) + self.offset if self.slope else self.offset
        return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))


def descend(rows: list[np.ndarray], ratios: np.ndarray, scales: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by coordinate steps on its dual; labels are +1 and -1.

    Row i has the values ratios[rows[i]] * scales[i]; they are made when they are needed, so memory holds the places only.
    """
    shares = {s: max(1, int((labels == s).sum())) for s in (1, -1)}
    cost = np.array([COST * len(labels) / (2 * shares[int(y)]) for y in labels])
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(labels))
    squares = ratios ** 2
    diagonal = np.array([float(squares[at].sum()) * s * s + 1.0 for at, s in zip(rows, scales, strict=True)])
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in rng.permutation(len(labels)):
            at, y = rows[i], labels[i]
            v = ratios[at] * scales[i]
            slope = y * (float(weights[at] @ v) + bias) - 1
            new = min(max(alpha[i] - slope / diagonal[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * y) != 0.0:
                weights[at] += step * v
                bias += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-4:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance of a positive label by margin, with smoothed targets, by Newton steps."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        w, e = np.maximum(p * (1 - p), 1e-9), p - target
        hessian = np.array([[(w * margins ** 2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hessian, np.array([(e * margins).sum(), e.sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def held_out(id_column: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
           text_column: str = "text") -> DataFrame:
    """(id, label, text) of at most SAMPLE_ROWS labelled documents that aren't held out, in no order.

    Labels without a document take no place. Ids with several labels take the lowest, ids with several texts the one of
    the least hash, so an id has one row. The chosen ids are broadcast: there are SAMPLE_ROWS of them at most.
    """
    known = (labels.where(labels[label_column].isNotNull() & labels[id_column].isNotNull())
             .groupBy(labels[id_column].alias("l_id")).agg(F.min(label_column).cast("int").alias("label"))
             .where(~held_out(F.col("l_id"))))
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    there = known.join(rows.select(F.col("id").alias("l_id")).distinct(), "l_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("l_id"), "l_id").limit(SAMPLE_ROWS)
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text"))).alias("least")
    return (rows.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).groupBy("id", "label").agg(one)
            .select("id", "label", F.col("least.text").alias("text")))


def _featured(rows: DataFrame) -> DataFrame:
    """(id, label, at): places as little-endian unsigned 16-bit integers."""
    made = T.StructType([T.StructField("at", T.BinaryType())])
    return map_texts(rows, ["id", "label"], "text", made,
                     lambda: lambda texts: ((places(t).astype("<u2").tobytes(),) for t in texts))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
        text_column: str = "text") -> Model:
    """The model from a bounded sample of labelled rows; a label is positive if it is over 0.

    A row of the sample is at most 2 ** PLACE_BITS numbers of 16 bits on the driver. The fit has three steps: log-count
    ratios, the dual descent on three quarters of the sample, and the logistic curve on the margins of the rest. Without both classes the score is the smoothed share of the positive one.
    """
    found = _featured(sample(docs, labels, id_column, label_column, text_column)).toArrow()
    rows = [np.frombuffer(at.as_buffer(), dtype="<u2") for at in found.column("at")]
    given = list(zip(map(str, found.column("id").to_pylist()), map(len, rows), found.column("label").to_pylist(), strict=True))
    order = sorted(range(len(rows)), key=given.__getitem__)
    rows, positive = [rows[i] for i in order], np.array([given[i][2] > 0 for i in order], dtype=bool)
    size = 1 << PLACE_BITS
    test = np.zeros(len(rows), dtype=bool)
    for side in (True, False):                       # each fourth row of either class
        test[np.flatnonzero(positive == side)[::4]] = True
    if min(positive[~test].sum(), (~positive[~test]).sum(), positive[test].sum(), (~positive[test]).sum()) < 1:
        share = (positive.sum() + 1) / (len(rows) + 2)
        return Model(np.zeros(size), np.ones(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    counts = np.full((2, size), SMOOTHING)
    for at, is_positive, out in zip(rows, positive, test, strict=True):
        if not out:
            counts[int(is_positive), at] += 1
    n1, n0 = positive[~test].sum(), (~positive[~test]).sum()
    ratios = np.log(counts[1] / (n1 + 2 * SMOOTHING)) - np.log(counts[0] / (n0 + 2 * SMOOTHING))
    squares = ratios ** 2
    used = np.flatnonzero(~test)
    scales = np.array([1 / np.sqrt(max(squares[rows[i]].sum(), 1e-12)) for i in used])
    weights, bias = descend([rows[i] for i in used], ratios, scales, np.where(positive[used], 1, -1))
    model = Model(weights * ratios, squares, bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(test)])
    model.slope, model.offset = logistic_curve(margins, positive[test])
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row for each row of `docs`; the score lies between 0 and 1.

    Only the text counts. Null texts are scored as empty ones. Repeated rows and null ids come back as they are; a null id
    is not held out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = sent.value
        return lambda texts: ((own.score(t),) for t in texts)

    scored = map_texts(docs, [id_column], text_column, T.StructType([T.StructField("score", T.DoubleType())]), start)
    return scored.select(id_column, held_out(F.col(id_column)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
