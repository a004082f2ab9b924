"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Features of a text are hashed to ``2**BITS`` slots: its words and word pairs, and one to three word forms in a
row. A form is the word with every run of capitals, other letters, digits or one other character
written once (``Rewh.###`` becomes ``Aa.#``); a word that repeats the one before it has a form of
its own. Forms carry over to words never seen in training. A slot's value is its share among the text's
n-grams of that sort, so long and short texts are alike.

Training is FTRL-Proximal (per-coordinate rates, L1 and L2). The training rows are dealt to shards of about
``SHARD_ROWS`` by a hash of the row; each task runs its shard ``EPOCHS`` times in a fixed order, and the
shards' weights are averaged slot by slot. A text's score is the logistic function of one sparse dot product.

Training rows are a bounded sample: about ``MAX_TRAIN`` labelled rows, chosen by a hash of the id. Scoring reads
every word of every text.

Defined cases: null and empty texts have one slot that says so (its weight is 0 unless training saw such
texts). Without training rows every score is 0.5, with one class only it is that class's smoothed share. A label of a repeated
id counts once, as its maximum; null labels are left out; rows of an id with several texts each train.
Repeated rows are kept, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize

from .arrow import BLANK, INSIDE, hashes, map_slices, split_tokens, text_slices
from .common import crc_mod

BITS = 18                   # hashed slots of the model
MAX_TRAIN = 20_000          # rows that the model is fitted on, at most (in expectation)
SHARD_ROWS = 2_500          # rows that one task trains on, about
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 0.01, 0.02, 0.1          # rate, its offset, and the two penalties
THRESHOLD = 0.5

KINDS = np.full(256, INSIDE, dtype=np.uint8)
KINDS[[0x20, 9, 10, 11, 12, 13]] = BLANK
ASIS = np.arange(256, dtype=np.uint8)
REPEATED = np.uint64(0x5851F42D4C957F2D)            # form of a word that repeats the one before it
SORTS = 5                                           # words, pairs of words, 1 to 3 forms in a row
EMPTY = 0                                           # slot of texts without a word
_UNIT = str.maketrans({**{chr(c): "A" for c in range(65, 91)}, **{chr(c): "9" for c in range(48, 58)}})
_RUNS = re.compile(r"(.)\1+", re.S)
_LETTERS = re.compile(r"[^\W\dA_]+")


def form(word: str) -> str:
    return _RUNS.sub(r"\1", _LETTERS.sub("a", word.translate(_UNIT)))


def slots(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every sort of n-gram: the row and the slot of each occurrence."""
    row, code, joined, found = split_tokens(column, KINDS, ASIS)
    if not len(row):
        return [(row, code)] * SORTS
    word = hashes(found)[code]
    shape = hashes(pa.array([form(w) for w in found.to_pylist()], pa.string()))[code]
    again = np.zeros(len(code), dtype=bool)
    again[1:] = joined[:-1] & (code[1:] == code[:-1])
    shape[again] = REPEATED
    out = []
    for sort, (h, n) in enumerate(((word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3))):
        x = np.full(len(h) - n + 1 if len(h) >= n else 0, np.uint64((sort + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1), dtype=np.uint64)
        ok = np.ones(len(x), dtype=bool)
        for k in range(n):
            x = (x ^ h[k:len(x) + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            if k + 1 < n:
                ok &= joined[k:len(x) + k]
        out.append((row[:len(x)][ok], (x[ok] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)))
    return out


def dots(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sparse dot product of every text with the weights."""
    z = np.zeros(len(column))
    words = None
    for row, slot in slots(column):
        n = np.bincount(row, minlength=len(z))
        words = n if words is None else words
        z += np.bincount(row, weights=weights[slot], minlength=len(z)) / np.maximum(n, 1)
    return z + np.where(words == 0, weights[EMPTY], 0.0)


def vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct slots and values of every text."""
    parts = slots(column)
    out = []
    at = [np.searchsorted(row, np.arange(len(column) + 1)) for row, _ in parts]
    for i in range(len(column)):
        s, v = [], []
        for (_, slot), a in zip(parts, at):
            mine = slot[a[i]:a[i + 1]]
            s.append(mine)
            v.append(np.full(len(mine), 1.0 / max(len(mine), 1)))
        if not len(s[0]):
            s, v = [np.array([EMPTY])], [np.array([1.0])]
        slot, back = np.unique(np.concatenate(s), return_inverse=True)
        out.append((slot.astype(np.int32), np.bincount(back, weights=np.concatenate(v))))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray, bool]]) -> tuple[np.ndarray, float]:
    """FTRL-Proximal over the rows in their order: weights and intercept."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)         # the last coordinate is the intercept
    bias = 1 << BITS

    def weight(s):
        zs = z[s]
        penalty = np.where(s == bias, 0.0, L1)
        return np.where(np.abs(zs) <= penalty, 0.0, -(zs - np.sign(zs) * penalty) / ((BETA + np.sqrt(n[s])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for slot, value, good in rows:
            s, x = np.append(slot, bias), np.append(value, 1.0)
            w = weight(s)
            g = (1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, float(w @ x))))) - good) * x
            z[s] += g - (np.sqrt(n[s] + g * g) - np.sqrt(n[s])) / ALPHA * w
            n[s] += g * g
    w = weight(np.arange(bias + 1))
    return w[:-1], float(w[-1])


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def scores(self, column: pa.Array) -> np.ndarray:
        z = dots(column, self.weights) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs (doc_id, text)`` joined with ``labels (doc_id, quality)``."""
    lab = (labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null")
                 .groupBy("doc_id").agg((F.max("quality") > 0).alias("good")))
    sizes = {r["good"]: r["count"] for r in lab.groupBy("good").count().collect()}      # two rows
    total = sum(sizes.values())
    if len(sizes) < 2:
        share = (sizes.get(True, 0) + 0.5) / (total + 1.0)
        return Model(np.zeros(1 << BITS), math.log(share / (1.0 - share)))
    grain = 1 << 20
    sample = lab.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < int(min(1.0, MAX_TRAIN / total) * grain))
    shards = max(1, round(min(total, MAX_TRAIN) / SHARD_ROWS))
    # About MAX_TRAIN rows of two short columns, whatever the size of the corpus.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "good", F.xxhash64("doc_id", "text").alias("h"))

    def featurise(batches):
        for whole in batches:
            for b in text_slices(whole):
                v = vectors(b.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [b.column("h"), b.column("good"), pa.array([s for s, _ in v], pa.list_(pa.int32())),
                     pa.array([x for _, x in v], pa.list_(pa.float64()))], ["h", "good", "slots", "vals"])

    rows = materialize(rows.mapInArrow(featurise, "h long, good boolean, slots array<int>, vals array<double>"), "quality-sample")

    def shard(batches):
        mine: dict[int, list] = {}
        for b in batches:
            for k, h, good, s, v in zip(*[b.column(c).to_pylist() for c in ("shard", "h", "good")], b.column("slots"), b.column("vals")):
                mine.setdefault(k, []).append((h, good, np.asarray(s.values, np.int32), np.asarray(v.values)))
        for part in mine.values():              # tasks may hold several shards; each trains on its own
            w, bias = train([(s, v, good) for _, good, s, v in sorted(part, key=lambda r: r[:2])])
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], ["slot", "w"])

    rows = rows.withColumn("shard", F.pmod(F.shiftright("h", 20), F.lit(shards)))
    sums = rows.repartition(shards, "shard").mapInArrow(shard, "slot long, w double").groupBy("slot").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    found = {r["slot"]: (r["w"], r["n"]) for r in materialize(sums, "quality-weights").collect()}       # 2**BITS rows at most
    if not found:
        return Model(np.zeros(1 << BITS), 0.0)
    used = found[-1][1]                                             # shards that had rows
    weights = np.zeros(1 << BITS)
    for slot, (w, _) in found.items():
        if slot >= 0:
            weights[slot] = w / used
    return Model(weights, found[-1][0] / used)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: fit on labels whose crc32 remainder by 3 is not 1, score all rows."""
    model = fit(docs, labels.filter(crc_mod(F.col("doc_id"), 3) != 1))
    shared = docs.sparkSession.sparkContext.broadcast(model)        # 2**BITS floats: 1 MB

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value.scores(b.column("text"))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                          ["doc_id", "score", "predicted"])

    out = map_slices(docs.select("doc_id", "text"), step, "doc_id long, score double, predicted int")
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
