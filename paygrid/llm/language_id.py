"""Language identification: script ranges narrow the candidates, Viterbi labels the words.

The model counts character 1- to 3-grams per language, hashed into a fixed table, over a
bounded sample of the training rows (``MAX_TRAIN`` documents, chosen by a hash of their
id). A word's score under a language is its mean log-probability per gram times a
capped gram count. The scripts that a language uses are learned from the same sample: a
word in a script that some learned language uses is scored only under those languages.
A Viterbi path over the words of a text, with a penalty for switching languages, labels
spans of mixed-language text; the language with most letters on the path is the answer.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and no span. A
text whose words fit no learned script gets the language with most training letters and its even share.
Without training rows every text is ``und``. Rows with null ``lang`` are not trained on. Ties go to the
language that comes first in code-point order. Repeated rows are kept; an empty table gives
an empty result; columns other than ``doc_id, text, lang`` are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_slices, text_slices
from .common import crc_mod

MAX_TRAIN = 20_000          # documents that the model is fitted on, at most (in expectation)
TABLE_BITS = 17             # hashed grams per language
SWITCH = 6.0                # cost of changing the language between two words
MAX_GRAMS = 24              # a longer word weighs no more than this many grams
UNSEEN = -60.0              # score of a word under a language that does not use its script
MIN_SCRIPT_SHARE = 0.01     # share of a language's letters that makes a script one of its own

# First code points of Unicode script ranges; letters before the first range are Latin.
SCRIPTS = ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul", "latin",
           "greek", "kana", "han", "hangul", "latin", "other")
STARTS = np.array([0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0E00, 0x10A0, 0x1100, 0x1E00,
                   0x1F00, 0x3040, 0x3400, 0xAC00, 0xFB00, 0x10000])
NAMES = sorted(set(SCRIPTS))
SCRIPT_OF = np.array([NAMES.index(s) for s in SCRIPTS])
_ALPHA: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Lookup table over all code points, built once per process."""
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _ALPHA[0]


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed grams of all words, the word each belongs to, letters per word, script per word.

    Characters that are not letters act as word boundaries; a gram holds a boundary only at its ends.
    """
    cps = np.frombuffer("\0".join(["", *words, "", ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    alpha = is_letter()[cps]
    c = np.where(alpha, cps, 0).astype(np.uint64)
    # Word of each position: separators are exactly the NULs added above (NULs in texts were mapped out).
    word = np.cumsum(cps == 0) - 1
    letters = np.bincount(word[alpha], minlength=len(words))[:len(words)]
    scripts = SCRIPT_OF[np.searchsorted(STARTS, cps, side="right") - 1]
    script = np.full(len(words), -1)
    pos = np.flatnonzero(alpha)[::-1]
    script[word[pos]] = scripts[pos]            # the first letter decides
    out, own = [], []
    a, b, d = c[:-2], c[1:-1], c[2:]
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - TABLE_BITS)
    for h, ok in (((b * k1 + np.uint64(1)) * k3, b > 0), ((a * k1 + b * k2 + np.uint64(2)) * k3, (a > 0) | (b > 0)),
                  ((a * k1 + b * k2 + d * k3 + np.uint64(3)) * k1, b > 0)):
        h ^= h >> np.uint64(29)
        at = np.flatnonzero(ok)
        out.append((h[at] * k2 >> shift).astype(np.int64))
        # A pair that starts with a boundary belongs to the word of its letter.
        own.append(np.where(c[at + 1] > 0, word[at + 1], word[at]))
    return np.concatenate(out), np.concatenate(own), letters, script


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words per row, the word id of every word in row order, and the distinct words (lower case)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    text = pc.replace_substring(pc.utf8_lower(pc.fill_null(column.cast(pa.string()), "")), "\0", " ")
    lists = pc.utf8_split_whitespace(text)
    n = np.asarray(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    d = lists.flatten().dictionary_encode()
    return n, d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        """``counts``: grams per language and table slot; ``scripts``: letters per language and script."""
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True)
        self.logp = np.log((counts + 0.5) / (total + 0.5 * counts.shape[1])).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = share >= MIN_SCRIPT_SHARE           # language x script
        self.first = int(scripts.sum(axis=1).argmax()) if langs else 0

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (words x languages, relative to the best language) and letters of each word."""
        grams, own, letters, script = word_grams(words)
        n = np.bincount(own, minlength=len(words))[:len(words)]
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        weight = np.minimum(n, MAX_GRAMS) / np.maximum(n, 1)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(own, weights=self.logp[k][grams], minlength=len(words))[:len(words)] * weight
        out -= out.max(axis=1, keepdims=True) if len(self.langs) else 0
        known = self.uses[:, script].T & (script >= 0)[:, None]      # words x languages
        narrowed = known.any(axis=1)
        out[narrowed] = np.where(known[narrowed], out[narrowed], UNSEEN)
        out[~narrowed] = 0.0
        return out, letters

    def paths(self, n: np.ndarray, codes: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Best language of every word: one Viterbi step for all texts of a block at a time."""
        best = np.zeros(len(codes), dtype=np.int16)
        starts = np.cumsum(n) - n
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        i, k = 0, len(self.langs)
        while i < len(order):
            # Texts of similar length share a block of at most a million cells.
            j = i + 1
            while j < len(order) and (j + 1 - i) * n[order[j]] * k <= 1 << 20 and n[order[j]] <= 2 * n[order[i]] + 8:
                j += 1
            rows = order[i:j]
            lens, width = n[rows], int(n[order[j - 1]])
            cell = np.minimum(np.arange(width)[:, None], lens[None, :] - 1) + starts[rows][None, :]     # step x text
            live = np.arange(width)[:, None] < lens[None, :]
            back = np.zeros((width, len(rows), k), dtype=np.int16)
            v = scores[codes[cell[0]]].copy()
            same = np.arange(k, dtype=np.int16)[None, :]
            for t in range(1, width):
                top = v.argmax(axis=1)
                jump = v[np.arange(len(rows)), top] - SWITCH
                moved = jump[:, None] > v
                back[t] = np.where(moved, top[:, None].astype(np.int16), same)
                step = np.where(moved, jump[:, None], v) + scores[codes[cell[t]]]
                v = np.where(live[t][:, None], step, v)
                back[t][~live[t]] = same
            state = v.argmax(axis=1).astype(np.int16)
            for t in range(width - 1, -1, -1):
                on = live[t]
                best[cell[t][on]] = state[on]
                state = back[t][np.arange(len(rows)), state] if t else state
            i = j
        return best

    def label(self, column: pa.Array) -> tuple[list[str], list[float], list[str]]:
        n, codes, words = split_words(column)
        if not self.langs:
            return ["und"] * len(n), [0.0] * len(n), [""] * len(n)
        scores, letters = self.word_scores(words)
        best = self.paths(n, codes, scores)
        row = np.repeat(np.arange(len(n)), n)
        weight = letters[codes].astype(np.float64)
        known = (scores[codes] != 0).any(axis=1) if len(codes) else np.zeros(0, dtype=bool)
        by = np.zeros((len(n), len(self.langs)))
        np.add.at(by, (row, best), weight)
        evidence = np.bincount(row, weights=weight * known, minlength=len(n))
        total = by.sum(axis=1)
        # Runs of one language: the first word of each run.
        edge = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (row[1:] != row[:-1])])) if len(row) else []
        starts = np.cumsum(n) - n
        spans: list[list[str]] = [[] for _ in n]
        for a, b in zip(edge, [*edge[1:], len(row)]):
            spans[row[a]].append(f"{self.langs[best[a]]}:{a - starts[row[a]]}:{b - starts[row[a]]}")
        lang, score = [], []
        for i in range(len(n)):
            if total[i] == 0:
                lang.append("und"); score.append(0.0); spans[i] = []    # noqa: E702
            elif evidence[i] == 0:
                lang.append(self.langs[self.first]); score.append(1.0 / len(self.langs))    # noqa: E702
            else:
                k = int(by[i].argmax())
                lang.append(self.langs[k]); score.append(float(by[i, k] / total[i]))    # noqa: E702
        return lang, score, [" ".join(s) for s in spans]


def train(docs: DataFrame, max_docs: int = MAX_TRAIN) -> Model:
    """Fit the model on at most about ``max_docs`` rows of ``doc_id, text, lang`` (text and lang non-null)."""
    rows = docs.filter("lang is not null").select("doc_id", "text", "lang")
    count = rows.groupBy("lang").count().collect()      # one row per language; texts are not read
    langs = sorted(r["lang"] for r in count)
    total = sum(r["count"] for r in count)
    if not langs:
        return Model([], np.zeros((0, 1 << TABLE_BITS)), np.zeros((0, len(NAMES))))
    if total > max_docs:
        keep = int(max_docs / total * (1 << 20))
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < keep)
    rows = rows.filter("text is not null").select("text", "lang")
    index = {x: i for i, x in enumerate(langs)}

    def count_grams(batches):
        counts = np.zeros((len(langs), 1 << TABLE_BITS), dtype=np.float32)
        scripts = np.zeros((len(langs), len(NAMES)))
        for whole in batches:
            for b in text_slices(whole):
                lang = np.array([index[x] for x in b.column("lang").to_pylist()], dtype=np.int64)
                n, codes, words = split_words(b.column("text"))
                grams, own, letters, script = word_grams(words)
                row_lang = np.repeat(lang, n)
                for k in range(len(langs)):
                    times = np.bincount(codes[row_lang == k], minlength=len(words))
                    counts[k] += np.bincount(grams, weights=times[own], minlength=1 << TABLE_BITS)
                    scripts[k] += np.bincount(script[script >= 0], weights=(times * letters)[script >= 0], minlength=len(NAMES))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((counts, scripts))], pa.binary())], ["part"])

    # The sample is bounded, so it is counted in eight tasks, one fixed-size table each.
    parts = rows.repartition(8).mapInArrow(count_grams, "part binary").collect()
    tables = [pickle.loads(p["part"]) for p in parts]
    return Model(langs, sum(t[0].astype(np.float64) for t in tables), sum(t[1] for t in tables))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` (runs ``lang:first:end`` in word positions) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # a fixed-size table per language

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, spans = shared.value.label(b.column("text"))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                           pa.array(spans, pa.string())], ["doc_id", "lang_pred", "score", "spans"])

    return map_slices(docs.select("doc_id", "text"), step, "doc_id long, lang_pred string, score double, spans string")


def identify(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Train on the rows whose crc32 remainder by 4 is not 2, label all rows."""
    model = train(docs.filter(crc_mod(F.col("doc_id"), 4) != 2), max_train)
    out = predict(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "spans")
