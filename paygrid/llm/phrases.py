"""Phrase collocation mining by top-order marginalisation.

Only the longest windows are counted: for every word the window of it and its up to four
followers in the piece, padded to five lead columns. One ROLLUP over those columns then sums the
windows to all shorter prefixes, so a single grouping gives the counts of all
phrases of one to five words and, at the level of the language, the number of words.

A window need not go past its longest prefix that occurs ``MIN_COUNT`` times: longer phrases from there are not
reported. Two passes count hashed slots, first of word pairs, then of three to five words whose pairs
all pass; a window ends before the first prefix whose slot stays below ``MIN_COUNT``. Prefixes that
share a slot only share a larger count, so nothing that can be reported is cut, whatever the number of slots. It
grows with the input up to ``2**MAX_BITS`` (one bit each is broadcast, 32 MB at most); past some 50 GB of text
windows stay longer and more rows are grouped, with the same result.

Words and languages: A-Z lower-cased, pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``.

Defined cases: null texts hold no word, a null language is ``und`` (and joins rows that
say ``und``), repeated rows count each time, an empty table or one without frequent phrases gives an empty
result, other columns are ignored. Very long texts are cut into words like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrid.session import materialize

from .arrow import BLANK, BREAK, INSIDE, hashes, split_tokens, text_slices

MIN_COUNT = 100             # occurrences of a candidate, at least
LONGEST = 5                 # words of a candidate, at most
TOP = 2_000                 # phrases reported for each language
MIN_BITS, MAX_BITS = 16, 28
CHUNK = 1 << 16             # slots summed at a time
BUFFER = 1 << 22            # slots that a task holds before it sorts them and hands them on
SPREAD = 64                 # parts of a language's phrases, each with its own best ones

WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
KINDS = np.full(256, INSIDE, dtype=np.uint8)
KINDS[[0x20, 0x09]] = BLANK
KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a slice of texts and hashes of the phrases that start at them."""

    def __init__(self, b: pa.RecordBatch):
        self.row, self.code, self.joined, self.words = split_tokens(b.column("text"), KINDS, LOWER)
        self.langs = b.column("lang").dictionary_encode()
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.row]
        self.own = hashes(self.words)[self.code] if len(self.code) else np.zeros(0, np.uint64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Words that a word of their piece follows, and the hash of each with that word."""
        at = np.flatnonzero(self.joined)
        of_lang = hashes(self.langs.dictionary)
        return at, self.longer(_mix(self.own[at] + of_lang[self.lang[at]]) if len(at) else self.own[at], at, 2)

    def longer(self, h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each position, given that of the first ``k - 1``."""
        return _mix(h * np.uint64(0x9E3779B97F4A7C15) + self.own[at + k - 1])


class Kept:
    """Slots whose phrases occur often enough together."""

    def __init__(self, bits: int, packed: bytes):
        self.shift, self.table = np.uint64(64 - bits), np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).view(bool)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        return self.table[(h >> self.shift).astype(np.int64)]


def frequent_slots(docs: DataFrame, bits: int, least: int, phrases) -> bytes:
    """A bit per slot, set where ``least`` or more of the phrases whose hashes ``phrases(words)`` yields fall into it.

    A task hands on its slots sorted and counted, three bytes each; a range of slots is summed as it streams past.
    """
    full = min(least, 255)                      # a count need not go beyond the bound: one byte is enough

    def counted(buffer):
        slot, n = np.unique(np.concatenate(buffer), return_counts=True)
        n = np.minimum(n, full).astype(np.uint8)
        cuts = np.flatnonzero(np.diff(slot // CHUNK)) + 1
        parts = list(zip(np.split(slot, cuts), np.split(n, cuts)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(s[0]) // CHUNK for s, _ in parts], pa.int64()), pa.array([(s % CHUNK).astype(np.uint16).tobytes() for s, _ in parts], pa.binary()),
             pa.array([c.tobytes() for _, c in parts], pa.binary())], ["chunk", "slots", "counts"])

    def count(batches):
        buffer, held = [], 0
        for whole in batches:
            for b in text_slices(whole):
                for h in phrases(Words(b)):
                    buffer.append((h >> np.uint64(64 - bits)).astype(np.uint32))
                    held += len(h)
                if held > BUFFER:
                    yield from counted(buffer)
                    buffer, held = [], 0
        if held:
            yield from counted(buffer)

    def add(batches):
        at, total = -1, np.zeros(CHUNK, dtype=np.int64)
        for b in batches:
            for chunk, slots, n in zip(b.column("chunk").to_pylist(), b.column("slots"), b.column("counts")):
                if chunk != at:
                    if at >= 0:
                        yield kept_row(at, total)
                    at, total = chunk, np.zeros(CHUNK, dtype=np.int64)
                total[np.frombuffer(slots.as_buffer(), dtype=np.uint16)] += np.frombuffer(n.as_buffer(), dtype=np.uint8)
        if at >= 0:
            yield kept_row(at, total)

    def kept_row(at, total):
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(total >= full).tobytes()])], ["chunk", "kept"])

    parts = docs.select("lang", "text").mapInArrow(count, "chunk long, slots binary, counts binary")
    kept = bytearray((1 << bits) // 8)
    for r in parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, kept binary").toLocalIterator():
        kept[r["chunk"] * CHUNK // 8:(r["chunk"] + 1) * CHUNK // 8] = r["kept"]
    return bytes(kept)


def windows(docs: DataFrame, least: int) -> DataFrame:
    """``lang, w1 .. w5, n``: padded longest windows with how often each slice of texts holds them."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(int(size // 32).bit_length(), MIN_BITS), MAX_BITS)
    pairs = spark.sparkContext.broadcast(frequent_slots(docs, bits, least, lambda w: [w.pairs()[1]]))

    def followed(w: Words, keeps: Kept):
        """Whether a frequent pair starts at each word, and the words where one does with the pairs' hashes."""
        at, h = w.pairs()
        ok = keeps(h)
        goes_on = np.zeros(len(w.code) + 1, dtype=bool)
        goes_on[at[ok]] = True
        return goes_on, at[ok], h[ok]

    memo: dict[str, Kept] = {}

    def long_phrases(w: Words):
        if not memo:
            memo["pairs"] = Kept(bits, pairs.value)     # unpacked once in a task
        goes_on, at, h = followed(w, memo["pairs"])
        for k in range(3, LONGEST + 1):
            on = goes_on[at + k - 2]
            at, h = at[on], h[on]
            h = w.longer(h, at, k)
            yield h

    longer = spark.sparkContext.broadcast(frequent_slots(docs, bits, least, long_phrases))

    def run(batches):
        of_pairs, of_longer = Kept(bits, pairs.value), Kept(bits, longer.value)
        for whole in batches:
            for b in text_slices(whole):
                w = Words(b)
                if not len(w.code):
                    continue
                goes_on, at, h = followed(w, of_pairs)
                pad = len(w.words)
                words = pa.concat_arrays([w.words, pa.array([""], pa.string())])
                # Windows of one word: counted here, there are few different ones.
                alone = np.flatnonzero(~goes_on[:-1])
                key, n = np.unique(w.lang[alone] * pad + w.code[alone], return_counts=True)
                yield _rows(w.langs.dictionary, words, key // pad, [key % pad] + [np.full(len(key), pad)] * (LONGEST - 1), n)
                first, alive = at, np.arange(len(at))
                cols = [w.code[at], w.code[at + 1]]
                for k in range(3, LONGEST + 1):
                    on = goes_on[at + k - 2]
                    at, alive = at[on], alive[on]
                    h = w.longer(h[on], at, k)
                    on = of_longer(h)
                    at, alive, h = at[on], alive[on], h[on]
                    col = np.full(len(first), pad)
                    col[alive] = w.code[at + k - 1]
                    cols.append(col)
                yield _rows(w.langs.dictionary, words, w.lang[first], cols, np.ones(len(first), np.int64))

    return docs.select("lang", "text").mapInArrow(run, f"lang string, {', '.join(w + ' string' for w in WORDS)}, n long")


def _rows(langs: pa.Array, words: pa.Array, lang: np.ndarray, cols: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs.take(pa.array(lang)), *[words.take(pa.array(c)) for c in cols],
                                       pa.array(n.astype(np.int64))], ["lang", *WORDS, "n"])


def prefix_counts(docs: DataFrame, least: int) -> DataFrame:
    """``lang, k, phrase, f``: counts of all phrases of 1 to 5 words with ``f >= least``; k = 0: words of the language."""
    longest = windows(docs, least).groupBy("lang", *WORDS).agg(F.sum("n").alias("n"))
    keep = "lang is not null and f >= least or k = 0 and lang is not null".replace("least", str(least))
    level = F.lit(LONGEST) - F.log2(F.grouping_id() + 1).cast("int")        # a level that keeps k words rolls up 5 - k
    last = F.coalesce(*[F.col(w) for w in reversed(WORDS)], F.lit("-"))      # pads are empty, rolled up words null
    sums = longest.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), level.alias("k"))
    sums = sums.filter(last != "").filter(keep)
    return sums.select("lang", "k", F.concat_ws(" ", *WORDS).alias("phrase"), "f")


def _floor_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in 38 digits."""
    big = [c.cast("decimal(20,0)") for c in (a, n, left, right)]
    return F.call_function("div", (big[0] * F.lit(1000).cast("decimal(5,0)") * big[1]).cast("decimal(38,0)"),
                           (big[2] * big[3]).cast("decimal(38,0)"))


def mine(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    # Written once; below, rows number at most a few hundredths of the words.
    f = materialize(prefix_counts(docs, least), "phrases")
    cand = f.filter("k >= 2")
    parts = F.split("phrase", " ")
    # Cutting after each word; both parts occur at least as often as the phrase, so the joins find them.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).alias("_part")
    cuts = cand.select("lang", "phrase", part, F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), parts.alias("p"))
    cuts = cuts.select("lang", "phrase", "_part", "a", "cut", F.array_join(F.slice("p", 1, F.col("cut")), " ").alias("head"),
                       F.array_join(F.slice("p", F.col("cut") + 1, LONGEST), " ").alias("tail"))
    of_head = f.filter("k >= 1").select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    of_tail = f.filter("k >= 1").select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # A language's total once for each part of its phrases, so that a frequent language is not one join key.
    total = f.filter("k = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("_part"))
    cuts = cuts.join(of_head, ["lang", "head"]).join(of_tail, ["lang", "tail"]).join(total, ["lang", "_part"])
    cuts = cuts.withColumn("score", _floor_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase", "_part", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    # A longer phrase around this one that is as frequent implies one that is longer by one word.
    around = cand.filter("k >= 3").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(parts, 1, F.col("k") - 1), " "), F.array_join(F.slice(parts, 2, F.col("k")), " "))).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    best = best.join(around, ["lang", "phrase"], "left").filter("outer is null or outer < a")
    best = best.select("lang", "phrase", "_part", "a", "n", "b.score", "b.l", "b.r")
    # The best of each part of a language first: its last window sees a bounded number of rows.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = best.filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
