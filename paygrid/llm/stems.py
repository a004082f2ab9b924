"""Counts of words and word stems per text, and the trie they form, in memory linear in the letters.

A node is a stem (the first letters of a word, ``MIN_STEM`` at least) or a whole word, named by a
64-bit hash of its letters. It carries the hash of the stem one letter shorter and its last
letter (the shortest ones all their letters), so no stem is ever held as a string of its own.
Per node: ``n0`` texts that hold it, whole words counted for the stems that equal them, and
``n1 ... n3`` texts in which it occurs so many times or more as what it is: a stem of longer
words, or a word.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import ranges, text_slices
from .ngram_join import _mix, _powers

MIN_STEM = 4                # letters of a stem, at least
LEVELS = 3                  # occurrences that are told apart
SLICE = 1 << 20             # bytes of text counted at once; a longer text is a step of its own
EDGES = ".,;:!?\"'()[]{}«»“”„‘’…-_*#|<>/\\&%$~`"
_LETTER, _LENGTH, _WHOLE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xA0761D6478BD642F))
_COUNTS = [f"n{m}" for m in range(LEVELS + 1)]


@dataclass
class Node:
    n: tuple[int, ...]
    parent: int             # hash of the stem without the last letter; 0 for the shortest
    tail: str               # last letter, or all letters of the shortest; ends in a space for whole words


def _nodes(texts: list[str | None], wanted: np.ndarray | None) -> pa.RecordBatch:
    """Nodes of some texts (those in ``wanted`` only, if given) with their counts."""
    words: dict[str, int] = {}
    of_text, of_word, times = [], [], []
    for t, text in enumerate(texts):
        for w, k in Counter(x.strip(EDGES) for x in (text or "").lower().split()).items():
            if w.isalpha():
                of_text.append(t), of_word.append(words.setdefault(w, len(words))), times.append(k)
    letters = "".join(words)
    code = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.array([len(w) for w in words], dtype=np.int64)
    end = np.cumsum(size)
    start = end - size
    at = np.arange(len(code)) - np.repeat(start, size)
    total = np.cumsum(_mix((code + np.uint64(1)) * _LETTER) * _powers(int(size.max(initial=0)) + 1)[0][at])
    before = np.where(start > 0, total[start - 1], np.uint64(0)) if len(total) else total
    stem = _mix(total - np.repeat(before, size) + (at + 1).astype(np.uint64) * _LENGTH)
    whole = _mix(stem[end - 1] ^ _WHOLE)

    of_text, of_word, times = (np.array(x, dtype=np.int64) for x in (of_text, of_word, times))
    n_stems = np.maximum(size[of_word] - MIN_STEM + 1, 0)
    i = ranges(start[of_word] + MIN_STEM - 1, n_stems)              # place of the last letter of every stem
    h = np.concatenate([stem[i], whole[of_word]])
    text = np.concatenate([np.repeat(of_text, n_stems), of_text])
    k = np.concatenate([np.where(i == np.repeat(end[of_word], n_stems) - 1, 0, np.repeat(times, n_stems)), times])
    place = np.concatenate([i, -1 - of_word])                       # whole words: -1 - number of the word
    if wanted is not None:
        keep = np.isin(h, wanted)
        h, text, k, place = h[keep], text[keep], k[keep], place[keep]
    order = np.lexsort((text, h))
    h, text, k, place = h[order], text[order], k[order], place[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    cuts = np.flatnonzero(new)
    k = np.add.reduceat(k, cuts) if len(cuts) else k
    h, place = h[cuts], place[cuts]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else cuts
    counts = [np.add.reduceat((k >= m).astype(np.int64), first) if len(first) else first for m in range(LEVELS + 1)]
    h, place = h[first], place[first]
    names = list(words)
    parent, tail = np.zeros(len(h), dtype=np.uint64), []
    for x, p in enumerate(place.tolist()):
        if p < 0:
            w = names[-1 - p]
            long = len(w) >= MIN_STEM
            parent[x] = stem[end[-1 - p] - 1] if long else 0
            tail.append(" " if long else w + " ")
        elif at[p] == MIN_STEM - 1:
            tail.append(letters[p - MIN_STEM + 1:p + 1])
        else:
            parent[x] = stem[p - 1]
            tail.append(letters[p])
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *[pa.array(c) for c in counts], pa.array(parent.view(np.int64)),
                                       pa.array(tail, pa.string())], ["h", *_COUNTS, "parent", "tail"])


def count(rows: DataFrame, least: int, wanted: np.ndarray | None = None) -> dict[int, Node]:
    """Nodes that at least ``least`` texts of ``rows (text)`` hold; ``wanted``: hashes (unsigned) of the only ones to count."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, limit=SLICE):
                yield _nodes(b.column("text").to_pylist(), shared.value)

    found = rows.select("text").mapInArrow(run, "h long, " + "".join(f"{c} long, " for c in _COUNTS) + "parent long, tail string")
    found = found.groupBy("h").agg(*[F.sum(c).alias(c) for c in _COUNTS], F.min("parent").alias("parent"), F.min("tail").alias("tail"))
    # A bounded sample's nodes in at least ``least`` texts: at most its letters divided by ``least``.
    return {r["h"]: Node(tuple(r[c] for c in _COUNTS), r["parent"], r["tail"]) for r in found.filter(F.col("n0") >= least).collect()}


def text_of(nodes: dict[int, Node], h: int) -> str:
    parts = []
    while h:
        parts.append(nodes[h].tail)
        h = nodes[h].parent
    return "".join(reversed(parts))
