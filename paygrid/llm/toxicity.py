"""Toxicity: Levenshtein automata over a learned lexicon trie, scored in context windows.

The lexicon is learned from labelled training rows: words, and stems of words, whose document
frequency among toxic rows is far above that among clean rows. The terms form a trie; the
product of the trie with Levenshtein automata (one edit from 5 letters, two from 8) runs as
a lazily built deterministic automaton over the distinct words of a text, so misspelled
terms match too. Each (term, edits, times) triple has a weight, its log-odds between the
classes; ``times`` counts occurrences up to ``LEVELS``, since a stem that clean texts hold once by
chance may only be telling when it recurs. A
hit's weight is scaled by its window: quotation marks or words of reported speech lower
it, direct address raises it. The score is the logistic function of the class prior plus
the best hit of every family of terms (terms with the same first letters, which tend to
occur together).

Fitting reads a bounded sample: at most about ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean
labelled rows, chosen by a hash of the id. Of copies and near copies in the sample (equal in
one of a few bands of minimum hashes) one is kept, so a text that occurs often does not make its
words look telling. Scoring reads every word of every text.

Defined cases: null and empty texts have no hit and get the score of a text without hits.
Without training rows of both classes nothing is known: every score is the prior (0.5
without any row). A label of a repeated id counts once, as its maximum, for the text with the smallest
hash; null labels are left out. Words may be of any length: memory is linear in the letters of a text. Repeated rows are kept, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize

from . import stems
from .arrow import map_slices, text_slices
from .common import crc_mod
from .language_id import split_words
from .ngram_join import _mix, shingle_sets
from .stems import EDGES, LEVELS

MAX_TOXIC = 6_000
MAX_CLEAN = 14_000
MIN_ROWS = 4                # toxic training rows that a term occurs in, at least
MIN_ODDS = 3.0              # cautious log-odds of a lexicon term between the classes, at least
COPY_BANDS, BAND_HASHES = 4, 4      # bands of minimum hashes of a text; agreeing in one makes two texts copies of each other
MIN_WEIGHT = 1.5            # weaker evidence does not count
GAIN = 1.0                  # log-odds that a longer stem must add to replace a shorter one
FAMILY = 5                  # terms that share so many first letters count once per text
MISSPELLED = 0.05           # prior share of a term's toxic rows that misspell it
WINDOW = 5                  # words of context on either side
QUOTED, REPORTED, ADDRESSED = 0.5, 0.75, 1.25       # factors of a hit's weight
WORST = 12.0                # cap of the summed weights
THRESHOLD = 0.7

QUOTES = set("\"«»“”„")
# Words of reported speech and of direct address in the four languages of the corpus.
REPORT_WORDS = set("said says called calls quoted quote wrote word words sagte sagt nannte nennt wort zitat dit disait "
                   "appelle mot dijo dice llamó palabra cita".split())
ADDRESS_WORDS = set("you your you're yourself du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted "
                    "ustedes vosotros".split())


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class TermAutomaton:
    """Trie of terms intersected with their Levenshtein automata, determinised as words ask for it."""

    MAX_STATES = 200_000        # memoised states; beyond it the memo starts anew, results stay the same

    def __init__(self, terms: list[tuple[str, bool]]):
        """``terms``: (text, is_stem); a stem also matches words that go on after it."""
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.limit = [0]
        for t, (text, _) in enumerate(terms):
            node, k = 0, edits_allowed(text)
            self.limit[0] = max(self.limit[0], k)
            for ch in text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({}), self.ends.append([]), self.limit.append(0)
                node = self.children[node][ch]
                self.limit[node] = max(self.limit[node], k)
            self.ends[node].append(t)
        self.alphabet = {ch for c in self.children for ch in c}
        self._reset()

    def __getstate__(self):
        return self.terms

    def __setstate__(self, terms):
        self.__init__(terms)

    def _reset(self):
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.stems: list[dict[int, int]] = []       # stems reached in a state: term -> edits
        self.full: list[dict[int, int]] = []        # terms that end in a state
        self.dead = self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """Adds the states reached by skipping letters of a term; keeps the fewest edits per node."""
        best: dict[int, int] = {}
        todo = list(states)
        while todo:
            node, e = todo.pop()
            if e > self.limit[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo.extend((c, e + 1) for c in self.children[node].values())
        return frozenset(best.items())

    def _state(self, states: frozenset) -> int:
        if states not in self.ids:
            self.ids[states] = len(self.sets)
            self.sets.append(states)
            self.step.append({})
            hits = {t: e for node, e in states for t in self.ends[node] if e <= edits_allowed(self.terms[t][0])}
            self.full.append(hits)
            self.stems.append({t: e for t, e in hits.items() if self.terms[t][1]})
        return self.ids[states]

    def _next(self, s: int, ch: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.sets[s]:
            for c, child in self.children[node].items():
                out.add((child, e if c == ch else e + 1))
            out.add((node, e + 1))
        n = self._state(self._closed(out))
        self.step[s][ch] = n
        return n

    def match(self, word: str) -> dict[int, int]:
        """Terms that the word matches, with the fewest edits of each."""
        s, found, alphabet, dead = self.start, None, self.alphabet, self.dead
        for ch in word:
            if ch not in alphabet:
                ch = ""
            n = self.step[s].get(ch)
            s = self._next(s, ch) if n is None else n
            if s == dead:
                return found or {}
            if self.stems[s]:
                found = found or {}
                for t, e in self.stems[s].items():
                    found[t] = min(e, found.get(t, 99))
        if self.full[s]:
            found = found or {}
            for t, e in self.full[s].items():
                found[t] = min(e, found.get(t, 99))
        if len(self.sets) > self.MAX_STATES:
            self._reset()
        return found or {}


def hits_of(column: pa.Array, automaton: TermAutomaton) -> list[list[tuple[int, int, float]]]:
    """Per text: (term, edits, context factor) of every hit."""
    n, codes, words = split_words(column)
    bare = [w.strip(EDGES) for w in words]
    table = {i: m for i, w in enumerate(bare) if w and (m := automaton.match(w))}
    out: list[list[tuple[int, int, float]]] = [[] for _ in n]
    if not table:
        return out
    hot = np.zeros(len(words), dtype=bool)
    hot[list(table)] = True
    at = np.flatnonzero(hot[codes])
    ends = np.cumsum(n)
    rows = np.searchsorted(ends, at, side="right")
    for p, r in zip(at, rows):
        first, last = ends[r] - n[r], ends[r]
        left = [words[c] for c in codes[max(first, p - WINDOW):p]]
        right = [words[c] for c in codes[p + 1:min(last, p + 1 + WINDOW)]]
        own = words[codes[p]]
        marks = sum(ch in QUOTES for w in left for ch in w)
        opened = marks % 2 == 1 or own[0] in QUOTES
        closed = any(ch in QUOTES for w in [own[1:], *right] for ch in w)
        around = {w.strip(EDGES) for w in left + right}
        factor = ((QUOTED if opened and closed else 1.0) * (REPORTED if around & REPORT_WORDS else 1.0)
                  * (ADDRESSED if around & ADDRESS_WORDS else 1.0))
        out[r].extend((t, e, factor) for t, e in table[codes[p]].items())
    return out


def levels(hits: list[tuple[int, int, float]]) -> dict[tuple[int, int, int], float]:
    """(term, edits, times) of a text's hits, each with its largest context factor."""
    times: Counter = Counter()
    factor: dict[tuple[int, int], float] = {}
    for t, e, f in hits:
        times[t, e] += 1
        factor[t, e] = max(f, factor.get((t, e), 0.0))
    return {(t, e, min(k, LEVELS)): factor[t, e] for (t, e), k in times.items()}


class Model:
    def __init__(self, automaton: TermAutomaton, weights: dict[tuple[int, int, int], float], prior: float, without: float):
        """``weights`` by (term, edits, times); ``prior``: log-odds of the classes; ``without``: of a text without hits."""
        self.automaton, self.weights, self.prior, self.without = automaton, weights, prior, without

    def scores(self, column: pa.Array) -> tuple[np.ndarray, list[str]]:
        out, found = [], []
        for hits in hits_of(column, self.automaton):
            best: dict[str, tuple[float, str]] = {}
            for key, factor in levels(hits).items():
                w, text = self.weights.get(key, 0.0) * factor, self.automaton.terms[key[0]][0]
                if w >= MIN_WEIGHT and w > best.get(text[:FAMILY], (0.0, ""))[0]:
                    best[text[:FAMILY]] = (w, text)
            z = self.prior + min(sum(w for w, _ in best.values()), WORST) if best else self.without
            out.append(1.0 / (1.0 + math.exp(-z)))
            found.append(" ".join(sorted(t for _, t in best.values())))
        return np.array(out, dtype=np.float64), found


def _counted(rows: DataFrame, of_batch, name: str) -> DataFrame:
    """Sum over all tasks of the counters that ``of_batch`` returns for a batch."""

    def run(batches):
        for whole in batches:
            total: Counter = Counter()
            for b in text_slices(whole):
                total.update(of_batch(b))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             [name, "n"])

    return rows.mapInArrow(run, f"{name} string, n long").groupBy(name).agg(F.sum("n").alias("n"))


def log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Cautious log-odds: one standard deviation fewer toxic rows, one clean row more."""
    return math.log(max(toxic - math.sqrt(toxic), 0.1) / n_toxic) - math.log((clean + 1.0) / n_clean)


def choose_terms(toxic: dict[int, stems.Node], clean: dict[int, stems.Node], least: int, n_toxic: int,
                 n_clean: int) -> list[tuple[str, bool]]:
    """Lexicon: (text, is_stem) of the shortest telling stems.

    A stem is lengthened as long as a longer one occurs in the same toxic rows, and gives way to
    its longer forms where those are clearly more telling.
    """
    none = stems.Node((0,) * (LEVELS + 1), 0, "")
    odds = {h: max(log_odds(node.n[m], clean.get(h, none).n[m], n_toxic, n_clean) for m in range(1, LEVELS + 1) if node.n[m] >= least)
            for h, node in toxic.items() if node.n[1] >= least}
    telling = {h for h, o in odds.items() if o >= MIN_ODDS}
    above: dict[int, int] = {0: 0}          # a node and the longest telling stem shorter than it
    longer: dict[int, list[int]] = {}       # a stem and the next longer telling ones
    for h in telling:
        path = [h]
        while path[-1] not in above:
            path.append(toxic[path[-1]].parent)
        for x, up in zip(path[-2::-1], path[:0:-1]):
            above[x] = up if up in telling else above[up]
        longer.setdefault(above[h], []).append(h)
    terms = set()
    todo = longer.get(0, [])[:]
    while todo:
        h = todo.pop()
        forms = longer.get(h, [])
        same = [g for g in forms if toxic[g].n[1] == toxic[h].n[1]]
        if same:
            todo.append(same[0] if len(same) == 1 else min(same, key=lambda g: stems.text_of(toxic, g)))
        elif forms and max(odds[g] for g in forms) >= odds[h] + GAIN:
            todo.extend(forms)
        else:
            text = stems.text_of(toxic, h)
            terms.add((text.rstrip(" "), not text.endswith(" ")))
    return sorted(terms)


def without_copies(rows: DataFrame) -> DataFrame:
    """``text, toxic`` of the rows that agree in no band of minimum hashes with a row of their class and a smaller id.

    Of rows with one id the text with the smallest hash counts.
    """
    names = [f"k{i}" for i in range(COPY_BANDS)]
    salts = [np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for i in range(COPY_BANDS * BAND_HASHES)]

    def hashes(batches):
        for whole in batches:
            for b in text_slices(whole):
                keys = np.zeros((b.num_rows, COPY_BANDS), dtype=np.uint64)
                for r, s in enumerate(shingle_sets(b.column("text").to_pylist(), 5)):
                    for i, salt in enumerate(salts):
                        least = _mix(s ^ salt).min() if len(s) else salt
                        keys[r, i // BAND_HASHES] = _mix(keys[r, i // BAND_HASHES:i // BAND_HASHES + 1] * salts[0] + least)[0]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"),
                                                  *[pa.array(keys[:, i].view(np.int64)) for i in range(COPY_BANDS)]], ["doc_id", "toxic", *names])

    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    slim = materialize(rows.mapInArrow(hashes, "doc_id long, toxic boolean, " + ", ".join(f"{k} long" for k in names)), "toxic-hashes")
    copies = None
    for k in names:
        first = slim.groupBy(k, "toxic").agg(F.min("doc_id").alias("first"))
        later = slim.join(first, [k, "toxic"]).filter("doc_id > first").select("doc_id")
        copies = later if copies is None else copies.unionByName(later)
    return rows.join(copies.distinct(), "doc_id", "left_anti").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn lexicon and weights from ``docs (doc_id, text)`` joined with ``labels (doc_id, toxic)``."""
    lab = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
                 .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in lab.groupBy("toxic").count().collect()}     # two rows
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        prior = 0.0 if not sizes else math.log((n_toxic + 0.5) / (n_clean + 0.5))
        return Model(TermAutomaton([]), {}, prior, prior)
    prior = math.log(n_toxic / n_clean)
    grain = 1 << 20
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(grain))
    sample = lab.filter(draw < F.when(F.col("toxic"), F.lit(int(min(1.0, MAX_TOXIC / n_toxic) * grain)))
                        .otherwise(F.lit(int(min(1.0, MAX_CLEAN / n_clean) * grain))))
    # About MAX_TOXIC + MAX_CLEAN rows of two short columns, whatever the size of the corpus.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    rows = materialize(without_copies(materialize(rows, "toxic-sample")), "toxic-sample")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    nt, nn = n.get(True, 0), n.get(False, 0)
    if not nt or not nn:
        return Model(TermAutomaton([]), {}, prior, prior)

    # A feature in fewer rows is not telling even if no clean row has it. Those that stay are bounded by the sample.
    least = next((k for k in range(MIN_ROWS, nt + 1) if log_odds(k, 0, nt, nn) >= MIN_ODDS), nt + 1)
    toxic = stems.count(rows.filter("toxic"), least)
    clean = stems.count(rows.filter("not toxic"), 1, np.array(sorted(toxic), dtype=np.int64).view(np.uint64))
    automaton = TermAutomaton(choose_terms(toxic, clean, least, nt, nn))

    def of_hits(b):
        c: Counter = Counter()
        for hits, bad in zip(hits_of(b.column("text"), automaton), b.column("toxic").to_pylist()):
            for t, e, k in levels(hits):
                c.update(f"{t} {e} {m} {int(bad)}" for m in range(1, k + 1))
            c[f"{'hit' if any(e == 0 for _, e, _ in hits) else 'none'} {int(bad)}"] += 1
        return c

    seen = {r["h"]: r["n"] for r in _counted(rows, of_hits, "h").collect()}      # a few rows per term
    weights = {}
    for t in range(len(automaton.terms)):
        exact = seen.get(f"{t} 0 1 1", 0)
        for e in range(edits_allowed(automaton.terms[t][0]) + 1):
            best = 0.0
            for m in range(1, LEVELS + 1):
                good, bad = seen.get(f"{t} {e} {m} 0", 0), seen.get(f"{t} {e} {m} 1", 0)
                best = weights[t, e, m] = max(best, log_odds(bad + (MISSPELLED * exact if e else 0.0), good, nt, nn))
    without = prior + math.log((seen.get("none 1", 0) + 0.5) / (nt + 1)) - math.log((seen.get("none 0", 0) + 0.5) / (nn + 1))
    return Model(automaton, weights, prior, min(without, prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, terms`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # the lexicon: a bounded number of terms

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        s, terms = shared.value.scores(b.column("text"))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)),
                                           pa.array(terms, pa.string())], ["doc_id", "score", "predicted", "terms"])

    return map_slices(docs.select("doc_id", "text"), step, "doc_id long, score double, predicted int, terms string")


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(crc_mod(F.col("doc_id"), 3) != 1)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on labels whose crc32 remainder by 3 is not 1, score all rows."""
    out = score(docs, fit(docs, training_labels(labels)))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted", "terms")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns."""
    model = fit(docs, training_labels(labels))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for b in text_slices(whole):
                s, _ = shared.value.scores(b.column("text"))
                yield b.filter(pa.array(s < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
