"""Personal data: fixed patterns plus a skip-chain conditional random field.

The base patterns (email, ip, card, phone) always stand. The field labels every token that
holds a digit or ``@`` with a kind, ``secret`` or ``none``. Its potentials are weights of hashed
features (shape, checksums, the word and the ``=`` or ``:`` before the token), of
neighbouring labels and of equal labels across skip edges: distant tokens that repeat or resemble each
other (same text, or same last digits) share one. All weights are learned together by pseudo-likelihood on a
bounded sample (at most about ``MAX_TRAIN`` documents, chosen by a hash of their id): each token is hidden in
turn and predicted from its features and its neighbours' labels. Labels to learn from are the base
matches, values assigned to a name of ``SECRET``, and ``none`` for matches that failed a check and for
other tokens, unless they resemble a found value.

Damped loopy belief propagation runs over all documents of a slice at once; tokens whose marginal
for one kind reaches ``CERTAIN`` add spans. So a number written another way elsewhere, a number
that a pattern lost because its match ran on into the next one, and a secret are found too. Tokens of
base spans are clamped to their kind, tokens of matches with a wrong checksum or value to none; matches
that are only too long say nothing about the tokens inside. An added card, phone or address
must pass the check of its kind (a phone may lack its prefix: 7 digits).

Defined cases: null text is empty and has no span. Without any training token nothing is added.
Repeated rows are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import ast
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import map_slices, text_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS, "secret")
MAX_TRAIN = 50_000          # documents that the potentials are learned on, at most (in expectation)
HASHED = 1 << 11            # features
PENALTY, STEPS, RATE = 0.3, 400, 0.1        # L2 penalty, steps and rate of the fit
NEAR = 3                    # skip neighbours of one label that a hidden token sees, at most
CLAMP = 30.0                # potential of a known label
ROUNDS, DAMP = 12, 0.5
CERTAIN = 0.9
TAIL_DIGITS = 7             # numbers that agree in so many last digits resemble each other

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits cannot match where the start of the run does not.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?[\x20\t]?[:=][\x20\t]?[\"']?([A-Za-z0-9+/_-]{16,})")
VALUE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
HEX = re.compile(r"[0-9a-fA-F]+")
CUE = 48                    # characters before a token in which its cue is looked for
MARK = re.compile(r"[0-9@]")
EDGES = ".,;:!?\"'[]{}<>«»“”"
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns by kind and start, and the matches dropped by a check.

    Dropped matches that are too long have the kind ``long``: they may have run over several values.
    """
    good: list[Span] = []
    bad: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            good.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]        # digit runs of any length: int() refuses long ones
        ok = all(len(p) <= 3 and int(p) <= 255 for p in parts)
        (good if ok else bad).append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0])
        ok = 13 <= len(digits) <= 19 and luhn(digits)
        if ok or len(digits) >= 13:
            (good if ok else bad).append(("card" if len(digits) <= 19 else "long", m.start(), m.end()))
    for m in PHONE.finditer(text):
        n = sum(ch.isdigit() for ch in m[0])
        (good if 9 <= n <= 15 else bad).append(("phone" if n <= 15 else "long", m.start(), m.end()))
    return good, bad


def tokens(text: str) -> list[tuple[int, int]]:
    """Trimmed white-space tokens that hold a digit or ``@``."""
    out, last = [], 0
    for m in MARK.finditer(text):
        if m.start() < last:
            continue
        start = m.start()
        while start > last and not text[start - 1].isspace():
            start -= 1
        stop = m.end()
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        last = stop
        body = text[start:stop]
        a = len(body) - len(body.lstrip(EDGES))
        b = len(body.rstrip(EDGES))
        if b > a:
            out.append((start + a, start + b))
    return out


def features(text: str, a: int, b: int) -> tuple[int, ...]:
    """Hashed features of the token ``text[a:b]`` and of the words before it."""
    token = text[a:b]
    digits = re.sub(r"[^0-9]", "", token)
    core = max(re.findall(r"[A-Za-z0-9]+", token), key=len, default="")
    made = "digits" if core.isdigit() else "hex" if HEX.fullmatch(core) else "mixed" if re.search("[0-9]", core) else "word"
    marks = (f"{'@' * ('@' in token)}{'+' * token.startswith('+')}{'(' * ('(' in token)}"
             f"{min(token.count('.'), 3)}{min(token.count('-'), 3)}{'a' * any(ch.isalpha() for ch in token)}")
    before = text[max(0, a - CUE):a].rstrip(" \t\"'")
    given = before[-1:] in ("=", ":") and before[-1:]
    word = (before[:-1] if given else before).split()[-1:] or [""]
    names = [f"n{min(len(digits), 20)}", f"m{marks}", f"k{made}{min(len(core), 64) // 8}", f"s{made}{len(digits)}{marks}" if len(digits) <= 20 else "s+",
             f"l{13 <= len(digits) <= 19 and luhn(digits)}{made}", f"i{valid('ip', token)}", f"e{token.count('@') == 1 and '.' in token.split('@')[1]}",
             f"g{given}{made}{len(core) >= 16}", f"w{given}{zlib.crc32(word[0].strip(EDGES).lower().encode()) % 64}"]
    return tuple(zlib.crc32(x.encode()) % HASHED for x in names)


def valid(kind: str, value: str) -> bool:
    """The check that a value of a kind has to pass."""
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        parts = value.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return TAIL_DIGITS <= len(digits) <= 15
    return bool(VALUE.search(value)) if kind == "secret" else "@" in value


def key_of(token: str) -> str:
    """Tokens with one key repeat or resemble each other; empty for tokens too short to tell."""
    digits = re.sub(r"[^0-9]", "", token)
    if len(digits) >= TAIL_DIGITS and "@" not in token:
        return "9" + digits[-TAIL_DIGITS:]
    return "a" + token.lower() if len(token) >= 5 else ""


class Graph:
    """Candidate tokens of several texts with their labels: ``known`` (clamped, else -1) and ``taught`` (to learn from, else -1)."""

    def __init__(self, texts: list[str]):
        self.text, self.start, self.end, self.known, self.taught, self.features = [], [], [], [], [], []
        chain, skip = [], []
        self.base: list[list[Span]] = []
        for t, text in enumerate(texts):
            good, bad = base_spans(text)
            self.base.append(good)
            # A token takes the largest label of the spans it overlaps: kinds, then failures, then matches that are too long.
            spans = sorted([(a, b, 1 + KINDS.index(k)) for k, a, b in good] + [(a, b, -2 if k == "long" else 0) for k, a, b in bad])
            secret = [m.span(1) for m in SECRET.finditer(text)]
            at: dict[str, int] = {}
            before, lo, sec = None, 0, 0
            for a, b in tokens(text):
                node = len(self.text)
                while lo < len(spans) and all(s[1] <= a for s in spans[lo:lo + 4]):
                    lo += 1
                while sec < len(secret) and secret[sec][1] <= a:
                    sec += 1
                over = [s[2] for s in spans[lo:lo + 16] if s[0] < b and s[1] > a
                        and (s[2] != 0 or 2 * (min(s[1], b) - max(s[0], a)) >= b - a)]
                label = max(over, default=0)
                self.known.append(max(label, -1) if over else -1)
                named = sec < len(secret) and secret[sec][0] < b
                self.taught.append(LABELS.index("secret") if not label and named else max(label, -1))
                self.text.append(t), self.start.append(a), self.end.append(b)
                self.features.append(features(text, a, b))
                if before is not None and a - before == 1:
                    chain.append((node - 1, node))
                before = b
                key = key_of(text[a:b])
                if key:
                    # Each occurrence links to the one before it, so edges stay linear in tokens.
                    if key in at:
                        skip.append((at[key], node))
                    at[key] = node
        self.chain = np.array(chain, dtype=np.int64).reshape(-1, 2)
        self.skip = np.array(skip, dtype=np.int64).reshape(-1, 2)
        kinds = np.array(self.taught, dtype=np.int64) > 0
        for i, j in np.concatenate([self.skip, self.skip[:, ::-1]]).tolist():
            if kinds[j] and not kinds[i] and self.known[i] < 0:
                self.taught[i] = -1         # resembles a found value, but no pattern speaks for or against it

    def examples(self) -> Counter:
        """Each taught token hidden in turn: (label, features, labels of its left and right neighbour, skip neighbours by label)."""
        n, k = len(self.text), len(LABELS)
        left, right, near = np.full(n, -1), np.full(n, -1), np.zeros((n, k), dtype=np.int64)
        label = np.array(self.taught, dtype=np.int64)
        left[self.chain[:, 1]] = label[self.chain[:, 0]]
        right[self.chain[:, 0]] = label[self.chain[:, 1]]
        for i, j in np.concatenate([self.skip, self.skip[:, ::-1]]).tolist():
            if label[j] >= 0:
                near[i, label[j]] += 1
        near = np.minimum(near, NEAR)
        return Counter((int(label[i]), self.features[i], int(left[i]), int(right[i]), tuple(near[i].tolist()))
                       for i in np.flatnonzero(label >= 0).tolist())


class Model:
    """``weights`` (feature, label), ``pair`` (label, next label) and ``skip`` (equal labels): log-potentials."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray, skip: float, empty: bool = False):
        self.weights, self.pair, self.skip, self.empty = weights, pair, skip, empty

    def node(self, features: tuple[int, ...]) -> np.ndarray:
        return self.weights[list(features)].sum(axis=0)

    def marginals(self, g: Graph) -> np.ndarray:
        """Label marginals of every token by damped loopy belief propagation."""
        cache: dict[tuple[int, ...], np.ndarray] = {}
        k = len(LABELS)
        for f in set(g.features):
            cache[f] = self.node(f)
        phi = np.array([cache[f] for f in g.features]).reshape(-1, k)
        known = np.array(g.known)
        at = np.flatnonzero(known >= 0)
        phi[at, known[at]] += CLAMP
        edges = np.concatenate([g.chain, g.skip])
        if len(edges):
            potential = np.concatenate([np.broadcast_to(self.pair, (len(g.chain), k, k)),
                                        np.broadcast_to(self.skip * np.eye(k), (len(g.skip), k, k))])
            src = np.concatenate([edges[:, 0], edges[:, 1]])
            dst = np.concatenate([edges[:, 1], edges[:, 0]])
            both = np.concatenate([potential, potential.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            message = np.zeros((len(src), k))
            for _ in range(ROUNDS):
                belief = phi.copy()
                np.add.at(belief, dst, message)
                out = (belief[src] - message[back])[:, :, None] + both
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                message = DAMP * message + (1 - DAMP) * new
            np.add.at(phi, dst, message)
        p = np.exp(phi - phi.max(axis=1, keepdims=True)) if len(phi) else phi
        return p / p.sum(axis=1, keepdims=True) if len(phi) else p


def learn(examples: dict[tuple, int]) -> Model:
    """Pseudo-likelihood: softmax regression of each hidden label on its features and its neighbours' labels (Adam)."""
    k = len(LABELS)
    weights, pair, skip = np.zeros((HASHED, k)), np.zeros((k, k)), np.zeros(1)
    rows = sorted(examples)
    if not rows:
        return Model(weights, pair, 0.0, empty=True)
    n = np.array([examples[r] for r in rows], dtype=np.float64)
    y = np.array([r[0] for r in rows])
    f = np.array([r[1] for r in rows])
    side = np.eye(k + 1)[:, :k]                 # label -1 (no neighbour, or an untaught one) is a row of zeros
    left, right = side[[r[2] for r in rows]], side[[r[3] for r in rows]]
    near = np.array([r[4] for r in rows], dtype=np.float64)
    params = [weights, pair, skip]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, STEPS + 1):
        z = weights[f].sum(axis=1) + left @ pair + right @ pair.T + skip[0] * near
        z -= z.max(axis=1, keepdims=True)
        d = np.exp(z)
        d /= d.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1.0
        d *= n[:, None]
        of_weights = PENALTY * weights
        for c in range(f.shape[1]):
            np.add.at(of_weights, f[:, c], d)
        grads = [of_weights, left.T @ d + d.T @ right + PENALTY * pair, np.array([(d * near).sum()]) + PENALTY * skip]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Model(weights, pair, float(skip[0]))


def refined(kind: str, text: str, a: int, b: int) -> Span | None:
    """The span of an added value, or None where it fails the check of its kind."""
    if not valid(kind, text[a:b]):
        return None
    if kind == "secret":
        m = max(VALUE.finditer(text, a, b), key=lambda m: m.end() - m.start())
        a, b = m.span()
    return kind, a, b


def find(texts: list[str], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Per text: base spans and all spans, each sorted by kind and start."""
    order = lambda s: (LABELS.index(s[0]), s[1], s[2])
    g = Graph(texts)
    added: list[list[Span]] = [[] for _ in texts]
    if g.text and not model.empty:
        p = model.marginals(g)
        label = np.where((p.max(axis=1) >= CERTAIN) & (np.array(g.known) < 0), p.argmax(axis=1), 0)
        linked = set(g.chain[:, 0].tolist())
        i = 0
        while i < len(label):
            j = i
            if label[i]:
                kind, text = LABELS[label[i]], texts[g.text[i]]
                # A value ends where it passes its check; a phone where it would no longer pass with the next token.
                while j in linked and label[j + 1] == label[i] and (
                        not valid(kind, text[g.start[i]:g.end[j]]) or kind == "phone" and valid(kind, text[g.start[i]:g.end[j + 1]])):
                    j += 1
                span = refined(kind, text, g.start[i], g.end[j])
                if span:
                    added[g.text[i]].append(span)
            i = j + 1
    return [(sorted(b, key=order), sorted(b + a, key=order)) for b, a in zip(g.base, added)]


def _candidates(b: pa.RecordBatch) -> list[int]:
    """Rows of a batch whose text holds a digit or ``@``."""
    hit = pc.fill_null(pc.match_substring_regex(b.column("text"), "[0-9@]"), False)
    return np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()


def fit(docs: DataFrame, max_docs: int = MAX_TRAIN) -> Model:
    """Learn the potentials on a sample of at most about ``max_docs`` documents."""
    rows = docs.select("doc_id", "text")
    n = docs.select("doc_id").count()
    if n > max_docs:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(max_docs / n * (1 << 20)))
    rows = rows.filter(F.col("text").rlike("[0-9@]")).select("text")

    def run(batches):
        c: Counter = Counter()
        for whole in batches:
            for b in text_slices(whole):
                c.update(Graph(b.column("text").to_pylist()).examples())
        yield pa.RecordBatch.from_arrays([pa.array([repr(x) for x in c], pa.string()), pa.array(list(c.values()), pa.int64())], ["key", "n"])

    # Distinct examples of a bounded sample.
    found = rows.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return learn({ast.literal_eval(r["key"]): r["n"] for r in found})


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: ``doc_id``, base counts per kind, digest of the base spans, all spans as text."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    none = hashlib.sha256(b"").hexdigest()

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = _candidates(b)
        text = b.column("text")
        n = {k: np.zeros(b.num_rows, dtype=np.int64) for k in KINDS}
        digest, spans = [none] * b.num_rows, [""] * b.num_rows
        for i, (base, whole) in zip(rows, find([text[i].as_py() for i in rows], shared.value)):
            for k, _, _ in base:
                n[k][i] += 1
            digest[i], spans[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(whole)
        return pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(n[k]) for k in KINDS], pa.array(digest), pa.array(spans)],
                                          ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return map_slices(docs.select("doc_id", "text"), step,
                      "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with the found spans redacted in ``text`` (and ``n_chars`` counted anew), all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = _candidates(b)
        text = b.column("text").to_pylist()
        for i, (_, spans) in zip(rows, find([text[i] for i in rows], shared.value)):
            text[i] = redacted(text[i], spans)
        return b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(text, b.schema.field("text").type))

    out = map_slices(docs, step, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
