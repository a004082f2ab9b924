"""N-gram join, language, toxicity, suffix dedup, BPE and PII against brute force, with the edge cases of each."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
import tiktoken
from paygrid.llm import byte_bpe, components, difference_cover, language_id, ngram_join, pii, suffix_dedup, toxicity
from paygrid.llm.common import crc_mod

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " \n\t", "one", "ONE", "two words", "x" * 199, "y" * 200, "é ü 日本 Привет", "a\x1c\x1db　c", "z" * 3000, "1 2 3 " * 400]


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"rep": F.lit("clash"), "size": F.lit(1), "tid": F.lit(2), "lang": F.lit(None).cast("string"), "unit": F.lit(0)})


# --- n-gram join -----------------------------------------------------------------------------------

def shingles(t, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def brute_join(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    par, links = list(range(len(rows))), Counter()

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                par[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(rows)), key=str)


def test_rows_without_id_link_like_others(spark):
    """A near copy with null id, a null row that alone connects two documents, null rows among themselves."""
    words = [f"w{i}" for i in range(400)]

    def changed(*at):
        return " ".join("x" + w if i in at else w for i, w in enumerate(words))

    rows = [(5, changed()), (None, changed(100)), (None, changed(100, 200)), (9, changed(100, 200, 300)), (11, "quite another text here"),
            (None, " ".join(words[::-1])), (None, "y " + " ".join(words[::-1])), (None, ""), (None, None), (None, changed(100))]
    rows += [(None if i % 3 else d, t) for i, (d, t) in enumerate(near_copies(7, 60), 0)]
    rows = [(d if d is None or d in (5, 9, 11) else d + 1000, t) for d, t in rows]
    for percent in (90, 98):
        got = ngram_join.join(frame(spark, rows), 3, percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute_join(rows, 3, percent)


def near_copies(seed, n_docs=140):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(400)]
    bases = [[r.choice(word) for _ in range(r.randint(5, 120))] for _ in range(12)]
    rows = []
    for i in range(n_docs):
        t = list(r.choice(bases))
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(t))
            t[k:k + 1] = r.choice([[], ["new"], [t[k], "more"]])
        rows.append((i * 7 % 1009, " ".join(t)))
    return rows + [(5000 + i, t) for i, t in enumerate(ODD) if t is not None] + [(6000, rows[0][1].upper()), (6001, rows[0][1].replace(" ", "\n "))]


@pytest.mark.parametrize("n,percent,block", [(3, 90, 256), (5, 80, 256), (3, 80, 7)])
def test_join_equals_brute_force(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)        # small blocks: hot units are cut up
    rows = near_copies(percent + n)
    got = ngram_join.join(frame(spark, rows), n, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == brute_join(rows, n, percent)


def test_join_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "lonely words of nobody"), (9, "A B C D")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 0, 1, 0), (2, 0, 2, 0), (3, 2, 3, 3), (3, 2, 3, 3), (None, 2, 3, 3), (None, 2, None, 0), (9, 2, 3, 3)], key=str)
    assert ngram_join.join(frame(spark, rows).limit(0)).count() == 0


def test_keep_one(spark):
    rows = near_copies(5, 60)
    df = frame(spark, rows + [(rows[0][0], rows[0][1]), (None, "null id here"), (8000, None)])
    kept = ngram_join.keep_one(df)
    comp = {c for _, _, c, _ in brute_join(rows + [(8000, None)], 5, 80)}
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(comp)
    assert kept.filter("doc_id is null").count() == 1


def test_keep_one_goes_by_text(spark):
    """Null ids and shared ids do not shield near copies, nor do they merge different texts."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (None, a), (None, a + " more"), (2, b), (2, c), (None, c + " more"), (None, "x y z"), (None, "x y z"), (None, "X  Y z"),
            (7, None), (8, ""), (None, None)]
    for order in (rows, rows[::-1]):
        got = Counter((r.doc_id, r.text if r.doc_id else None) for r in ngram_join.keep_one(frame(spark, order)).collect())
        assert got == Counter([(1, a), (2, b), (2, c), (None, None), (7, None), (8, ""), (None, None)])


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, r.randint(101, 160)) for _ in range(40)] + [(7, 7)]
    got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[b] == 100 for a, b in edges if a == 100) and got[100] == 100


# --- language ---------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right >= 0.98 * n


def test_language_edges(spark):
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    greek = spark.createDataFrame([("αβγ δεζ ηθι " * 20, "el")] * 3, "text string, lang string")
    more = greek.unionByName(spark.createDataFrame([(None, "en"), ("text", None)], "text string, lang string"))
    model = language_id.train(train.select("doc_id", "text", "lang").unionByName(more, allowMissingColumns=True))
    en, de = [train.filter(F.col("lang") == x).orderBy("doc_id").first().text.split()[:60] for x in ("en", "de")]
    rows = list(enumerate(ODD)) + [(100, " ".join(en + de)), (101, "ζηθ " * 5), (102, "漢字"), (None, " ".join(de)), (103, "12 34 !!")]
    got = {r.doc_id: r for r in language_id.predict(frame(spark, rows), model).collect()}
    assert {got[i].lang_pred for i in (0, 1, 2, 103)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    assert got[101].lang_pred == "el" and got[None].lang_pred == "de" and got[102].lang_pred in model.langs
    runs = [s.split(":") for s in got[100].spans.split()]
    long = [x for x in runs if int(x[2]) - int(x[1]) >= 20]
    assert [x[0] for x in long] == ["en", "de"] and abs(int(long[0][2]) - len(en)) <= 8
    assert language_id.predict(frame(spark, rows).limit(0), model).count() == 0
    empty = language_id.identify(frame(spark, rows)).collect()       # nothing to train on
    assert {r.lang_pred for r in empty} == {"und"}


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(4)
    m = language_id.Model(["a", "b", "c"], np.ones((3, 1 << language_id.TABLE_BITS)), np.ones((3, len(language_id.NAMES))))
    scores = -rng.random((30, 3)).astype(np.float32) * 12
    n = np.array([0, 1, 4, 5, 6, 0, 5])
    codes = rng.integers(0, 30, n.sum())
    best = m.paths(n, codes, scores)
    at = 0
    for k in n:
        def value(path, at=at):
            return sum(scores[codes[at + i], x] for i, x in enumerate(path)) - language_id.SWITCH * sum(
                x != y for x, y in zip(path, path[1:]))
        if k:
            import itertools
            assert value(best[at:at + k]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(k)))), abs=1e-4)
        at += k


# --- toxicity ---------------------------------------------------------------------------------------

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [("idiot", False), ("worthless", False), ("vequ", True), ("lostra", True), ("ab", False)]
    a = toxicity.TermAutomaton(terms)
    r = random.Random(1)
    words = ["idiot", "idiots", "iddiot", "id1ot", "vequxyz", "veq", "lostrx", "worthles", "wrthlss", "ab", "abc", "", "lostraß"]
    words += ["".join(r.choices("idotwrhlesvqua", k=r.randint(1, 10))) for _ in range(400)]
    for w in words:
        want = {}
        for t, (text, stem) in enumerate(terms):
            d = min(edit_distance(w[:k], text) for k in range(len(w) + 1)) if stem else edit_distance(w, text)
            if d <= toxicity.edits_allowed(text):
                want[t] = d
        assert a.match(w) == want, w


def toxic_corpus(n=600):
    r = random.Random(3)
    word = ["".join(r.choices("aeiourstn", k=r.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(word) for _ in range(r.randint(20, 60))]
        bad = i % 6 == 0
        if bad:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(["scumbag", "worthless", "moronic"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out_and_misspelled(spark):
    rows, labels = toxic_corpus(3000)
    clean = rows[1][1]
    extra = [(10000, f"{clean} scumbagg {clean}"), (10001, f"{clean} you worthles moronic {clean}"),
             (10002, f'{clean} he said "scumbag" {clean}'), (10003, clean)] + [(20000 + i, t) for i, t in enumerate(ODD)]
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (1, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(frame(spark, rows + extra), lab).collect()}
    held = [(bad, got[i].predicted) for i, bad in labels if got[i].held_out]
    assert len(held) > 100 and all(bad == p for bad, p in held)
    assert got[10000].predicted == 1 and got[10001].predicted == 1 and got[10003].predicted == 0
    assert got[10002].score < got[10001].score
    assert all(got[20000 + i].predicted == 0 for i in range(len(ODD))) and all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_learns_rare_terms(spark):
    """A term in 1 % of the toxic rows and in no clean one is in the lexicon, and marks a text without other terms."""
    rows, labels = toxic_corpus(9000)
    rows += [(9000 + k, " ".join(rows[6 * k + 1][1].split()[::-1]) + " dunderhead") for k in range(15)]
    labels += [(9000 + k, 1) for k in range(15)]
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any("dunderhead".startswith(t) for t, _ in model.automaton.terms)
    got = toxicity.score(frame(spark, [(1, rows[10][1] + " dunderhead"), (2, rows[10][1])]), model).collect()
    assert {r.doc_id: r.predicted for r in got} == {1: 1, 2: 0}


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.judge(frame(spark, list(enumerate(ODD))), none).collect()
    assert {r.score for r in got} == {0.5} and {r.predicted for r in got} == {0}
    rows, labels = toxic_corpus(200)
    df = frame(spark, rows)
    kept = toxicity.keep_clean(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, bad in labels if not bad}
    assert toxicity.judge(df.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_crc_folds(spark):
    import binascii

    got = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", crc_mod(F.col("doc_id"), 4).alias("m")).collect()
    assert all(r.m == binascii.crc32(str(r.doc_id).encode()) % 4 for r in got)


# --- suffix dedup ------------------------------------------------------------------------------------

def brute_dedup(rows):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + 200] for t in raw for i in range(len(t) - 199))
    out = []
    for (d, _), t in zip(rows, raw):
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~gone]) if t else b""
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("kind", ["mixed", "periodic", "variants", "hot", "empty"])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, kind):
    r = random.Random(6)
    p = "".join(r.choices("abcdefgh é", k=700))
    noise = lambda lo, hi: "".join(r.choices("abcdefghij ", k=r.randint(lo, hi)))
    if kind == "mixed":
        rows = list(enumerate(ODD)) + [(20, p), (21, p), (None, p[50:500]), (22, p[:199]), (23, p[300:620] * 2)]
        rows += [(30 + i, noise(50, 400) + p[r.randint(0, 300):r.randint(400, 700)] + noise(0, 300)) for i in range(25)]
    elif kind == "periodic":
        rows = [(i, "".join(r.choices("ab", k=5)) * 60) for i in range(8)] + [(9, "a" * 3000), (10, "ab " * 300)]
    elif kind == "variants":
        monkeypatch.setattr(suffix_dedup, "SUFFIXES", 500)      # buckets larger than a block
        rows = [(i, p[:k] + "#" + p[k + 1:]) for i, k in enumerate(range(5, 695, 23))]
    elif kind == "hot":
        monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 3)    # buckets larger than a task
        rows = [(i, noise(80, 150) + p[:190 + i % 15] + noise(80, 150)) for i in range(25)] + [(100, p), (101, p[:300])]
    else:
        rows = []
    got = suffix_dedup.remove(frame(spark, rows).repartition(3)).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == brute_dedup(rows)
    assert all(hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 for x in got)


def test_difference_cover_property():
    v, cover = difference_cover.V, difference_cover.COVER
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    for i in range(v):
        for j in range(v):
            assert set(difference_cover.AHEAD[i]) & set(difference_cover.AHEAD[j])


def test_block_finds_repeats():
    r = random.Random(8)
    base = bytes(r.choices(b"ab", k=1500))
    text = base + b"x" * 300 + base[200:900] + bytes(r.choices(b"abc", k=300)) + b"ab" * 200
    at = np.arange(len(text) - 200)
    found = difference_cover.Block(text).repeats(at, at * 0, at * 0 + 1)
    seen = Counter(text[i:i + 200] for i in at)
    assert found.tolist() == [seen[text[i:i + 200]] > 1 for i in at]


# --- byte-level BPE -----------------------------------------------------------------------------------

def test_bpe_equals_the_library(spark):
    codec = byte_bpe.Codec.load(VOCAB, public_tokenizers.PATTERN)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = ODD + ["I'll don't we've  ", "aaaaaaaaaaaaaaaaaaaaaaaaa" * 9, "🙂🙂  \t\n\n x", "\x85x", "x" * 5000 + "ab", "<|endoftext|>"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    got = {r.doc_id: r for r in byte_bpe.digests(frame(spark, list(enumerate(texts))), VOCAB, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = ref.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_round_trip_and_edges(spark):
    df = frame(spark, list(enumerate(ODD)) + [(None, "null id"), (3, "one")])
    enc = byte_bpe.encode(df, VOCAB, public_tokenizers.PATTERN)
    back = Counter((r.doc_id, bytes(r.bytes)) for r in byte_bpe.decode(enc, VOCAB, public_tokenizers.PATTERN).collect())
    assert back == Counter((r.doc_id, (r.text or "").encode()) for r in df.collect())
    assert byte_bpe.encode(df.limit(0), VOCAB, public_tokenizers.PATTERN).count() == 0


def test_heap_and_matrix_agree():
    codec = byte_bpe.Codec.load(VOCAB, public_tokenizers.PATTERN)
    r = random.Random(9)
    for n in (2, 17, 200, 900):
        piece = "".join(r.choices("etaoinshr", k=n)).encode()
        ids = codec.byte_id[np.frombuffer(piece, dtype=np.uint8)][None, :]
        assert codec.merge_matrix(ids.copy())[0].tolist() == codec.merge_long(piece).tolist()


# --- personal data ------------------------------------------------------------------------------------

def brute_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(10)
    pieces = ["a.b@c.de", "a@b@c.d.e", "@x.y", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111-1111 1111", "4111111111111112",
              "+1 (269) 555-3296", "+12", "+1.2.3.4-5 6 7 8 9.", "x", " ", "-", ".", "@", "+", "12", "é", "\n", "0000.0.0.1"]
    for _ in range(600):
        t = "".join(r.choices(pieces, k=r.randint(1, 9)))
        assert pii.base_spans(t)[0] == brute_pii(t), t


def test_pii_spans_and_redaction(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9000 + i, t) for i, t in enumerate(ODD)] + [
        (9100, "call +1 (269) 555-3296, later 555-3296"), (None, "mail a@b.cd now")], "doc_id long, text string")
    both = d.unionByName(odd)
    model = pii.fit(both)
    text = {r.doc_id: r.text or "" for r in both.collect()}
    for r in pii.detect(both.withColumn("n_email", F.lit("clash")), model).collect():
        base = pii.written(brute_pii(text[r.doc_id]))
        spans = set(r.spans.split(",")) if r.spans else set()
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) - {""} <= spans
        assert r.n_email == base.count("email:")
        if r.doc_id == 9100:
            assert "phone:30:38" in spans           # the repeated number, written another way
    clean = {r.doc_id: r.text for r in pii.redact(both, model).collect()}
    assert clean[None] == "mail [EMAIL] now" and clean[9000] is None
    assert clean[9100] == "call [PHONE], later [PHONE]"
    assert not any(brute_pii(t or "") for t in clean.values())
    assert pii.detect(odd.limit(0), model).count() == 0


def test_without_training_nothing_is_added(spark):
    df = frame(spark, [(1, "no data here"), (2, None)])
    assert [r.spans for r in pii.detect(df).collect()] == ["", ""]


def enumerated(model, g):
    """Label marginals of every token from all labellings."""
    import itertools

    n, k = len(g.features), len(pii.LABELS)
    phi = np.array([model.node(f) for f in g.features])
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        w = np.exp(sum(phi[i, x] for i, x in enumerate(labels)) + sum(model.pair[labels[i], labels[j]] for i, j in g.chain)
                   + sum(model.skip * (labels[i] == labels[j]) for i, j in g.skip))
        for i, x in enumerate(labels):
            total[i, x] += w
    return total / total.sum(axis=1, keepdims=True)


def test_messages_give_enumerated_marginals():
    """Exact without cycles; close to enumeration with a cycle of chain and skip edges."""
    rng = np.random.default_rng(5)
    model = pii.Model(rng.normal(size=(pii.HASHED, len(pii.LABELS))), 0.5 * rng.normal(size=(len(pii.LABELS),) * 2), 0.7)
    g = pii.Graph([""])
    g.features, g.known = [(1, 2), (3, 4), (5, 2)], [-1, -1, -1]
    g.chain, g.skip = np.array([[0, 1]]), np.array([[1, 2]])
    assert np.allclose(model.marginals(g), enumerated(model, g), atol=2e-3)
    g.features, g.known = [*g.features, (6, 7)], [-1] * 4
    g.chain, g.skip = np.array([[0, 1], [1, 2], [2, 3]]), np.array([[0, 3]])
    assert np.allclose(model.marginals(g), enumerated(model, g), atol=0.05)


def test_pseudo_likelihood_learns_features_neighbours_and_repeats():
    none, phone = 0, pii.LABELS.index("phone")
    zero, two = (0,) * len(pii.LABELS), tuple(2 * (i == phone) for i in range(len(pii.LABELS)))
    m = pii.learn({(none, (1,), -1, -1, zero): 50, (phone, (2,), phone, -1, zero): 50, (phone, (3,), -1, -1, two): 20, (none, (3,), -1, -1, zero): 20})
    assert m.node((2,))[phone] > m.node((1,))[phone] and m.pair[phone, phone] > 0 and m.skip > 0
    assert pii.learn({}).empty


def test_field_finds_hidden_labels_and_adds_spans():
    """Fit on even documents; base labels of odd ones hidden in turn must come back, failed checks must not."""
    d = duckdb.sql("select doc_id, text from '/root/testdata/sf0.1/documents.parquet' where regexp_matches(text, '[0-9@]')").fetchall()
    counts = Counter()
    for i, t in d:
        if i % 2 == 0:
            counts.update(pii.Graph([t]).examples())
    model, odd = pii.learn(counts), [t for i, t in d if i % 2]
    g = pii.Graph(odd)
    taught, known = np.array(g.taught), np.array(g.known)
    hidden = np.zeros(len(known), dtype=np.int64)
    for fold in range(5):
        pick = np.arange(len(known)) % 5 == fold
        g.known = np.where(pick, -1, known).tolist()
        p = model.marginals(g)
        hidden[pick] = np.where(p.max(axis=1) >= pii.CERTAIN, p.argmax(axis=1), 0)[pick]
    kinds = taught > 0
    assert (hidden[kinds] == taught[kinds]).mean() >= 0.98 and not hidden[taught == 0].any()
    added = [s for b, w in pii.find(odd, model) for s in w if s not in b]
    assert len(added) > 50 and {k for k, _, _ in added} >= {"secret", "phone"}

    text = "+1 (269) 555-3296 10.0.0.1 and 4845168114407329 4929348385146306 or 4845168114407328, TOKEN = \"9233A8ECF7C5B09FE594\"### v2.0"
    base, spans = pii.find([text], model)[0]
    assert base == [("ip", 18, 26)]
    assert [(k, text[a:b]) for k, a, b in spans] == [
        ("ip", "10.0.0.1"), ("card", "4845168114407329"), ("card", "4929348385146306"), ("phone", "+1 (269) 555-3296"),
        ("secret", "9233A8ECF7C5B09FE594")]


def test_very_long_tokens_are_read_in_linear_time():
    m = pii.learn({(0, (1,), -1, -1, (0,) * len(pii.LABELS)): 1})
    for t in ("9" * 200_000, "a@" + "." * 200_000 + "@", "token=" + "a1" * 100_000, "(1-" * 60_000, "+1" + " 2" * 100_000):
        assert pii.find([t], m)[0][0] == pii.base_spans(t)[0]
