"""Quality classifier, phrases and conversation repair against brute force, with the edge cases of each."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paygrid.llm import conversation_repair, language_id, phrases, pii, quality_classifier, stems, toxicity
from paygrid.llm.common import crc_mod
from paygrid.llm.queries import ORACLE, QUERIES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_phrases", "op13_conversation_repair"])
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def test_long_digit_runs_are_no_crash(spark):
    run = "0" * 6000
    good, _ = pii.base_spans(f"at {run}1.2.3.4 end")
    assert good == [("ip", 3, 3 + 6000 + 7)]
    texts = [f"{run}1.2.3.4", f"1.{run}.3.4", "9" * 6000 + ".1.1.1", "1" * 200_000, f"+{'5' * 6000}", f"a@b.{run}"]
    got = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_ip for r in got] == [1, 1, 0, 0, 0, 0]


def test_more_languages_than_a_byte_holds():
    """The path names the best language beyond the 127th too."""
    model = language_id.Model.__new__(language_id.Model)
    model.langs = [f"l{i}" for i in range(300)]
    scores = np.zeros((2, 300))
    scores[0, 299], scores[1, 200] = 50.0, 50.0
    got = model.paths(np.array([3, 2]), np.array([0, 0, 0, 1, 1]), scores)
    assert got.tolist() == [299, 299, 299, 200, 200]


# --- phrases ---------------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    n, found = Counter(), {}
    for lang, t in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                found.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        drop = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= 100 * cand[p[i:j]]}
        best = []
        for p in cand.keys() - drop:
            score, k = min((1000 * cand[p] * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -cand[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def texts_in_four_languages():
    r = random.Random(1)
    voc = [f"w{i}" for i in range(12)] + ["é", "日本", "A", "b\x1cc", "x　y"]
    gaps = [" ", "  ", "\t", ". ", "\n", " ", " ", " ", "!"]
    rows = [(r.choice(["en", "de", None, "und"]), "".join(r.choice(voc) + r.choice(gaps) for _ in range(r.randint(0, 60)))) for _ in range(400)]
    return rows + [(None, None), ("en", ""), ("en", "  \n"), ("xx", "a"), ("long", "a b c, " * 60_000), ("long", "z" * 300_000)]


@pytest.mark.parametrize("least,top", [(5, 2000), (3, 50), (10 ** 6, 10)])
def test_phrases_equal_brute_force(spark, least, top):
    rows = texts_in_four_languages()
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit(1), "k": F.lit("clash"), "w1": F.lit("x")}).repartition(5)
    got = phrases.mine(df, least, top)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_colliding_pairs_change_nothing(spark, monkeypatch):
    rows = texts_in_four_languages()[:-2]
    for name, value in (("MIN_BITS", 4), ("MAX_BITS", 4), ("CHUNK", 8), ("BUFFER", 1000)):      # all phrases share a few slots
        monkeypatch.setattr(phrases, name, value)
    df = spark.createDataFrame(rows * 3, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.mine(df, 4, 500).collect()) == brute_phrases(rows * 3, 4, 500)


def test_no_documents_no_phrases(spark):
    assert phrases.mine(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 999_999_999_937, 10 ** 14 + 7, 10 ** 12 + 39, 10 ** 12 + 61
    got = spark.range(1).select(phrases._floor_score(*[F.lit(x).cast("long") for x in (a, n, left, right)])).first()[0]
    assert got == 1000 * a * n // (left * right)


# --- conversation repair ---------------------------------------------------------------------------

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """Dijkstra over (cost, letters): the first complete repair is the cheapest and, of those, ASCII-least."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (i, state) in seen:
            continue
        seen.add((i, state))
        new = [(r, STEP.get((state, r[0]))) for r in ("user", "assistant")]
        for r, q in new:
            if q:
                heapq.heappush(heap, (cost + 3, audit + "I", i, q, out + (f"{r}:",)))
        if i < len(rows):
            role, text, fault = rows[i]
            more = 3 if fault == "truncated" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in STEP:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEP[state, role[:1]], out + (f"{role}:{text}",)))
                for r, q in new:
                    if q:
                        heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, q, out + (f"{r}:{text}",)))


def brute_repair(table):
    def known(x):
        return " " if x is None else str(x)

    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{known(conv)}:{known(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else known(role), known(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, marked, n = set(), [], Counter()
        for _, role, text in rows:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
            n[fault] += 1
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations():
    r = random.Random(2)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "sys", "Ünder"]
    said = ["a.", "b", "c!", "", " ", None, "x?", "d. ", "é", "same.", ".\x0b", "x" * 5000 + "."]
    rows = [(c, r.choice([t, t, t, t + 2, None, 0]), r.choice(roles[:5] if r.random() < .8 else roles),
             r.choice(said) if r.random() < .5 else f"t{r.random()}.")
            for c in [*range(120), None] for t in range(r.choice([1, 2, 3, 5, 8, 12, 30]))]
    rows += [rows[5], rows[5], (500, None, None, None), (501, 1, "user", "y" * 200_000)]
    return rows + [(999, i, ("user", "assistant")[i % 2] if r.random() < .9 else "system", f"row {i}." if r.random() < .9 else "same")
                   for i in range(500)]


@pytest.mark.parametrize("block", [conversation_repair.BLOCK, 7])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)        # small blocks: a conversation is cut up
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"at": F.lit("clash"), "block": F.lit(1), "blank": F.lit(0)}).repartition(5)
    assert sorted((tuple(r) for r in conversation_repair.repair(df).collect()), key=str) == brute_repair(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", f"{i} says.") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = {r.at >> 33 for r in conversation_repair.numbered(conversation_repair.damage(df)).select("at").collect()}
        got = [tuple(r) for r in conversation_repair.repair(df).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and got == brute_repair(rows)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(df).count() == 0


def test_checkpoints_give_the_plain_vectors():
    r = random.Random(3)
    for n in (0, 1, 2, 3, 10, 50, 101):
        codes = bytes(r.randrange(12) for _ in range(n))
        plain = [conversation_repair.closed(conversation_repair.ENDS)]
        for c in reversed(codes):
            plain.append(conversation_repair.before(c, plain[-1]))
        plain.reverse()
        walk = conversation_repair.Walk(codes, plain[-1])
        assert len(walk.marks) <= n ** 0.5 + 3
        assert all(walk.marks[i] == plain[i] for i in walk.marks) and [walk._at(i) for i in range(n)] == plain[:n]
        assert conversation_repair.vector(conversation_repair.matrix(codes), plain[-1]) == plain[0]


# --- quality classifier ----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality_classifier.judge(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = Counter((r.quality, r.predicted == r.quality) for r in got)
    assert right[0, True] >= 0.95 * (right[0, True] + right[0, False])
    assert right[1, True] >= 0.98 * (right[1, True] + right[1, False])
    assert all(0.0 <= r.score <= 1.0 and r.predicted == (r.score >= 0.5) for r in got)


def labelled(spark, n=300):
    r = random.Random(5)
    word = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(r.choice(word) + ("!!" if i % 3 == 0 else "") for _ in range(40))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 3 != 0), None) for i in range(n)], "doc_id long, quality int, toxic int")


def test_learns_only_from_its_fold(spark):
    docs, labels = labelled(spark)
    held = crc_mod(F.col("doc_id"), 3) == 1
    lies = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    extra = docs.withColumns({"slots": F.lit("clash"), "good": F.lit(1), "lang": F.lit("x"), "h": F.lit(2)}).repartition(3)
    a = {r.doc_id: (r.score, r.held_out) for r in quality_classifier.judge(docs, labels).collect()}
    b = {r.doc_id: (r.score, r.held_out) for r in quality_classifier.judge(extra, lies).collect()}
    assert a == b
    assert all((s >= 0.5) == (i % 3 != 0) and out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, (s, out) in a.items())


def test_classifier_edges(spark):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(None, "w1 w2"), (None, None), (5000, ""), (5001, " \n"), (5002, None), (5003, "x" * 400_000), (3, "w3"), (3, "w3"),
                                 (5004, "日本 é " * 50_000)], "doc_id long, text string")
    got = quality_classifier.judge(docs.unionByName(odd), labels.unionByName(
        spark.createDataFrame([(None, 1, 1), (7, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int"))).collect()
    assert len(got) == 309 and all(0.0 <= r.score <= 1.0 for r in got)
    empty = {r.score for r in got if r.doc_id in (5000, 5001, 5002)}
    assert len(empty) == 1
    assert quality_classifier.judge(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality_classifier.judge(odd, labels.limit(0)).collect()} == {0.5}
    one = quality_classifier.judge(odd, labels.filter("quality = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9


def test_scores_are_sparse_dot_products():
    """The vectorised dot products equal those of the explicit sparse vectors, and training follows the FTRL formulas."""
    texts = pa.array(["A b b !! c", None, "", "Aa.# 12 12 é", "one " * 500])
    w = np.random.default_rng(0).normal(size=1 << quality_classifier.BITS)
    by_vector = [float(w[s] @ v) for s, v in quality_classifier.vectors(texts)]
    assert np.allclose(quality_classifier.dots(texts, w), by_vector)
    rows = [(np.array([1, 5], np.int32), np.array([0.5, 1.0]), True), (np.array([5], np.int32), np.array([1.0]), False)]
    z, n = Counter(), Counter()
    bias, q = 1 << quality_classifier.BITS, quality_classifier

    def weight(j):
        pen = 0.0 if j == bias else q.L1
        return 0.0 if abs(z[j]) <= pen else -(z[j] - np.sign(z[j]) * pen) / ((q.BETA + n[j] ** 0.5) / q.ALPHA + q.L2)

    for _ in range(q.EPOCHS):
        for slot, value, good in rows:
            x = {**dict(zip(slot.tolist(), value.tolist())), bias: 1.0}
            p = 1 / (1 + np.exp(-sum(weight(j) * v for j, v in x.items())))
            step = {j: ((p - good) * v, weight(j)) for j, v in x.items()}
            for j, (g, old) in step.items():
                z[j] += g - ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / q.ALPHA * old
                n[j] += g * g
    got, b = quality_classifier.train(rows)
    assert np.allclose([got[1], got[5], b], [weight(1), weight(5), weight(bias)])


def test_forms():
    assert [quality_classifier.form(w) for w in ("Rewh.###", "THE!!", "éa12", "|", "aB", "")] == ["Aa.#", "A!", "a9", "|", "aA", ""]


def brute_stems(texts):
    """Per word (final space) and stem: texts that hold it, and those that hold it 1, 2, 3 times or more."""
    held, out = Counter(), {}
    for t in texts:
        count = Counter()
        seen = set()
        for w in (t or "").lower().split():
            w = w.strip(stems.EDGES)
            if w.isalpha():
                count[w + " "] += 1
                count.update(w[:n] for n in range(stems.MIN_STEM, len(w)))
                seen.update([w + " ", *(w[:n] for n in range(stems.MIN_STEM, len(w) + 1))])
        held.update(seen)
        for f in seen:
            row = out.setdefault(f, [0] * stems.LEVELS)
            for m in range(stems.LEVELS):
                row[m] += count[f] > m
    return {f: (held[f], *out[f]) for f in held}


def test_stem_counts_equal_brute_force(spark):
    d = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    texts = [*d, None, "", "a ab abc abcd abcde abcde, abcdef", "Straße ÉÉÉÉÉ ééééé x1y 日本語日本語", "abcd abcd abcd abcd"]
    got = stems.count(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), 2)
    want = {f: n for f, n in brute_stems(texts).items() if n[0] >= 2}
    assert {stems.text_of(got, h): node.n for h, node in got.items()} == want
    some = sorted(got)[::3]
    again = stems.count(spark.createDataFrame([(t,) for t in texts], "text string"), 1, np.array(some, dtype=np.int64).view(np.uint64))
    assert sorted(again) == some and all(again[h].n == got[h].n for h in some)


def test_toxicity_of_very_long_words_and_repeated_ids(spark):
    """Words of 200,000 letters in labelled rows; rows with one id and different texts learn the same one on each run."""
    long = "".join(chr(97 + (i * i // 7) % 26) for i in range(200_000))
    rows = [(i, f"nasty{'x' * (i % 3)} thing number {'abcdefghij'[i % 10]} {'klmnopqrst'[i // 10 % 10]} {long[:200_000 - i] if i < 8 else ''}", 1) for i in range(40)]
    rows += [(100 + i, f"plain words {'abcdefghij'[i % 10]} and {'klmnopqrst'[i // 10 % 10]} more {long if i == 3 else ''}", 0) for i in range(60)]
    rows += [(100, "another text of this id", 0), (101, None, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame(sorted({(i, y) for i, _, y in rows}), "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.repartition(7), labels)
    assert model.automaton.terms == again.automaton.terms and model.weights == again.weights
    assert any(t[0].startswith("nast") for t in model.automaton.terms)
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect() if r.doc_id < 40 or r.doc_id > 101}
    assert all(found[i] == (i < 40) for i in found)
