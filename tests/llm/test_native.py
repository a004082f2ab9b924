"""Quality rules, SpotSigs, source mixing and URL filter against brute force, with the edge cases of each."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paygrid.llm import mixing, quality_rules, spotsigs, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", " \n\t", "one", "the cat sat on the mat", "a b c a b c a b c", "x\ny\nx\n\n \nx", "#*$%&|<> !!",
         "é ü 日本 the word of the day", "the " * 300, "w" * 5000, "\x0bthe\x0ccat\rof the dog and the bird in the sky"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)


def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)] + [(None, "null id of the row", "s1"), (4, TEXTS[4], "s1")]
    return frame(spark, rows).withColumns({"size": F.lit("clash"), "pattern": F.lit(1), "range": F.lit(2)})


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_measurements(spark):
    for r, t in [(quality_rules.judge(frame(spark, [(1, t, "s")])).first(), t) for t in TEXTS]:
        w, t = words(t), t or ""
        tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        cover = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(cover))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w))


def test_policies_and_ablations(spark):
    led = quality_rules.ledger(docs(spark))
    rows = [r.fail_bits for r in led.collect()]
    for r in quality_rules.ablations(led).collect():
        m, b = quality_rules.mask(quality_rules.POLICIES[r.policy]), 1 << list(quality_rules.RULES).index(r.rule)
        assert r.kept == sum(not x & m for x in rows) and r.failed == sum(bool(x & b) for x in rows)
        assert r.failed_alone == sum(x & m == b for x in rows) and r.kept_without == sum(not x & m & ~b for x in rows)
    assert quality_rules.ledger(docs(spark).limit(0)).count() == 0


def signatures(t):
    flat = re.sub("[" + re.escape(spotsigs.PUNCTUATION + "\t\n\x0b\x0c\r") + "]", " ", (t or "").lower())
    w = [x for x in flat.split(" ") if x]
    out = set()
    for i, x in enumerate(w):
        if x in spotsigs.ANCHORS:
            chain = [y for y in w[i + 1:] if y not in spotsigs.ANCHORS][:spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((x, *chain))
    if not out and w:
        out = {tuple(w)} if len(w) < 3 else {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    return out


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_fingerprints(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "the quick fox of the hill and the lazy dog in a house " * i) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in spotsigs.fingerprints(df).collect()}
    order = sorted(dict(rows), reverse=True)
    text = {i: t or "" for i, t in rows}
    for k, i in enumerate(order):
        t, nxt = text[i], text[order[(k + 1) % len(order)]]
        h = len(t) // 2
        edit = t[:len(t) - h] + nxt[:h]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert len(r.fingerprint) == 8 * len(signatures(t)) and len(r.edited_fingerprint) == 8 * len(signatures(edit))
        assert math.isclose(r.near_edited, likeness(signatures(t), signatures(edit)))
        assert math.isclose(r.near_next, likeness(signatures(t), signatures(nxt)))


def test_fingerprint_edges(spark):
    assert spotsigs.fingerprints(docs(spark).limit(0)).count() == 0
    one = spotsigs.fingerprints(frame(spark, [(7, "the cat sat on the mat", "s")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"the cat satthe cat sat").hexdigest()
    got = spotsigs.fingerprints(docs(spark)).collect()
    assert len(got) == len(TEXTS) + 2 and len({r.fingerprint for r in got if r.doc_id == 4}) == 1


HOT_IDS = {
    "outlier": list(range(3000)) + [10**12],
    "nulls": [None] * 3000 + list(range(1500)),
    "hot id": [5] * 2000 + list(range(2000)),
    "ends": [-2**63, 2**63 - 1] + list(range(-1000, 1000)),
}


@pytest.mark.parametrize("name", HOT_IDS)
@pytest.mark.parametrize("n_ranges", [8, 300])
def test_next_document_in_even_ranges(spark, name, n_ranges):
    ids = HOT_IDS[name]
    df = spark.createDataFrame([(i, f"the cat {k} sat on mat {k * 7}") for k, i in enumerate(ids)], "doc_id long, text string")
    tied = df.withColumn("tie", F.xxhash64("text"))
    if n_ranges == 8:
        sizes = [r["count"] for r in tied.withColumn("r", spotsigs.id_ranges(df, n_ranges)).groupBy("r").count().collect()]
        assert max(sizes) <= 1.5 * len(ids) / n_ranges
    order = sorted(tied.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.tie))
    want = Counter((r.doc_id, r.text, order[(k + 1) % len(order)].text) for k, r in enumerate(order))
    got = Counter((r.doc_id, r.text, r.next_text) for r in spotsigs.with_next(df, n_ranges).collect())
    assert got == want


def test_near_pairs(spark):
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join("the " + w for w in base[:60 - i]) for i in range(12)} | {50: "the other words of a kind"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    sets = spotsigs.add_signatures(df, "text", "sigs").select("id", "sigs")
    got = {(r.a, r.b) for r in spotsigs.near_pairs(sets, 0.9).collect()}
    want = {(a, b) for a in texts for b in texts if a < b and likeness(signatures(texts[a]), signatures(texts[b])) >= 0.9}
    assert got == want and want


def waterfill(sizes, weights, times=3):
    total, cap, done = sum(sizes), [times * s for s in sizes], set()
    while True:
        rest = total - sum(cap[i] for i in done)
        w = sum(weights[i] for i in range(len(sizes)) if i not in done)
        target = [cap[i] if i in done else rest * weights[i] / w for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if target[i] > cap[i] + 1e-9}
        if not over:
            return target
        done |= over


def test_mix(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 5}" if i % 3 else "s0") for i in range(400)] + [(900, "tiny", "é"), (901, "a b", None), (902, None, "zz")]
    got = mixing.mix(frame(spark, rows), block_tokens=16).collect()
    names = sorted({s for _, _, s in rows if s is not None}, key=lambda x: [ord(c) for c in x]) + [None]
    sizes = [sum(len(words(t)) for _, t, s in rows if s == n) for n in names]
    target = dict(zip(names, waterfill(sizes, [i % 3 + 1 for i in range(len(names))])))
    by = Counter()
    for r in got:
        assert math.isclose(r.target, target[r.source]) and r.taken <= 3 * r.size and r.source_size == sizes[names.index(r.source)]
        by[r.source] += r.taken
    assert all(by[n] == math.floor(target[n] + 1e-9) for n in names) and len(got) == len(rows)
    again = mixing.mix(frame(spark, rows[::-1]), block_tokens=16).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_schedule_spreads_sources(spark):
    t = spark.createDataFrame([(1, 6400.0), (2, 12800.0), (3, 100.0)], "sid int, target double")
    slots = sorted((r.slot, r.sid) for r in mixing.schedule(spark, t, 64).collect())
    need = {1: 100, 2: 200, 3: 2}
    assert Counter(s for _, s in slots) == need
    for upto in (30, 90, 150, 240):         # any start of the schedule holds each source's share, a few slots off
        seen = Counter(s for _, s in slots[:upto])
        assert all(abs(seen[s] - upto * n / 302) < 4 for s, n in need.items())


def test_mix_edges(spark):
    got = mixing.mix(docs(spark)).collect()
    assert len(got) == len(TEXTS) + 2 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(docs(spark).limit(0)).count() == 0
    assert mixing.mix(frame(spark, [(1, None, "a"), (2, "", None)])).agg(F.sum("taken")).first()[0] == 0
    out = mixing.mix_documents(docs(spark))
    assert out.columns == docs(spark).columns and out.filter("text is null").count() == 0


def test_mix_keeps_repeated_empty_rows(spark):
    rows = [(1, "", "a"), (1, "", "a"), (1, None, "a"), (None, "", "a"), (None, "", "a"), (None, " ", None), (None, None, None),
            (2, "some words here", "a"), (2, "some words here", "a"), (3, "x y", None)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, len(words(t)), s) for i, t, s in rows)
    assert all(r.taken == 0 for r in got if not r.size) and mixing.mix(frame(spark, rows[:4])).count() == 4


def test_mix_follows_the_schedule(spark):
    rows = [(i, f"w{i} " * 512, f"s{i % 3}") for i in range(90)]
    df = frame(spark, rows)
    got = [r.doc_id for r in mixing.mix_documents(df).collect()]
    plan = mixing.mix(df).collect()
    want = sorted((slot.slot, slot.start, r.doc_id) for r in plan for slot in r.slots[:(2 * r.taken + r.size) // (2 * r.size)])
    assert got == [i for _, _, i in want] and len(got) >= 89 and len({slot for slot, _, _ in want}) == len(want)
    share = {s: n / len(got) for s, n in Counter(i % 3 for i in got).items()}
    for upto in (15, 45, 75):           # any start of the mix holds each source's share, a few documents off
        seen = Counter(i % 3 for i in got[:upto])
        assert all(abs(seen[s] - upto * x) < 4 for s, x in share.items())


def test_url_parts_and_rules(spark):
    urls = {"http://A.Example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/", "block"),
            "https://example.org/en/12#x": ("example.org", "/en/12", "example.org/en/1", "block"),
            "ftp://x.org/a?b": ("x.org", "/a", "org/", "allow"), "http://com/fr/": ("com", "/fr/", "com/fr/", "allow"),
            "http://z.com/de/9": ("z.com", "/de/9", "com/de/", "block"), "http://xorg/": ("xorg", "/", None, None),
            "http://x.org": ("x.org", "", None, None), "a?u=http://b.org/c": ("b.org", "/c", "org/", "allow"),
            "no scheme": ("", "", None, None), "": ("", "", None, None), None: ("", "", None, None),
            "http://h.net?x/y": ("h.net", "", None, None)}
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    for i, (host, path, rule, verdict) in enumerate(urls.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge(df.filter("url = 'no scheme' or url is null")).collect()} == {"allow"}


def test_url_model_by_hand(spark):
    """The ratio of every gram equals Witten-Bell smoothing computed directly."""
    patterns = [("ab/ab", 3, 0), ("ba/ba", 0, 2), ("ab", 0, 0)]
    order = 2
    counts = [Counter(), Counter()]
    for p, *n in patterns:
        s = url_filter.START * order + p + url_filter.END
        for i in range(order, len(s)):
            for k in range(order + 1):
                for c, m in zip(counts, n):
                    c[s[i - k:i + 1]] += m

    def prob(c, gram):
        lower = 1 / url_filter.ALPHABET if len(gram) == 1 else prob(c, gram[1:])
        n = {g: m for g, m in c.items() if len(g) == len(gram) and g[:-1] == gram[:-1] and m}
        t, s = len(n), sum(n.values())
        return (n.get(gram, 0) + t * lower) / (s + t) if s + t else lower

    df = spark.createDataFrame(patterns, "pattern string, n_allow long, n_block long")
    got = {r.pattern: r.llr for r in url_filter.score_patterns(df, order).collect()}
    for p, *_ in patterns:
        s = url_filter.START * order + p + url_filter.END
        want = [math.log(prob(counts[0], s[i - order:i + 1])) - math.log(prob(counts[1], s[i - order:i + 1]))
                for i in range(order, len(s))]
        assert got[p] == pytest.approx(sum(want) / len(want), abs=1e-6)


def test_url_model_tells_classes_apart(spark):
    rows = [(i, f"http://good{i % 7}.org/page/{i}") for i in range(60)] + [(100 + i, f"http://spam{i % 7}.com/de/win{i}") for i in range(60)]
    rows += [(300, "http://good3.net/page/5"), (301, "http://spam2.net/de/win9")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[300] == "allow" and got[301] == "block"


def test_url_model_reads_digits_and_case(spark):
    """URLs that differ only in digits or case are told apart, as the rule org/en/1 asks for."""
    rows = [(i, f"http://example.org/en/1{i}") for i in range(40)] + [(100 + i, f"http://example.org/en/2{i}") for i in range(40)]
    rows += [(300, "http://host.net/en/15"), (301, "http://host.net/en/25"), (302, "http://host.net/EN/25")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[0].verdict == "block" and got[100].verdict == "allow"
    assert (got[300].verdict, got[301].verdict) == ("block", "allow") and got[301].llr != got[302].llr


def test_worker_returns_memory_after_a_batch():
    """A worker that is kept for later stages does not hold the memory of its last batch."""
    import re

    import pyarrow as pa

    from paygrid.llm.arrow import text_slices

    def held():
        return int(re.search(r"Rss:\s+(\d+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

    batch = pa.RecordBatch.from_pydict({"text": ["a b"] * 1000})
    kept = []

    def work():
        # Small blocks with a few left standing above them: the allocator cannot shrink by itself.
        blocks = [bytes(1000) for _ in range(200_000)]
        kept.extend(blocks[::20_000])

    before = held()
    for _ in text_slices(batch):
        work()
    assert held() - before < 60


def test_pair_table_lists_its_pairs():
    import numpy as np

    from paygrid.llm.byte_bpe import PairTable

    pairs = {(a << 32 | b): a + b + 300 for a in range(40) for b in range(0, 40, 3)}
    assert PairTable(np.array(list(pairs)), np.array(list(pairs.values()))).as_dict() == pairs


def test_codec_matrices_stay_small(monkeypatch):
    """Many distinct pieces are merged in matrices of bounded size, whatever the slice; the ids are those of one piece at a time."""
    import public_tokenizers

    from paygrid.llm import byte_bpe
    from paygrid.llm.byte_bpe import Codec

    codec = Codec.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    sizes, merge = [], Codec.merge_matrix
    monkeypatch.setattr(Codec, "merge_matrix", lambda self, ids: (sizes.append(ids.size), merge(self, ids))[1])
    pieces = [f"q{i * 7919:x}zx{i:b}".encode() for i in range(20_000)]
    ids, n = codec.encode_pieces(pieces)
    assert max(sizes) <= 1 << 18 and len(n) == len(pieces)
    ends = n.cumsum()
    for i in (0, 77, 19_999):
        assert list(ids[ends[i] - n[i]:ends[i]]) == list(codec.encode_pieces([pieces[i]])[0])
