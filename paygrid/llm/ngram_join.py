"""N-gram Jaccard self-join: rare-first prefix filter with length, positional and suffix filters.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a document's set holds the
64-bit hashes of its distinct n-word shingles (fewer words: the whole sequence is its one
shingle; no words: empty, linked with nothing). Steps:

1. Count shingles over all documents in a fixed-size table of hashed counters. Rank order is
   (counter, hash): rare first, and one order for all documents, which is all that
   the prefix filter needs to be exact.
2. Collapse documents with equal sets into classes; the smallest id represents a class.
3. Two sets can only reach the threshold if their prefixes share a shingle. All buckets (shingle
   -> classes) with the same smallest class form one unit, so near copies that share many
   shingles meet in a few units instead of in every bucket; a pair is handled only in
   the smallest unit it shares. Members without a partner of fitting length leave the unit. Units are
   cut into blocks, and pairs of blocks are the
   work items, so a hot unit spreads over many tasks and its rows stay linear per block.
4. Inside an item, a first look at sizes and histograms of hash ranges applies the length and the
   suffix filter; it ships some hundred bytes a class. Classes with a partner left get their prefixes
   for the positional filter, and those with a partner left after it their full sets. Pairs that pass
   all three filters are verified exactly, once each. Only spanning edges and link counts leave a task.
5. Connected components of the spanning edges.

The intersection counts are over 64-bit hashes: distinct shingles of one pair collide
with a chance of about 2**-64 per pair of shingles.

Defined cases: null text has no words. Rows that share a ``doc_id`` count as one document.
Rows with null id link like any other; their component is null where no document with an id is
reachable. Repeated rows are kept; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrid.session import materialize

from .arrow import text_slices
from .components import connected_components

SKETCH_BITS = 20            # hashed counters of shingle frequency, whatever the corpus
CHUNKS = 16                 # pieces in which the counters are summed
BLOCK = 256                 # classes of a block; a work item holds two blocks at most
HIST = 64                   # hash ranges of the suffix filter, one byte each
WORD_BYTES = 2 << 20        # bytes of text hashed at once

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, up to ``n``."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, WORD_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, np.uint64(base), dtype=np.uint64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x)
        _POWERS["letters"] = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of ``data`` (lower-case bytes)."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~_WHITE[raw]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(raw))
    total = np.cumsum(_POWERS["letters"][raw] * up[:len(raw)])
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    return starts, _mix((total[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    begin = np.cumsum([0] + [len(r) + 1 for r in raw])
    starts, words = word_hashes(b"\n".join(raw))
    first = np.searchsorted(starts, begin)
    h = np.full(max(0, len(words) - n + 1), np.uint64(n), dtype=np.uint64)
    for k in range(n):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            x = np.sort(h[a:b - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            x = np.full(1, np.uint64(b - a), dtype=np.uint64)
            for w in words[a:b]:
                x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + w)
            out.append(x)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def counters(sketch: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return sketch[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]


def frequency_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Shingle counts over all documents in ``2**SKETCH_BITS`` hashed counters (4 MB)."""

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for whole in batches:
            for b in text_slices(whole, limit=WORD_BYTES):
                sets = shingle_sets(b.column("text").to_pylist(), n)
                slot = (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                total += np.bincount(slot, minlength=1 << SKETCH_BITS)
        if total.any():
            parts = np.minimum(total, (1 << 32) - 1).astype(np.uint32).reshape(CHUNKS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()),
                                              pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], ["chunk", "part"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, p in zip(b.column("chunk").to_pylist(), b.column("part").to_pylist()):
                x = np.frombuffer(zlib.decompress(p), dtype=np.uint32).astype(np.int64)
                sums[c] = sums[c] + x if c in sums else x
        if sums:
            packed = [zlib.compress(np.minimum(x, (1 << 32) - 1).astype(np.uint32).tobytes(), 1) for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "part"])

    kind = "chunk int, part binary"
    parts = docs.select("text").mapInArrow(count, kind)
    sketch = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), dtype=np.uint32)
    for r in parts.repartition(CHUNKS, "chunk").mapInArrow(add, kind).collect():
        sketch[r["chunk"]] = np.frombuffer(zlib.decompress(r["part"]), dtype=np.uint32)
    return sketch.reshape(-1)


def ranked(hashes: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The set in rank order: rare shingles first, ties by hash."""
    return hashes[np.lexsort((hashes, counters(sketch, hashes)))]


def prefix_length(size: int, percent: int) -> int:
    """Shingles of a set that a partner at the threshold must share one of."""
    return size - -(-percent * size // 100) + 1


def histogram(hashes: np.ndarray) -> bytes:
    """Shingles per hash range, at most 255 each: the difference of two histograms bounds that of the sets from below."""
    return np.minimum(np.bincount((hashes & np.uint64(HIST - 1)).astype(np.int64), minlength=HIST), 255).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, n: int, percent: int, sketch) -> DataFrame:
    """``doc_id, n_shingles, key, prefix, hist`` of every row; ``key`` names the set (null: empty)."""

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, limit=WORD_BYTES):
                sets = shingle_sets(b.column("text").to_pylist(), n)
                size = np.array([len(s) for s in sets], dtype=np.int64)
                key = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                prefix = [ranked(s, sketch.value)[:prefix_length(len(s), percent)].view(np.int64) if len(s) else None for s in sets]
                hist = [histogram(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(size), pa.array(key, pa.binary()), pa.array(prefix, pa.list_(pa.int64())),
                     pa.array(hist, pa.binary())], ["doc_id", "n_shingles", "key", "prefix", "hist"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, key binary, prefix array<long>, hist binary")


class Item:
    """The classes of one work item; candidate pairs are those that pass every filter.

    Without prefixes (the first look, which ships little) the positional filter is left to the next one.
    """

    def __init__(self, rows: dict[str, list], percent: int, sketch: np.ndarray, unit: int, cross: bool):
        self.percent = percent
        size = np.array(rows["size"], dtype=np.int64)
        g = len(size)
        need = -(-percent * (size[:, None] + size[None, :]) // (100 + percent))
        ok = 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])     # length
        ok &= np.triu(np.ones((g, g), dtype=bool), 1)
        if cross:
            side = np.array(rows["block"], dtype=np.int64)
            ok &= side[:, None] != side[None, :]
        if "prefix" in rows and ok.any():
            ok &= self._positional(rows["prefix"], size, need, sketch)
        if ok.any():
            smaller = [(i, p) for i, ps in enumerate(rows["units"]) for p in ps if p < unit]
            if smaller:
                names = np.unique([p for _, p in smaller], return_inverse=True)[1]
                ok &= self._common(np.array([i for i, _ in smaller]), names, g) == 0        # a smaller unit has the pair
        i, j = np.nonzero(ok)
        if len(i):                                                                           # suffix filter
            hist = np.array([np.frombuffer(h, dtype=np.uint8) for h in rows["hist"]], dtype=np.int16)
            keep = np.zeros(len(i), dtype=bool)
            for k in range(0, len(i), 1 << 14):
                a, b = i[k:k + (1 << 14)], j[k:k + (1 << 14)]
                keep[k:k + (1 << 14)] = np.abs(hist[a] - hist[b]).sum(axis=1) <= size[a] + size[b] - 2 * need[a, b]
            i, j = i[keep], j[keep]
        self.size, self.i, self.j = size, i, j

    def _positional(self, prefixes: list[np.ndarray], size: np.ndarray, need: np.ndarray, sketch: np.ndarray) -> np.ndarray:
        """Pairs that share a prefix shingle and enough of the prefixes to reach the overlap that they need."""
        g = len(size)
        lens = [len(p) for p in prefixes]
        own, flat = np.repeat(np.arange(g), lens), np.concatenate(prefixes)
        order = np.lexsort((flat, counters(sketch, flat)))
        new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
        rank = np.empty(len(flat), dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        start = np.cumsum([0] + lens)[:-1]
        last = np.maximum.reduceat(rank, start)
        # Prefix shingles of i up to the smaller of the two last ranks: all that the pair shares there is in
        # both prefixes, so beyond it at most the rest of the smaller set can be shared.
        upto = np.array([np.searchsorted(rank[a:a + n], last, side="right") for a, n in zip(start, lens)])
        shared = self._common(own, rank, g)
        return (shared > 0) & (shared + np.minimum(size[:, None] - upto, size[None, :] - upto.T) >= need)

    @staticmethod
    def _common(own: np.ndarray, name: np.ndarray, g: int) -> np.ndarray:
        """Number of names that each two rows share."""
        many = np.bincount(name) > 1
        keep = many[name]
        column = (np.cumsum(many) - 1)[name[keep]]
        m = np.zeros((g, int(many.sum())), dtype=np.float32)
        m[own[keep], column] = 1.0
        return (m @ m.T).astype(np.int64)

    def links(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs whose sets reach the threshold, each verified once."""
        hit = np.zeros(len(self.i), dtype=bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[-1], self.i])))
        for a, b in zip(edges, [*edges[1:], len(self.i)]):
            mine, js = sets[self.i[a]], self.j[a:b]
            other = np.concatenate([sets[j] for j in js])
            at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
            both = np.add.reduceat((mine[at] == other).astype(np.int64), np.cumsum([0] + [len(sets[j]) for j in js])[:-1])
            total = self.size[self.i[a]] + self.size[js] - both
            hit[a:b] = 100 * both >= self.percent * total
        return self.i[hit], self.j[hit]


def _items(rows: DataFrame, work, schema: str) -> DataFrame:
    """Calls ``work(rows of one item)`` for every (unit, lo, hi); an item holds at most two blocks."""
    keys = ["unit", "lo", "hi"]
    names = rows.columns

    def run(batches):
        open_key, held = None, []
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
            n = b.num_rows
            if not n:
                continue
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            cuts = [*np.flatnonzero(new).tolist(), n]
            for s, e in zip(cuts, cuts[1:]):
                key = tuple(int(c[s]) for c in cols)
                if key != open_key:
                    if held:
                        yield from work(open_key, pa.Table.from_batches(held))
                    open_key, held = key, []
                held.append(b.slice(s, e - s))
        if held:
            yield from work(open_key, pa.Table.from_batches(held))

    return rows.select(*names).repartition(*keys).sortWithinPartitions(*keys, "rep").mapInArrow(run, schema)


def with_partner_length(members: DataFrame, percent: int) -> DataFrame:
    """Members ``(unit, rep, size)`` whose unit holds another one that the length filter could pair them with.

    Length classes grow by the threshold, so partners lie in the same or a neighbouring class; the
    classes of a unit are counted by a pre-aggregating groupBy. Dropped members lose no pair.
    """
    step = math.log(100.0 / percent)
    m = members.withColumn("cls", F.floor(F.log("size") / F.lit(step * 1.000001)).cast("int"))
    near = m.select("unit", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)).alias("cls"))
    counts = near.groupBy("unit", "cls").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return m.join(counts.select("unit", "cls"), ["unit", "cls"], "left_semi").select("unit", "rep")


def name_classes(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``key, rep``: ids, none of them a ``doc_id``, for the classes that hold null ids only.

    Hashes of the key; a draw in which two are equal or one is a document's is repeated with another salt.
    """
    nameless = classes.filter("rep is null")
    ids = docs.select(F.col("doc_id").alias("rep"))
    salt = 0
    while True:
        named = materialize(nameless.select("key", F.xxhash64("key", F.lit(salt)).alias("rep")), "ngram-named")
        twice = named.groupBy("rep").count().filter("count > 1").limit(1).count()
        if not twice and not named.join(ids, "rep", "left_semi").limit(1).count():
            return named
        salt += 1


def join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs (doc_id, text)``."""
    return _join(docs, n, percent)[0]


def _join(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    spark: SparkSession = docs.sparkSession
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, n))
    sigs = materialize(signatures(docs, n, percent, sketch), "ngram-signatures")
    classes = materialize(
        sigs.filter("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("size"),
            F.first("prefix").alias("prefix"), F.first("hist").alias("hist")), "ngram-classes")
    named = name_classes(classes, docs) if classes.filter("rep is null").limit(1).count() else None
    live = classes
    if named is not None:
        live = (classes.join(named.withColumnRenamed("rep", "made"), "key", "left")
                       .withColumn("rep", F.coalesce("rep", "made")).drop("made"))
        live = materialize(live, "ngram-classes")

    posts = live.select("rep", F.explode("prefix").alias("token"))
    buckets = posts.groupBy("token").agg(F.min("rep").alias("unit"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = posts.join(buckets.select("token", "unit"), "token").select("unit", "rep").distinct()
    members = materialize(with_partner_length(members.join(live.select("rep", "size"), "rep"), percent), "ngram-units")
    blocks = members.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"))
    units = members.groupBy("rep").agg(F.sort_array(F.collect_set("unit")).alias("units"))
    placed = members.join(blocks, "unit").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    placed = (placed.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
                    .select("unit", "lo", "hi", "rep", "block").join(units, "rep"))
    slim = "unit long, lo long, hi long, rep long, block int"

    def look(rows: DataFrame, name: str) -> DataFrame:
        """The classes of each item that still have a partner."""
        names = [c for c in ("size", "block", "units", "hist", "prefix") if c in rows.columns]

        def partners(key, t):
            held = {k: t[k].to_pylist() for k in names}
            if "prefix" in held:
                held["prefix"] = [np.array(p, dtype=np.int64).view(np.uint64) for p in held["prefix"]]
            item = Item(held, percent, sketch.value, key[0], key[1] != key[2])
            used = np.unique(np.concatenate([item.i, item.j]))
            if len(used):
                yield pa.RecordBatch.from_pydict({
                    **{k: pa.array(np.full(len(used), v)) for k, v in zip(("unit", "lo", "hi"), key)},
                    **{k: t[k].combine_chunks().take(pa.array(used)) for k in ("rep", "block")}})

        return materialize(_items(rows, partners, slim), name)

    used = look(placed.join(live.select("rep", "size", "hist"), "rep"), "ngram-first")
    used = look(used.join(units, "rep").join(live.select("rep", "size", "hist", "prefix"), "rep"), "ngram-second")

    def full(batches):
        for whole in batches:
            for b in text_slices(whole, limit=WORD_BYTES):
                sets = shingle_sets(b.column("text").to_pylist(), n)
                yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "set"])

    wanted = used.select("rep").distinct()
    texts = docs.select(F.col("doc_id").alias("rep"), "text").filter("rep is not null")
    if named is not None:
        keyed = signatures(docs.filter("doc_id is null").select(F.xxhash64("text").alias("doc_id"), "text"), n, percent, sketch)
        keyed = keyed.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("h")).join(named, "key").select("h", "rep")
        texts = texts.unionByName(docs.filter("doc_id is null").select(F.xxhash64("text").alias("h"), "text").join(keyed, "h").select("rep", "text"))
    sets = (texts.join(wanted, "rep", "left_semi").mapInArrow(full, "rep long, set binary")
                .groupBy("rep", F.xxhash64("set").alias("h")).agg(F.first("set").alias("set")).drop("h"))
    second = (used.join(units, "rep").join(live.groupBy("rep").agg(F.sum("copies").alias("copies")), "rep").join(sets, "rep"))

    def verify(key, t):
        c = t.combine_chunks()
        whole = [np.frombuffer(s, dtype=np.uint64) for s in c["set"].to_pylist()]
        rows = {"size": [len(s) for s in whole], "block": c["block"].to_pylist(), "units": c["units"].to_pylist(),
                "hist": [histogram(s) for s in whole],
                "prefix": [ranked(s, sketch.value)[:prefix_length(len(s), percent)] for s in whole]}
        i, j = Item(rows, percent, sketch.value, key[0], key[1] != key[2]).links(whole)
        if not len(i):
            return
        rep, copies = c["rep"].to_numpy(), c["copies"].to_numpy()
        links = np.bincount(i, weights=copies[j], minlength=len(rep)) + np.bincount(j, weights=copies[i], minlength=len(rep))
        root = np.arange(len(rep))
        while True:                     # smallest index over links until nothing moves
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if (new == root).all():
                break
            root = new
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_pydict({"a": rep[at], "b": rep[root[at]], "links": links[at].astype(np.int64)})

    edges = materialize(_items(second, verify, "a long, b long, links long"), "ngram-edges")
    groups = connected_components(edges.select("a", "b"))
    if named is not None:
        # Made-up ids are no documents: a component is named by its smallest real one, if any.
        made = named.select(F.col("rep").alias("node"), F.lit(True).alias("made"))
        real = groups.join(made, "node", "left").groupBy("component").agg(
            F.min(F.when(F.col("made").isNull(), F.col("node"))).alias("least"))
        groups = groups.join(real, "component").select("node", F.col("least").alias("component"), F.lit(True).alias("grouped"))
    else:
        groups = groups.withColumn("grouped", F.lit(True))
    linked = edges.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    real_rep = F.col("rep") if named is None else F.when(F.col("made").isNull(), F.col("rep"))
    if named is not None:
        live = live.join(named.select("key", F.lit(True).alias("made")), "key", "left")
    per_class = (live.select("key", "rep", "copies", real_rep.alias("own")).join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                        .join(linked, "rep", "left")
                        .select("key", F.when(F.col("grouped"), F.col("component")).otherwise(F.col("own")).alias("component_id"),
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = sigs.select("doc_id", "n_shingles", "key").join(per_class, "key", "left")
    empty = F.col("key").isNull()
    out = out.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                     F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return out, per_class


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: the smallest id (null last), then text hash; all columns.

    Texts are the nodes, so rows with null or shared ids are compared like any other. Documents
    without words stay, repeated rows of them once.
    """
    cols = docs.columns
    marked = docs.withColumns({"_text": F.xxhash64("text"), "_row": F.xxhash64(*cols)})
    found = (join(marked.select(F.col("_text").alias("doc_id"), "text"), n, percent).groupBy(F.col("doc_id").alias("_text"))
             .agg(F.min("component_id").alias("_component"), F.max("n_shingles").alias("_n")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_text", "_row")).alias("first")
    alone = F.when(F.col("_n") == 0, F.struct("doc_id")).alias("_alone")
    kept = marked.select("doc_id", "_text", "_row").join(found, "_text").groupBy("_component", alone).agg(first)
    out = marked.join(kept.select("first._text", "first._row"), ["_text", "_row"], "left_semi")
    return out.dropDuplicates(["_text", "_row"]).select(*cols)
