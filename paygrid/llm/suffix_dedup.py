"""Exact substring removal: 200-byte strings that also start elsewhere, by suffix sorting.

The suffixes to sort are narrowed first, without loss. Of the ``GRAM``-byte strings inside a
200-byte window the one with the smallest hash is the window's anchor, so equal windows have
equal anchors at the same offset. Anchors are counted over the corpus; windows of anchors that
occur once cannot repeat. Where all occurrences of an anchor have the same context (the text
that its windows span), all their windows repeat. Only the distinct contexts of the
remaining anchors are sorted: they are dealt out by anchor and by the part of the
context that all windows of a role hold, and each task sorts the suffixes of one bucket block at a time
with a difference cover (see ``difference_cover``). A bucket with more contexts than a task should
hold (a line in a third of all texts, say) is split further: its windows are dealt out one by
one, by their own digest, and counted with pre-aggregation.

Hashes of anchors and contexts have 64 bits; the windows themselves are compared by their bytes,
except where whole contexts are equal by hash and in the buckets that are split (128-bit digests).

Defined cases: null text is empty; texts under 200 bytes keep everything. Rows that share a
``doc_id`` are separate documents; repeated rows and exact copies are occurrences elsewhere.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize

from .arrow import ranges, text_slices
from .difference_cover import DEPTH, Block
from .ngram_join import _POWERS, _mix, _powers

GRAM = 64
SPREAD = DEPTH - GRAM + 1       # grams of a window
SIDE = (SPREAD - 1) // 2        # context bytes beside the gram that every window of a role holds
BYTES = 2 << 20                 # text hashed at once
SUFFIXES = 1 << 18              # suffixes sorted at once
HOT_CONTEXTS = 20_000           # contexts of a bucket that one task holds (some 5 MB)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from block-wise running minima."""
    n = len(x) - width + 1
    pad = -len(x) % width
    grid = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchors_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Anchors of all windows: row, gram hash, context hash, position, largest and smallest offset."""
    keep = [i for i, t in enumerate(texts) if len(t) >= DEPTH]
    lens = np.array([len(texts[i]) for i in keep], dtype=np.int64)
    if not len(lens):
        return {k: np.zeros(0, dtype=np.int64) for k in ("row", "h", "ctx", "pos", "far", "near")}
    raw = np.frombuffer(b"".join(texts[i] for i in keep), dtype=np.uint8)
    begin = np.cumsum(lens) - lens
    n = len(raw)
    up, down = _powers(n + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_POWERS["letters"][raw] * up[:n])])
    grams = _mix((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    bits = np.uint64(max(22, int(n).bit_length()))
    # Smallest hash first, then the leftmost position; grams that cross into the next text are never
    # inside a valid window.
    packed = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min(packed, SPREAD)
    window = ranges(begin, lens - DEPTH + 1)
    at = (least[window] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(lens)), lens - DEPTH + 1)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]))
    lo, hi = window[new], window[np.concatenate([new[1:], [len(window)]]) - 1]
    p, own = at[new], owner[new]
    # The context with its place around the anchor.
    ctx = _mix((total[hi + DEPTH] - total[lo]) * down[lo] + ((p - lo) * 256 + (p - hi)).astype(np.uint64))
    return {"row": np.array(keep, dtype=np.int64)[own], "h": grams[p].view(np.int64), "ctx": ctx.view(np.int64),
            "pos": p - begin[own], "far": p - lo, "near": p - hi}


def _bytes(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def anchors(docs: DataFrame) -> DataFrame:
    """``tid, h, ctx, pos, far, near`` of every anchor; ``tid`` is the hash of the text."""

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, limit=BYTES):
                a = anchors_of(_bytes(b.column("text")))
                tid = b.column("tid").take(pa.array(a["row"]))
                yield pa.RecordBatch.from_arrays(
                    [tid, pa.array(a["h"]), pa.array(a["ctx"]), pa.array(a["pos"].astype(np.int32)),
                     pa.array(a["far"].astype(np.int16)), pa.array(a["near"].astype(np.int16))],
                    ["tid", "h", "ctx", "pos", "far", "near"])

    return docs.select("tid", "text").mapInArrow(run, "tid long, h long, ctx long, pos int, far short, near short")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Context bytes of the wanted anchors, dealt out as ``bucket, h, ctx, n, far, near, part``.

    A window with offset ``o`` before the gram reaches ``SPREAD - 1 - o`` bytes past it, so the
    windows of one role (offset above ``SIDE`` or not) all hold ``SIDE`` bytes on one side of the gram.
    These bytes join the bucket's key: a common line in different surroundings spreads out.
    """
    per_text = wanted.groupBy("tid").agg(F.collect_list(F.struct("pos", "far", "near", "h", "ctx", "n")).alias("marks"))
    joined = docs.select("tid", "text").join(per_text, "tid")

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, limit=BYTES):
                out: dict[str, list] = {k: [] for k in ("bucket", "h", "ctx", "n", "far", "near", "part")}
                for t, marks in zip(_bytes(b.column("text")), b.column("marks").to_pylist()):
                    for m in marks:
                        p = m["pos"]
                        for far, near, side in ((m["far"], max(m["near"], SIDE + 1), t[p - SIDE:p]),
                                                (min(m["far"], SIDE), m["near"], t[p + GRAM:p + GRAM + SIDE])):
                            if far < near:
                                continue
                            key = hashlib.blake2b(side, digest_size=8, key=m["h"].to_bytes(8, "little", signed=True),
                                                  person=b"right" if far <= SIDE else b"left").digest()
                            out["bucket"].append(int.from_bytes(key, "little", signed=True))
                            out["part"].append(t[p - far:p - near + DEPTH])
                            for k, v in (("h", m["h"]), ("ctx", m["ctx"]), ("n", m["n"]), ("far", far), ("near", near)):
                                out[k].append(v)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "part" else pa.int64()) for k, v in out.items()})

    return joined.mapInArrow(run, "bucket long, h long, ctx long, n long, far long, near long, part binary").dropDuplicates(
        ["bucket", "ctx", "far"])


def sort_block(rows: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (row, offset) of a block of whole buckets that occur more than once."""
    lens = np.array([len(x) for x in rows["part"]], dtype=np.int64)
    start = np.cumsum(lens) - lens
    far, near = np.array(rows["far"], dtype=np.int64), np.array(rows["near"], dtype=np.int64)
    n = far - near + 1
    row = np.repeat(np.arange(len(n)), n)
    step = ranges(np.zeros(len(n), dtype=np.int64), n)
    offset = far[row] - step
    names = np.unique(np.array(rows["bucket"], dtype=np.int64), return_inverse=True)[1]
    weight = np.array(rows["n"], dtype=np.int64)[row]
    # Equal windows have equal offsets, so bucket and offset name a suffix bucket.
    found = Block(b"".join(rows["part"])).repeats(start[row] + step, names[row] * SPREAD + offset, weight)
    return row[found], offset[found]


def repeated(parts: DataFrame) -> DataFrame:
    """``h, ctx, from_off, to_off``: runs of offsets whose windows repeat, per context."""

    def block(rows: dict[str, list]):
        row, off = sort_block(rows)
        if not len(row):
            return
        cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (off[1:] != off[:-1] - 1)]))
        last = np.concatenate([cut[1:], [len(row)]]) - 1
        yield pa.RecordBatch.from_pydict({
            "h": pa.array(np.array(rows["h"], dtype=np.int64)[row[cut]]), "ctx": pa.array(np.array(rows["ctx"], dtype=np.int64)[row[cut]]),
            "from_off": pa.array(off[cut]), "to_off": pa.array(off[last])})

    def pieces(rows: dict[str, list]):
        """A block as it is, or cut by offsets if one bucket alone is too large for a block."""
        total = sum(f - n + 1 for f, n in zip(rows["far"], rows["near"]))
        if total <= 2 * SUFFIXES:
            yield from block(rows)
            return
        width = max(1, SPREAD * SUFFIXES // total)
        for top in range(SPREAD - 1, -1, -width):
            at = [i for i, (f, n) in enumerate(zip(rows["far"], rows["near"])) if f >= top - width + 1 and n <= top]
            if not at:
                continue
            cut = {k: [rows[k][i] for i in at] for k in ("bucket", "h", "ctx", "n")}
            cut["far"] = [min(rows["far"][i], top) for i in at]
            cut["near"] = [max(rows["near"][i], top - width + 1) for i in at]
            cut["part"] = [rows["part"][i][rows["far"][i] - f:rows["far"][i] - n + DEPTH]
                           for i, f, n in zip(at, cut["far"], cut["near"])]
            yield from block(cut)

    names = parts.columns

    def run(batches):
        held: dict[str, list] = {k: [] for k in names}
        size, last = 0, None
        for b in batches:
            cols = {k: b.column(k).to_pylist() for k in names}
            for i, bucket in enumerate(cols["bucket"]):
                if bucket != last and size >= SUFFIXES:
                    yield from pieces(held)
                    held, size = {k: [] for k in names}, 0
                for k in held:
                    held[k].append(cols[k][i])
                size += cols["far"][i] - cols["near"][i] + 1
                last = bucket
        if size:
            yield from pieces(held)

    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, "h long, ctx long, from_off long, to_off long")


def repeated_in_hot(parts: DataFrame) -> DataFrame:
    """``h, ctx, from_off, to_off`` for buckets too large for a task: windows counted by their digest."""

    def windows(batches):
        for b in batches:
            h, ctx, n, far, near, part = (b.column(k).to_pylist() for k in ("h", "ctx", "n", "far", "near", "part"))
            for i in range(0, b.num_rows, 1000):
                rows = [(h[k], ctx[k], n[k], f, hashlib.blake2b(part[k][far[k] - f:far[k] - f + DEPTH], digest_size=16).digest())
                        for k in range(i, min(i + 1000, b.num_rows)) for f in range(far[k], near[k] - 1, -1)]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())],
                                                     ["h", "ctx", "n", "off", "digest"])

    w = parts.select("h", "ctx", "n", "far", "near", "part").mapInArrow(
        windows, "h long, ctx long, n long, off long, digest binary")
    often = w.groupBy("digest").agg(F.sum("n").alias("times")).filter("times > 1").select("digest")
    return w.join(often, "digest").select("h", "ctx", F.col("off").alias("from_off"), F.col("off").alias("to_off"))


def covered(docs: DataFrame) -> DataFrame:
    """``tid, spans``: byte intervals ``(start, end)`` of repeated windows per text, overlaps included."""
    found = anchors(docs)
    # Per anchor: its occurrences, and whether they all have one context.
    hot = materialize(found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), (F.min("ctx") == F.max("ctx")).alias("plain"))
                           .filter("n > 1").select("h", "plain"), "suffix-hot")
    again = materialize(found.join(hot, "h"), "suffix-anchors")
    plain = again.filter("plain").select(
        "tid", (F.col("pos") - F.col("far")).alias("a"), (F.col("pos") - F.col("near") + DEPTH).alias("b"))
    mixed = again.filter("not plain")
    wanted = (mixed.groupBy("h", "ctx").agg(F.min(F.struct("tid", "pos", "far", "near")).alias("m"), F.count(F.lit(1)).alias("n"))
                   .select("m.*", "h", "ctx", "n"))
    parts = materialize(_contexts(docs, wanted), "suffix-contexts")
    large = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_CONTEXTS).select("bucket")
    runs = materialize(repeated(parts.join(large, "bucket", "left_anti")).unionByName(
        repeated_in_hot(parts.join(large, "bucket", "left_semi"))), "suffix-runs")
    sorted_ = mixed.join(runs, ["h", "ctx"]).select(
        "tid", (F.col("pos") - F.col("from_off")).alias("a"), (F.col("pos") - F.col("to_off") + DEPTH).alias("b"))
    return plain.unionByName(sorted_).distinct().groupBy("tid").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def union_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of intervals; touching intervals become one."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.concatenate([[True], a[1:] > b[:-1]])
    return a[first], b[np.concatenate([np.flatnonzero(first)[1:], [len(a)]]) - 1]


def remove(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row; ``kept``: remaining bytes."""
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("tid"))
    joined = d.join(materialize(covered(d), "suffix-spans"), "tid", "left").select("doc_id", "text", "spans")

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, limit=BYTES):
                texts = _bytes(b.column("text"))
                removed, n_spans, kept = [], [], []
                lists = b.column("spans")
                flat = lists.flatten()
                a_all = flat.field("a").to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, dtype=np.int64)
                b_all = flat.field("b").to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, dtype=np.int64)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                end = np.cumsum(n)
                for t, e, k in zip(texts, end, n):
                    if not k:
                        removed.append(0), n_spans.append(0), kept.append(t)
                        continue
                    x, y = union_of(a_all[e - k:e].astype(np.int64), b_all[e - k:e].astype(np.int64))
                    removed.append(int((y - x).sum())), n_spans.append(len(x))
                    kept.append(b"".join(t[u:v] for u, v in zip([0, *y], [*x, len(t)])))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(n_spans, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                     pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
