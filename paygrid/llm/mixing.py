"""Mixing sources to target weights by a low-discrepancy slot schedule (DataFrame functions only).

Sources in code-point order (null last) weigh ``1, 2, 3`` repeating and share all words
of the corpus; a target stops at ``max_repeats`` times its source's size and the excess is
reshared by weight (water filling). The words a source contributes are its documents in a
hash-shuffled order, read cyclically and cut into equal blocks of ``block_tokens`` words.
Golden-ratio points mapped through the cumulative slot shares say which source feeds each
slot; the slot's rank within its source names the block it takes.

Defined cases: null text or no word: size 0, never taken. Null source: a source of its own,
ordered last. Null ids are shuffled by text. Repeated rows are separate documents.
An empty table gives an empty result. Columns other than those read are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from paygrid.session import materialize

from .common import n_words

BLOCK_TOKENS = 512
MAX_REPEATS = 3
# Multiplier of the golden-ratio sequence in 31-bit integers: round(0.6180339887 * 2**31), odd.
GOLDEN_31 = 1327217885
CHUNK_SLOTS = 1 << 16
GRID = 1 << 12


def source_targets(sized: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``sid, source, source_size, target`` (double).

    Works on one row per source; the windows below never see documents.
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    src = src.withColumn("weight", (F.col("sid") - 1) % 3 + 1)
    src = src.withColumn("cap", F.col("source_size") * max_repeats)
    whole = W.partitionBy(F.lit(1))
    before = W.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(
        W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    src = (src.withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), zero))
              .withColumn("rest_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)))
    # A source is capped when even its share of what the smaller ratios leave exceeds its cap.
    src = src.withColumn("fits", F.col("rest") * F.col("weight") <= F.col("cap") * F.col("rest_weight"))
    src = src.withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "sid",
                                                                      "rest", "rest_weight"))).over(whole))
    share = F.col("level.rest") * F.col("weight") / F.col("level.rest_weight")
    target = F.when(F.col("level").isNull() | (share > F.col("cap")), F.col("cap").cast("double")).otherwise(share)
    return src.select("sid", "source", "source_size", target.cast("double").alias("target"))


def schedule(spark: SparkSession, targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Slots ``slot, sid, rank``: which block (rank) of which source each slot takes.

    Slot ``n`` takes the source whose share of the unit interval holds ``frac(n * phi)``.
    The sequence gives every source its share up to a few slots; slots beyond a source's
    need are left out and missing ones follow at the end of the schedule, so each source
    ends with exactly ``ceil(floor(target) / block_tokens)`` slots.
    """
    need = targets.select("sid", F.ceil(F.floor("target") / block_tokens).alias("n_slots")).filter("n_slots > 0")
    run = W.partitionBy(F.lit(1)).orderBy("sid").rowsBetween(W.unboundedPreceding, 0)
    need = (need.withColumn("upto", F.sum("n_slots").over(run))
                .withColumn("total", F.sum("n_slots").over(W.partitionBy(F.lit(1))))
                .withColumn("lo", (F.col("upto") - F.col("n_slots")) / F.col("total"))
                .withColumn("hi", F.col("upto") / F.col("total")))
    total = need.agg(F.max("total")).first()[0] or 0
    # An equi-join on a grid of the unit interval stands in for a range join.
    cells = need.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1).cast("long")))))
    slots = spark.range(total).select(
        F.col("id").alias("slot"), (F.pmod(F.col("id") % (1 << 31) * GOLDEN_31, F.lit(1 << 31)) / (1 << 31)).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * GRID))
    hit = (slots.join(cells.select("cell", "sid", "lo", "hi"), "cell")
                .filter("u >= lo and u < hi").select("slot", "sid"))
    hit = hit.withColumn("chunk", F.floor(F.col("slot") / CHUNK_SLOTS))
    # Rank in two levels, so a source with a third of the slots is not one window.
    per = hit.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    per = per.withColumn("base", F.coalesce(F.sum("n").over(
        W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranked = (hit.withColumn("k", F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")))
                 .join(per.select("sid", "chunk", "base"), ["sid", "chunk"])
                 .select("slot", "sid", (F.col("base") + F.col("k") - 1).alias("rank")))
    kept = ranked.join(need.select("sid", "n_slots"), "sid").filter("rank < n_slots").drop("n_slots")
    got = per.groupBy("sid").agg(F.sum("n").alias("got"))
    tail = (need.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
                .filter("got < n_slots")
                .withColumn("rank", F.explode(F.sequence(F.col("got"), F.col("n_slots") - 1)))
                .select((F.lit(total) + F.col("upto") - F.col("n_slots") + F.col("rank")).alias("slot"), "sid", "rank"))
    return kept.select("slot", "sid", "rank").unionByName(tail)


def mix(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), block_tokens: int = BLOCK_TOKENS,
        max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per document: ``keys, size, source, source_size, target, taken, slots``.

    ``taken``: words taken, repeats counted; ``slots``: for every pass that takes from the document, its
    first slot in the schedule and where it starts in the stream of the source (the order within a slot).
    """
    # Rows without id are shuffled by their text, so that they spread over the buckets below.
    shuffled = F.md5(F.coalesce(F.col(keys[0]).cast("string"), F.col("text"), F.lit("")))
    sized = docs.select(*keys, "source", n_words(F.col("text")).alias("size"), shuffled.alias("h"))
    # Written once: the totals, the prefix sums and the join below read the sizes, not the texts.
    sized = materialize(sized, "mix-sizes")
    targets = materialize(source_targets(sized, max_repeats).coalesce(1), "mix-targets")
    slots = schedule(docs.sparkSession, targets, block_tokens).select("sid", F.col("rank").alias("block"), "slot")

    d = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    # Rows without words do not move the offset that tells equal rows apart below, so they stay out of the aggregate.
    empty = d.filter("size = 0").select(*keys, "size", "source", "source_size", "target", F.lit(0).cast("long").alias("taken"),
                                       F.array().cast("array<struct<slot:bigint,start:bigint>>").alias("slots"))
    d = d.filter("size > 0").withColumn("bucket", F.substring("h", 1, 3))
    # Offsets in the shuffled stream of the source: bucket sums first, then within a bucket.
    base = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    base = base.withColumn("base", F.coalesce(F.sum("words").over(
        W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inner = W.partitionBy("sid", "bucket").orderBy("h", *keys, "size").rowsBetween(W.unboundedPreceding, -1)
    d = (d.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
          .join(base.select("sid", "bucket", "base"), ["sid", "bucket"])
          .withColumn("off", F.col("base") + F.col("inner"))
          .withColumn("goal", F.floor("target")))
    # Every pass over the source that starts below the target, then every block the pass touches.
    passes = F.when(F.col("off") < F.col("goal"), F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("goal") - 1 - F.col("off")) / F.col("source_size"))))
    d = d.select("*", F.explode_outer(passes).alias("pass"))
    d = (d.withColumn("start", F.col("off") + F.col("pass") * F.col("source_size"))
          .withColumn("end", F.least(F.col("start") + F.col("size"), F.col("goal"))))
    d = d.select("*", F.explode_outer(F.when(F.col("pass").isNotNull(), F.sequence(
        F.floor(F.col("start") / block_tokens), F.floor((F.col("end") - 1) / block_tokens)))).alias("block"))
    j = d.join(slots, ["sid", "block"], "left")
    part = F.when(F.col("slot").isNotNull(), F.least("end", (F.col("block") + 1) * block_tokens)
                  - F.greatest("start", F.col("block") * block_tokens)).otherwise(F.lit(0))
    row = [*keys, "size", "source", "source_size", "target", "off"]
    per_pass = j.groupBy(*row, "start").agg(F.sum(part).cast("long").alias("taken"), F.min("slot").alias("slot"))
    # A source has at most ``max_repeats`` passes, so the list of a document is short.
    first = F.when(F.col("slot").isNotNull(), F.struct("slot", "start"))
    taken = per_pass.groupBy(*row).agg(F.sum("taken").alias("taken"), F.sort_array(F.collect_list(first)).alias("slots")).drop("off")
    return taken.unionByName(empty)


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as many times as its taken words cover it.

    A pass that covers at least half of a document keeps that copy, whole; documents that the
    mix leaves out, and those without words, are not part of it. Columns are those of ``docs``;
    rows are in the order of the schedule, each copy at the first slot that its pass feeds.
    """
    others = [c for c in docs.columns if c != "doc_id"]
    # The row travels as one struct, so its column names cannot clash with those used here.
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"), F.xxhash64(*others).alias("key"))
    plan = mix(rows, ("doc_id", "key"))
    n = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int")
    copies = plan.filter("taken > 0").select(F.col("doc_id").alias("id"), F.col("key").alias("k"),
                                             F.explode(F.slice("slots", F.lit(1), n)).alias("at"))
    # Equal rows share their copies: one of them stands for all.
    one = rows.select("doc_id", "key", "row").dropDuplicates(["doc_id", "key"])
    out = one.join(copies, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")))
    return out.select("row", "at").orderBy("at").select("row.*")
