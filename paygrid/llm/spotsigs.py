"""Document fingerprints by SpotSigs (DataFrame functions only).

A signature is an anchor (a common word) with the next ``CHAIN`` content words after it,
common words in between skipped. A document's fingerprint is its set of signature hashes;
likeness is the Jaccard coefficient of two sets. ``near_pairs`` compares only sets whose
lengths allow the threshold, found through their rarest signatures.

Defined cases: null text is the empty text; a text without words has the empty set. A text
without any signature (no anchor, or nothing after it) uses every word as an anchor of the
two words after it; with fewer than three words, the whole sequence is its one signature.
Two empty sets have likeness 1, an empty and another set 0. Equal texts have equal
fingerprints. Rows with equal ids are ordered by a hash of their text (and share a task only as
far as they repeat one text). Null ids come last in the descending order. A table of one row is its own next document; an empty table gives an
empty result. Columns other than ``doc_id, text`` are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from paygrid.session import materialize

from .common import BLANKS

# Common words of English, German, French and Spanish that anchor signatures.
ANCHORS = (
    "a an and are as at be by for from had has have he her his i in is it its not of on or she that the their "
    "them they this to was we were which with you "
    "als auf aus bei das dem den der des die ein eine einem einen einer es für im ist mit nicht sich sie sind "
    "und von war wie zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne ou par pas pour qui que sa se "
    "ses son sont sur un une "
    "al como con del el ella en era esta está las lo los más no para pero por que se sin su sus una uno y"
).split()
CHAIN = 2
PUNCTUATION = ".,;:!?\"()[]{}«»“”„…|"
# Bounds of id ranges are searched in blocks of this many.
BLOCK = 128


def add_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with column ``out``: sorted distinct 32-bit hashes of the signatures of column ``text``.

    Each step is a column of its own: an array built inside a lambda would be built again
    for every element of the outer array.
    """
    kept = df.columns
    flat = F.trim(F.translate(F.lower(F.coalesce(F.col(text), F.lit(""))), PUNCTUATION + BLANKS,
                              " " * (len(PUNCTUATION) + len(BLANKS))))
    anchor = lambda x: x.isin(*ANCHORS)
    short = lambda h: F.pmod(h, F.lit(1 << 32))
    d = df.withColumn("_flat", flat)
    d = d.withColumn("_t", F.when(F.col("_flat") == "", F.array().cast("array<string>")).otherwise(F.split("_flat", " +")))
    d = d.withColumns({
        "_spots": F.filter(F.transform("_t", lambda x, i: F.when(anchor(x), i).otherwise(F.lit(-1))), lambda i: i >= 0),
        "_content": F.filter("_t", lambda x: ~anchor(x))})
    d = d.withColumn("_n", F.size("_content"))
    # The k-th anchor stands at i, so i - k content words come before it.
    d = d.withColumn("_sigs", F.filter(F.transform("_spots", lambda i, k: F.when(
        i - k + (CHAIN - 1) < F.col("_n"),
        short(F.xxhash64(F.get("_t", i), *[F.get("_content", i - k + c) for c in range(CHAIN)])))),
        lambda h: h.isNotNull()))
    n = F.size("_t")
    dense = F.transform(F.sequence(F.lit(0), n - 3),
                        lambda i: short(F.xxhash64(*[F.get("_t", i + c) for c in range(3)])))
    rest = (F.when(n == 0, F.array().cast("array<bigint>"))
             .when(n < 3, F.array(short(F.xxhash64(F.array_join("_t", " "))))).otherwise(dense))
    sigs = F.when(F.size("_sigs") > 0, F.col("_sigs")).otherwise(rest)
    return d.withColumn(out, F.sort_array(F.array_distinct(sigs))).select(*kept, out)


def as_text(sigs: Column) -> Column:
    """Fingerprint text: 8 hex digits per signature, ascending."""
    return F.array_join(F.transform(sigs, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard coefficient of two sorted distinct arrays; 0 where the lengths rule out ``least``."""
    na, nb = F.size(a), F.size(b)
    inter = F.size(F.array_intersect(a, b))
    bound = F.least(na, nb) < F.greatest(na, nb) * F.lit(least)
    return (F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0) | bound, F.lit(0.0))
             .otherwise(inter / (na + nb - inter)))


def near_pairs(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints with likeness of at least ``least``, once each.

    ``sets``: ``id, sigs``, one row per distinct set. Sets are partitioned by length: classes
    grow by ``1 / least``, so partners lie in the same or the next class. Within a class two
    sets meet on one of their rarest signatures (prefix filter).
    """
    df_ = sets.select("id", F.explode("sigs").alias("s"))
    freq = df_.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = materialize(df_.join(freq, "s").groupBy("id")
                         .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("o")), "spot-ranked")
    n = F.size("o")
    prefix = F.slice("o", F.lit(1), n - F.ceil(n * F.lit(least) - 1e-9).cast("int") + 1)
    cls = F.floor(F.log(n.cast("double")) / F.lit(-math.log(least)) + 1e-9).cast("int")
    posts = ranked.select("id", cls.alias("cls"), n.alias("n"), F.explode(prefix).alias("p")).select(
        "id", "cls", "n", F.col("p.s").alias("s"))
    probe = posts.select(F.col("id").alias("x"), F.col("n").alias("nx"), "s", F.explode(F.array("cls", F.col("cls") + 1)).alias("cls"),
                         F.col("cls").alias("own"))
    cand = (probe.join(posts, ["s", "cls"])
                 .filter(((F.col("own") < F.col("cls")) | (F.col("x") < F.col("id")))
                         & (F.least("n", "nx") >= F.greatest("n", "nx") * least) & (F.col("x") != F.col("id")))
                 .select("x", "id").distinct())
    one, two = sets.select(F.col("id").alias("x"), F.col("sigs").alias("sx")), sets.select("id", "sigs")
    likeness = jaccard(F.col("sx"), F.col("sigs"), least)
    return (cand.join(one, "x").join(two, "id").withColumn("likeness", likeness).filter(F.col("likeness") >= least)
                .select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b"), "likeness"))


def _rank(cuts: list[int], before) -> Column:
    """How many of the ascending ``cuts`` satisfy ``before``, which holds up to some cut: whole blocks of ``BLOCK`` first."""
    if not cuts:
        return F.lit(0)
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    if len(cuts) <= BLOCK:
        return F.size(F.filter(array(cuts), before))
    whole = F.size(F.filter(array(cuts[BLOCK - 1::BLOCK]), before)) * BLOCK
    return whole + F.size(F.filter(F.slice(array(cuts), whole + 1, F.lit(BLOCK)), before))


def id_ranges(docs: DataFrame, n_ranges: int) -> Column:
    """Number of the range of a row of ``doc_id, tie``; no range holds much more than an even share.

    Ranges ascend with the id and, within an id, descend with the tie. Bounds are quantiles of
    the ids, so gaps and outliers do not matter. An id or the null that fills several ranges is
    split among them by the tie, a hash of the text; null ids have negative ranges. The driver
    reads ``n_ranges`` numbers, whatever the size of the table.
    """
    steps = [i / n_ranges for i in range(1, n_ranges)] or [0.5]
    # The sketch errs by a twentieth of a range at most.
    cuts, n, nulls = docs.agg(F.percentile_approx("doc_id", steps, 20 * n_ranges), F.count(F.lit(1)),
                              F.count_if(F.col("doc_id").isNull())).first()
    cuts = sorted(cuts or [])
    # The upper 32 bits of the tie as a number from 0 on, in the order of the ties.
    spread = F.shiftright("tie", 32) + (1 << 31)
    part = lambda pieces: F.shiftright(spread * pieces, 32)
    upto, below = _rank(cuts, lambda c: c <= F.col("doc_id")), _rank(cuts, lambda c: c < F.col("doc_id"))
    null_pieces = max(1, math.ceil(nulls * n_ranges / max(n, 1)))
    return F.when(F.col("doc_id").isNull(), -1 - part(F.lit(null_pieces).cast("long"))).otherwise(
        upto - part((upto - below).cast("long"))).cast("int")


def with_next(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """``doc_id, text, next_text, sigs, next_sigs``: each document beside the next in descending id order.

    Texts are shuffled once, into id ranges of about equal counts; the first document of each
    range is also sent to the range above it, so no window crosses a range.
    """
    spark = docs.sparkSession
    n_ranges = n_ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", tie)
    d = d.withColumn("range", id_ranges(docs.select("doc_id"), n_ranges))
    first = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "tie")
    tops = d.groupBy("range").agg(F.min(first).alias("first"), F.min_by("doc_id", first).alias("top"))
    up = W.partitionBy(F.lit(1)).orderBy("range")
    lowest = F.min("range").over(W.partitionBy(F.lit(1)))
    # At most 2 * n_ranges + 1 rows: each range's top document goes to the next range above, the last one's to the lowest.
    tops = tops.select("top", F.col("first.tie").alias("top_tie"), F.coalesce(F.lead("range").over(up), lowest).alias("goes_to"))
    tops = materialize(tops.coalesce(1), "spot-tops")
    heads = (d.join(F.broadcast(tops), F.col("tie").eqNullSafe(F.col("top_tie")) & F.col("doc_id").eqNullSafe(F.col("top")))
              .groupBy("goes_to").agg(F.first("text").alias("text"))
              .select(F.lit(None).cast("long").alias("doc_id"), "text", tie.alias("tie"), F.col("goes_to").alias("range"),
                      F.lit(1).alias("last")))
    rows = d.withColumn("last", F.lit(0)).unionByName(heads)
    rows = add_signatures(rows, "text", "sigs")
    w = W.partitionBy("range").orderBy("last", F.col("doc_id").desc_nulls_last(), "tie")
    return (rows.withColumn("next_text", F.lead("text").over(w)).withColumn("next_sigs", F.lead("sigs").over(w))
                .filter("last = 0").select("doc_id", "text", "next_text", "sigs", "next_sigs"))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points of ``text`` replaced by the first as many (or all) of ``following``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: length, digest of the edited text, both fingerprints and their likenesses."""
    d = with_next(docs).withColumn("edit", edited(F.col("text"), F.col("next_text")))
    d = add_signatures(d, "edit", "edit_sigs")
    d = d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
                 "sigs", "next_sigs", "edit_sigs")
    return d.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sigs")).alias("fingerprint"),
                    as_text(F.col("edit_sigs")).alias("edited_fingerprint"),
                    jaccard(F.col("sigs"), F.col("edit_sigs")).alias("near_edited"),
                    jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
