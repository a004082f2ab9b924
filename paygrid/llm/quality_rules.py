"""Quality rules: one ledger of measurements and failure bits, read by versioned policies (DataFrame functions only).

Every rule is evaluated once per document; rule ``i`` sets bit ``i`` of ``fail_bits``. A
policy is a named mask of bits, so a new version of a policy, or an ablation that leaves
a rule out, is bit arithmetic on the ledger and never reads a text again.

Defined cases: a null or blank text has no words, all measurements 0, and fails
``few_words``. Repeated rows are kept. An empty table gives an empty ledger. Columns other
than ``doc_id, text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, trimmed

SYMBOLS = "#*$%&|<>"
# Rules in bit order: name -> condition over the measurements that marks a failure.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "2 * n_exclaim > n_words",
}
BASE = ("few_words", "repeated_words")
# Policies by version; each names the rules whose failure drops a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": BASE + ("symbols", "duplicate_lines", "short_words", "long_words"),
    # Repeated lines alone also mark clean lists and refrains, so v2 only measures them.
    "v2": BASE + ("symbols", "short_words", "long_words", "shouting"),
}
PRODUCTION = "v2"


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)




def measurements(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of each text, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("t"))
    d = d.withColumn("tt", trimmed(F.col("t")))
    d = d.withColumn("w", F.when(F.col("tt") == "", F.array().cast("array<string>")).otherwise(F.split("tt", " +")))
    blank = lambda line: F.trim(F.translate(line, BLANKS, " " * len(BLANKS))) != ""
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), blank))
    n = F.size("w")
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(
        F.array().cast("array<bigint>"))
    # Without a repeated window nothing is sorted by position.
    d = d.withColumn("win", windows)
    d = d.withColumn("any", F.size(F.array_distinct("win")) < F.size("win"))
    none = F.array().cast("array<int>")
    d = d.withColumn("pairs", F.when(F.col("any"), F.sort_array(F.transform(
        "win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("starts", F.when(F.col("any"), F.sort_array(F.transform(F.filter(
        "pairs", lambda p, k: (p["h"] == F.get("pairs", k - 1)["h"]).eqNullSafe(True)
        | (p["h"] == F.get("pairs", k + 1)["h"]).eqNullSafe(True)), lambda p: p["i"]))).otherwise(none))
    # Each start covers three words; the next start cuts its cover short.
    cover = F.aggregate(F.transform("starts", lambda s, k: F.least(
        F.lit(3), F.coalesce(F.get("starts", k + 1), s + 3) - s)), F.lit(0), lambda a, x: a + x)
    spaces = BLANKS + " "
    return d.select(
        "doc_id", n.cast("long").alias("n_words"),
        F.length(F.translate("t", spaces, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        cover.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("t") - F.length(F.translate("t", "!", ""))).cast("long").alias("n_exclaim"))


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus ``fail_bits``: bit i is set when rule i of ``RULES`` fails."""
    m = measurements(docs)
    bits = F.lit(0).cast("long")
    for i, cond in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return m.withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, rules: tuple[str, ...], out: str = "kept") -> DataFrame:
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask(rules))) == 0)


def ablations(led: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule: documents kept, failed by the rule, failed by it alone, kept without it.

    The ledger is first grouped by its bits (at most 2**len(RULES) rows), so every policy
    and ablation works on counts.
    """
    by_bits = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rows = [(v, r, mask(p), 1 << list(RULES).index(r)) for v, p in policies.items() for r in p]
    grid = F.explode(F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("long").alias("m"),
                                        F.lit(b).cast("long").alias("b")) for v, r, m, b in rows]))
    g = by_bits.select("fail_bits", "n", grid.alias("x")).select("fail_bits", "n", "x.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("m"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return g.groupBy("policy", "rule").agg(
        total(hit == 0).alias("kept"),
        total(F.col("fail_bits").bitwiseAND(F.col("b")) != 0).alias("failed"),
        total(hit == F.col("b")).alias("failed_alone"),
        total(hit.bitwiseAND(F.bitwise_not(F.col("b"))) == 0).alias("kept_without"))


def judge(docs: DataFrame) -> DataFrame:
    """The ledger with the base verdict and the production policy's verdict."""
    led = apply_policy(ledger(docs), POLICIES[PRODUCTION])
    return led.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(mask(BASE))) != 0)
