"""URL filter: host and path rules, else the ratio of two character language models (DataFrame functions only).

Two variable-order Markov models (Witten-Bell interpolation, contexts of up to ``order``
characters) are fitted on the URLs that the rules accept and reject. A URL without a rule
gets the difference of its two log-likelihoods divided by its length; the threshold lies
between the class means, nearer to the class with the smaller spread. The models read whole
URLs, case and digits kept; equal URLs are one pattern with counts.

Defined cases: a null URL or one without ``://`` has empty host and path, no rule and is
judged as its text (null: empty) by the models; without training URLs of both classes
every URL without a rule is allowed. An empty table gives an empty result; repeated
rows are kept; columns other than ``page_id, url`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paygrid.session import materialize

from .common import ascii_lower

# (rule, verdict); a rule is host/path-prefix. The list is a parameter of a few entries.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
ORDER = 4
ALPHABET = 256      # symbols that the order-0 model shares its unseen mass over
START, END = "\x02", "\x03"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null without one)."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return rule, verdict


def gram_scores(patterns: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log P(last char | rest) under the accepting minus the rejecting model.

    ``patterns``: ``pattern, n_allow, n_block``. Every gram of the corpus gets its ratio, so a
    scored URL needs one lookup of its longest gram per character.
    """
    padded = F.concat(F.lit(START * order), F.col("pattern"), F.lit(END))
    at = patterns.select("n_allow", "n_block", padded.alias("p")).select(
        "*", F.explode(F.sequence(F.lit(1), F.length("p") - order)).alias("i"))
    at = at.groupBy(F.substring(F.col("p"), F.col("i"), F.lit(order + 1)).alias("full")).agg(
        F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
    grams = at.select("n_allow", "n_block", F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("k"), "full")
    grams = grams.groupBy("k", F.expr("right(full, k)").alias("gram")).agg(
        F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
    grams = materialize(grams.withColumn("ctx", F.expr("left(gram, k - 1)")), "url-grams")
    ctx = grams.groupBy("k", "ctx").agg(
        F.sum("n_allow").alias("s_allow"), F.sum("n_block").alias("s_block"),
        F.sum((F.col("n_allow") > 0).cast("long")).alias("t_allow"),
        F.sum((F.col("n_block") > 0).cast("long")).alias("t_block"))
    g = grams.join(ctx, ["k", "ctx"])

    def smooth(side: str, lower: Column) -> Column:
        s, t = F.col(f"s_{side}"), F.col(f"t_{side}")
        return F.when(s + t > 0, (F.col(f"n_{side}") + t * lower) / (s + t)).otherwise(lower)

    level = g.filter("k = 1").select("gram", *[smooth(x, F.lit(1.0 / ALPHABET)).alias(f"p_{x}")
                                               for x in ("allow", "block")])
    for k in range(2, order + 2):
        low = level.select(F.col("gram").alias("tail"), "p_allow", "p_block")
        up = g.filter(F.col("k") == k).withColumn("tail", F.expr(f"right(gram, {k - 1})")).join(low, "tail")
        level = up.select("gram", *[smooth(x, F.col(f"p_{x}")).alias(f"p_{x}") for x in ("allow", "block")])
    return level.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def score_patterns(patterns: DataFrame, order: int = ORDER) -> DataFrame:
    """``pattern, llr``: length-normalised log-likelihood difference of each distinct URL."""
    padded = F.concat(F.lit(START * order), F.col("pattern"), F.lit(END))
    at = patterns.select("pattern", padded.alias("p")).select(
        "pattern", F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - order),
                                         lambda i: F.substring(F.col("p"), i, F.lit(order + 1)))).alias("gram"))
    at = at.join(gram_scores(patterns, order), "gram")
    return at.groupBy("pattern").agg(F.round(F.avg("ratio"), 9).alias("llr"))


def judge(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, llr`` for every row of ``pages``."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.coalesce("url", F.lit("")).alias("pattern"))
    rule, says = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("says", says)
    patterns = materialize(rows.groupBy("pattern").agg(
        F.count(F.when(F.col("says") == "allow", 1)).alias("n_allow"),
        F.count(F.when(F.col("says") == "block", 1)).alias("n_block")), "url-patterns")
    scored = materialize(score_patterns(patterns, order).join(patterns, "pattern"), "url-scores")

    def moments(side: str):
        n = F.sum(f"n_{side}")
        mean = F.sum(F.col("llr") * F.col(f"n_{side}")) / F.nullif(n, F.lit(0))
        square = F.sum(F.col("llr") * F.col("llr") * F.col(f"n_{side}")) / F.nullif(n, F.lit(0))
        return mean.alias(f"m_{side}"), F.sqrt(F.greatest(square - mean * mean, F.lit(1e-12))).alias(f"d_{side}")

    m = scored.agg(*moments("allow"), *moments("block")).first()
    if m["m_allow"] is None or m["m_block"] is None:
        cut = float("-inf")
    else:
        cut = (m["m_allow"] * m["d_block"] + m["m_block"] * m["d_allow"]) / (m["d_allow"] + m["d_block"])
    out = rows.join(scored.select("pattern", "llr"), "pattern")
    by_model = F.when(F.col("llr") >= F.lit(cut), F.lit("allow")).otherwise(F.lit("block"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("says", by_model).alias("verdict"), "llr")
