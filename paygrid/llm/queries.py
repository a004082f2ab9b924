"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import byte_bpe, conversation_repair, language_id, mixing, ngram_join, phrases, pii, quality_classifier, quality_rules, spotsigs, suffix_dedup, toxicity, url_filter
from .common import read_table
from .oracle import ORACLE

QUERIES = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f
    return add


@query("op1_ngram_join")
def op1(spark, sf_dir):
    return ngram_join.join(read_table(spark, sf_dir, "documents"), n=3, percent=90)


@query("op2_language_id")
def op2(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    return toxicity.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op4_suffix_dedup")
def op4(spark, sf_dir):
    return suffix_dedup.remove(read_table(spark, sf_dir, "documents")).drop("kept")


@query("op5_quality_rules")
def op5(spark, sf_dir):
    q = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "fail_bits")


@query("op6_spotsigs")
def op6(spark, sf_dir):
    return spotsigs.fingerprints(read_table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def op7(spark, sf_dir):
    import public_tokenizers

    return byte_bpe.digests(read_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op8_pii")
def op8(spark, sf_dir):
    return pii.detect(read_table(spark, sf_dir, "documents"))


@query("op9_source_mix")
def op9(spark, sf_dir):
    m = mixing.mix(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", F.get("slots", F.lit(0))["slot"].alias("first_slot"))


@query("op10_url_filter")
def op10(spark, sf_dir):
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


@query("op11_quality_classifier")
def op11(spark, sf_dir):
    return quality_classifier.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op12_phrases")
def op12(spark, sf_dir):
    return phrases.mine(read_table(spark, sf_dir, "documents"))


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    return conversation_repair.repair(read_table(spark, sf_dir, "conversations"))
