"""The pipeline on small tables: each stage against what its operator decides, and the registered queries."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
import corpus_pipeline as C
from paygrid.llm import mixing, ngram_join, pii, toxicity
from paygrid.llm.common import n_words
from paygrid.llm.queries import ORACLE, QUERIES
from paygrid.session import _SCRATCH, ensure_checkpoint_dir, scratch_mark
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    cols, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(df.columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(ent.queries())
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(1).withColumns(
        {"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")}))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = C.drop_toxic(spark, docs, SF)
    bad = {r.doc_id for r in toxicity.judge(docs, labels).filter("predicted = 1").collect()}
    assert Counter(r.doc_id for r in one.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id not in bad)
    two = C.drop_near_copies(spark, one, SF)
    groups = ngram_join.join(one, 5, 80).filter("doc_id is not null").select("component_id").distinct().count()
    assert two.filter("doc_id is not null").count() == groups
    three = C.redact_pii(spark, two, SF)
    assert three.count() == two.count() and not any(pii.base_spans(r.text or "")[0] for r in three.collect())
    four = C.mix_sources(spark, three, SF)
    assert all(x.columns == docs.columns for x in (one, two, three, four))
    sized = three.select("source", n_words(F.col("text")).alias("size"))
    after = {r.source: r.n for r in four.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("n")).collect()}
    longest = sized.agg(F.max("size")).first()[0]
    for r in mixing.source_targets(sized).collect():       # documents stay whole: off by half of one at most
        assert abs(after.get(r.source, 0) - r.target) <= longest / 2 + 1
    assert max(Counter(r.doc_id for r in four.collect()).values()) <= 3
    last = C.encode(spark, four, SF)
    assert last.count() == four.count() and last.filter("n_tokens = 0").count() == 0


def test_pipeline_leaves_only_its_result(spark):
    start, folder = scratch_mark(), ensure_checkpoint_dir(spark).removeprefix("file:") + "/paygrid-tmp"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    done = C.run(spark, SF)
    assert [os.path.basename(p) for p in _SCRATCH[start:]] == list(set(os.listdir(folder)) - before)
    assert len(_SCRATCH) == start + 1 and done.count() > 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
