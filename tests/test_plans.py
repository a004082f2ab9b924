"""Plan-shape checks: no cartesian products, pruned scans, bounded exchanges on the flagship."""

import pytest

import __spark_entry__ as ent

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["divergent_contracheques", "consolidado", "cache_payload", "mapping_summary",
                                  "load_audit", "check_fk", "validation_alerts", "rubrica_quality",
                                  "entity_counts", "cache_upsert_counts", "upsert"])
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan_text(ent.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_flagship_prunes_and_shuffles_little(spark):
    df = ent.queries()["divergent_contracheques"](spark, SF)
    text = plan_text(df)
    # unused columns never leave the files
    for col in ["c_acctbal", "p_brand", "p_size", "p_retailprice", "n_regionkey"]:
        assert col not in text
    # the join key + keep-last + per-payslip aggregate
    assert text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") <= 4
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text or "IsNotNull(l_orderkey)" in text


def scratch_writes(spark, name) -> int:
    from paygrid import session

    before = len(session._SCRATCH)
    ent.queries()[name](spark, SF)
    return len(session._SCRATCH) - before


@pytest.mark.parametrize("name,most", [("consolidado", 4), ("load_errors", 4), ("cache_payload", 5), ("load_audit", 6)])
def test_few_scratch_writes(spark, name, most):
    assert scratch_writes(spark, name) <= most


@pytest.mark.parametrize("name", ["load_audit", "load_summary"])
def test_counts_come_from_the_writes(spark, name):
    """What is left to run holds the counts as literals: no frame is read to be counted."""
    text = plan_text(ent.queries()[name](spark, SF))
    assert "FileScan" not in text and "Exchange" not in text and "Join" not in text


def test_a_line_joins_its_payslip_once(spark, monkeypatch):
    from paygrid.operators import resolve
    from paygrid.plans.catalog import migration

    seen = []
    real = resolve.surrogate_keys
    monkeypatch.setattr(resolve, "surrogate_keys", lambda df, *a, **k: (seen.append(df), real(df, *a, **k))[1])
    m = migration(spark, SF)
    m.item_tagged, m.snapshot, m.rejects()
    ranked = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    lines = [p for df, p in zip(seen, ranked) if "item_hash" in df.columns]
    assert len(seen) == 3 and len(lines) == 1               # dimensions, payslips, lines
    assert sum("Join" in x and "numfunc" in x for x in lines[0].splitlines()) == 1          # the outcome map alone


def test_lines_meet_their_orders_last(spark):
    """No joined row of the source is dealt out again: the look-ups are done on either side of the last join."""
    from paygrid.sources import tables as T

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = [x for x in plan_text(T.payroll_checks(spark, SF)).splitlines() if "Join" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "l_orderkey" in joins[0] and len(joins) == 4


def test_lines_are_ranked_without_order_and_hash(spark):
    """The written lines hold neither the source order nor what follows from other columns, and are numbered without a join."""
    from paygrid.plans.catalog import migration

    m = migration(spark, SF)
    text = m.item._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join" in x for x in text.splitlines()) == 1                                 # the offsets of the ranges
    assert "src_order" not in text
    written = [x for x in text.splitlines() if "Relation" in x]
    assert written and not any("item_hash" in x or "valor_total_item" in x for x in written)
