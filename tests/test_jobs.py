"""Run flows end to end on sf0.001: migrate twice = once, incremental = one-shot, cache refresh."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as ent
from paygrid.plans import jobs
from paygrid.plans.options import RunOptions
from paygrid.sources import tables as T
from paygrid.sources.store import Store
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
TS = dt.datetime(2026, 1, 1, 12, 0, 0)


def _snapshot(store, table):
    df = store.read(table)
    return sorted(map(tuple, df.drop("updated_at").collect()))


def test_migrate_is_idempotent(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="paygrid-store-", dir="/tmp"))
    checks, folhas = T.payroll_checks(spark, SF), T.payroll_folhas(spark, SF)
    audit1 = jobs.migrate(spark, checks, folhas, RunOptions(1997), store, TS)
    first = {t: _snapshot(store, t) for t in ["servidor", "contracheque", "contracheque_item",
                                              "contracheque_consolidado"]}
    assert audit1.count() == 1
    jobs.migrate(spark, checks, folhas, RunOptions(1997), store, TS)
    for t, rows in first.items():
        assert _snapshot(store, t) == rows, t
    audit = store.read("carga_importacao")
    assert audit.count() == 2 and set(r.status for r in audit.collect()) <= {"SUCESSO", "SUCESSO_PARCIAL"}
    # every payslip is loaded or rejected, never both
    n_src = jobs.E.contracheques(jobs.E.normalize_checks(jobs._scan(checks, folhas, RunOptions(1997))[0])).count()
    n_ok = store.read("contracheque").count()
    n_rej = store.read("carga_importacao_erro").filter(F.col("mensagem_erro").contains("para o contracheque")) \
        .filter(F.col("id_carga") == 1).count()
    assert n_ok + n_rej == n_src
    summary = jobs.refresh_cache(spark, RunOptions(1997, 3, generate_cache=True, refresh_cache_competencia=True),
                                 store, TS).first()
    assert summary["elegiveis"] == summary["processados"] == summary["inseridos"]
    again = jobs.refresh_cache(spark, RunOptions(1997, 3, generate_cache=True, refresh_cache_competencia=True),
                               store, TS).first()
    assert again["removidos"] == summary["processados"] and again["inseridos"] == summary["processados"]


def test_validate_and_dry_run(spark):
    checks, folhas = T.payroll_checks(spark, SF), T.payroll_folhas(spark, SF)
    out = jobs.validate(spark, checks, folhas, RunOptions(1996))
    m = out["mapeamento"].first()
    assert m.total_contracheques == m.mapeados_por_descricao + m.mapeados_por_fallback + m.nao_mapeados
    assert jobs.dry_run(spark, checks, folhas, RunOptions(1996)).count() == 6


def test_incremental_equals_one_shot(spark, duck):
    df = ent.queries()["incremental_load"](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ent.oracle_sql()["incremental_load"])
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest([d[0] for d in res.description], drows)[0]


def test_incremental_payslips_span_batches(spark, duck, monkeypatch):
    """Files are order-key ranges read in key order; lines of one payslip arrive in several of them."""
    from paygrid.plans import catalog
    from paygrid.streaming import incremental

    seen, load = [], incremental.load_stream
    monkeypatch.setattr(incremental, "load_stream", lambda spark, source, *a: (seen.append(source), load(spark, source, *a))[1])
    monkeypatch.setattr(catalog, "STREAM_ROWS", 2_000, raising=False)
    df = ent.queries()["incremental_load"](spark, SF)
    rows = spark.read.parquet(seen[0]).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("at"))
    spans = rows.groupBy("NUMFUNC", "NUMVINC", "MES_ANO", "NUMERO").agg(F.countDistinct("f").alias("n")).filter("n > 1").count()
    files = rows.groupBy("at").agg(F.min("SRC_ORDER.l_orderkey").alias("lo"), F.max("SRC_ORDER.l_orderkey").alias("hi")).orderBy("at").collect()
    assert spans > 0 and len(files) == 3 and all(a.hi < b.lo for a, b in zip(files, files[1:]))
    res = duck.execute(ent.oracle_sql()["incremental_load"])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([d[0] for d in res.description], res.fetchall())[0]


def test_failed_load_is_audited(spark):
    import pytest

    store = Store(spark, tempfile.mkdtemp(prefix="paygrid-store-", dir="/tmp"))
    checks = T.payroll_checks(spark, SF)
    with pytest.raises(Exception):
        jobs.load_tables(spark, checks, checks, store, TS)     # runs source with the wrong shape
    rows = store.read("carga_importacao").collect()
    assert [r.status for r in rows] == ["ERRO"] and rows[0].observacao


def test_steps_side_by_side(spark):
    """The steps of a group run at the same time, and the first error is raised once all of them have ended."""
    import threading

    import pytest

    meet, ended = threading.Barrier(3, timeout=30), []

    def step(name, bad=False):
        def run():
            meet.wait()
            ended.append((name, spark.range(5).count()))
            if bad:
                raise ValueError(name)
        return run

    with pytest.raises(ValueError, match="a"):
        jobs._side_by_side([step("a", True), step("b"), step("c")])
    assert sorted(ended) == [("a", 5), ("b", 5), ("c", 5)]


def test_later_load_stages_only_appended_lines(spark, monkeypatch):
    """What an upsert returns is scratch data: it is not written a second time before its periods are replaced."""
    from paygrid import session
    from paygrid.operators.resolve import Migration

    store = Store(spark, tempfile.mkdtemp(prefix="paygrid-store-", dir="/tmp"))
    checks, folhas = T.payroll_checks(spark, SF), T.payroll_folhas(spark, SF)
    jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    names, write = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name="tmp": (names.append(name), write(df, name))[1])
    jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    assert [n for n in names if n.startswith("stage-")] == ["stage-contracheque_item"]
    m = Migration(checks, folhas)
    m.__dict__["periods"] = [(1996, 12), (1997, 3)]
    rows = spark.createDataFrame([(1996, 12), (1997, 3), (1997, 12), (1996, 3), (None, 3), (1997, None)], "ano int, mes int")
    assert sorted(map(tuple, m.touched(rows).collect())) == [(1996, 12), (1997, 3)]
    assert " OR " not in m.touched(rows)._jdf.queryExecution().optimizedPlan().toString()


def test_later_load_takes_few_jobs(spark):
    """An upsert is one written join: repeated keys, new rows and the stored maximum are counted by that write."""
    store = Store(spark, tempfile.mkdtemp(prefix="paygrid-store-", dir="/tmp"))
    checks, folhas = T.payroll_checks(spark, SF), T.payroll_folhas(spark, SF)
    jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    assert len(set(tracker.getJobIdsForGroup(None)) - before) < 125


def test_children_are_written_after_their_parents(spark, monkeypatch):
    """A parent whose write fails leaves none of its children in the store, and the load ends as ERRO."""
    import pytest

    store = Store(spark, tempfile.mkdtemp(prefix="paygrid-store-", dir="/tmp"))
    checks, folhas = T.payroll_checks(spark, SF), T.payroll_folhas(spark, SF)
    write = Store.write_periods

    def broken(self, table, *args, **kw):
        if table == "contracheque":
            raise OSError("disk")
        return write(self, table, *args, **kw)

    monkeypatch.setattr(Store, "write_periods", broken)
    with pytest.raises(OSError, match="disk"):
        jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    assert store.read("servidor_vinculo") is not None and store.read("carga_importacao").first().status == "ERRO"
    for t in ("contracheque", "contracheque_item", "contracheque_snapshot_funcional", "contracheque_consolidado"):
        assert store.read(t) is None, t
    monkeypatch.setattr(Store, "write_periods", write)
    jobs.migrate(spark, checks, folhas, RunOptions(1997, 3), store, TS)
    ids = {r[0] for r in store.read("contracheque").select("id_contracheque").collect()}
    assert ids and {r[0] for r in store.read("contracheque_item").select("id_contracheque").collect()} <= ids


def test_few_new_rows_are_numbered_without_ranges(spark, monkeypatch):
    """An upsert's new rows get the same ids from one task as from ranges, after the stored maximum; repeats are refused."""
    import pytest

    from paygrid import session
    from paygrid.operators import dedupe, sinks

    target = spark.createDataFrame([(7, 1, "a"), (9, None, "b")], "id bigint, k bigint, v string")
    source = spark.createDataFrame([(5, "x"), (1, "y"), (None, "n"), (None, "n"), (3, "z")], "k bigint, v string")
    names, write = [], session.materialize
    monkeypatch.setattr(dedupe, "materialize", lambda df, name="tmp": (names.append(name), write(df, name))[1])
    few = sorted(map(str, sinks.upsert(target, source, ["k"], ["v"], id_col="id").collect()))
    assert names == []
    monkeypatch.setattr(dedupe, "FEW_ROWS", 0)
    assert sorted(map(str, sinks.upsert(target, source, ["k"], ["v"], id_col="id").collect())) == few and names == ["ids"]
    assert "Row(id=12, k=3, v='z')" in few and "Row(id=13, k=5, v='x')" in few and "Row(id=7, k=1, v='y')" in few
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.upsert(target, source.unionByName(source), ["k"], ["v"], id_col="id")
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.upsert(target.limit(0), source.filter("k = 1").unionByName(source), ["k"], ["v"], id_col="id")
