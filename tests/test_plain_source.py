"""Every pipeline runs on a source with exactly the payroll columns (no order column)."""

import datetime as dt

from pyspark.sql import functions as F

from paygrid.operators import entities as E
from paygrid.operators.documents import folha_numbers
from paygrid.plans import jobs
from paygrid.plans.options import RunOptions
from paygrid.schemas import PAYROLL_CHECKS_SCHEMA, PAYROLL_FOLHAS_SCHEMA
from paygrid.sources import tables as T
from paygrid.sources.store import Store

SF = "/root/testdata/sf0.001"
TS = dt.datetime(2026, 1, 1, 12, 0, 0)


def plain(spark):
    checks = T.payroll_checks(spark, SF).select(*PAYROLL_CHECKS_SCHEMA.names)
    folhas = T.payroll_folhas(spark, SF).select(*PAYROLL_FOLHAS_SCHEMA.names)
    return checks, folhas


def test_jdbc_shaped_frame_goes_through(spark):
    w = E.normalize_checks(spark.createDataFrame([], PAYROLL_CHECKS_SCHEMA))
    assert E.itens(w, with_sequence=False).count() == 0 and E.servidores(w).count() == 0
    assert E.folhas(E.normalize_folhas(spark.createDataFrame([], PAYROLL_FOLHAS_SCHEMA))).count() == 0


def test_order_columns_of_the_caller(spark):
    checks, _ = plain(spark)
    w = E.normalize_checks(checks, order=["NUMFUNC", "INFO"])
    assert dict(w.dtypes)["src_order"].startswith("struct<NUMFUNC:bigint,INFO:string")


def test_migrate_validate_dry_run(spark, tmp_path):
    checks, folhas = plain(spark)
    store = Store(spark, str(tmp_path))
    o = RunOptions(1997, 3)
    assert jobs.migrate(spark, checks, folhas, o, store, TS).count() == 1
    assert store.read("contracheque").count() > 0 and store.read("contracheque_item").count() > 0
    out = jobs.validate(spark, checks, folhas, o)
    assert out["relatorio"].filter("metrica = 'contracheques_sem_vinculo'").count() == 1
    assert out["relatorio"].filter("secao = 'contracheques_por_mes'").count() == 1
    assert out["falhas_mapeamento"].count() == out["mapeamento"].first().nao_mapeados
    assert jobs.dry_run(spark, checks, folhas, o).count() == 6


def test_fallback_counts_stored_runs(spark, tmp_path):
    """A run stored by an earlier load still counts when the next source no longer lists it."""
    checks, folhas = plain(spark)
    store = Store(spark, str(tmp_path))
    month = F.lit("1997-03-01").cast("date")
    two = folhas.filter(F.col("MES_ANO_FOLHA") == month).orderBy("NUM_FOLHA").limit(2)
    one = two.orderBy("NUM_FOLHA").limit(1)
    jobs.load_tables(spark, checks.filter(F.col("MES_ANO") == month), two, store, TS)
    before = store.read("contracheque").count()
    jobs.load_tables(spark, checks.filter(F.col("MES_ANO") == month), one, store, TS)
    assert store.read("contracheque").count() == before


def test_run_number_as_wide_as_ids(spark):
    c = spark.createDataFrame([(1, 2020, 1, None, None, 3_000_000_000), (2, 2020, 1, 5, 7, 1), (2, 2020, 1, 5, 7, 2)],
                              "numfunc bigint, ano int, mes int, num_folha bigint, numero bigint, id_contracheque bigint")
    got = {r.id_contracheque: r.folha_numero for r in folha_numbers(c).collect()}
    assert got == {3_000_000_000: 3_000_000_000, 1: 5, 2: 7}
