"""Operator semantics on small local frames (FIXTURES.md section 4, SURVEY section 5 properties)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paygrid.operators import dedupe, entities as E, reconcile as R, sinks as S
from paygrid.operators.documents import folha_numbers


def test_keep_last_drops_null_required_first(spark):
    # later row has NULL nome: the earlier row is kept (required columns drop first)
    w = spark.createDataFrame([(1, "A", "x", 1), (1, None, "y", 2), (2, "B", None, 1), (2, "B2", None, 2)],
                              "numfunc bigint, nome string, cpf string, o int")
    w = w.withColumn("src_order", F.struct("o")).withColumn("pis_pasep", F.lit(None).cast("string")) \
        .withColumn("identidade", F.lit(None).cast("string"))
    got = {r.numfunc: (r.nome, r.cpf) for r in E.servidores(w).collect()}
    assert got == {1: ("A", "x"), 2: ("B2", None)}


def test_surrogate_keys_equal_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))
    got = dedupe.surrogate_keys(df, ["k"], "sid", num_partitions=7).toPandas().sort_values("k")
    assert list(got["sid"]) == list(range(1, 5001))
    got2 = dedupe.surrogate_keys(df, ["k"], "sid", start=101, num_partitions=3).agg(F.min("sid"), F.max("sid")).first()
    assert tuple(got2) == (101, 5100)


def test_surrogate_keys_of_dense_ranges(spark, monkeypatch):
    """Ranges of a dense column are dealt out without sampling; rows without an id are ranked by themselves."""
    monkeypatch.setattr(dedupe, "RANGE_IDS", 100)
    df = spark.range(0, 3000).select((F.col("id") % 4 == 3).alias("bad"), F.col("id").alias("k"))
    df = df.withColumn("p", F.when(~F.col("bad"), F.floor(F.col("k") / 8) + 1))      # 1..375, six good rows each
    runs = []
    monkeypatch.setattr(type(df), "repartitionByRange", lambda *a, **k: runs.append(a))
    got = dedupe.surrogate_keys(df, ["bad", "p", "k"], "sid", within=["bad"], dense=("p", 375)).collect()
    assert not runs
    good = sorted((r.p, r.k, r.sid) for r in got if not r.bad)
    assert [g[2] for g in good] == list(range(1, 2251))
    assert sorted(r.sid for r in got if r.bad) == list(range(1, 751))


def test_written_plans_keep_the_limit_of_the_session(spark):
    from paygrid.session import short_methods

    key = "spark.sql.codegen.hugeMethodLimit"
    with short_methods(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == "65535"
    spark.conf.set(key, "4000")
    try:
        with short_methods(spark):
            assert spark.conf.get(key) == "4000"
        assert spark.conf.get(key) == "4000"
    finally:
        spark.conf.unset(key)


def test_candidates_deal_payslips_out_twice(spark):
    """Links meet their employees below the join with the payslips, which are not dealt out by employee."""
    from paygrid.operators.documents import candidates

    c = spark.range(4).select(F.col("id").alias("id_contracheque"), F.lit(1).cast("bigint").alias("id_vinculo"), *[
        F.lit(None).cast("bigint").alias(n) for n in ("id_folha_referencia", "ano", "mes", "mes_ano", "competencia", "folha_descricao_origem",
                                                     "dt_lib_c_cheque", "data_consolidacao", "numero")])
    texts = lambda *names: [F.lit("x").alias(n) for n in names]
    v = spark.range(1, 3).select(F.col("id").alias("id_vinculo"), F.col("id").alias("id_servidor"),
                                 *texts("id_funcional", "regime_juridico", "tipo_vinculo"))
    s = spark.range(1, 3).select(F.col("id").alias("id_servidor"), F.col("id").alias("numfunc"), *texts("nome", "cpf", "pis_pasep", "identidade"))
    f = spark.range(1).select(F.col("id").alias("id_folha_referencia"), F.col("id").alias("num_folha"), *texts("descricao_folha"))
    snap = c.select("id_contracheque", *texts("orgao", "cargo", "ref_cargo", "funcao", "ref_funcao", "municipio", "setor", "regime_juridico",
                                              "tipo_vinculo", "banco", "agencia", "conta", "carga_horaria"))
    x = candidates(c, v, s, f, snap)
    assert sorted((r.id_contracheque, r.numfunc) for r in x.collect()) == [(i, 1) for i in range(4)]
    joins = [line for line in x._jdf.queryExecution().analyzed().toString().splitlines() if "Join Inner" in line]
    depth = {key: line.index("Join") for line in joins for key in ("id_vinculo", "id_servidor") if f"({key}#" in line}
    assert depth["id_servidor"] > depth["id_vinculo"]


def test_sequence_in_group(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 5), (1, 2)], "g int, o int")
    got = sorted(tuple(r) for r in dedupe.sequence_in_group(df, ["g"], "o", "s").collect())
    assert got == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 5, 1)]


def test_consolidate_cases(spark):
    h = spark.createDataFrame([(1, Decimal(100), None, Decimal(90)), (2, Decimal(5), None, None)],
                              "id bigint, bruto decimal(15,2), descontos decimal(15,2), liquido decimal(15,2)")
    i = spark.createDataFrame([(1, Decimal(80), None, None), (1, None, Decimal(20), None), (1, None, None, Decimal(10))],
                              "id bigint, valor_vantagem decimal(15,2), valor_auxiliar decimal(15,2), valor_desconto decimal(15,2)")
    got = {r.id: r for r in R.consolidate(h, i, ["id"]).collect()}
    r1, r2 = got[1], got[2]
    assert (r1.total_vantagens, r1.total_descontos_itens, r1.total_itens) == (Decimal("100.00"), Decimal("10.00"), 3)
    assert (r1.divergencia_bruto, r1.divergencia_descontos, r1.divergencia_liquido) == (
        Decimal("0.00"), Decimal("-10.00"), Decimal("0.00"))
    assert (r2.total_vantagens, r2.total_itens, r2.divergencia_bruto) == (Decimal("0.00"), 0, Decimal("5.00"))


def test_upsert_three_cases(spark):
    target = spark.createDataFrame([(1, 10, "a", "x"), (2, 20, "b", "y")], "id bigint, k bigint, v string, keep string")
    source = spark.createDataFrame([(10, None), (30, "c")], "k bigint, v string")
    out = {r.k: r for r in S.upsert(target, source, ["k"], ["v"], id_col="id").collect()}
    assert (out[10].id, out[10].v, out[10].keep) == (1, None, "x")       # update to NULL, others kept
    assert (out[20].id, out[20].v) == (2, "b")                           # untouched
    assert (out[30].id, out[30].v, out[30].keep) == (3, "c", None)       # insert after max id


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, 10, "a")], "id bigint, k bigint, v string")
    source = spark.createDataFrame([(10, "z"), (11, "n")], "k bigint, v string")
    once = S.upsert(target, source, ["k"], ["v"], id_col="id")
    twice = S.upsert(once, source, ["k"], ["v"], id_col="id")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_rejects_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k bigint, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k bigint, v string")
    with pytest.raises(S.DuplicateKeyError):
        S.upsert(target, source, ["k"], ["v"])


def test_scoped_delete(spark):
    cache = spark.createDataFrame([("1", 2026, 1), ("2", 2026, 1), ("1", 2026, 2), ("1", 2025, 1)],
                                  "matricula string, ano int, mes int")
    rem, n = S.scoped_delete(cache, 2026, 1, "1")
    assert n.first()[0] == 1 and rem.count() == 3
    assert S.scoped_delete(cache, 2026)[1].first()[0] == 3
    with pytest.raises(ValueError):
        S.scoped_delete(cache, 2026, None, "1")


def test_append_if_absent(spark):
    cols = ("id_contracheque bigint, codigo_rubrica_origem bigint, complemento string, info string, "
            "valor_vantagem decimal(15,2), valor_desconto decimal(15,2), valor_auxiliar decimal(15,2)")
    stored = spark.createDataFrame([(1, 5, None, None, Decimal(1), None, None)], cols)
    inc = spark.createDataFrame([(1, 5, None, None, Decimal(1), Decimal(0), None),
                                 (1, 6, None, None, Decimal(1), None, None)], cols)
    got = S.append_if_absent(stored, inc).collect()
    assert [r.codigo_rubrica_origem for r in got] == [6]   # NULL and 0.00 hash alike


def test_folha_numbers(spark):
    rows = [(1, 1, 1, 5), (1, 1, 1, 10), (1, 1, 5, 11), (1, None, 0, 7),
            (2, 1, 1, 9), (2, 2, 2, 8), (2, None, 1, 2), (2, None, 2, 1)]
    df = spark.createDataFrame(rows, "numfunc bigint, num_folha bigint, numero bigint, id_contracheque bigint") \
        .withColumn("ano", F.lit(2026)).withColumn("mes", F.lit(1))
    got = {r.id_contracheque: r.folha_numero for r in folha_numbers(df).collect()}
    assert [got[i] for i in (5, 10, 11, 7)] == [1, 10, 5, 7]
    assert [got[i] for i in (9, 8, 2, 1)] == [1, 2, 900000000, 900000001]


def test_reject_precedence_and_folha_fallback(spark):
    from paygrid.operators.resolve import map_folha

    folha = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1), 1, "Folha Jan/2026"), (2, dt.date(2026, 2, 1), 1, None),
         (3, dt.date(2026, 3, 1), 1, "A"), (4, dt.date(2026, 4, 1), 1, "A"), (5, dt.date(2026, 4, 1), 2, "B")],
        "id_folha_referencia bigint, mes_ano_folha date, num_folha bigint, descricao_folha string")
    cc = spark.createDataFrame(
        [(dt.date(2026, 1, 1), "folha 01/2026"), (dt.date(2026, 2, 1), None), (dt.date(2026, 3, 1), "zzz"),
         (dt.date(2026, 4, 1), "zzz")], "mes_ano date, folha_descricao_origem string")
    got = [(r.id_folha_por_descricao, r.id_folha_por_mes, r.id_folha_referencia)
           for r in map_folha(cc, folha).orderBy("mes_ano").collect()]
    assert got == [(1, 1, 1), (2, 2, 2), (None, 3, 3), (None, None, None)]


def test_sequence_hot_group(spark):
    # one group holds most rows: numbering stays dense and ordered across partitions
    df = spark.range(0, 20000).select((F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99)).alias("g"),
                                      (F.col("id") * 31 % 20011).alias("o"))
    got = dedupe.sequence_in_group(df, ["g"], "o", "s").toPandas()
    for _, grp in got.groupby("g"):
        assert list(grp.sort_values("o")["s"]) == list(range(1, len(grp) + 1))


def test_reconcile_source_equals_two_branch(spark):
    from paygrid.sources import tables as T

    w = E.normalize_checks(T.payroll_checks(spark, "/root/testdata/sf0.001"))
    a = R.reconcile_source(w)
    b = R.consolidate(E.contracheques(w), E.itens(w), E.PAYSLIP_KEY)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_ranks_within_groups(spark):
    rows = [(g, k) for g in ("a", "b", "c") for k in range(0, 900 if g == "b" else 40)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    for n in (1, 3, 8):
        got = dedupe.surrogate_keys(df, ["g", "k"], "id", num_partitions=n, within=["g"]).collect()
        assert len(got) == len(rows) and all(r.id == r.k + 1 for r in got)
    with pytest.raises(ValueError):
        dedupe.surrogate_keys(df, ["k", "g"], "id", within=["g"])


def test_counts_of_writes(spark):
    from paygrid.operators.counts import Counts, rows
    from paygrid.session import materialize

    c = Counts()
    materialize(c.watch(n=rows(), even=F.count_if(F.col("id") % 2 == 0))(spark.range(101).repartition(4)), "counted")
    materialize(c.watch(none=rows())(spark.range(0)), "counted-empty")
    assert (c["n"], c["even"], c["none"]) == (101, 51, 0) and "n" in c and "other" not in c
    assert c.row(spark, ["n", "even"], more=7).first().asDict() == {"n": 101, "even": 51, "more": 7}


def test_pages_are_read_by_their_bounds(spark):
    from paygrid.operators import documents as D

    c = spark.range(3, 2600, 2).withColumnRenamed("id", "id_contracheque")
    p = sorted(D.pages(c, 500).collect())
    assert [(r.pagina, r.linhas) for r in p] == [(0, 500), (1, 500), (2, 299)]
    got = [x.id_contracheque for r in p for x in D.page(c, r.primeiro_id, r.ultimo_id).orderBy("id_contracheque").collect()]
    assert got == list(range(3, 2600, 2))


def test_document_token_is_made_once(spark):
    """The folded description of a document is a column, not an expression inside every rule and field that reads it."""
    from paygrid.operators import documents as D
    from paygrid.plans.catalog import doc_inputs

    m, c = doc_inputs(spark, "/root/testdata/sf0.001")
    plan = D.payloads(c, m.item).select("folha_tipo", "folha_descricao", "contracheque.competencia")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("translate(") <= 6
