"""Run flows: migrate, validate only, dry run, cache refresh.

One lazy plan per output, no chunk loop: the wide source is normalised once
and written (scanned once, lineage cut), every target table is made as scratch data that its
children read, and written to the store after its parents. A finished or failed
load deletes its scratch data and superseded table versions.

A payslip without a description match falls back to the only run of its month. "Only" refers to
all stored runs, those of earlier loads included, so the result of a load does not depend
on how its source was cut into batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrid.operators import documents as D
from paygrid.operators import entities as E
from paygrid.operators import quality as Q
from paygrid.operators import reconcile as R
from paygrid.operators import sinks as S
from paygrid.operators.counts import Counts, rows
from paygrid.operators.resolve import Migration
from paygrid.plans.options import RunOptions, Scope, refresh_scope
from paygrid.sources import period as P
from paygrid.session import materialize, release_scratch, scratch_mark
from paygrid.sources.store import FACTS, Store

LOAD_ORDER = {
    "folha_referencia": "folha", "servidor": "servidor", "rubrica": "rubrica",
    "servidor_vinculo": "vinculo", "contracheque": "contracheque",
    "contracheque_snapshot_funcional": "snapshot", "contracheque_item": "item",
    "contracheque_consolidado": "consolidado",
}
# Steps of a load in dependency order. Those of one group read only what earlier groups made and run side by side: a batch
# of a stream is small, and one step alone leaves most cores idle while it is planned and committed.
LOAD_STEPS = [["folha_referencia", "servidor", "rubrica", "stored"], ["servidor_vinculo"], ["contracheque", "retry"],
              ["contracheque_item", "contracheque_snapshot_funcional"], ["contracheque_consolidado", "errors"]]
# Writes into the store run beside the steps, as no step reads them; a table is written once its parents are, so a crash
# leaves no row in the store whose parent is missing.
WRITERS = 4
PARENTS = {"servidor_vinculo": ["servidor"], "contracheque": ["servidor_vinculo", "folha_referencia"],
           "contracheque_snapshot_funcional": ["contracheque"], "contracheque_item": ["contracheque", "rubrica"],
           "contracheque_consolidado": ["contracheque"]}


def _side_by_side(steps: list[Callable[[], None]]) -> None:
    """Run the steps in threads of the driver; all have ended when this returns or raises the first error."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(step)) for step in steps]:
            done.result()

TABLE_COLUMNS = {
    "servidor_vinculo": ["id_vinculo", "id_servidor", "numvinc", "id_funcional", "regime_juridico",
                         "tipo_vinculo", "ativo", "updated_at"],
    "servidor": ["id_servidor", "numfunc", "cpf", "nome", "pis_pasep", "identidade", "updated_at"],
    "rubrica": ["id_rubrica", "codigo_rubrica", "nome_rubrica", "tipo_rubrica", "ativa", "updated_at"],
    "folha_referencia": ["id_folha_referencia", "mes_ano_folha", "num_folha", "descricao_folha",
                         "data_consolidacao", "dt_lib_c_cheque", "ano", "mes", "ativa"],
}


def _scan(checks: DataFrame, folhas: DataFrame, o: RunOptions) -> tuple[DataFrame, DataFrame]:
    c = P.scan_contracheques(checks, o.ano, o.mes, o.data_inicio, o.data_fim)
    f = P.scan_folhas(folhas, o.ano, o.mes, o.data_inicio, o.data_fim)
    return c, f


# Tables that only live during a load.
SCRATCH = ("_bronze",)

AUDIT_COLUMNS = ["id_carga", "tipo_origem", "referencia", "status", "qtd_registros_lidos",
                 "qtd_registros_processados", "qtd_registros_erro", "observacao", "data_inicio", "data_fim"]


def _audit_row(spark: SparkSession, id_carga: int, tipo_origem: str, referencia: str | None, status: str,
               observacao: str | None, data_inicio: dt.datetime) -> DataFrame:
    """One audit row with zero counts (a load that is open or failed)."""
    return spark.range(1).select(
        F.lit(id_carga).cast("bigint").alias("id_carga"), F.lit(tipo_origem).alias("tipo_origem"),
        F.lit(referencia).cast("string").alias("referencia"), F.lit(status).alias("status"),
        F.lit(0).cast("bigint").alias("qtd_registros_lidos"),
        F.lit(0).cast("bigint").alias("qtd_registros_processados"),
        F.lit(0).cast("bigint").alias("qtd_registros_erro"),
        F.lit(observacao).cast("string").alias("observacao"),
        F.lit(data_inicio).cast("timestamp_ntz").alias("data_inicio"),
        F.current_timestamp().cast("timestamp_ntz").alias("data_fim"))


def _close_audit(store: Store, id_carga: int, row: DataFrame) -> DataFrame:
    """Replace the load's audit row (the audit table is tiny: one row per load)."""
    old = store.read("carga_importacao")
    keep = old.filter(F.col("id_carga") != id_carga) if old is not None else None
    row = row.select(*AUDIT_COLUMNS)
    return store.write("carga_importacao", row if keep is None else keep.select(*AUDIT_COLUMNS).unionByName(row))


def load_tables(spark: SparkSession, checks: DataFrame, folhas: DataFrame, store: Store,
                load_ts: dt.datetime | None = None, tipo_origem: str = "ORACLE",
                referencia: str | None = None) -> DataFrame:
    """Normalise, resolve and upsert one batch into the store; returns the audit row.

    Used by the batch migration and, unchanged, by the incremental stream (J1):
    stored ids are kept, lines are appended only when absent, and consolidation is
    recomputed from every stored line of the touched payslips. The audit row is
    opened as INICIADO, closed as SUCESSO / SUCESSO_PARCIAL, or ERRO on failure.
    """
    load_ts = load_ts or dt.datetime.now().replace(microsecond=0)
    audit_old = store.read("carga_importacao")
    id_carga = (audit_old.agg(F.max("id_carga")).first()[0] or 0) + 1 if audit_old is not None else 1
    _close_audit(store, id_carga, _audit_row(spark, id_carga, tipo_origem, referencia, S.STATUS_STARTED, None,
                                             load_ts))
    mark = scratch_mark()
    try:
        return _load(spark, checks, folhas, store, load_ts, tipo_origem, referencia, id_carga)
    except Exception as exc:
        _close_audit(store, id_carga, _audit_row(spark, id_carga, tipo_origem, referencia, S.STATUS_ERROR,
                                                 str(exc), load_ts))
        raise
    finally:
        # Every table is written or the load has failed: nothing reads this load's scratch data again.
        release_scratch(spark, mark)
        store.prune(SCRATCH)


def _load(spark: SparkSession, checks: DataFrame, folhas: DataFrame, store: Store, load_ts: dt.datetime,
          tipo_origem: str, referencia: str | None, id_carga: int) -> DataFrame:
    counts = Counts()
    # Retried rows were counted as read by the load that they came with.
    normalized = counts.watch(linhas_brutas=rows())(E.normalize_checks(checks))
    pending = store.read("_pending")
    if pending is not None:
        # Rows whose link could not be resolved in an earlier batch are retried.
        normalized = normalized.unionByName(pending)
    made: dict[str, object] = {}

    def bronze() -> None:
        made["bronze"] = store.write("_bronze", normalized)

    def target() -> None:
        made["m"] = Migration(None, folhas, load_ts=load_ts, existing=store.read_all(), counts=counts, counted=True)

    _side_by_side([bronze, target])
    bronze, m = made["bronze"], made["m"]
    m.__dict__["w"] = bronze

    writes: dict[str, Future] = {}

    def table(name: str) -> None:
        """Make a table as scratch data, which its children read; its write into the store is nobody's input and runs aside."""
        prop = LOAD_ORDER[name]
        df = getattr(m, prop)
        if name in TABLE_COLUMNS:
            df = df.select(*TABLE_COLUMNS[name])
        if name not in FACTS:
            aside(name, partial(store.write, name, df))
            return
        if name == "contracheque_item":
            # Appended lines are a union with the stored ones, whose files the write replaces.
            df = m.__dict__[prop] = store.stage(name, df)
        # Only the batch's periods are rewritten.
        aside(name, partial(store.write_periods, name, df, staged=True))

    def aside(name: str, write: Callable[[], object]) -> None:
        # Parents are handed in before their children, so the oldest write never waits.
        first = [writes[p] for p in PARENTS.get(name, ())]

        def run() -> None:
            for parent in first:
                parent.result()
            write()

        writes[name] = writers.submit(inheritable_thread_target(run))

    def errors() -> None:
        store.write_periods("carga_importacao_erro", S.error_rows(m.rejects(with_payload=True), id_carga), staged=True)

    def retry() -> None:
        # Retry queue: rows without a resolvable link wait for their parent in a later batch.
        links = m.vinculo.select("numfunc", "numvinc")
        waiting = bronze.dropna(subset=["numfunc", "numvinc"]).join(links, ["numfunc", "numvinc"], "left_anti")
        aside("_pending", partial(store.write, "_pending", waiting))

    def stored() -> None:
        """What later steps ask about the stored facts; read before any of them is replaced."""
        if m.max_ids:
            m.periods

    others = {"errors": errors, "retry": retry, "stored": stored}
    # Every write has ended, well or not, when this is left: then the scratch data may go.
    with ThreadPoolExecutor(WRITERS) as writers:
        if not {"folha_referencia", "servidor", "rubrica"} <= m.existing.keys():
            m._ranked                         # several steps read it, so it is made before them
        for steps in LOAD_STEPS:
            _side_by_side([others.get(s) or partial(table, s) for s in steps])
        for write in writes.values():
            write.result()
    found = counts.row(spark, ["folhas_lidas", "linhas_brutas", "contracheques_unicos", "itens_processados"], erros=m.n_rejects())
    audit = S.load_audit(found, tipo_origem, referencia, "Execucao concluida.").select(
        F.lit(id_carga).cast("bigint").alias("id_carga"), "*",
        F.lit(load_ts).cast("timestamp_ntz").alias("data_inicio"),
        F.current_timestamp().cast("timestamp_ntz").alias("data_fim"))
    _close_audit(store, id_carga, audit)
    return store.read("carga_importacao").filter(F.col("id_carga") == id_carga)


def migrate(spark: SparkSession, checks: DataFrame, folhas: DataFrame, opts: RunOptions, store: Store,
            load_ts: dt.datetime | None = None) -> DataFrame:
    """Section 3.1: the real migration of one period."""
    opts = opts.validated()
    c, f = _scan(checks, folhas, opts)
    return load_tables(spark, c, f, store, load_ts, "ORACLE", f"ANO={opts.ano}")


def validate(spark: SparkSession, checks: DataFrame, folhas: DataFrame, opts: RunOptions) -> dict[str, DataFrame]:
    """Section 3.2: validation only; no table is written. Returns the metric frames, defects in full."""
    opts = opts.validated()
    c, f = _scan(checks, folhas, opts)
    # Written once: every metric below is one more reader.
    w = materialize(E.normalize_checks(c), "validate")
    fol = E.folhas(E.normalize_folhas(f))
    cc = materialize(E.contracheques(w), "validate-cc")
    it = materialize(E.itens(w, with_sequence=False), "validate-itens")
    status = materialize(Q.mapping_status(cc, fol), "validate-status")
    summary = Q.mapping_summary(status)
    rq = Q.rubrica_quality(w, it)
    servers = E.servidores(w)
    links = E.vinculos(w)
    ent = Q.entity_counts(servers, links, E.rubricas(w), cc)
    # A link counts when its employee is a usable one, as in the load.
    without = Q.sem_vinculo(cc, links.join(servers.select("numfunc"), "numfunc", "left_semi"))
    unlinked = without.agg(F.count(F.lit(1)).alias("contracheques_sem_vinculo"))
    runs = Q.folha_month_profile(fol)
    return {
        "folhas_por_mes": runs, "meses_multiplos": Q.folha_multi_months(fol),
        "mapeamento": summary, "falhas_mapeamento": Q.mapping_failures(status),
        "servidor_vinculo": ent, "rubrica": rq, "rubricas_nulas": Q.rubrica_null_lines(it),
        "sem_vinculo": without,
        "contracheques_por_mes": Q.contracheques_por_mes(cc), "media_itens": Q.media_itens(it),
        "alertas": Q.validation_alerts(summary, rq),
        "relatorio": Q.validation_report({"mapeamento": summary, "servidor_vinculo": ent, "sem_vinculo": unlinked,
                                          "rubrica": rq, "distribuicao": Q.media_itens(it), "folhas": runs},
                                         {"contracheques_por_mes": Q.contracheques_por_mes(cc)}),
    }


def dry_run(spark: SparkSession, checks: DataFrame, folhas: DataFrame, opts: RunOptions) -> DataFrame:
    """Section 3.2 (dry run): rows of the six entity frames, nothing written."""
    opts = opts.validated()
    c, _ = _scan(checks, folhas, opts)
    w = materialize(E.normalize_checks(c), "dry-run")
    return Q.dry_run_counts({
        "servidor": E.servidores(w), "servidor_vinculo": E.vinculos(w), "rubrica": E.rubricas(w),
        "contracheque": E.contracheques(w), "contracheque_snapshot_funcional": E.snapshots(w),
        "contracheque_item": E.itens(w, with_sequence=False)})


def refresh_cache(spark: SparkSession, opts: RunOptions, store: Store,
                  updated_at: dt.datetime | None = None) -> DataFrame:
    """Section 3.3: scoped delete, candidates -> documents -> upsert, summary row.

    Only the (ano, mes) partitions of the scope and of the new documents are read
    and rewritten; a scope partition left without documents is dropped.
    """
    opts = opts.validated()
    scope, matricula = refresh_scope(opts)
    t = store.read_all()
    cands = D.candidates(t["contracheque"], t["servidor_vinculo"], t["servidor"], t["folha_referencia"],
                         t["contracheque_snapshot_funcional"], year=opts.ano, month=opts.mes,
                         matricula=matricula, start_date=opts.data_inicio, end_date=opts.data_fim)
    payload = D.payloads(cands, t["contracheque_item"])
    rows = D.to_cache_rows(payload, updated_at)
    keys, upd = S.UPSERT_CONTRACTS["contracheque_cache"]
    cache_all = t.get("contracheque_cache")
    periods = {(r["ano"], r["mes"]) for r in rows.select("ano", "mes").distinct().collect()}
    scope_periods: set = set()
    removed = None
    if cache_all is not None and scope is not Scope.NONE:
        sp = cache_all.filter(F.col("ano") == opts.ano)
        if scope is not Scope.YEAR:
            sp = sp.filter(F.col("mes") == opts.mes)
        scope_periods = {(r["ano"], r["mes"]) for r in sp.select("ano", "mes").distinct().collect()}
    touched = periods | scope_periods
    if cache_all is None:
        new_cache = rows
        counts = rows.agg(F.count(F.lit(1)).alias("processados"), F.count(F.lit(1)).alias("inseridos"),
                          F.lit(0).cast("bigint").alias("atualizados"))
    else:
        cond = F.lit(False)
        for a, mth in touched:
            cond = cond | ((F.col("ano") == a) & (F.col("mes") == mth))
        cache = cache_all.filter(cond).select(*rows.columns)
        if scope is not Scope.NONE:
            cache, removed = S.scoped_delete(cache, opts.ano, None if scope is Scope.YEAR else opts.mes, matricula)
        counts = S.cache_upsert_counts(cache, rows, keys)
        new_cache = S.upsert(cache, rows, keys, upd, id_col=None)
    # Everything that reads the old cache is computed before its partitions are replaced.
    staged = materialize(new_cache, "cache-stage")
    parts = [S.counts_row({"elegiveis": cands}), counts,
             payload.agg(F.coalesce(F.sum(F.size("contracheque.rubricas")), F.lit(0)).alias("total_rubricas"))]
    if removed is not None:
        parts.append(removed)
    summary = materialize(S.merge_rows(parts), "cache-summary")
    kept = {(r["ano"], r["mes"]) for r in staged.select("ano", "mes").distinct().collect()}
    store.write_periods("contracheque_cache", staged, staged=True)
    for a, mth in scope_periods - kept:
        store.drop_partition("contracheque_cache", {"ano": a, "mes": mth})
    return summary
