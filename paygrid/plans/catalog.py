"""Registered queries: name -> (spark builder, oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables. The oracle SQL (DuckDB) computes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrid.operators import entities as E
from paygrid.operators import reconcile as R
from paygrid.operators.resolve import Migration
from paygrid.plans import oracle as O
from paygrid.session import materialize
from paygrid.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_final: str | None = None, planted: dict[str, str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_final is not None:
            ORACLE[name] = O.sql(oracle_final, planted)
        return fn
    return deco


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.normalize_checks(T.payroll_checks(spark, sf_dir))


def migration(spark: SparkSession, sf_dir: str) -> Migration:
    return Migration(T.payroll_checks(spark, sf_dir), T.payroll_folhas(spark, sf_dir))


# --- 7.1 minimum slice: payslips that do not reconcile with their lines ----------

@register("divergent_contracheques", f"""
SELECT * FROM (
  SELECT h.numfunc, h.numvinc, h.mes_ano, h.numero,
    CAST(coalesce(t.sv, 0) + coalesce(t.sa, 0) AS DECIMAL(15,2)) AS total_vantagens,
    CAST(coalesce(t.sd, 0) AS DECIMAL(15,2)) AS total_descontos_itens,
    CAST(coalesce(t.n, 0) AS INTEGER) AS total_itens,
    CAST(coalesce(h.bruto, 0) - (coalesce(t.sv, 0) + coalesce(t.sa, 0)) AS DECIMAL(15,2)) AS divergencia_bruto,
    CAST(coalesce(h.descontos, 0) - coalesce(t.sd, 0) AS DECIMAL(15,2)) AS divergencia_descontos,
    CAST(coalesce(h.liquido, 0) - (coalesce(t.sv, 0) + coalesce(t.sa, 0) - coalesce(t.sd, 0)) AS DECIMAL(15,2)) AS divergencia_liquido
  FROM b_contracheque h
  LEFT JOIN (SELECT {O.KEY4}, sum(valor_vantagem) AS sv, sum(valor_auxiliar) AS sa,
                    sum(valor_desconto) AS sd, count(*) AS n
             FROM b_item GROUP BY ALL) t USING ({O.KEY4})
) x WHERE divergencia_bruto <> 0 OR divergencia_descontos <> 0 OR divergencia_liquido <> 0
""")
def q_divergent(spark, sf_dir):
    return R.divergent(R.reconcile_source(wide(spark, sf_dir)))


# --- 2.B entity projections --------------------------------------------------------

@register("dim_folha", "SELECT * EXCLUDE (src_order) FROM b_folha")
def q_dim_folha(spark, sf_dir):
    return E.folhas(E.normalize_folhas(T.payroll_folhas(spark, sf_dir))).drop("src_order")


@register("dim_servidor", "SELECT * FROM b_servidor")
def q_dim_servidor(spark, sf_dir):
    return E.servidores(wide(spark, sf_dir))


@register("dim_vinculo", "SELECT * FROM b_vinculo")
def q_dim_vinculo(spark, sf_dir):
    return E.vinculos(wide(spark, sf_dir))


@register("dim_rubrica", "SELECT * FROM b_rubrica")
def q_dim_rubrica(spark, sf_dir):
    return E.rubricas(wide(spark, sf_dir))


@register("fact_contracheque", "SELECT * FROM b_contracheque")
def q_fact_contracheque(spark, sf_dir):
    return E.contracheques(wide(spark, sf_dir))


@register("fact_snapshot", "SELECT * FROM b_snapshot")
def q_fact_snapshot(spark, sf_dir):
    return E.snapshots(wide(spark, sf_dir))


@register("fact_item", "SELECT * EXCLUDE (src_order) FROM b_item")
def q_fact_item(spark, sf_dir):
    return E.itens(wide(spark, sf_dir))


@register("item_totals", f"""
SELECT {O.KEY4},
  CAST(coalesce(sum(valor_vantagem), 0) AS DECIMAL(15,2)) AS soma_vantagem,
  CAST(coalesce(sum(valor_auxiliar), 0) AS DECIMAL(15,2)) AS soma_auxiliar,
  CAST(coalesce(sum(valor_desconto), 0) AS DECIMAL(15,2)) AS soma_desconto,
  CAST(count(*) AS INTEGER) AS total_itens
FROM b_item GROUP BY ALL""")
def q_item_totals(spark, sf_dir):
    return R.item_totals(E.itens(wide(spark, sf_dir), with_sequence=False), E.PAYSLIP_KEY)


# --- 2.D / 2.F: resolved model ------------------------------------------------------

CC_COLS = ["id_contracheque", "id_vinculo", "id_folha_referencia", "mes_ano", "numero",
           "folha_descricao_origem", "competencia", "bruto", "descontos", "liquido",
           "data_consolidacao", "dt_lib_c_cheque", "ano", "mes", "hash_origem"]


@register("surrogate_keys", "SELECT id_servidor, numfunc, cpf, nome, pis_pasep, identidade FROM t_servidor")
def q_surrogate_keys(spark, sf_dir):
    return migration(spark, sf_dir).servidor.drop("updated_at")


@register("folha_ids", "SELECT * EXCLUDE (src_order) FROM t_folha")
def q_folha_ids(spark, sf_dir):
    return migration(spark, sf_dir).folha.drop("src_order")


@register("rubrica_ids", "SELECT * FROM t_rubrica")
def q_rubrica_ids(spark, sf_dir):
    return migration(spark, sf_dir).rubrica.drop("updated_at")


@register("vinculo_resolve", """
SELECT id_vinculo, id_servidor, numvinc, id_funcional, regime_juridico, tipo_vinculo, ativo FROM t_vinculo""")
def q_vinculo_resolve(spark, sf_dir):
    return migration(spark, sf_dir).vinculo.select(
        "id_vinculo", "id_servidor", "numvinc", "id_funcional", "regime_juridico", "tipo_vinculo", "ativo")


@register("vinculo_rejects", "SELECT * FROM t_errors WHERE entidade = 'servidor_vinculo'")
def q_vinculo_rejects(spark, sf_dir):
    return migration(spark, sf_dir).vinculo_rejects.drop("payload_origem")


@register("contracheque_folha_map", f"""
SELECT {O.KEY4}, id_folha_por_descricao, id_folha_por_mes, id_folha_referencia,
  CASE WHEN id_folha_por_descricao IS NOT NULL THEN 'DESCRICAO'
       WHEN id_folha_por_mes IS NOT NULL THEN 'FALLBACK' ELSE 'NAO_MAPEADO' END AS forma_mapeamento
FROM c_tag""")
def q_contracheque_folha_map(spark, sf_dir):
    m = migration(spark, sf_dir)
    x = m.contracheque_tagged
    return x.select(*E.PAYSLIP_KEY, "id_folha_por_descricao", "id_folha_por_mes", "id_folha_referencia",
                    F.when(F.col("id_folha_por_descricao").isNotNull(), "DESCRICAO")
                    .when(F.col("id_folha_por_mes").isNotNull(), "FALLBACK")
                    .otherwise("NAO_MAPEADO").alias("forma_mapeamento"))


@register("contracheque_resolve", f"SELECT {', '.join(CC_COLS)} FROM t_cc")
def q_contracheque_resolve(spark, sf_dir):
    return migration(spark, sf_dir).contracheque.drop("updated_at")


@register("snapshot_resolve", "SELECT * FROM t_snapshot")
def q_snapshot_resolve(spark, sf_dir):
    return migration(spark, sf_dir).snapshot.drop("ano", "mes")


@register("item_resolve", "SELECT * FROM t_item")
def q_item_resolve(spark, sf_dir):
    return migration(spark, sf_dir).item.drop("ano", "mes")


@register("consolidado", "SELECT * FROM t_consolidado")
def q_consolidado(spark, sf_dir):
    return migration(spark, sf_dir).consolidado.drop("ano", "mes")


@register("load_errors", "SELECT * FROM t_errors")
def q_load_errors(spark, sf_dir):
    return migration(spark, sf_dir).rejects(with_payload=False)


@register("key_lookup", """
SELECT DISTINCT k.numfunc, k.numvinc, v.id_servidor, v.id_vinculo
FROM (SELECT DISTINCT numfunc, numvinc FROM b_contracheque) k
JOIN t_vinculo v USING (numfunc, numvinc)""")
def q_key_lookup(spark, sf_dir):
    """Distinct link keys of the payslips -> stored ids (inner join, no IN blocks)."""
    m = migration(spark, sf_dir)
    keys = m.payslip_src.select("numfunc", "numvinc").distinct()
    return keys.join(m.vinculo.select("numfunc", "numvinc", "id_servidor", "id_vinculo"),
                     ["numfunc", "numvinc"], "inner")


# --- 2.E / 2.G: validation metrics ----------------------------------------------------

from paygrid.operators import quality as Q  # noqa: E402


class Validation:
    """Inputs of the validation run: B2-B8 frames over the whole source (built lazily)."""

    def __init__(self, spark, sf_dir, shared=False):
        """``shared``: several metrics read the frames, so each is written once."""
        self.spark, self.sf_dir = spark, sf_dir
        self.once = materialize if shared else (lambda df, name: df)

    @cached_property
    def w(self):
        return self.once(wide(self.spark, self.sf_dir), "validate")

    @cached_property
    def folhas(self):
        return E.folhas(E.normalize_folhas(T.payroll_folhas(self.spark, self.sf_dir)))

    @cached_property
    def contracheques(self):
        return self.once(E.contracheques(self.w), "validate-cc")

    @cached_property
    def itens(self):
        return self.once(E.itens(self.w, with_sequence=False), "validate-itens")

    def status(self):
        return Q.mapping_status(self.contracheques, self.folhas)

    def summary(self):
        return Q.mapping_summary(self.status())

    def rubricas(self):
        return Q.rubrica_quality(self.w, self.itens)

    def entities(self):
        return Q.entity_counts(E.servidores(self.w), E.vinculos(self.w), E.rubricas(self.w), self.contracheques)


SUMMARY_COLS = ["total_contracheques", "mapeados_por_descricao", "mapeados_por_fallback", "nao_mapeados",
                "taxa_sucesso", "taxa_fallback", "taxa_erro"]
RUBQ_COLS = ["rubricas_distintas", "rubricas_nulas", "nomes_rubrica_vazios"]
ENT_COLS = ["servidores_unicos", "vinculos_unicos", "rubricas_unicas", "contracheques_unicos"]


@register("mapping_summary", "SELECT * FROM q_summary")
def q_mapping_summary(spark, sf_dir):
    return Validation(spark, sf_dir).summary()


@register("mapping_failures_top50", f"""
SELECT {O.KEY4}, folha_descricao_origem FROM q_status WHERE forma_mapeamento = 'NAO_MAPEADO'
ORDER BY {O.KEY4} LIMIT 50""")
def q_mapping_failures_top50(spark, sf_dir):
    """The report's first 50 examples."""
    return Q.mapping_failures(Validation(spark, sf_dir).status(), 50)


@register("mapping_failures", f"""
SELECT {O.KEY4}, folha_descricao_origem FROM q_status WHERE forma_mapeamento = 'NAO_MAPEADO'""")
def q_mapping_failures(spark, sf_dir):
    """Every unmapped payslip."""
    return Q.mapping_failures(Validation(spark, sf_dir).status())


@register("entity_counts", "SELECT * FROM q_entities")
def q_entity_counts(spark, sf_dir):
    return Validation(spark, sf_dir, shared=True).entities()


@register("sem_vinculo", f"""
SELECT {O.KEY4} FROM b_contracheque c
WHERE NOT EXISTS (SELECT 1 FROM t_vinculo v WHERE v.numfunc = c.numfunc AND v.numvinc = c.numvinc)""")
def q_sem_vinculo(spark, sf_dir):
    m = migration(spark, sf_dir)
    return Q.sem_vinculo(m.payslip_src, m.vinculo)


@register("rubrica_quality", "SELECT * FROM q_rubq")
def q_rubrica_quality(spark, sf_dir):
    return Validation(spark, sf_dir, shared=True).rubricas()


@register("rubrica_nula_top50", f"""
SELECT {O.KEY4}, codigo_rubrica_origem, nome_rubrica_origem FROM b_item WHERE codigo_rubrica_origem IS NULL
ORDER BY {O.KEY4}, item_hash LIMIT 50""")
def q_rubrica_nula_top50(spark, sf_dir):
    """The report's first 50 examples."""
    return Q.rubrica_null_lines(Validation(spark, sf_dir).itens, 50)


@register("rubrica_nula", f"""
SELECT {O.KEY4}, codigo_rubrica_origem, nome_rubrica_origem FROM b_item WHERE codigo_rubrica_origem IS NULL""")
def q_rubrica_nula(spark, sf_dir):
    """Every line without a pay code."""
    return Q.rubrica_null_lines(Validation(spark, sf_dir).itens)


@register("sem_vinculo_ate_1997", f"""
SELECT {O.KEY4} FROM b_contracheque c WHERE NOT EXISTS (
  SELECT 1 FROM wn v WHERE v.mes_ano < DATE '1998-01-01' AND v.numfunc = c.numfunc AND v.numvinc = c.numvinc)""")
def q_sem_vinculo_ate_1997(spark, sf_dir):
    """D16 where it finds something: payslips whose link is not among those stored up to 1997."""
    v = Validation(spark, sf_dir, shared=True)
    return Q.sem_vinculo(v.contracheques, E.vinculos(v.w.filter(F.col("mes_ano") < F.lit("1998-01-01").cast("date"))))


@register("contracheques_por_mes", "SELECT mes_ano, count(*) AS quantidade FROM b_contracheque GROUP BY 1 ORDER BY 1")
def q_contracheques_por_mes(spark, sf_dir):
    return Q.contracheques_por_mes(Validation(spark, sf_dir).contracheques)


@register("media_itens", "SELECT * FROM q_media")
def q_media_itens(spark, sf_dir):
    return Q.media_itens(Validation(spark, sf_dir).itens)


@register("folha_month_profile", """
SELECT count(*) AS total_meses, count(*) FILTER (WHERE quantidade_folhas = 1) AS meses_folha_unica,
       count(*) FILTER (WHERE quantidade_folhas > 1) AS meses_multiplas_folhas FROM q_fmonths""")
def q_folha_month_profile(spark, sf_dir):
    return Q.folha_month_profile(Validation(spark, sf_dir).folhas)


@register("folha_multi_months", """
SELECT mes_ano, quantidade_folhas, array_to_string(num_folhas, '|') AS num_folhas,
       array_to_string(descricoes, '|') AS descricoes
FROM q_fmonths WHERE quantidade_folhas > 1 ORDER BY mes_ano""")
def q_folha_multi_months(spark, sf_dir):
    x = Q.folha_multi_months(Validation(spark, sf_dir).folhas)
    return x.select("mes_ano", "quantidade_folhas",
                    F.array_join(F.col("num_folhas").cast("array<string>"), "|").alias("num_folhas"),
                    F.array_join("descricoes", "|").alias("descricoes"))


@register("folhas_por_mes", "SELECT mes_ano_folha, count(*) AS quantidade FROM b_folha GROUP BY 1")
def q_folhas_por_mes(spark, sf_dir):
    return Q.folhas_por_mes(Validation(spark, sf_dir).folhas)


@register("dry_run_counts", """
SELECT 'servidor' AS entidade, count(*) AS quantidade FROM b_servidor
UNION ALL SELECT 'servidor_vinculo', count(*) FROM b_vinculo
UNION ALL SELECT 'rubrica', count(*) FROM b_rubrica
UNION ALL SELECT 'contracheque', count(*) FROM b_contracheque
UNION ALL SELECT 'contracheque_snapshot_funcional', count(*) FROM b_snapshot
UNION ALL SELECT 'contracheque_item', count(*) FROM b_item""")
def q_dry_run_counts(spark, sf_dir):
    w = Validation(spark, sf_dir, shared=True).w
    return Q.dry_run_counts({
        "servidor": E.servidores(w), "servidor_vinculo": E.vinculos(w), "rubrica": E.rubricas(w),
        "contracheque": E.contracheques(w), "contracheque_snapshot_funcional": E.snapshots(w),
        "contracheque_item": E.itens(w, with_sequence=False)})


@register("validation_alerts", "SELECT * FROM q_alerts")
def q_validation_alerts(spark, sf_dir):
    v = Validation(spark, sf_dir, shared=True)
    return Q.validation_alerts(v.summary(), v.rubricas())


@register("validation_report", "\nUNION ALL\n".join([
    O.long_sql("mapeamento", "q_summary", SUMMARY_COLS),
    O.long_sql("servidor_vinculo", "q_entities", ENT_COLS),
    O.long_sql("rubrica", "q_rubq", RUBQ_COLS),
    O.long_sql("distribuicao", "q_media", ["media_itens_por_contracheque"]),
    O.long_sql("folhas", "(SELECT count(*) AS total_meses, count(*) FILTER (WHERE quantidade_folhas = 1) AS meses_folha_unica, "
               "count(*) FILTER (WHERE quantidade_folhas > 1) AS meses_multiplas_folhas FROM q_fmonths) f",
               ["total_meses", "meses_folha_unica", "meses_multiplas_folhas"]),
    "SELECT 'contracheques_por_mes', strftime(mes_ano, '%Y-%m'), CAST(count(*) AS VARCHAR) FROM b_contracheque GROUP BY mes_ano",
]))
def q_validation_report(spark, sf_dir):
    v = Validation(spark, sf_dir, shared=True)
    return Q.validation_report({
        "mapeamento": v.summary(), "servidor_vinculo": v.entities(), "rubrica": v.rubricas(),
        "distribuicao": Q.media_itens(v.itens), "folhas": Q.folha_month_profile(v.folhas)},
        {"contracheques_por_mes": Q.contracheques_por_mes(v.contracheques)})


# --- 2.D D12-D15 / 2.F F4-F5 / 2.I I11-I16: documents ------------------------------------

from paygrid.operators import documents as D  # noqa: E402

CAND_COLS = ["id_contracheque", "numfunc", "nome", "cpf", "pis_pasep", "identidade", "id_funcional",
             "vinc_regime_juridico", "vinc_tipo_vinculo", "ano", "mes", "competencia", "folha_descricao_origem",
             "dt_lib_c_cheque", "data_consolidacao", "numero", "num_folha", "descricao_folha", "orgao", "cargo",
             "ref_cargo", "funcao", "ref_funcao", "municipio", "setor", "snap_regime_juridico",
             "snap_tipo_vinculo", "banco", "agencia", "conta", "carga_horaria"]


def doc_inputs(spark, sf_dir, **scope):
    m = migration(spark, sf_dir)
    cands = D.candidates(m.contracheque, m.vinculo, m.servidor, m.folha, m.snapshot, **scope)
    return m, cands


@register("cache_candidates", f"SELECT {', '.join(CAND_COLS)} FROM d_cand")
def q_cache_candidates(spark, sf_dir):
    return doc_inputs(spark, sf_dir)[1].select(*CAND_COLS)


@register("cache_scope", f"SELECT {', '.join(CAND_COLS)} FROM d_cand WHERE ano = 1997 AND mes = 3")
def q_cache_scope(spark, sf_dir):
    """Candidates of one competência (year 1997, month 3)."""
    return doc_inputs(spark, sf_dir, year=1997, month=3)[1].select(*CAND_COLS)


@register("cache_candidate_count", "SELECT count(*) AS total FROM d_cand")
def q_cache_candidate_count(spark, sf_dir):
    return doc_inputs(spark, sf_dir)[1].agg(F.count(F.lit(1)).alias("total"))


@register("cache_items", "SELECT * FROM d_items")
def q_cache_items(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    return m.item.join(c.select("id_contracheque"), "id_contracheque", "left_semi").select(
        "id_contracheque", "codigo_rubrica_origem", "nome_rubrica_origem", "tipo_rubrica_origem",
        "valor_vantagem", "valor_desconto", "valor_auxiliar")


@register("item_classes", "SELECT id_contracheque, id_contracheque_item, tipo, valor FROM d_class")
def q_item_classes(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    items = m.item.join(c.select("id_contracheque"), "id_contracheque", "left_semi")
    return D.classified_items(items).select("id_contracheque", "id_contracheque_item", "tipo", "valor")


@register("folha_numero", "SELECT * FROM d_num")
def q_folha_numero(spark, sf_dir):
    return D.folha_numbers(doc_inputs(spark, sf_dir)[1])


@register("cache_resumo", "SELECT * FROM d_tot")
def q_cache_resumo(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    items = m.item.join(c.select("id_contracheque"), "id_contracheque", "left_semi")
    return D.document_totals(D.classified_items(items)).withColumnRenamed("total_rubricas", "total_rubricas")


@register("folha_tipo", "SELECT id_contracheque, competencia_folha_descricao AS folha_descricao, folha_tipo FROM d_payload")
def q_folha_tipo(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    p = D.payloads(c, m.item)
    return p.select("id_contracheque", F.col("contracheque.competencia.folha_descricao").alias("folha_descricao"),
                    "folha_tipo")


@register("cache_payload", "SELECT * FROM d_payload")
def q_cache_payload(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    p = D.payloads(c, m.item)
    d = F.col("contracheque")
    return p.select(
        "id_contracheque", "matricula", "cpf", "ano", "mes", "folha_numero", "folha_tipo", "folha_descricao",
        d["servidor"]["nome"].alias("nome"), d["servidor"]["regime_juridico"].alias("regime_juridico"),
        d["servidor"]["tipo_vinculo"].alias("tipo_vinculo"), d["servidor"]["carga_horaria"].alias("carga_horaria"),
        d["competencia"]["descricao"].alias("competencia_descricao"),
        d["competencia"]["data_liberacao"].alias("data_liberacao"),
        d["competencia"]["folha_descricao"].alias("competencia_folha_descricao"),
        d["resumo"]["bruto"].alias("resumo_bruto"), d["resumo"]["descontos"].alias("resumo_descontos"),
        d["resumo"]["liquido"].alias("resumo_liquido"),
        F.size(d["rubricas"]).cast("int").alias("n_rubricas"))


@register("cache_documents")
def q_cache_documents(spark, sf_dir):
    """Cache rows with the JSON document (checked by rows; JSON number text differs by engine)."""
    m, c = doc_inputs(spark, sf_dir)
    return D.to_cache_rows(D.payloads(c, m.item))


DOC_KEY = "CAST(d.numfunc AS VARCHAR) AS matricula, CAST(d.ano AS INTEGER) AS ano, CAST(d.mes AS INTEGER) AS mes, n.folha_numero"
DOC_TEXTS = {"nome": "nome", "cpf": "cpf", "id_funcional": "id_funcional", "orgao": "orgao", "cargo": "cargo",
             "referencia_cargo": "ref_cargo", "funcao": "funcao", "referencia_funcao": "ref_funcao",
             "municipio": "municipio", "setor": "setor", "banco": "banco", "agencia": "agencia", "conta": "conta",
             "pis_pasep": "pis_pasep", "identidade": "identidade"}


def _parsed_documents(spark, sf_dir):
    """The cache rows with their JSON text parsed again."""
    m, c = doc_inputs(spark, sf_dir)
    texts = ", ".join(f"{k}: string" for k in DOC_TEXTS)
    schema = (f"servidor struct<{texts}>, resumo struct<bruto: double, descontos: double, liquido: double>, "
              "rubricas array<struct<codigo: bigint, descricao: string, tipo: string, valor: double>>")
    rows = D.to_cache_rows(D.payloads(c, m.item))
    return rows.select("matricula", "ano", "mes", "folha_numero", F.from_json("contracheque_json", schema).alias("d"))


@register("cache_document_lines", f"""
SELECT {DOC_KEY}, CAST(row_number() OVER (PARTITION BY x.id_contracheque ORDER BY x.sequencia_item NULLS LAST,
         x.id_contracheque_item) - 1 AS INTEGER) AS posicao, coalesce(x.codigo_rubrica_origem, 0) AS codigo,
       coalesce({O._strip('x.nome_rubrica_origem')}, '') AS descricao, x.tipo, CAST(x.valor AS DOUBLE) AS valor
FROM d_class x JOIN d_cand d USING (id_contracheque) JOIN d_num n USING (id_contracheque)""")
def q_cache_document_lines(spark, sf_dir):
    """The lines of every JSON document, in order, read back from its text."""
    return _parsed_documents(spark, sf_dir).select(
        "matricula", "ano", "mes", "folha_numero", F.posexplode("d.rubricas").alias("posicao", "r")).select(
        "matricula", "ano", "mes", "folha_numero", "posicao", "r.*")


@register("cache_document_fields", f"""
SELECT {DOC_KEY}, {', '.join(f"coalesce({O._strip('d.' + c)}, '') AS {k}" for k, c in DOC_TEXTS.items())},
       CAST(coalesce(t.bruto, 0) AS DOUBLE) AS bruto, CAST(coalesce(t.descontos, 0) AS DOUBLE) AS descontos,
       CAST(coalesce(t.bruto, 0) - coalesce(t.descontos, 0) AS DOUBLE) AS liquido
FROM d_cand d JOIN d_num n USING (id_contracheque) LEFT JOIN d_tot t USING (id_contracheque)""")
def q_cache_document_fields(spark, sf_dir):
    """The text fields and totals of every JSON document, read back from its text."""
    return _parsed_documents(spark, sf_dir).select("matricula", "ano", "mes", "folha_numero", "d.servidor.*", "d.resumo.*")


@register("cache_summary", """
SELECT (SELECT count(*) FROM d_cand) AS elegiveis, count(*) AS processados,
       CAST(sum(n_rubricas) AS BIGINT) AS total_rubricas FROM d_payload""")
def q_cache_summary(spark, sf_dir):
    """E13 (fresh store: nothing removed, every document inserted)."""
    m, c = doc_inputs(spark, sf_dir)
    p = D.payloads(c, m.item)
    u = c.select(F.lit(1).alias("e"), F.lit(0).alias("p"), F.lit(0).alias("r")).unionByName(
        p.select(F.lit(0).alias("e"), F.lit(1).alias("p"), F.size("contracheque.rubricas").alias("r")))
    return u.agg(F.sum("e").cast("bigint").alias("elegiveis"), F.sum("p").cast("bigint").alias("processados"),
                 F.sum("r").cast("bigint").alias("total_rubricas"))


# --- 2.A sources and sinks ------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from paygrid.functions import normalize as N  # noqa: E402
from paygrid.operators import sinks as S  # noqa: E402
from paygrid.operators.dedupe import surrogate_keys  # noqa: E402
from paygrid.sources import period as P  # noqa: E402

RAW37 = list(E.CHECK_COLUMNS)
FOLHA5 = ["MES_ANO_FOLHA", "NUM_FOLHA", "FOLHA", "DATA_CONSOLIDACAO", "DT_LIB_C_CHEQUE"]
CUT = _dt.date(1998, 1, 1)


@register("period_filter", """
SELECT NUMFUNC, NUMVINC, MES_ANO, NUMERO, RUBRICA FROM w
WHERE MES_ANO >= DATE '1996-12-01' AND MES_ANO < DATE '1997-01-01'""")
def q_period_filter(spark, sf_dir):
    """December window (the year rolls over at the upper bound)."""
    w = T.payroll_checks(spark, sf_dir)
    return P.filter_period(w, "MES_ANO", 1996, 12).select("NUMFUNC", "NUMVINC", "MES_ANO", "NUMERO", "RUBRICA")


@register("period_range", """
SELECT NUMFUNC, NUMVINC, MES_ANO, NUMERO, RUBRICA FROM w
WHERE MES_ANO >= DATE '1997-02-01' AND MES_ANO < DATE '1997-03-02'""")
def q_period_range(spark, sf_dir):
    """A1: explicit inclusive date range wins over the month."""
    w = T.payroll_checks(spark, sf_dir)
    return P.filter_period(w, "MES_ANO", 1997, 2, _dt.date(1997, 2, 1), _dt.date(1997, 3, 1)).select(
        "NUMFUNC", "NUMVINC", "MES_ANO", "NUMERO", "RUBRICA")


@register("scan_folhas", f"""
SELECT {', '.join(FOLHA5)} FROM fsrc WHERE MES_ANO_FOLHA >= DATE '1997-01-01' AND MES_ANO_FOLHA < DATE '1998-01-01'""")
def q_scan_folhas(spark, sf_dir):
    return P.scan_folhas(T.payroll_folhas(spark, sf_dir), 1997).drop("SRC_ORDER")


@register("scan_contracheques", f"""
SELECT {', '.join(RAW37)} FROM w WHERE MES_ANO >= DATE '1997-01-01' AND MES_ANO < DATE '1998-01-01'""")
def q_scan_contracheques(spark, sf_dir):
    return P.scan_contracheques(T.payroll_checks(spark, sf_dir), 1997).select(*RAW37)


@register("source_counts", """
SELECT (SELECT count(*) FROM fsrc WHERE MES_ANO_FOLHA >= DATE '1997-01-01' AND MES_ANO_FOLHA < DATE '1998-01-01')
         AS qtd_folhas,
       (SELECT count(*) FROM w WHERE MES_ANO >= DATE '1997-01-01' AND MES_ANO < DATE '1998-01-01')
         AS qtd_linhas_contracheque""")
def q_source_counts(spark, sf_dir):
    return P.source_counts(T.payroll_checks(spark, sf_dir), T.payroll_folhas(spark, sf_dir), 1997)


def _b3_sql(pred: str) -> str:
    return (f"SELECT numfunc, cpf, nome, pis_pasep, identidade FROM wn WHERE numfunc IS NOT NULL AND nome IS NOT NULL "
            f"AND {pred} QUALIFY row_number() OVER (PARTITION BY numfunc ORDER BY src_order DESC) = 1")


@register("upsert", f"""
SELECT CASE WHEN t.numfunc IS NOT NULL THEN t.id_servidor
            ELSE (SELECT count(*) FROM ({_b3_sql("mes_ano < DATE '1998-01-01'")}) q0)
                 + row_number() OVER (PARTITION BY t.numfunc IS NULL ORDER BY s.numfunc) END AS id_servidor,
       coalesce(t.numfunc, s.numfunc) AS numfunc,
       CASE WHEN s.numfunc IS NOT NULL THEN s.cpf ELSE t.cpf END AS cpf,
       CASE WHEN s.numfunc IS NOT NULL THEN s.nome ELSE t.nome END AS nome,
       CASE WHEN s.numfunc IS NOT NULL THEN s.pis_pasep ELSE t.pis_pasep END AS pis_pasep,
       CASE WHEN s.numfunc IS NOT NULL THEN s.identidade ELSE t.identidade END AS identidade
FROM (SELECT row_number() OVER (ORDER BY numfunc) AS id_servidor, *
      FROM ({_b3_sql("mes_ano < DATE '1998-01-01'")}) a) t
FULL OUTER JOIN ({_b3_sql("mes_ano >= DATE '1998-01-01'")}) s ON t.numfunc = s.numfunc""")
def q_upsert(spark, sf_dir):
    """Employees loaded up to 1997, then the 1998+ batch upserted on numfunc."""
    w = wide(spark, sf_dir)
    old = surrogate_keys(E.servidores(w.filter(F.col("mes_ano") < F.lit(CUT))), ["numfunc"], "id_servidor")
    new = E.servidores(w.filter(F.col("mes_ano") >= F.lit(CUT)))
    keys, upd = S.UPSERT_CONTRACTS["servidor"]
    return S.upsert(old.select("id_servidor", "numfunc", "cpf", "nome", "pis_pasep", "identidade"), new,
                    keys, [c for c in upd if c != "updated_at"], id_col="id_servidor")


ITEM_HASH_SQL = O.hash_sql("id_contracheque", "codigo_rubrica_origem", "complemento", "info",
                           f"coalesce(valor_vantagem, {O.Z})", f"coalesce(valor_desconto, {O.Z})",
                           f"coalesce(valor_auxiliar, {O.Z})")


@register("stable_hash", f"SELECT id_contracheque_item, {ITEM_HASH_SQL} AS hash_conteudo FROM t_item")
def q_stable_hash(spark, sf_dir):
    """Content hash of the stored lines."""
    it = migration(spark, sf_dir).item
    return it.select("id_contracheque_item", S.content_hash(it).alias("hash_conteudo"))


ITEM_COLS = ["id_contracheque_item", "id_contracheque", "id_rubrica", "sequencia_item", "codigo_rubrica_origem",
             "nome_rubrica_origem", "tipo_rubrica_origem", "complemento", "info", "valor_vantagem",
             "valor_desconto", "valor_auxiliar", "valor_total_item"]


@register("append_new_items", f"""
SELECT {', '.join(ITEM_COLS)} FROM t_item i
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT s.id_contracheque, {ITEM_HASH_SQL.replace('id_contracheque', 's.id_contracheque')} AS h
                 FROM t_item s JOIN t_cc c ON c.id_contracheque = s.id_contracheque WHERE c.ano < 1998) st
  WHERE st.id_contracheque = i.id_contracheque AND st.h = {ITEM_HASH_SQL})""")
def q_append_new_items(spark, sf_dir):
    """Lines of payslips stored up to 1997 are skipped, the rest are appended."""
    m = migration(spark, sf_dir)
    stored = m.item.join(m.contracheque.filter(F.col("ano") < 1998).select("id_contracheque"),
                         "id_contracheque", "left_semi")
    return S.append_if_absent(stored, m.item).select(*ITEM_COLS)


def _cache_rows(spark, sf_dir):
    m, c = doc_inputs(spark, sf_dir)
    return D.payloads(c, m.item).select("matricula", "ano", "mes", "folha_numero")


@register("scoped_delete", """
SELECT matricula, ano, mes, folha_numero FROM d_payload WHERE NOT (ano = 1997 AND mes = 3)""")
def q_scoped_delete(spark, sf_dir):
    """The cache after removing competência 03/1997."""
    remaining, _ = S.scoped_delete(_cache_rows(spark, sf_dir), 1997, 3)
    return remaining


@register("scoped_delete_count", "SELECT count(*) AS removidos FROM d_payload WHERE ano = 1997")
def q_scoped_delete_count(spark, sf_dir):
    """Rows removed by a whole-year refresh (1997)."""
    return S.scoped_delete(_cache_rows(spark, sf_dir), 1997)[1]


@register("cache_upsert_counts", """
SELECT count(*) AS processados, count(*) FILTER (WHERE ano > 1997) AS inseridos,
       count(*) FILTER (WHERE ano = 1997) AS atualizados
FROM d_payload WHERE ano >= 1997""")
def q_cache_upsert_counts(spark, sf_dir):
    """A refresh of 1997+ over a cache that holds documents up to 1997."""
    # Written once: the stored and the new rows are two readers.
    rows = materialize(_cache_rows(spark, sf_dir), "cache-rows")
    return S.cache_upsert_counts(rows.filter(F.col("ano") <= 1997), rows.filter(F.col("ano") >= 1997))


LOAD_SUMMARY_SQL = """
SELECT (SELECT count(*) FROM w) AS linhas_brutas, (SELECT count(*) FROM b_servidor) AS servidores_unicos,
  (SELECT count(*) FROM b_vinculo) AS vinculos_unicos, (SELECT count(*) FROM b_rubrica) AS rubricas_unicas,
  (SELECT count(*) FROM b_contracheque) AS contracheques_unicos_processados,
  (SELECT count(*) FROM b_snapshot) AS snapshots_processados, (SELECT count(*) FROM b_item) AS itens_processados,
  (SELECT count(*) FROM t_item) AS itens_inseridos,
  (SELECT count(*) FROM t_consolidado WHERE divergencia_bruto <> 0 OR divergencia_descontos <> 0
                                         OR divergencia_liquido <> 0) AS divergencias_encontradas,
  (SELECT count(*) FROM fsrc) AS folhas_lidas, (SELECT count(*) FROM t_errors) AS erros"""


def _load_counts(spark, sf_dir):
    """Every count comes from the job that writes the rows; no frame is read to be counted."""
    m = Migration(T.payroll_checks(spark, sf_dir), T.payroll_folhas(spark, sf_dir), counted=True)
    erros = m.n_rejects()
    materialize(m.counts.watch(divergencias_encontradas=F.count_if(R.is_divergent()))(m.consolidado), "consolidado")
    names = ["linhas_brutas", "servidores_unicos", "vinculos_unicos", "rubricas_unicas", "itens_processados", "itens_inseridos",
             "divergencias_encontradas", "folhas_lidas"]
    # A payslip is a header and a snapshot.
    payslips = m.counts["contracheques_unicos"]
    return m.counts.row(spark, names, contracheques_unicos_processados=payslips, snapshots_processados=payslips, erros=erros)


@register("load_summary", LOAD_SUMMARY_SQL)
def q_load_summary(spark, sf_dir):
    """Counts of a full load."""
    return _load_counts(spark, sf_dir)


@register("load_audit", f"""
SELECT 'ORACLE' AS tipo_origem, 'TODOS' AS referencia,
  CASE WHEN erros > 0 THEN 'SUCESSO_PARCIAL' ELSE 'SUCESSO' END AS status,
  folhas_lidas + linhas_brutas AS qtd_registros_lidos,
  contracheques_unicos_processados + itens_processados AS qtd_registros_processados,
  erros AS qtd_registros_erro, 'Execucao concluida.' AS observacao
FROM ({LOAD_SUMMARY_SQL}) s""")
def q_load_audit(spark, sf_dir):
    """The closing audit row of a full load."""
    c = _load_counts(spark, sf_dir).withColumnRenamed("contracheques_unicos_processados", "contracheques_unicos")
    return S.load_audit(c, "ORACLE", "TODOS", "Execucao concluida.")


# --- 2.I scalar functions over whole source columns -------------------------------------------

@register("norm_string", f"SELECT DISTINCT NOME AS nome_origem, {O._strip('NOME')} AS nome FROM w")
def q_norm_string(spark, sf_dir):
    w = T.payroll_checks(spark, sf_dir).select("NOME").distinct()
    return w.select(F.col("NOME").alias("nome_origem"), N.norm_string("NOME").alias("nome"))


@register("norm_folha_desc", f"SELECT DISTINCT FOLHA AS folha_origem, {O.folha_desc_sql('FOLHA')} AS folha_normalizada FROM w")
def q_norm_folha_desc(spark, sf_dir):
    w = T.payroll_checks(spark, sf_dir).select("FOLHA").distinct()
    return w.select(F.col("FOLHA").alias("folha_origem"), N.norm_folha_desc("FOLHA").alias("folha_normalizada"))


@register("norm_token", f"""
SELECT DISTINCT FOLHA AS folha_origem, {O.token_sql('FOLHA')} AS token, {O.folha_tipo_sql('FOLHA')} AS folha_tipo FROM w""")
def q_norm_token(spark, sf_dir):
    # The token depends on the description alone: each distinct one is folded once, not once per line.
    w = T.payroll_checks(spark, sf_dir).select("FOLHA").distinct()
    return w.select(F.col("FOLHA").alias("folha_origem"), N.norm_token("FOLHA").alias("token"),
                    N.folha_tipo("FOLHA").alias("folha_tipo"))


@register("norm_decimal", f"""
SELECT DISTINCT l_extendedprice * l_discount AS valor_origem,
       {O._norm('money', 'l_extendedprice * l_discount')} AS valor FROM lineitem""")
def q_norm_decimal(spark, sf_dir):
    li = T.read_table(spark, sf_dir, "lineitem")
    v = F.col("l_extendedprice") * F.col("l_discount")
    return li.select(v.alias("valor_origem"), N.norm_decimal(v).alias("valor")).distinct()


@register("norm_int", """
SELECT DISTINCT CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE ' ' || CAST(o_custkey * 7 AS VARCHAR) || ' ' END AS texto_origem,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey * 7 AS BIGINT) END AS valor FROM orders""")
def q_norm_int(spark, sf_dir):
    o = T.read_table(spark, sf_dir, "orders")
    t = F.when(F.col("o_orderkey") % 9 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" "), (F.col("o_custkey") * 7).cast("string"), F.lit(" ")))
    return o.select(t.alias("texto_origem"), N.norm_int(t, "string").alias("valor")).distinct()


@register("norm_decimal_text", """
SELECT DISTINCT t AS texto_origem, CASE WHEN t = '' THEN NULL ELSE CAST((c + CASE WHEN b > 5 OR (b = 5 AND (z OR c % 2 = 1))
         THEN 1 ELSE 0 END) / 100.0 AS DECIMAL(15,2)) END AS valor
FROM (SELECT l_orderkey % 1000 * 100 + l_linenumber AS c, l_suppkey % 10 AS b, l_partkey % 2 = 1 AS z,
        CASE WHEN l_orderkey % 11 = 0 THEN '' ELSE CAST(l_orderkey % 1000 AS VARCHAR) || '.0' || CAST(l_linenumber AS VARCHAR)
          || CAST(l_suppkey % 10 AS VARCHAR) || CASE WHEN l_partkey % 2 = 1 THEN '00000000000000000000001' ELSE '' END END AS t
      FROM lineitem) x""")
def q_norm_decimal_text(spark, sf_dir):
    """I3 on texts with many decimals: half-even once, from the whole text."""
    li = T.read_table(spark, sf_dir, "lineitem")
    s = lambda c: c.cast("string")
    t = F.when(F.col("l_orderkey") % 11 == 0, F.lit("")).otherwise(F.concat(
        s(F.col("l_orderkey") % 1000), F.lit(".0"), s(F.col("l_linenumber")), s(F.col("l_suppkey") % 10),
        F.when(F.col("l_partkey") % 2 == 1, F.lit("00000000000000000000001")).otherwise(F.lit(""))))
    return li.select(t.alias("texto_origem"), N.norm_decimal(t).alias("valor")).distinct()


@register("norm_date_text", """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d 10:11:12') END AS texto_origem,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data, count(*) AS quantidade
FROM orders GROUP BY 1, 2""")
def q_norm_date_text(spark, sf_dir):
    """I4 on timestamp texts and empty texts."""
    o = T.read_table(spark, sf_dir, "orders")
    t = F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:11:12")))
    return o.groupBy(t.alias("texto_origem"), N.norm_date(t, "string").alias("data")).agg(
        F.count(F.lit(1)).alias("quantidade"))


@register("norm_token_text", """
SELECT DISTINCT p_name AS texto_origem, 'A ' || upper(p_name) || ' FI 12 A ACAO' AS token FROM part""")
def q_norm_token_text(spark, sf_dir):
    """I10 on wide spaces, full-width letters, ligatures, numerals and accents around table values."""
    p = T.read_table(spark, sf_dir, "part")
    t = F.concat(F.lit("\u2003\uff41\u2003"), F.col("p_name"), F.lit("  \ufb01 \u246b \u1ea5 a\u00e7\u00e3o\u00df "))
    return p.select(F.col("p_name").alias("texto_origem"), N.norm_token(t).alias("token")).distinct()


@register("norm_date", "SELECT CAST(o_orderdate AS DATE) AS data, count(*) AS quantidade FROM orders GROUP BY 1")
def q_norm_date(spark, sf_dir):
    o = T.read_table(spark, sf_dir, "orders")
    return o.groupBy(N.norm_date("o_orderdate").alias("data")).agg(F.count(F.lit(1)).alias("quantidade"))


# --- 2.L integrity checks -------------------------------------------------------------------------

from paygrid.operators import integrity as IG  # noqa: E402


def model_tables(spark, sf_dir, m: Migration | None = None) -> dict:
    m = m or migration(spark, sf_dir)
    return {"servidor": m.servidor, "servidor_vinculo": m.vinculo, "folha_referencia": m.folha,
            "contracheque": m.contracheque, "contracheque_snapshot_funcional": m.snapshot,
            "rubrica": m.rubrica, "contracheque_item": m.item, "contracheque_consolidado": m.consolidado}


@register("check_unique", O.unique_sql())
def q_check_unique(spark, sf_dir):
    return IG.check_unique(model_tables(spark, sf_dir))


def broken_tables(spark, sf_dir) -> dict:
    """The model with planted defects: employees repeated, payslips after 1997 missing, links without a flag."""
    t = model_tables(spark, sf_dir)
    return t | {
        "servidor": t["servidor"].unionByName(t["servidor"].filter(F.col("numfunc") % 10 == 0)),
        "contracheque": t["contracheque"].filter(F.col("ano") <= 1997),
        "servidor_vinculo": t["servidor_vinculo"].withColumn("ativo", F.when(F.col("numvinc") != 2, F.col("ativo")))}


@register("check_unique_defects", O.unique_sql(O.BROKEN))
def q_check_unique_defects(spark, sf_dir):
    return IG.check_unique(broken_tables(spark, sf_dir))


@register("check_fk_defects", O.fk_sql(O.BROKEN))
def q_check_fk_defects(spark, sf_dir):
    return IG.check_fk(broken_tables(spark, sf_dir))


@register("check_not_null_defects", O.not_null_sql(O.BROKEN))
def q_check_not_null_defects(spark, sf_dir):
    return IG.check_not_null(broken_tables(spark, sf_dir))


@register("check_fk", O.fk_sql())
def q_check_fk(spark, sf_dir):
    return IG.check_fk(model_tables(spark, sf_dir))


@register("check_not_null", O.not_null_sql())
def q_check_not_null(spark, sf_dir):
    return IG.check_not_null(model_tables(spark, sf_dir))


@register("check_domain", O.domain_sql())
def q_check_domain(spark, sf_dir):
    return IG.check_domain(model_tables(spark, sf_dir))


# --- 2.J incremental load --------------------------------------------------------------------------

STREAM_ROWS = 20_000        # source rows of a file, so of a batch, at every size


@register("incremental_load", """
SELECT c.numfunc, c.numvinc, c.mes_ano, c.numero, k.total_vantagens, k.total_descontos_itens, k.total_itens,
       k.divergencia_bruto, k.divergencia_descontos, k.divergencia_liquido
FROM t_consolidado k JOIN t_cc c USING (id_contracheque)""")
def q_incremental_load(spark, sf_dir):
    """The source streamed as files of order-key ranges converges to the one-shot load.

    The source is written in one job, range-partitioned by order key, and replayed file by file, so
    payslips span batches; ``foreachBatch`` upserts each into the store. The result is the stored
    consolidation with its business key.
    """
    import uuid

    from paygrid.schemas import PAYROLL_CHECKS_SCHEMA
    from paygrid.session import ensure_checkpoint_dir
    from paygrid.sources.store import Store
    from paygrid.streaming.incremental import load_stream, write_ranges

    root = f"{ensure_checkpoint_dir(spark)}/incremental-{uuid.uuid4().hex}"
    checks = T.payroll_checks(spark, sf_dir)
    write_ranges(checks, f"{root}/source", "SRC_ORDER.l_orderkey", STREAM_ROWS)
    from pyspark.sql import types as TT

    schema = TT.StructType(list(PAYROLL_CHECKS_SCHEMA.fields) + [checks.schema["SRC_ORDER"]])
    store = Store(spark, f"{root}/store")
    # Written once: every batch reads the payroll runs.
    folhas = materialize(T.payroll_folhas(spark, sf_dir), "stream-folhas")
    load_stream(spark, f"{root}/source", schema, folhas, store, f"{root}/checkpoint")
    k = store.read("contracheque_consolidado")
    c = store.read("contracheque").select("id_contracheque", "id_vinculo", "mes_ano", "numero")
    v = store.read("servidor_vinculo").select("id_vinculo", "id_servidor", "numvinc")
    s = store.read("servidor").select("id_servidor", "numfunc")
    return (k.join(c, "id_contracheque").join(v, "id_vinculo").join(s, "id_servidor")
            .select("numfunc", "numvinc", "mes_ano", "numero", "total_vantagens", "total_descontos_itens",
                    "total_itens", "divergencia_bruto", "divergencia_descontos", "divergencia_liquido"))


# --- remaining inventory keys: F1, F2, G1, I7, A11, I20 ---------------------------------------------

@register("keep_last", f"""
SELECT {O.KEY4}, src_order.l_orderkey AS origem_orderkey, src_order.l_linenumber AS origem_linenumber
FROM wn WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {O.KEY4} ORDER BY src_order DESC) = 1""")
def q_keep_last(spark, sf_dir):
    """which source line survives per payslip key (max_by over the source order, map-side partial)."""
    from paygrid.operators.dedupe import keep_last

    w = wide(spark, sf_dir).dropna(subset=E.PAYSLIP_KEY)
    k = keep_last(w.select(*E.PAYSLIP_KEY, "src_order"), E.PAYSLIP_KEY, "src_order", keep_order=True)
    return k.select(*E.PAYSLIP_KEY, F.col("src_order.l_orderkey").alias("origem_orderkey"),
                    F.col("src_order.l_linenumber").alias("origem_linenumber"))


@register("keep_last_default_order", f"""
SELECT {O.KEY4}, nome_rubrica, info, vantagem, desconto, auxiliar FROM wd
WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {O.KEY4} ORDER BY from_last) = 1""")
def q_keep_last_default_order(spark, sf_dir):
    """F1 on a source without an order column: the struct of all its columns orders the rows."""
    from paygrid.operators.dedupe import keep_last

    w = E.normalize_checks(T.payroll_checks(spark, sf_dir).drop("SRC_ORDER")).dropna(subset=E.PAYSLIP_KEY)
    cols = [*E.PAYSLIP_KEY, "nome_rubrica", "info", "vantagem", "desconto", "auxiliar"]
    return keep_last(w.select(*cols, "src_order"), E.PAYSLIP_KEY).select(*cols)


@register("fact_item_default_order", f"""
SELECT {O.KEY4}, codigo_rubrica_origem, complemento, info, valor_total_item,
       CAST(row_number() OVER (PARTITION BY {O.KEY4} ORDER BY from_last DESC) AS INTEGER) AS sequencia_item
FROM (SELECT {O.KEY4}, rubrica AS codigo_rubrica_origem, complemento, info, vantagem, desconto, auxiliar, from_last,
        CAST(coalesce(vantagem, 0) + coalesce(auxiliar, 0) - coalesce(desconto, 0) AS DECIMAL(15,2)) AS valor_total_item
      FROM wd WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {O.KEY4}, rubrica, coalesce(complemento, ''), coalesce(info, ''),
        coalesce(vantagem, 0), coalesce(desconto, 0), coalesce(auxiliar, 0) ORDER BY from_last) = 1) x""")
def q_fact_item_default_order(spark, sf_dir):
    """B8/F2 on a source without an order column."""
    w = E.normalize_checks(T.payroll_checks(spark, sf_dir).drop("SRC_ORDER"))
    return E.itens(w).select(*E.PAYSLIP_KEY, "codigo_rubrica_origem", "complemento", "info", "valor_total_item",
                             "sequencia_item")


@register("item_sequence", f"SELECT {O.KEY4}, item_hash, sequencia_item FROM b_item")
def q_item_sequence(spark, sf_dir):
    """line number inside the payslip, in source order of the surviving lines."""
    return E.itens(wide(spark, sf_dir)).select(*E.PAYSLIP_KEY, "item_hash", "sequencia_item")


@register("item_total", "SELECT item_hash, valor_vantagem, valor_auxiliar, valor_desconto, valor_total_item FROM b_item")
def q_item_total(spark, sf_dir):
    """Vantagem + auxiliar - desconto with NULL as 0.00."""
    return E.itens(wide(spark, sf_dir), with_sequence=False).select("item_hash", "valor_vantagem", "valor_auxiliar", "valor_desconto",
                                               "valor_total_item")


@register("cache_page", f"""
SELECT {', '.join(CAND_COLS)} FROM d_cand
ORDER BY id_contracheque, numfunc, ano, mes, num_folha NULLS LAST, numero OFFSET 1000 LIMIT 1000""")
def q_cache_page(spark, sf_dir):
    """G1: the second 1,000-payslip page in the reference's candidate order (OFFSET/LIMIT is the feature)."""
    c = doc_inputs(spark, sf_dir)[1].select(*CAND_COLS)
    return c.orderBy("id_contracheque", "numfunc", "ano", "mes", F.col("num_folha").asc_nulls_last(),
                     "numero").offset(1000).limit(1000)


def _b5_sql(pred: str) -> str:
    return (f"SELECT rubrica AS codigo_rubrica, nome_rubrica, tipo_rubrica, 'S' AS ativa FROM wn "
            f"WHERE rubrica IS NOT NULL AND nome_rubrica IS NOT NULL AND {pred} "
            f"QUALIFY row_number() OVER (PARTITION BY rubrica ORDER BY src_order DESC) = 1")


@register("upsert_rubrica", f"""
SELECT CASE WHEN t.codigo_rubrica IS NOT NULL THEN t.id_rubrica
            ELSE (SELECT count(*) FROM ({_b5_sql("mes_ano < DATE '1998-01-01'")}) q0)
                 + row_number() OVER (PARTITION BY t.codigo_rubrica IS NULL ORDER BY s.codigo_rubrica) END AS id_rubrica,
       coalesce(t.codigo_rubrica, s.codigo_rubrica) AS codigo_rubrica,
       CASE WHEN s.codigo_rubrica IS NOT NULL THEN s.nome_rubrica ELSE t.nome_rubrica END AS nome_rubrica,
       CASE WHEN s.codigo_rubrica IS NOT NULL THEN s.tipo_rubrica ELSE t.tipo_rubrica END AS tipo_rubrica,
       CASE WHEN s.codigo_rubrica IS NOT NULL THEN s.ativa ELSE t.ativa END AS ativa
FROM (SELECT row_number() OVER (ORDER BY codigo_rubrica) AS id_rubrica, *
      FROM ({_b5_sql("mes_ano < DATE '1998-01-01'")}) a) t
FULL OUTER JOIN ({_b5_sql("mes_ano >= DATE '1998-01-01'")}) s ON t.codigo_rubrica = s.codigo_rubrica""")
def q_upsert_rubrica(spark, sf_dir):
    """Pay codes loaded up to 1997, then the 1998+ batch upserted on codigo_rubrica."""
    w = wide(spark, sf_dir)
    old = surrogate_keys(E.rubricas(w.filter(F.col("mes_ano") < F.lit(CUT))), ["codigo_rubrica"], "id_rubrica")
    new = E.rubricas(w.filter(F.col("mes_ano") >= F.lit(CUT)))
    keys, upd = S.UPSERT_CONTRACTS["rubrica"]
    return S.upsert(old.select("id_rubrica", "codigo_rubrica", "nome_rubrica", "tipo_rubrica", "ativa"), new,
                    keys, [c for c in upd if c != "updated_at"], id_col="id_rubrica")


@register("load_errors_payload")
def q_load_errors_payload(spark, sf_dir):
    """Reject rows with the source row as JSON (checked by rows: JSON number text differs by engine)."""
    return S.error_rows(migration(spark, sf_dir).rejects(with_payload=True), 1)


def _reject_sql(entity: str, key: str, tag: str, number: str) -> str:
    return (f"SELECT '{entity}' AS entidade, {key} AS chave_origem, _erro AS mensagem_erro, numfunc, numvinc, "
            f"{number} AS numero FROM {tag} WHERE _erro IS NOT NULL")


@register("load_errors_fields", "\nUNION ALL\n".join([
    _reject_sql("servidor_vinculo", "concat_ws(':', numfunc, numvinc)", "v_tag", "CAST(NULL AS BIGINT)"),
    _reject_sql("contracheque", "concat_ws(':', numfunc, numvinc, mes_ano, numero)", "c_tag", "numero"),
    _reject_sql("contracheque_snapshot_funcional", "concat_ws(':', numfunc, numvinc, mes_ano, numero)", "s_tag", "numero"),
    _reject_sql("contracheque_item", "item_hash", "i_tag", "numero")]))
def q_load_errors_fields(spark, sf_dir):
    """Key fields of the rejected source rows, read back from their JSON text."""
    r = migration(spark, sf_dir).rejects(with_payload=True)
    p = F.from_json("payload_origem", "numfunc bigint, numvinc bigint, numero bigint")
    return r.select("entidade", "chave_origem", "mensagem_erro", p.alias("p")).select(
        "entidade", "chave_origem", "mensagem_erro", "p.*")


# --- sources with planted faults: every reject message, and every constraint, finds something -----------

def planted_migration(spark, sf_dir) -> Migration:
    """Employees whose number 13 divides have no name anywhere, and no May has a payroll run."""
    checks = T.payroll_checks(spark, sf_dir).withColumn("NOME", F.when(F.col("NUMFUNC") % 13 != 0, F.col("NOME")))
    return Migration(checks, T.payroll_folhas(spark, sf_dir).filter(F.month("MES_ANO_FOLHA") != 5))


@register("load_errors_planted", "SELECT * FROM t_errors", O.PLANTED)
def q_load_errors_planted(spark, sf_dir):
    """All seven reject messages occur."""
    return planted_migration(spark, sf_dir).rejects(with_payload=False)


@register("vinculo_rejects_planted", "SELECT * FROM t_errors WHERE entidade = 'servidor_vinculo'", O.PLANTED)
def q_vinculo_rejects_planted(spark, sf_dir):
    return planted_migration(spark, sf_dir).vinculo_rejects.drop("payload_origem")


@register("sem_vinculo_planted", f"""
SELECT {O.KEY4} FROM b_contracheque c
WHERE NOT EXISTS (SELECT 1 FROM t_vinculo v WHERE v.numfunc = c.numfunc AND v.numvinc = c.numvinc)""", O.PLANTED)
def q_sem_vinculo_planted(spark, sf_dir):
    """D16 on links that are really missing."""
    m = planted_migration(spark, sf_dir)
    return Q.sem_vinculo(m.payslip_src, m.vinculo).select(*E.PAYSLIP_KEY)


def _twice(df: DataFrame, key: str) -> DataFrame:
    return df.unionByName(df.filter(F.col(key) % 7 == 0))


@register("check_unique_all_defects", O.unique_sql(O.REPEATED))
def q_check_unique_all_defects(spark, sf_dir):
    """L1: every unique key is violated, that of the cached documents included."""
    m, c = doc_inputs(spark, sf_dir)
    t = model_tables(spark, sf_dir, m) | {"contracheque_cache": D.payloads(c, m.item).drop("contracheque", "id_contracheque")}
    keys = {"servidor": "numfunc", "servidor_vinculo": "id_vinculo", "folha_referencia": "id_folha_referencia", "rubrica": "id_rubrica",
            "contracheque": "id_contracheque", "contracheque_snapshot_funcional": "id_contracheque",
            "contracheque_consolidado": "id_contracheque", "contracheque_cache": "folha_numero"}
    return IG.check_unique({name: _twice(t[name], key) for name, key in keys.items()})


@register("check_fk_all_defects", O.fk_sql(O.ORPHANED))
def q_check_fk_all_defects(spark, sf_dir):
    """L2: every foreign key is violated, that of the load errors included."""
    m = migration(spark, sf_dir)
    t = model_tables(spark, sf_dir, m)
    for name, key in (("servidor", "id_servidor"), ("servidor_vinculo", "id_vinculo"), ("folha_referencia", "id_folha_referencia"),
                      ("contracheque", "id_contracheque"), ("rubrica", "id_rubrica")):
        t[name] = t[name].filter(F.col(key) % 7 != 0)
    t["carga_importacao"] = spark.range(1, 2).withColumnRenamed("id", "id_carga")
    t["carga_importacao_erro"] = S.error_rows(m.rejects(), 1 + F.length("chave_origem") % 2)
    return IG.check_fk(t)


@register("check_domain_defects", O.domain_sql(O.TOO_WIDE))
def q_check_domain_defects(spark, sf_dir):
    """L4: values that are too wide for their VARCHAR or NUMERIC column, before they are cast to it."""
    m = migration(spark, sf_dir)
    wide_money = lambda c: F.col(c).cast("decimal(28,2)")
    return IG.check_domain({
        "contracheque": m.contracheque.withColumns({
            "bruto": F.when(F.col("numero") == 1, wide_money("bruto") * 100000000).otherwise(wide_money("bruto")),
            "competencia": F.repeat("competencia", F.lit(2))}),
        "contracheque_item": m.item.withColumn("valor_vantagem", wide_money("valor_vantagem") * 1000000000),
        "servidor": m.servidor.withColumn("cpf", F.concat("cpf", F.lit("x")))})


@register("check_source_domain", """
SELECT 'carga_horaria' AS coluna, 'decimal(10,2)' AS tipo, count(*) FILTER (WHERE NUMFUNC % 2 = 0) AS violacoes FROM w
UNION ALL SELECT 'bruto', 'decimal(15,2)', count(*) FILTER (WHERE NUMERO = 1) FROM w
UNION ALL SELECT 'descontos', 'decimal(15,2)', count(*) FILTER (WHERE abs(DESCONTOS * 1000000000) >= 10000000000000) FROM w
UNION ALL SELECT unnest(['liquido', 'vantagem', 'desconto', 'auxiliar']), 'decimal(15,2)', 0""")
def q_check_source_domain(spark, sf_dir):
    """L4/I3 on the source: text and wide money that the target has no room for."""
    w = T.payroll_checks(spark, sf_dir)
    return IG.check_source_domain(w.withColumns({
        "BRUTO": F.when(F.col("NUMERO") == 1, F.concat(F.lit("9876543210123456"), F.col("BRUTO").cast("string")))
        .otherwise(F.col("BRUTO").cast("string")),
        "DESCONTOS": F.col("DESCONTOS").cast("decimal(28,2)") * 1000000000,
        "CARGA_HORARIA": F.when(F.col("NUMFUNC") % 2 == 0, F.lit("123456789.00")).otherwise(F.lit("40.00"))}))


@register("norm_decimal_long", """
SELECT DISTINCT t AS texto_origem, CAST(n * CAST('1' || repeat('0', z) AS DECIMAL(38,0)) AS DECIMAL(38,2)) AS valor, length(CAST(n AS VARCHAR)) + z <= 13 AS cabe
FROM (SELECT *, CAST(n AS VARCHAR) || repeat('0', z) || '.00' AS t
      FROM (SELECT l_orderkey + 1 AS n, CAST(8 + l_linenumber * 2 AS INTEGER) AS z FROM lineitem) a) b""")
def q_norm_decimal_long(spark, sf_dir):
    """Numbers of 10 to 28 integer digits keep their value, and say whether the target has room."""
    li = T.read_table(spark, sf_dir, "lineitem")
    zeros = F.repeat(F.lit("0"), (8 + F.col("l_linenumber") * 2).cast("int"))
    t = F.concat((F.col("l_orderkey") + 1).cast("string"), zeros, F.lit(".00"))
    v = N.norm_decimal_wide("texto_origem")
    return li.select(t.alias("texto_origem")).distinct().select("texto_origem", v.alias("valor"), N.fits(v).alias("cabe"))


# --- A4 chunked scan, G1 pages, C3 scopes ---------------------------------------------------------------

@register("chunked_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS data FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-03-15' AND CAST(o_orderdate AS DATE) < DATE '1998-02-01'""")
def q_chunked_scan(spark, sf_dir):
    """A4: one partition per month window; the period filter leaves the windows it touches."""
    from paygrid.sources import chunks

    chunks.register(spark)
    o = spark.read.format(chunks.FORMAT).option("path", f"{sf_dir}/orders.parquet").option("column", "o_orderdate").load()
    kind = o.schema["o_orderdate"].dataType
    lo, hi = (F.lit(d).cast(kind) for d in (_dt.date(1996, 3, 15), _dt.date(1998, 2, 1)))
    o = o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
    return o.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("data"))


@register("cache_pages", """
SELECT CAST((rk - 1) // 1000 AS BIGINT) AS pagina, min(id_contracheque) AS primeiro_id, max(id_contracheque) AS ultimo_id, count(*) AS linhas
FROM (SELECT id_contracheque, row_number() OVER (ORDER BY id_contracheque) AS rk FROM d_cand WHERE ano >= 1995) x GROUP BY 1""")
def q_cache_pages(spark, sf_dir):
    """G1: every page of the candidates from 1995 on, by its key bounds."""
    return D.pages(doc_inputs(spark, sf_dir)[1].filter(F.col("ano") >= 1995))


@register("cache_scope_matricula", """
SELECT id_contracheque, numfunc, ano, mes FROM d_cand WHERE ano = 1996 AND CAST(numfunc AS VARCHAR) LIKE '%7'""")
def q_cache_scope_matricula(spark, sf_dir):
    """C3 by matrícula, for all employees whose number ends in 7."""
    m, c = doc_inputs(spark, sf_dir, year=1996)
    ids = m.servidor.filter(F.col("numfunc") % 10 == 7).select("numfunc")
    return c.join(ids, "numfunc", "left_semi").select("id_contracheque", "numfunc", "ano", "mes")


@register("cache_scope_range", """
SELECT id_contracheque, numfunc, ano, mes FROM d_cand JOIN (SELECT id_contracheque, mes_ano FROM t_cc) k USING (id_contracheque)
WHERE mes_ano >= DATE '1995-11-01' AND mes_ano <= DATE '1996-02-01'""")
def q_cache_scope_range(spark, sf_dir):
    """C3 by date range, its end included."""
    c = doc_inputs(spark, sf_dir, start_date=_dt.date(1995, 11, 1), end_date=_dt.date(1996, 2, 1))[1]
    return c.select("id_contracheque", "numfunc", "ano", "mes")
