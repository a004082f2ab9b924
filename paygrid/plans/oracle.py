"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

The SQL is built from named CTEs; ``sql(name, final)`` emits the CTEs that
``final`` needs (transitively) followed by the final SELECT. The payroll-shaped
view of the driver tables is the same mapping as ``paygrid.sources.tables``.
"""

from __future__ import annotations

import re

# The oracle spells out its own fixed values: nothing here comes from the code under test.
KEY4 = "numfunc, numvinc, mes_ano, numero"

# Code points that the source's strip() removes.
WHITESPACE = [0x9, 0xa, 0xb, 0xc, 0xd, 0x1c, 0x1d, 0x1e, 0x1f, 0x20, 0x85, 0xa0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
              0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200a, 0x2028, 0x2029, 0x202f, 0x205f, 0x3000]

# Month tokens of run descriptions and their two-digit numbers (fixed values).
MONTH_TOKENS = {
    "JAN": "01", "JANEIRO": "01",
    "FEB": "02", "FEV": "02", "FEVEREIRO": "02",
    "MAR": "03", "MARCO": "03", "MARÇO": "03",
    "APR": "04", "ABR": "04", "ABRIL": "04",
    "MAY": "05", "MAI": "05", "MAIO": "05",
    "JUN": "06", "JUNHO": "06",
    "JUL": "07", "JULHO": "07",
    "AUG": "08", "AGO": "08", "AGOSTO": "08",
    "SEP": "09", "SET": "09", "SETEMBRO": "09",
    "OCT": "10", "OUT": "10", "OUTUBRO": "10",
    "NOV": "11", "NOVEMBRO": "11",
    "DEC": "12", "DEZ": "12", "DEZEMBRO": "12",
}
# One replacement per month, the longest token first.
MONTHS = {n: sorted((t for t, m in MONTH_TOKENS.items() if m == n), key=len, reverse=True) for n in sorted(set(MONTH_TOKENS.values()))}

# Kind of every column of the two sources, in source order.
CHECK_COLUMNS = {
    "MES_ANO": "date", "NUMERO": "int", "NUMFUNC": "int", "NUMVINC": "int", "DATA_CONSOLIDACAO": "date",
    "DT_LIB_C_CHEQUE": "date", "CPF": "str", "NOME": "str", "PIS_PASEP": "str", "IDENTIDADE": "str",
    "ID_FUNCIONAL": "str", "REGIME_JURIDICO": "str", "TIPO_VINCULO": "str", "FOLHA": "str", "COMPETENCIA": "str",
    "ORGAO": "str", "CARGO": "str", "REF_CARGO": "str", "FUNCAO": "str", "REF_FUNCAO": "str", "MUNICIPIO": "str",
    "SETOR": "str", "BANCO": "str", "AGENCIA": "str", "CONTA": "str", "CARGA_HORARIA": "hours", "BRUTO": "money",
    "DESCONTOS": "money", "LIQUIDO": "money", "RUBRICA": "int", "NOME_RUBRICA": "str", "TIPO_RUBRICA": "str",
    "COMPLEMENTO": "str", "INFO": "str", "VANTAGEM": "money", "DESCONTO": "money", "AUXILIAR": "money",
}
FOLHA_COLUMNS = {"MES_ANO_FOLHA": "date", "NUM_FOLHA": "int", "FOLHA": "str", "DATA_CONSOLIDACAO": "date",
                 "DT_LIB_C_CHEQUE": "date"}

WS_SQL = "(" + " || ".join(f"chr({c})" for c in WHITESPACE) + ")"
WS_RE = "[" + "".join(f"\\x{{{c:x}}}" for c in WHITESPACE) + "]+"


def _trim(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {WS_SQL})"


def _strip(x: str) -> str:
    return f"nullif({_trim(x)}, '')"


def _norm(kind: str, x: str) -> str:
    if kind == "str":
        return _strip(x)
    if kind == "int":
        return f"CAST({x} AS BIGINT)"
    if kind == "date":
        return f"CAST({x} AS DATE)"
    if kind == "money":
        return f"CAST(round_even(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DECIMAL(15,2))"
    if kind == "hours":
        return f"CAST(round_even(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DECIMAL(10,2))"
    raise ValueError(kind)


def folha_desc_sql(x: str) -> str:
    """Run-description canonical form (same rules as ``norm_folha_desc``; RE2 has no look-behind)."""
    out = f"upper(regexp_replace({_strip(x)}, '{WS_RE}', ' ', 'g'))"
    for number, aliases in MONTHS.items():
        alt = "|".join(aliases)
        out = f"regexp_replace({out}, '(^|[^A-ZÇ])({alt})/([0-9]{{4}})', '\\1{number}/\\3', 'g')"
    return f"regexp_replace({out}, '(^|[^0-9])([0-9])/([0-9]{{4}})', '\\10\\2/\\3', 'g')"


def token_sql(x: str) -> str:
    base = f"upper(coalesce({_strip(x)}, ''))"
    return _trim(f"regexp_replace(strip_accents({base}), '{WS_RE}', ' ', 'g')")


def folha_tipo_sql(x: str) -> str:
    t = token_sql(x)
    return (f"CASE WHEN contains({t}, 'DECIMO') OR contains({t}, '13') THEN 'DECIMO' "
            f"WHEN contains({t}, 'NORMAL') THEN 'NORMAL' WHEN contains({t}, 'AVULSA') THEN 'AVULSO' "
            f"WHEN contains({t}, 'ESTORNO') THEN 'ESTORNO' ELSE 'OUTROS' END")


def hash_sql(*parts: str) -> str:
    texts = ", ".join(f"coalesce({_trim(p)}, '')" for p in parts)
    return f"sha256(concat_ws('||', {texts}))"


def _folha_text(m: str, p: str) -> str:
    return (f"'  Folha   Normal ' || CASE WHEN {p} = 5 THEN 'Avulsa ' ELSE '' END || CAST({p} AS VARCHAR)"
            f" || ' - ' || strftime({m}, '%b') || '/' || strftime({m}, '%Y') || ' '")


M0 = "CAST(date_trunc('month', o.o_orderdate) AS DATE)"
PRIO = "CAST(split_part(o.o_orderpriority, '-', 1) AS BIGINT)"
BRUTO = "CAST(o.o_totalprice AS DECIMAL(15,2))"
DESC10 = f"CAST(round_even({BRUTO} * 0.10, 2) AS DECIMAL(15,2))"
PRICE = "CAST(l.l_extendedprice AS DECIMAL(15,2))"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, body: str, deps: list[str]) -> None:
    CTES[name] = body
    DEPS[name] = deps


cte("w", f"""
SELECT
  {M0} AS MES_ANO,
  1 + o.o_orderkey % 3 AS NUMERO,
  o.o_custkey AS NUMFUNC,
  1 + o.o_orderkey % 2 AS NUMVINC,
  last_day({M0}) AS DATA_CONSOLIDACAO,
  CASE WHEN {PRIO} = 3 THEN NULL ELSE CAST(o.o_orderdate AS DATE) + 5 END AS DT_LIB_C_CHEQUE,
  lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') AS CPF,
  CASE WHEN l.l_linenumber = 4 AND o.o_orderkey % 5 = 0 THEN NULL
       WHEN l.l_linenumber = 2 THEN '  ' || c.c_name || ' ' ELSE c.c_name END AS NOME,
  CASE WHEN o.o_custkey % 4 = 0 THEN '' ELSE lpad(CAST(o.o_custkey * 7 AS VARCHAR), 11, '0') END AS PIS_PASEP,
  CASE WHEN o.o_custkey % 3 = 0 THEN NULL ELSE 'RG' || CAST(o.o_custkey AS VARCHAR) END AS IDENTIDADE,
  CAST(o.o_custkey AS VARCHAR) || '-' || CAST(1 + o.o_orderkey % 2 AS VARCHAR) AS ID_FUNCIONAL,
  CASE WHEN o.o_orderstatus = 'F' THEN 'ESTATUTARIO' WHEN o.o_orderstatus = 'O' THEN ' CLT ' ELSE '' END AS REGIME_JURIDICO,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'EFETIVO' ELSE 'COMISSIONADO' END AS TIPO_VINCULO,
  {_folha_text(M0, PRIO)} AS FOLHA,
  CASE WHEN {PRIO} = 2 THEN NULL ELSE strftime({M0}, '%m/%Y') END AS COMPETENCIA,
  n.n_name AS ORGAO,
  c.c_mktsegment AS CARGO,
  'R' || CAST({PRIO} AS VARCHAR) AS REF_CARGO,
  CASE WHEN o.o_orderkey % 4 = 0 THEN 'CHEFE DE SECAO' ELSE NULL END AS FUNCAO,
  CASE WHEN o.o_orderkey % 4 = 0 THEN ' F1 ' ELSE '' END AS REF_FUNCAO,
  'CIDADE ' || CAST(c.c_nationkey AS VARCHAR) AS MUNICIPIO,
  '  SETOR ' || CAST(o.o_orderkey % 10 AS VARCHAR) || '  ' AS SETOR,
  '001' AS BANCO,
  lpad(CAST(o.o_custkey % 10000 AS VARCHAR), 4, '0') AS AGENCIA,
  CAST(o.o_custkey * 13 AS VARCHAR) AS CONTA,
  CAST(CASE WHEN {PRIO} = 4 THEN 20.00 ELSE 40.00 END AS DECIMAL(10,2)) AS CARGA_HORARIA,
  {BRUTO} AS BRUTO,
  {DESC10} AS DESCONTOS,
  CAST({BRUTO} - {DESC10} AS DECIMAL(15,2)) AS LIQUIDO,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_partkey END AS RUBRICA,
  CASE WHEN p.p_partkey % 50 = 0 THEN '  ' ELSE p.p_name END AS NOME_RUBRICA,
  p.p_type AS TIPO_RUBRICA,
  CASE WHEN l.l_linenumber = 1 THEN NULL ELSE 'C' || CAST(l.l_linenumber AS VARCHAR) END AS COMPLEMENTO,
  l.l_linestatus || ' ' || CAST(l.l_suppkey AS VARCHAR) AS INFO,
  CASE WHEN l.l_returnflag = 'N' THEN {PRICE} END AS VANTAGEM,
  CASE WHEN l.l_returnflag = 'R' THEN CAST(round_even({PRICE} * CAST(l.l_discount AS DECIMAL(5,2)), 2) AS DECIMAL(15,2)) END AS DESCONTO,
  CASE WHEN l.l_returnflag = 'A' THEN CAST(round_even({PRICE} * CAST(l.l_tax AS DECIMAL(5,2)), 2) AS DECIMAL(15,2)) END AS AUXILIAR,
  struct_pack(l_orderkey := l.l_orderkey, l_linenumber := l.l_linenumber, l_partkey := l.l_partkey,
              l_suppkey := l.l_suppkey, l_quantity := l.l_quantity, l_extendedprice := l.l_extendedprice,
              l_discount := l.l_discount, l_tax := l.l_tax, l_returnflag := l.l_returnflag,
              l_linestatus := l.l_linestatus, l_shipdate := l.l_shipdate) AS SRC_ORDER
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
""", [])

cte("fsrc", f"""
SELECT m AS MES_ANO_FOLHA, p AS NUM_FOLHA, {_folha_text('m', 'p')} AS FOLHA,
       last_day(m) AS DATA_CONSOLIDACAO, m + 4 AS DT_LIB_C_CHEQUE,
       struct_pack(mes := m, num := p) AS SRC_ORDER
FROM (SELECT DISTINCT {M0} AS m, {PRIO} AS p FROM orders o) r
WHERE (month(m) % 2 = 1 OR p = 1) AND NOT (month(m) = 12 AND p = 1)
""", [])

cte("wn", "SELECT " + ",\n  ".join(
    [f"{_norm(kind, name)} AS {name.lower()}" for name, kind in CHECK_COLUMNS.items()]
    + ["SRC_ORDER AS src_order"]) + "\nFROM w", ["w"])

cte("nf", "SELECT " + ",\n  ".join(
    [f"{_norm(kind, name)} AS {name.lower()}" for name, kind in FOLHA_COLUMNS.items()]
    + ["SRC_ORDER AS src_order"]) + "\nFROM fsrc", ["fsrc"])


def _last(keys: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY src_order DESC) = 1"


cte("b_folha", f"""
SELECT mes_ano_folha, num_folha, folha AS descricao_folha, data_consolidacao, dt_lib_c_cheque,
       'S' AS ativa, CAST(year(mes_ano_folha) AS INTEGER) AS ano, CAST(month(mes_ano_folha) AS INTEGER) AS mes,
       src_order
FROM nf WHERE mes_ano_folha IS NOT NULL AND num_folha IS NOT NULL
{_last('mes_ano_folha, num_folha')}""", ["nf"])

cte("b_servidor", f"""
SELECT numfunc, cpf, nome, pis_pasep, identidade FROM wn
WHERE numfunc IS NOT NULL AND nome IS NOT NULL
{_last('numfunc')}""", ["wn"])

cte("b_vinculo", f"""
SELECT numfunc, numvinc, id_funcional, regime_juridico, tipo_vinculo, 'S' AS ativo FROM wn
WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL
{_last('numfunc, numvinc')}""", ["wn"])

cte("b_rubrica", f"""
SELECT rubrica AS codigo_rubrica, nome_rubrica, tipo_rubrica, 'S' AS ativa FROM wn
WHERE rubrica IS NOT NULL AND nome_rubrica IS NOT NULL
{_last('rubrica')}""", ["wn"])

cte("b_contracheque", f"""
SELECT {KEY4}, folha AS folha_descricao_origem, competencia, bruto, descontos, liquido,
       data_consolidacao, dt_lib_c_cheque,
       CAST(year(mes_ano) AS INTEGER) AS ano, CAST(month(mes_ano) AS INTEGER) AS mes,
       {hash_sql('numfunc', 'numvinc', 'mes_ano', 'numero')} AS hash_origem
FROM wn WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
{_last(KEY4)}""", ["wn"])

cte("b_snapshot", f"""
SELECT {KEY4}, orgao, cargo, ref_cargo, funcao, ref_funcao, municipio, setor, regime_juridico,
       tipo_vinculo, banco, agencia, conta, carga_horaria
FROM wn WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
{_last(KEY4)}""", ["wn"])

# Source order where no order column is given: all columns in order, NULL smallest.
DEFAULT_LAST = ", ".join(f"{c} DESC NULLS LAST" for c in CHECK_COLUMNS)
cte("wd", "SELECT " + ",\n  ".join([f"{_norm(kind, name)} AS {name.lower()}" for name, kind in CHECK_COLUMNS.items()])
    + f",\n  row_number() OVER (ORDER BY {DEFAULT_LAST}) AS from_last\nFROM w", ["w"])

Z = "CAST(0 AS DECIMAL(15,2))"
cte("b_item0", f"""
SELECT {KEY4}, rubrica AS codigo_rubrica_origem, nome_rubrica AS nome_rubrica_origem,
       tipo_rubrica AS tipo_rubrica_origem, complemento, info,
       vantagem AS valor_vantagem, desconto AS valor_desconto, auxiliar AS valor_auxiliar,
       CAST(coalesce(vantagem, {Z}) + coalesce(auxiliar, {Z}) - coalesce(desconto, {Z}) AS DECIMAL(15,2)) AS valor_total_item,
       {hash_sql('numfunc', 'numvinc', 'mes_ano', 'numero', 'rubrica', 'complemento', 'info',
                 f'coalesce(vantagem, {Z})', f'coalesce(desconto, {Z})', f'coalesce(auxiliar, {Z})')} AS item_hash,
       src_order
FROM wn WHERE numfunc IS NOT NULL AND numvinc IS NOT NULL AND mes_ano IS NOT NULL AND numero IS NOT NULL
{_last('item_hash')}""", ["wn"])

cte("b_item", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY {KEY4} ORDER BY src_order) AS INTEGER) AS sequencia_item
FROM b_item0""", ["b_item0"])


def _deps(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in DEPS[n]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


# Planted faults of the source: employees without any name, and months without a payroll run.
PLANTED = {"w": "SELECT * REPLACE (CASE WHEN NUMFUNC % 13 = 0 THEN NULL ELSE NOME END AS NOME) FROM ({}) x",
           "fsrc": "SELECT * FROM ({}) x WHERE month(MES_ANO_FOLHA) <> 5"}


def sql(final: str, planted: dict[str, str] | None = None) -> str:
    """WITH <needed CTEs> <final>; CTE names are found in ``final`` by word match.

    ``planted`` wraps the named CTEs (``{}`` stands for their own text).
    """
    used = [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", final)]
    order = _deps(used)
    body = ",\n".join(f"{n} AS ({(planted or {}).get(n, '{}').replace('{}', CTES[n])})" for n in order)
    return f"WITH {body}\n{final}" if order else final


# --- resolved model: ids, reject splits, folha mapping ----------------------------

cte("t_servidor", "SELECT row_number() OVER (ORDER BY numfunc) AS id_servidor, * FROM b_servidor", ["b_servidor"])
cte("t_folha", "SELECT row_number() OVER (ORDER BY mes_ano_folha, num_folha) AS id_folha_referencia, * FROM b_folha",
    ["b_folha"])
cte("t_rubrica", "SELECT row_number() OVER (ORDER BY codigo_rubrica) AS id_rubrica, * FROM b_rubrica", ["b_rubrica"])
cte("v_tag", """
SELECT v.*, s.id_servidor,
  CASE WHEN s.id_servidor IS NULL THEN 'Servidor nao encontrado para o vinculo.' END AS _erro
FROM b_vinculo v LEFT JOIN t_servidor s USING (numfunc)""", ["b_vinculo", "t_servidor"])
cte("t_vinculo", """
SELECT row_number() OVER (ORDER BY id_servidor, numvinc) AS id_vinculo, * EXCLUDE (_erro)
FROM v_tag WHERE _erro IS NULL""", ["v_tag"])
cte("f_desc", f"""
SELECT mes_ano_folha AS fd_mes, {folha_desc_sql('descricao_folha')} AS fd_desc, id_folha_referencia AS fd_id
FROM t_folha
QUALIFY row_number() OVER (PARTITION BY mes_ano_folha, {folha_desc_sql('descricao_folha')} ORDER BY src_order DESC) = 1""",
    ["t_folha"])
cte("f_mes", """
SELECT mes_ano_folha AS fm_mes, min(id_folha_referencia) AS fm_id FROM t_folha
GROUP BY mes_ano_folha HAVING count(DISTINCT id_folha_referencia) = 1""", ["t_folha"])
cte("c_tag", f"""
SELECT c.*, v.id_servidor, v.id_vinculo, fd.fd_id AS id_folha_por_descricao, fm.fm_id AS id_folha_por_mes,
  coalesce(fd.fd_id, fm.fm_id) AS id_folha_referencia,
  CASE WHEN v.id_vinculo IS NULL THEN 'Vinculo nao encontrado para o contracheque.'
       WHEN coalesce(fd.fd_id, fm.fm_id) IS NULL THEN 'Folha de referencia nao encontrada para o contracheque.'
  END AS _erro
FROM b_contracheque c
LEFT JOIN t_vinculo v USING (numfunc, numvinc)
LEFT JOIN f_desc fd ON c.mes_ano = fd.fd_mes AND {folha_desc_sql('c.folha_descricao_origem')} IS NOT DISTINCT FROM fd.fd_desc
LEFT JOIN f_mes fm ON c.mes_ano = fm.fm_mes""", ["b_contracheque", "t_vinculo", "f_desc", "f_mes"])
cte("t_cc", """
SELECT row_number() OVER (ORDER BY id_vinculo, mes_ano, numero) AS id_contracheque, * EXCLUDE (_erro)
FROM c_tag WHERE _erro IS NULL""", ["c_tag"])


def _child_tag(src: str, msg_link: str, msg_cc: str) -> str:
    return f"""
SELECT x.*, cc.id_contracheque,
  CASE WHEN v.id_vinculo IS NULL THEN '{msg_link}' WHEN cc.id_contracheque IS NULL THEN '{msg_cc}' END AS _erro
FROM {src} x
LEFT JOIN (SELECT numfunc, numvinc, id_vinculo FROM t_vinculo) v USING (numfunc, numvinc)
LEFT JOIN (SELECT {KEY4}, id_contracheque FROM t_cc) cc USING ({KEY4})"""


cte("s_tag", _child_tag("b_snapshot", "Vinculo nao encontrado para snapshot.",
                        "Contracheque nao encontrado para snapshot."), ["b_snapshot", "t_vinculo", "t_cc"])
cte("i_tag", _child_tag("b_item", "Vinculo nao encontrado para item.",
                        "Contracheque nao encontrado para item."), ["b_item", "t_vinculo", "t_cc"])
cte("t_snapshot", """
SELECT row_number() OVER (ORDER BY id_contracheque) AS id_snapshot, id_contracheque, orgao, cargo, ref_cargo,
  funcao, ref_funcao, municipio, setor, regime_juridico, tipo_vinculo, banco, agencia, conta, carga_horaria
FROM s_tag WHERE _erro IS NULL""", ["s_tag"])
cte("t_item", """
SELECT row_number() OVER (ORDER BY i.id_contracheque, i.sequencia_item) AS id_contracheque_item,
  i.id_contracheque, r.id_rubrica, i.sequencia_item, i.codigo_rubrica_origem, i.nome_rubrica_origem,
  i.tipo_rubrica_origem, i.complemento, i.info, i.valor_vantagem, i.valor_desconto, i.valor_auxiliar,
  i.valor_total_item, i.item_hash
FROM i_tag i LEFT JOIN t_rubrica r ON i.codigo_rubrica_origem = r.codigo_rubrica
WHERE i._erro IS NULL""", ["i_tag", "t_rubrica"])
cte("t_consolidado", f"""
SELECT row_number() OVER (ORDER BY c.id_contracheque) AS id_contracheque_consolidado, c.id_contracheque,
  CAST(coalesce(t.sv, 0) + coalesce(t.sa, 0) AS DECIMAL(15,2)) AS total_vantagens,
  CAST(coalesce(t.sd, 0) AS DECIMAL(15,2)) AS total_descontos_itens,
  CAST(coalesce(t.n, 0) AS INTEGER) AS total_itens,
  CAST(coalesce(c.bruto, 0) - (coalesce(t.sv, 0) + coalesce(t.sa, 0)) AS DECIMAL(15,2)) AS divergencia_bruto,
  CAST(coalesce(c.descontos, 0) - coalesce(t.sd, 0) AS DECIMAL(15,2)) AS divergencia_descontos,
  CAST(coalesce(c.liquido, 0) - (coalesce(t.sv, 0) + coalesce(t.sa, 0) - coalesce(t.sd, 0)) AS DECIMAL(15,2)) AS divergencia_liquido
FROM t_cc c
LEFT JOIN (SELECT id_contracheque, sum(valor_vantagem) AS sv, sum(valor_auxiliar) AS sa, sum(valor_desconto) AS sd,
                  count(*) AS n FROM t_item GROUP BY id_contracheque) t USING (id_contracheque)""", ["t_cc", "t_item"])
cte("t_errors", f"""
SELECT 'servidor_vinculo' AS entidade, CAST(numfunc AS VARCHAR) || ':' || CAST(numvinc AS VARCHAR) AS chave_origem,
       _erro AS mensagem_erro FROM v_tag WHERE _erro IS NOT NULL
UNION ALL
SELECT 'contracheque', concat_ws(':', numfunc, numvinc, mes_ano, numero), _erro FROM c_tag WHERE _erro IS NOT NULL
UNION ALL
SELECT 'contracheque_snapshot_funcional', concat_ws(':', numfunc, numvinc, mes_ano, numero), _erro
FROM s_tag WHERE _erro IS NOT NULL
UNION ALL
SELECT 'contracheque_item', item_hash, _erro FROM i_tag WHERE _erro IS NOT NULL""", ["v_tag", "c_tag", "s_tag", "i_tag"])


# --- validation metrics -----------------------------------------------------------


def percent_sql(v: str, t: str) -> str:
    return (f"CAST(CASE WHEN {t} = 0 THEN 0 ELSE round_even(CAST({v} AS DECIMAL(38,10)) * 100 "
            f"/ CAST({t} AS DECIMAL(38,10)), 2) END AS DECIMAL(7,2))")


cte("q_status", f"""
SELECT c.*, CASE WHEN d.fd_mes IS NOT NULL THEN 'DESCRICAO' WHEN m.fm_runs = 1 THEN 'FALLBACK'
                 ELSE 'NAO_MAPEADO' END AS forma_mapeamento
FROM b_contracheque c
LEFT JOIN (SELECT DISTINCT mes_ano_folha AS fd_mes, {folha_desc_sql('descricao_folha')} AS fd_desc FROM b_folha) d
  ON c.mes_ano = d.fd_mes AND {folha_desc_sql('c.folha_descricao_origem')} IS NOT DISTINCT FROM d.fd_desc
LEFT JOIN (SELECT mes_ano_folha AS fm_mes, count(*) AS fm_runs FROM b_folha GROUP BY 1) m ON c.mes_ano = m.fm_mes
""", ["b_contracheque", "b_folha"])

cte("q_summary", f"""
SELECT total_contracheques, mapeados_por_descricao, mapeados_por_fallback, nao_mapeados,
  {percent_sql('mapeados_por_descricao + mapeados_por_fallback', 'total_contracheques')} AS taxa_sucesso,
  {percent_sql('mapeados_por_fallback', 'total_contracheques')} AS taxa_fallback,
  {percent_sql('nao_mapeados', 'total_contracheques')} AS taxa_erro
FROM (SELECT count(*) AS total_contracheques,
        count(*) FILTER (WHERE forma_mapeamento = 'DESCRICAO') AS mapeados_por_descricao,
        count(*) FILTER (WHERE forma_mapeamento = 'FALLBACK') AS mapeados_por_fallback,
        count(*) FILTER (WHERE forma_mapeamento = 'NAO_MAPEADO') AS nao_mapeados
      FROM q_status) s""", ["q_status"])

cte("q_rubq", """
SELECT
  (SELECT count(*) FROM (SELECT rubrica FROM wn WHERE rubrica IS NOT NULL GROUP BY rubrica
                         HAVING count(nome_rubrica) > 0)) AS rubricas_distintas,
  (SELECT count(*) FROM b_item WHERE codigo_rubrica_origem IS NULL) AS rubricas_nulas,
  (SELECT count(*) FROM (SELECT rubrica FROM wn WHERE rubrica IS NOT NULL GROUP BY rubrica
                         HAVING count(*) FILTER (WHERE nome_rubrica IS NULL) > 0)) AS nomes_rubrica_vazios""",
    ["wn", "b_item"])

cte("q_entities", """
SELECT (SELECT count(*) FROM b_servidor) AS servidores_unicos, (SELECT count(*) FROM b_vinculo) AS vinculos_unicos,
       (SELECT count(*) FROM b_rubrica) AS rubricas_unicas, (SELECT count(*) FROM b_contracheque) AS contracheques_unicos""",
    ["b_servidor", "b_vinculo", "b_rubrica", "b_contracheque"])

cte("q_media", f"""
SELECT CAST(CASE WHEN k = 0 THEN 0 ELSE round_even(CAST(n AS DECIMAL(38,10)) / k, 2) END AS DECIMAL(12,2))
         AS media_itens_por_contracheque
FROM (SELECT count(*) AS n, count(DISTINCT ({KEY4})) AS k FROM b_item) x""", ["b_item"])

cte("q_fmonths", """
SELECT mes_ano_folha AS mes_ano, count(*) AS quantidade_folhas,
       list_sort(list_distinct(list(num_folha))) AS num_folhas,
       list_sort(list_distinct(list(descricao_folha) FILTER (WHERE descricao_folha IS NOT NULL))) AS descricoes
FROM b_folha GROUP BY 1""", ["b_folha"])

cte("q_alerts", """
SELECT s.nao_mapeados = 0 AS mapeamento_ok, s.taxa_fallback >= 10 AS fallback_alto,
       (r.rubricas_nulas = 0 AND r.nomes_rubrica_vazios = 0) AS rubricas_consistentes
FROM q_summary s, q_rubq r""", ["q_summary", "q_rubq"])


def long_sql(section: str, cte_name: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS secao, '{c}' AS metrica, CAST({c} AS VARCHAR) AS valor FROM {cte_name}" for c in cols)


# --- documents (cache) ---------------------------------------------------------------

cte("d_cand", """
SELECT c.id_contracheque, s.numfunc, s.nome, s.cpf, s.pis_pasep, s.identidade, v.id_funcional,
  v.regime_juridico AS vinc_regime_juridico, v.tipo_vinculo AS vinc_tipo_vinculo, c.ano, c.mes,
  c.competencia, c.folha_descricao_origem, c.dt_lib_c_cheque, c.data_consolidacao, c.numero,
  fr.num_folha, fr.descricao_folha, csf.orgao, csf.cargo, csf.ref_cargo, csf.funcao, csf.ref_funcao,
  csf.municipio, csf.setor, csf.regime_juridico AS snap_regime_juridico, csf.tipo_vinculo AS snap_tipo_vinculo,
  csf.banco, csf.agencia, csf.conta, csf.carga_horaria
FROM t_cc c
JOIN t_vinculo v ON v.id_vinculo = c.id_vinculo
JOIN t_servidor s ON s.id_servidor = v.id_servidor
LEFT JOIN t_folha fr ON fr.id_folha_referencia = c.id_folha_referencia
LEFT JOIN t_snapshot csf ON csf.id_contracheque = c.id_contracheque
QUALIFY row_number() OVER (PARTITION BY c.id_contracheque
                           ORDER BY s.numfunc, c.ano, c.mes, fr.num_folha NULLS LAST, c.numero) = 1""",
    ["t_cc", "t_vinculo", "t_servidor", "t_folha", "t_snapshot"])

_ORD5 = "num_folha ASC NULLS LAST, numero ASC NULLS LAST, id_contracheque"
cte("d_num", f"""
SELECT unnest(ids) AS id_contracheque, unnest(used) AS folha_numero FROM (
  SELECT list(id_contracheque ORDER BY {_ORD5}) AS ids,
    list_reduce(list([num_folha, numero, id_contracheque] ORDER BY {_ORD5}),
      lambda acc, x: list_append(acc, coalesce(
        list_filter(x, lambda v: v IS NOT NULL AND v > 0 AND NOT list_contains(acc, v))[1],
        list_filter(range(greatest(900000000, x[3]), greatest(900000000, x[3]) + len(acc) + 1),
                    lambda v: NOT list_contains(acc, v))[1])), []::BIGINT[]) AS used
  FROM d_cand GROUP BY numfunc, ano, mes) g""", ["d_cand"])

cte("d_items", """
SELECT id_contracheque, codigo_rubrica_origem, nome_rubrica_origem, tipo_rubrica_origem,
       valor_vantagem, valor_desconto, valor_auxiliar
FROM t_item WHERE id_contracheque IN (SELECT id_contracheque FROM d_cand)""", ["t_item", "d_cand"])

cte("d_class", """
SELECT * FROM (
  SELECT id_contracheque, id_contracheque_item, sequencia_item, codigo_rubrica_origem, nome_rubrica_origem,
    CASE WHEN coalesce(valor_desconto, 0) > 0 THEN 'DESCONTO'
         WHEN coalesce(valor_vantagem, 0) + coalesce(valor_auxiliar, 0) > 0 THEN 'VANTAGEM' END AS tipo,
    CAST(CASE WHEN coalesce(valor_desconto, 0) > 0 THEN coalesce(valor_desconto, 0)
              WHEN coalesce(valor_vantagem, 0) + coalesce(valor_auxiliar, 0) > 0
              THEN coalesce(valor_vantagem, 0) + coalesce(valor_auxiliar, 0) ELSE 0 END AS DECIMAL(15,2)) AS valor
  FROM t_item WHERE id_contracheque IN (SELECT id_contracheque FROM d_cand)) x
WHERE tipo IS NOT NULL AND valor > 0""", ["t_item", "d_cand"])

cte("d_tot", """
SELECT id_contracheque,
  CAST(coalesce(sum(valor) FILTER (WHERE tipo = 'VANTAGEM'), 0) AS DECIMAL(15,2)) AS bruto,
  CAST(coalesce(sum(valor) FILTER (WHERE tipo = 'DESCONTO'), 0) AS DECIMAL(15,2)) AS descontos,
  CAST(coalesce(sum(valor) FILTER (WHERE tipo = 'VANTAGEM'), 0) - coalesce(sum(valor) FILTER (WHERE tipo = 'DESCONTO'), 0)
       AS DECIMAL(15,2)) AS liquido,
  count(*) AS total_rubricas
FROM d_class GROUP BY id_contracheque""", ["d_class"])


def _t(c: str) -> str:
    return f"coalesce({_strip(c)}, '')"


FOLHA_DESC = f"coalesce({_strip('d.descricao_folha')}, {_strip('d.folha_descricao_origem')}, '')"
cte("d_payload", f"""
SELECT d.id_contracheque, CAST(d.numfunc AS VARCHAR) AS matricula, {_t('d.cpf')} AS cpf,
  CAST(d.ano AS INTEGER) AS ano, CAST(d.mes AS INTEGER) AS mes, n.folha_numero,
  {folha_tipo_sql(FOLHA_DESC)} AS folha_tipo,
  coalesce({folha_desc_sql(FOLHA_DESC)}, {FOLHA_DESC}) AS folha_descricao,
  {_t('d.nome')} AS nome,
  coalesce({_strip('d.snap_regime_juridico')}, {_strip('d.vinc_regime_juridico')}, '') AS regime_juridico,
  coalesce({_strip('d.snap_tipo_vinculo')}, {_strip('d.vinc_tipo_vinculo')}, '') AS tipo_vinculo,
  CAST(coalesce(d.carga_horaria, 0) AS DOUBLE) AS carga_horaria,
  coalesce({_strip('d.folha_descricao_origem')}, {_strip('d.competencia')},
           lpad(CAST(d.mes AS VARCHAR), 2, '0') || '/' || CAST(d.ano AS VARCHAR)) AS competencia_descricao,
  coalesce(strftime(d.dt_lib_c_cheque, '%Y-%m-%d'), '') AS data_liberacao,
  {FOLHA_DESC} AS competencia_folha_descricao,
  CAST(coalesce(t.bruto, 0) AS DOUBLE) AS resumo_bruto,
  CAST(coalesce(t.descontos, 0) AS DOUBLE) AS resumo_descontos,
  CAST(coalesce(t.bruto, 0) - coalesce(t.descontos, 0) AS DOUBLE) AS resumo_liquido,
  CAST(coalesce(t.total_rubricas, 0) AS INTEGER) AS n_rubricas
FROM d_cand d JOIN d_num n USING (id_contracheque) LEFT JOIN d_tot t USING (id_contracheque)""",
    ["d_cand", "d_num", "d_tot"])


# --- integrity checks (generated from paygrid.schemas) -----------------------------------

from paygrid import schemas as _SC  # noqa: E402

TABLE_CTE = {"servidor": "t_servidor", "servidor_vinculo": "t_vinculo", "folha_referencia": "t_folha",
             "contracheque": "t_cc", "contracheque_snapshot_funcional": "t_snapshot", "rubrica": "t_rubrica",
             "contracheque_item": "t_item", "contracheque_consolidado": "t_consolidado"}


def _u(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Tables with planted defects: employees repeated, payslips after 1997 missing, links without a flag.
BROKEN = TABLE_CTE | {
    "servidor": "(SELECT * FROM t_servidor UNION ALL SELECT * FROM t_servidor WHERE numfunc % 10 = 0)",
    "contracheque": "(SELECT * FROM t_cc WHERE ano <= 1997)",
    "servidor_vinculo": "(SELECT * REPLACE (CASE WHEN numvinc = 2 THEN NULL ELSE ativo END AS ativo) FROM t_vinculo)",
}


def unique_sql(tables: dict[str, str] = TABLE_CTE) -> str:
    out = []
    for t, keys in _SC.UNIQUE.items():
        if t not in tables:
            continue
        k = ", ".join(keys)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
        out.append(f"SELECT '{t}' AS tabela, 'unique({','.join(keys)})' AS restricao, "
                   f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS violacoes "
                   f"FROM (SELECT count(*) AS n FROM {tables[t]} x WHERE {nn} GROUP BY {k}) g")
    return _u(out)


def fk_sql(tables: dict[str, str] = TABLE_CTE) -> str:
    out = []
    for child, col, parent, pcol in _SC.FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        out.append(f"SELECT '{child}' AS tabela, 'fk({col})->{parent}' AS restricao, CAST(count(*) AS BIGINT) AS violacoes "
                   f"FROM {tables[child]} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {tables[parent]} p WHERE p.{pcol} = c.{col})")
    return _u(out)


def not_null_sql(tables: dict[str, str] = TABLE_CTE) -> str:
    out = []
    for t, cols in _SC.NOT_NULL.items():
        if t not in tables:
            continue
        for c in cols:
            out.append(f"SELECT '{t}' AS tabela, 'not_null({c})' AS restricao, "
                       f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violacoes FROM {tables[t]} x")
    return _u(out)


def domain_sql(tables: dict[str, str] = TABLE_CTE) -> str:
    out = []
    for t in sorted(set(_SC.VARCHAR) | set(_SC.NUMERIC)):
        if t not in tables:
            continue
        for c, n in _SC.VARCHAR.get(t, {}).items():
            out.append(f"SELECT '{t}' AS tabela, 'varchar({c},{n})' AS restricao, "
                       f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violacoes FROM {tables[t]} x")
        for c, (p, s) in _SC.NUMERIC.get(t, {}).items():
            out.append(f"SELECT '{t}' AS tabela, 'numeric({c},{p},{s})' AS restricao, "
                       f"CAST(count(*) FILTER (WHERE abs({c}) >= {10 ** (p - s)}) AS BIGINT) AS violacoes "
                       f"FROM {tables[t]} x")
    return _u(out)


# One planted fault for every unique key, foreign key and kind of domain.
CACHE = "(SELECT matricula, cpf, ano, mes, folha_numero, folha_tipo, folha_descricao FROM d_payload)"


def _twice(table: str, key: str) -> str:
    return f"(SELECT * FROM {table} a UNION ALL SELECT * FROM {table} b WHERE {key} % 7 = 0)"


REPEATED = {"servidor": _twice("t_servidor", "numfunc"), "servidor_vinculo": _twice("t_vinculo", "id_vinculo"),
            "folha_referencia": _twice("t_folha", "id_folha_referencia"), "contracheque": _twice("t_cc", "id_contracheque"),
            "contracheque_snapshot_funcional": _twice("t_snapshot", "id_contracheque"), "rubrica": _twice("t_rubrica", "id_rubrica"),
            "contracheque_consolidado": _twice("t_consolidado", "id_contracheque"), "contracheque_cache": _twice(CACHE, "folha_numero")}
ORPHANED = {"servidor": "(SELECT * FROM t_servidor WHERE id_servidor % 7 <> 0)", "servidor_vinculo": "(SELECT * FROM t_vinculo WHERE id_vinculo % 7 <> 0)",
            "folha_referencia": "(SELECT * FROM t_folha WHERE id_folha_referencia % 7 <> 0)",
            "contracheque": "(SELECT * FROM t_cc WHERE id_contracheque % 7 <> 0)", "rubrica": "(SELECT * FROM t_rubrica WHERE id_rubrica % 7 <> 0)",
            "contracheque_snapshot_funcional": "t_snapshot", "contracheque_item": "t_item", "contracheque_consolidado": "t_consolidado",
            "carga_importacao": "(SELECT 1 AS id_carga)",
            "carga_importacao_erro": "(SELECT 1 + length(chave_origem) % 2 AS id_carga FROM t_errors)"}
TOO_WIDE = {
    "contracheque": "(SELECT * REPLACE (CASE WHEN numero = 1 THEN CAST(bruto AS DECIMAL(38,2)) * 100000000 ELSE bruto END AS bruto, "
                    "repeat(competencia, 2) AS competencia) FROM t_cc)",
    "contracheque_item": "(SELECT * REPLACE (CAST(valor_vantagem AS DECIMAL(38,2)) * 1000000000 AS valor_vantagem) FROM t_item)",
    "servidor": "(SELECT * REPLACE (cpf || 'x' AS cpf) FROM t_servidor)"}

