"""Entity projections: wide source -> seven normalised frames.

All share one shape: normalise each column once (``normalize_checks``), derive,
drop rows whose required columns are NULL, then keep the last row per key. The
wide frame is normalised once and every entity branches from it; a load writes
it (bronze) before branching so the source is scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrid.functions import normalize as N
from paygrid.operators.dedupe import ORDER_COL, keep_last

PAYSLIP_KEY = ["numfunc", "numvinc", "mes_ano", "numero"]

# Normaliser per source column of the wide view (fixed by the source contract).
CHECK_COLUMNS = {
    "MES_ANO": "date", "NUMERO": "int", "NUMFUNC": "int", "NUMVINC": "int",
    "DATA_CONSOLIDACAO": "date", "DT_LIB_C_CHEQUE": "date",
    "CPF": "str", "NOME": "str", "PIS_PASEP": "str", "IDENTIDADE": "str",
    "ID_FUNCIONAL": "str", "REGIME_JURIDICO": "str", "TIPO_VINCULO": "str",
    "FOLHA": "str", "COMPETENCIA": "str", "ORGAO": "str", "CARGO": "str",
    "REF_CARGO": "str", "FUNCAO": "str", "REF_FUNCAO": "str", "MUNICIPIO": "str",
    "SETOR": "str", "BANCO": "str", "AGENCIA": "str", "CONTA": "str",
    "CARGA_HORARIA": "hours", "BRUTO": "money", "DESCONTOS": "money", "LIQUIDO": "money",
    "RUBRICA": "int", "NOME_RUBRICA": "str", "TIPO_RUBRICA": "str",
    "COMPLEMENTO": "str", "INFO": "str", "VANTAGEM": "money", "DESCONTO": "money",
    "AUXILIAR": "money",
}

FOLHA_COLUMNS = {
    "MES_ANO_FOLHA": "date", "NUM_FOLHA": "int", "FOLHA": "str",
    "DATA_CONSOLIDACAO": "date", "DT_LIB_C_CHEQUE": "date",
}


def _normaliser(kind: str, col, dtype: str):
    if kind == "str":
        return N.norm_string(col)
    if kind == "int":
        return N.norm_int(col, dtype)
    if kind == "date":
        return N.norm_date(col, dtype)
    if kind == "money":
        return N.norm_decimal(col, source=dtype)
    if kind == "hours":
        return N.norm_decimal(col, "decimal(10,2)", source=dtype)
    raise ValueError(kind)


def _normalize(df: DataFrame, spec: dict[str, str], order: Sequence[str] | None) -> DataFrame:
    """B1 + per-column normalisers; output names are lower case.

    "Last row" needs a total order. It is the struct of the ``order`` columns where the caller
    names some, else a column ``SRC_ORDER`` where the source has one, else the struct of all
    source columns (rows equal in all of them are the same row).
    """
    upper = df.toDF(*[c.upper() for c in df.columns])
    types = dict(upper.dtypes)
    cols = [
        _normaliser(kind, F.col(name), types[name]).alias(name.lower())
        for name, kind in spec.items()
    ]
    if order:
        by = F.struct(*[F.col(c.upper()) for c in order])
    elif "SRC_ORDER" in upper.columns:
        by = F.col("SRC_ORDER")
    else:
        by = F.struct(*[F.col(c) for c in upper.columns])
    return upper.select(*cols, by.alias(ORDER_COL))


def normalize_checks(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    return _normalize(df, CHECK_COLUMNS, order)


def normalize_folhas(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    return _normalize(df, FOLHA_COLUMNS, order)


def _finish(df: DataFrame, required: list[str], keys: list[str], keep_order: bool = False) -> DataFrame:
    return keep_last(df.dropna(subset=required), keys, ORDER_COL, keep_order=keep_order)


def folhas(nf: DataFrame) -> DataFrame:
    """B2: payroll runs."""
    df = nf.select(
        "mes_ano_folha", "num_folha",
        F.col("folha").alias("descricao_folha"),
        "data_consolidacao", "dt_lib_c_cheque",
        F.lit("S").alias("ativa"),
        F.year("mes_ano_folha").alias("ano"),
        F.month("mes_ano_folha").alias("mes"),
        ORDER_COL,
    )
    return _finish(df, ["mes_ano_folha", "num_folha"], ["mes_ano_folha", "num_folha"], keep_order=True)


def servidores(w: DataFrame) -> DataFrame:
    """Employees."""
    df = w.select("numfunc", "cpf", "nome", "pis_pasep", "identidade", ORDER_COL)
    return _finish(df, ["numfunc", "nome"], ["numfunc"])


def vinculos(w: DataFrame) -> DataFrame:
    """Employment links."""
    df = w.select("numfunc", "numvinc", "id_funcional", "regime_juridico", "tipo_vinculo",
                  F.lit("S").alias("ativo"), ORDER_COL)
    return _finish(df, ["numfunc", "numvinc"], ["numfunc", "numvinc"])


def rubricas(w: DataFrame) -> DataFrame:
    """Pay codes."""
    df = w.select(F.col("rubrica").alias("codigo_rubrica"), "nome_rubrica", "tipo_rubrica",
                  F.lit("S").alias("ativa"), ORDER_COL)
    return _finish(df, ["codigo_rubrica", "nome_rubrica"], ["codigo_rubrica"])


# Columns of the payslip header and of the position snapshot (fixed by the target model).
HEADER_COLUMNS = ["folha_descricao_origem", "competencia", "bruto", "descontos", "liquido", "data_consolidacao",
                  "dt_lib_c_cheque", "ano", "mes", "hash_origem"]
SNAPSHOT_COLUMNS = ["orgao", "cargo", "ref_cargo", "funcao", "ref_funcao", "municipio", "setor", "regime_juridico",
                    "tipo_vinculo", "banco", "agencia", "conta", "carga_horaria"]


# Header columns that follow from the payslip key: made after the last row is known.
KEY_DERIVED = ["ano", "mes", "hash_origem"]


def hash_origem() -> Column:
    """Hash of the payslip key."""
    return N.stable_hash(*PAYSLIP_KEY, texts=())


def item_hash() -> Column:
    """Content hash of a line, over its payslip key and six content fields (NULL money as 0.00)."""
    z = N.zero()
    return N.stable_hash(*PAYSLIP_KEY, "codigo_rubrica_origem", "complemento", "info",
                         F.coalesce("valor_vantagem", z), F.coalesce("valor_desconto", z), F.coalesce("valor_auxiliar", z),
                         texts=("complemento", "info"))


def _last_payslip(w: DataFrame, columns: list[str]) -> DataFrame:
    src = w.withColumn("folha_descricao_origem", F.col("folha")).select(
        *PAYSLIP_KEY, *[c for c in columns if c not in KEY_DERIVED], ORDER_COL)
    made = {"ano": F.year("mes_ano"), "mes": F.month("mes_ano"), "hash_origem": hash_origem()}
    return _finish(src, PAYSLIP_KEY, PAYSLIP_KEY).withColumns(made).select(*PAYSLIP_KEY, *columns)


def contracheques(w: DataFrame) -> DataFrame:
    """Payslip headers (hash_origem is a hash of the key, not of the content)."""
    return _last_payslip(w, HEADER_COLUMNS)


def snapshots(w: DataFrame) -> DataFrame:
    """Position of the employee at the time of the payslip."""
    return _finish(w.select(*PAYSLIP_KEY, *SNAPSHOT_COLUMNS, ORDER_COL), PAYSLIP_KEY, PAYSLIP_KEY)


def payslips(w: DataFrame) -> DataFrame:
    """B6 and B7 in one aggregate: both keep the last source row of the payslip key."""
    return _last_payslip(w, [*HEADER_COLUMNS, *SNAPSHOT_COLUMNS])


def itens(w: DataFrame, with_order: bool = False, with_sequence: bool = True) -> DataFrame:
    """Payslip lines; identical lines of a payslip collapse (content hash).

    Lines are dealt out by payslip once, without their hash (it names the payslip, so lines of one hash meet):
    collapsing, numbering and the join with the payslips all use that exchange. A payslip's lines are one
    task's work, as in its document. ``with_sequence=False`` skips the line number (F2).
    """
    df = w.select(
        *PAYSLIP_KEY,
        F.col("rubrica").alias("codigo_rubrica_origem"),
        F.col("nome_rubrica").alias("nome_rubrica_origem"),
        F.col("tipo_rubrica").alias("tipo_rubrica_origem"),
        "complemento", "info",
        F.col("vantagem").alias("valor_vantagem"),
        F.col("desconto").alias("valor_desconto"),
        F.col("auxiliar").alias("valor_auxiliar"),
        ORDER_COL,
    ).dropna(subset=PAYSLIP_KEY).repartition(*PAYSLIP_KEY)
    df = keep_last(df.withColumn("item_hash", item_hash()), [*PAYSLIP_KEY, "item_hash"], ORDER_COL, keep_order=True)
    df = df.withColumn("valor_total_item", N.item_total("valor_vantagem", "valor_auxiliar", "valor_desconto"))
    cols = [*PAYSLIP_KEY, "codigo_rubrica_origem", "nome_rubrica_origem", "tipo_rubrica_origem",
            "complemento", "info", "valor_vantagem", "valor_desconto", "valor_auxiliar",
            "valor_total_item", "item_hash"]
    if with_sequence:
        df = df.withColumn("sequencia_item", F.row_number().over(Window.partitionBy(*PAYSLIP_KEY).orderBy(ORDER_COL, "item_hash")))
        cols.append("sequencia_item")
    if with_order:
        cols.append(ORDER_COL)
    return df.select(*cols)
