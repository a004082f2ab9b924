"""Readers for the two payroll sources.

``payroll_checks`` is the wide source (one row per payslip line, 37 columns with
header and employee fields repeated); ``payroll_folhas`` lists the payroll runs.
In production both come from ``spark.read.jdbc`` / ``spark.read.parquet`` with
the schemas in ``paygrid.schemas``; for the test tables they are derived from the
star schema (lineitem, orders, customer, nation, part) as described in
FIXTURES.md section 3. The same mapping is written in SQL in
``paygrid.plans.oracle`` so both engines see identical inputs.

Scan order: the sources have no ORDER BY, so "keep the last row" needs an
explicit order. Every row carries ``SRC_ORDER``, a struct that is a total order
over the source rows (the lineitem columns, which are unique row-wise).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lineitem columns that together order the wide source totally (fixed values).
SRC_ORDER_FIELDS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; parquet gives pushdown and column pruning."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prio(col: str = "o_orderpriority") -> Column:
    return F.split_part(F.col(col), F.lit("-"), F.lit(1)).cast("bigint")


def folha_text(month: Column, prio: Column) -> Column:
    """Run description as the legacy system spells it: messy spaces, English month."""
    return F.concat(
        F.lit("  Folha   Normal "),
        F.when(prio == 5, F.lit("Avulsa ")).otherwise(F.lit("")),
        prio.cast("string"),
        F.lit(" - "),
        F.date_format(month, "MMM"),
        F.lit("/"),
        F.date_format(month, "yyyy"),
        F.lit(" "),
    )


def payroll_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide payroll source (37 upper-case columns + SRC_ORDER)."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")

    # Lines and orders meet last, each with its own look-ups done, so that no joined row is dealt out again; a file of
    # one row group is one task, whatever the split size: both sides are spread by the key that this join needs.
    lines = read_table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left").repartition("l_orderkey")
    heads = (
        orders.join(customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
                    F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .repartition("o_orderkey")
    )
    okey = F.col("o_orderkey")
    ckey = F.col("o_custkey")
    line = F.col("l_linenumber")
    prio = _prio()
    month = F.col("o_month")
    # The texts of an order are made once, not once per line.
    heads = heads.withColumn("o_month", F.trunc(F.col("o_orderdate"), "MM"))
    heads = heads.withColumns({"o_folha": folha_text(month, prio), "o_competencia": F.date_format(month, "MM/yyyy")})
    j = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    bruto = F.col("o_totalprice").cast("decimal(15,2)")
    descontos = F.bround(bruto * F.lit(Decimal("0.10")), 2).cast("decimal(15,2)")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    flag = F.col("l_returnflag")

    def s(c: Column) -> Column:
        return c.cast("string")

    return j.select(
        month.alias("MES_ANO"),
        (F.lit(1) + okey % 3).alias("NUMERO"),
        ckey.alias("NUMFUNC"),
        (F.lit(1) + okey % 2).alias("NUMVINC"),
        F.last_day(month).alias("DATA_CONSOLIDACAO"),
        F.when(prio == 3, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.col("o_orderdate").cast("date"), 5)).alias("DT_LIB_C_CHEQUE"),
        F.lpad(s(ckey), 11, "0").alias("CPF"),
        F.when((line == 4) & (okey % 5 == 0), F.lit(None).cast("string"))
        .when(line == 2, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name")).alias("NOME"),
        F.when(ckey % 4 == 0, F.lit("")).otherwise(F.lpad(s(ckey * 7), 11, "0")).alias("PIS_PASEP"),
        F.when(ckey % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("RG"), s(ckey))).alias("IDENTIDADE"),
        F.concat(s(ckey), F.lit("-"), s(F.lit(1) + okey % 2)).alias("ID_FUNCIONAL"),
        F.when(F.col("o_orderstatus") == "F", F.lit("ESTATUTARIO"))
        .when(F.col("o_orderstatus") == "O", F.lit(" CLT "))
        .otherwise(F.lit("")).alias("REGIME_JURIDICO"),
        F.when(okey % 2 == 0, F.lit("EFETIVO")).otherwise(F.lit("COMISSIONADO")).alias("TIPO_VINCULO"),
        F.col("o_folha").alias("FOLHA"),
        F.when(prio == 2, F.lit(None).cast("string")).otherwise(F.col("o_competencia")).alias("COMPETENCIA"),
        F.col("n_name").alias("ORGAO"),
        F.col("c_mktsegment").alias("CARGO"),
        F.concat(F.lit("R"), s(prio)).alias("REF_CARGO"),
        F.when(okey % 4 == 0, F.lit("CHEFE DE SECAO")).otherwise(F.lit(None).cast("string")).alias("FUNCAO"),
        F.when(okey % 4 == 0, F.lit(" F1 ")).otherwise(F.lit("")).alias("REF_FUNCAO"),
        F.concat(F.lit("CIDADE "), s(F.col("c_nationkey"))).alias("MUNICIPIO"),
        F.concat(F.lit("  SETOR "), s(okey % 10), F.lit("  ")).alias("SETOR"),
        F.lit("001").alias("BANCO"),
        F.lpad(s(ckey % 10000), 4, "0").alias("AGENCIA"),
        s(ckey * 13).alias("CONTA"),
        F.when(prio == 4, F.lit(Decimal("20.00"))).otherwise(F.lit(Decimal("40.00")))
        .cast("decimal(10,2)").alias("CARGA_HORARIA"),
        bruto.alias("BRUTO"),
        descontos.alias("DESCONTOS"),
        (bruto - descontos).cast("decimal(15,2)").alias("LIQUIDO"),
        F.when(line == 7, F.lit(None).cast("bigint")).otherwise(F.col("l_partkey")).alias("RUBRICA"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("NOME_RUBRICA"),
        F.col("p_type").alias("TIPO_RUBRICA"),
        F.when(line == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), s(line))).alias("COMPLEMENTO"),
        F.concat(F.col("l_linestatus"), F.lit(" "), s(F.col("l_suppkey"))).alias("INFO"),
        F.when(flag == "N", price).alias("VANTAGEM"),
        F.when(flag == "R", F.bround(price * F.col("l_discount").cast("decimal(5,2)"), 2))
        .cast("decimal(15,2)").alias("DESCONTO"),
        F.when(flag == "A", F.bround(price * F.col("l_tax").cast("decimal(5,2)"), 2))
        .cast("decimal(15,2)").alias("AUXILIAR"),
        F.struct(*[F.col(c) for c in SRC_ORDER_FIELDS]).alias("SRC_ORDER"),
    )


def payroll_folhas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll runs: one per (month, priority) of the orders, thinned out.

    Kept when the month is odd or the run number is 1, except run 1 in
    December, so the data has months with many runs, with one run and with none.
    """
    orders = read_table(spark, sf_dir, "orders")
    runs = orders.select(
        F.trunc(F.col("o_orderdate"), "MM").alias("m"), _prio().alias("p")
    ).distinct()
    runs = runs.filter(((F.month("m") % 2) == 1) | (F.col("p") == 1)).filter(
        ~((F.month("m") == 12) & (F.col("p") == 1))
    )
    return runs.select(
        F.col("m").alias("MES_ANO_FOLHA"),
        F.col("p").alias("NUM_FOLHA"),
        folha_text(F.col("m"), F.col("p")).alias("FOLHA"),
        F.last_day("m").alias("DATA_CONSOLIDACAO"),
        F.date_add("m", 4).alias("DT_LIB_C_CHEQUE"),
        F.struct(F.col("m").alias("mes"), F.col("p").alias("num")).alias("SRC_ORDER"),
    )


def read_jdbc(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 5000) -> DataFrame:
    """A2-A4 for a database source: a partitioned JDBC scan.

    The reference reads one cursor in 5,000-row chunks on one thread; here each
    of ``num_partitions`` tasks reads one range of ``partition_column`` (a date
    or numeric column such as MES_ANO), with the period filter pushed into the
    per-partition queries by Catalyst. Connection options come from the caller.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", num_partitions or 8))
    return r.load()
