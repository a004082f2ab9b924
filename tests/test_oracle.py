"""Every registered query against its DuckDB oracle on the smallest tables (sf0.001)."""

import pytest

import __spark_entry__ as ent
from paygrid.plans.catalog import QUERIES as CATALOG
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
ORACLE = ent.oracle_sql()
HEAVY = {"incremental_load"}   # covered in test_jobs


# The queries of the llm subpackage have their own tests.
PAYROLL = set(CATALOG)


@pytest.mark.parametrize("name", sorted(k for k in ORACLE if k not in HEAVY and k in PAYROLL))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = PAYROLL - set(ORACLE)
    assert no_oracle <= {"cache_documents", "load_errors_payload"}


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0 and "divergencia_liquido" in df.columns
