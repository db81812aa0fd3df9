"""Registered queries next to their SQL on whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from compare import check
from tallyroll.llm.catalogue import catalogue, oracle_sql


def test_names():
    assert {name.split("_")[0] for name in catalogue()} == {f"op{n}" for n in range(1, 14)}
    assert set(catalogue()) | {"pipeline"} <= set(contract.queries())
    assert set(oracle_sql()) <= set(catalogue()) and set(oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    assert check(catalogue()[name](spark, sf_dir), con, oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(set(catalogue()) - set(oracle_sql())))
def test_others_return_a_row_for_each_input_row(spark, sf_dir, name):
    df = catalogue()[name](spark, sf_dir)
    if name.startswith("op8_"):
        # Only what it finds.
        assert 0 < df.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
        return
    if name.startswith("op6_"):
        expected = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    else:
        expected = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert df.count() == expected
