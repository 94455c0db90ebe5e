"""The package's queries: registered, whole, and equal to their SQL where there is one."""

import re

import pytest
from conftest import TESTDATA, same_rows

import __spark_entry__
from twinfold.llm import queries


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= __spark_entry__.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = same_rows(queries.QUERIES[name](spark, f"{TESTDATA}/sf0.001"), duck, queries.ORACLE_SQL[name])
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(queries.QUERIES.keys() - queries.ORACLE_SQL.keys()))
def test_query_has_every_document(spark, name):
    out = queries.QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    assert out.select("doc_id").distinct().count() == docs.count()


def test_native_plans_run_no_python(spark):
    for name in ("op1_decontamination", "op2_quality_rules", "op7_secret_scan"):
        plan = queries.QUERIES[name](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_no_operator_swallows_import_errors():
    import pathlib

    import twinfold.llm

    for p in pathlib.Path(twinfold.llm.__file__).parent.glob("*.py"):
        assert "ImportError" not in p.read_text()
