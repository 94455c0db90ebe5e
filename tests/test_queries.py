"""Every query of the library against its SQL, at sf0.001."""

import pytest
from conftest import TESTDATA, same_rows

import __spark_entry__
from twinfold.plans import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    ours, theirs = same_rows(queries.QUERIES[name](spark, f"{TESTDATA}/sf0.001"), duck, queries.ORACLE_SQL[name])
    assert ours == theirs


def test_entry_gives_the_github_groups(spark):
    assert __spark_entry__.entry(spark).count() == 7


def test_all_library_queries_are_registered():
    assert queries.QUERIES.keys() <= __spark_entry__.queries().keys()
    assert queries.ORACLE_SQL.keys() <= __spark_entry__.oracle_sql().keys()
