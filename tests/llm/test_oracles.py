"""The registered queries of the package against their SQL, on whole tables."""

import pytest

pytest.importorskip("sluice.llm")

import __spark_entry__ as entry_mod
from compare import compare, duck

from sluice.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_mod.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, con, name):
    problems, rows, _ = compare(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name])
    assert not problems, problems
    assert rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql_on_another_size(spark, name):
    sf = "/root/testdata/sf0.001"
    problems, _, _ = compare(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLE[name])
    assert not problems, problems
