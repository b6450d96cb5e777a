"""Every query that has SQL, over the whole tables of the smallest test data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in entry.oracle_sql().items()}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    ours, theirs = compare(spark, connect(FOLDER), FOLDER, entry.queries()[name], ORACLES[name])
    assert ours == theirs


def test_the_rest_runs_and_keys_agree(spark):
    queries = entry.queries()
    assert set(ORACLES) <= set(queries)
    for name in set(queries) - set(ORACLES):
        assert queries[name](spark, FOLDER).columns
    assert entry.entry(spark).count() > 0


def test_no_query_shows_pupils(spark):
    for name in ("indicador_municipio", "comparativo_meta_resultado", "public_indicador_municipio", "public_evolucao_alfabetizacao", "indicador_atual_hibrido"):
        assert "id_aluno" not in entry.queries()[name](spark, FOLDER).columns
