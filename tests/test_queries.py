import pytest

from sparkloom import queries as library

from .helpers import SMALL, connection, of_spark, of_sql


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(library.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert of_spark(library.QUERIES[name](spark, SMALL)) == of_sql(con, library.ORACLES[name])


def test_entry_runs_without_the_training_data_operators(spark, monkeypatch):
    import importlib
    import sys

    import __spark_entry__

    with monkeypatch.context() as m:
        for name in [n for n in sys.modules if n == "sparkloom.llm" or n.startswith("sparkloom.llm.")] + ["sparkloom.llm", "corpus_pipeline"]:
            m.setitem(sys.modules, name, None)  # as if it were not there
        m.delattr("sparkloom.llm", raising=False)
        entry = importlib.reload(__spark_entry__)
        assert set(entry.queries()) == set(library.QUERIES)
        assert set(entry.oracle_sql()) == set(library.ORACLES)
        assert entry.entry(spark).count() > 0
    importlib.reload(__spark_entry__)
