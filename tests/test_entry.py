"""The entry module works without the training-data operators."""
import sys

import __spark_entry__ as entry


def test_queries_without_the_training_data_operators(monkeypatch):
    with monkeypatch.context() as m:
        for name in [n for n in sys.modules if n.startswith("partnerlens.llm") or n == "corpus_pipeline"]:
            m.delitem(sys.modules, name)
        m.setitem(sys.modules, "partnerlens.llm", None)
        m.setitem(sys.modules, "corpus_pipeline", None)
        found = entry.queries()
    assert "partner_rankings" in found and not any(q.startswith("op") and q[2:3].isdigit() for q in found) and "pipeline" not in found


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
