"""The entry stands without the subpackage of the training-data operators."""

import importlib
import sys

import pytest

import __spark_entry__

from freshet.catalogue import QUERIES


@pytest.mark.parametrize("missing", ["freshet.llm.catalogue", "freshet.llm", "corpus_pipeline", "ahocorasick"])
def test_other_queries_stand_alone(monkeypatch, missing):
    for name in [n for n in sys.modules if n.startswith("freshet.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    import freshet

    monkeypatch.delattr(freshet, "llm", raising=False)
    alone = importlib.reload(__spark_entry__)
    try:
        assert alone.queries() == QUERIES and set(alone.oracle_sql()) <= set(QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
