"""Every query that has SQL gives DuckDB's rows."""

from __future__ import annotations

import datetime
import sys
import warnings

import pytest

import __spark_entry__
from tallow.plans import catalog
from tests.conftest import SF


def _shown(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def same_rows(df, relation):
    assert sorted(df.columns) == sorted(relation.columns)
    ours = sorted(tuple(_shown(r[c]) for c in sorted(df.columns)) for r in df.collect())
    place = [relation.columns.index(c) for c in sorted(relation.columns)]
    theirs = sorted(tuple(_shown(r[k]) for k in place) for r in relation.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    same_rows(catalog.QUERIES[name](spark, SF), duck.sql(catalog.ORACLE_SQL[name]))


def test_every_market_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("lost", ["tallow.llm", "tallow.llm.registry", "tallow.llm.piece_encoding", "corpus_pipeline"])
def test_entry_without_the_optional_part(monkeypatch, lost):
    """Parts that are gone, or that lack something they import."""
    for name in [m for m in sys.modules if m.startswith(("tallow.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    if "llm" in sys.modules["tallow"].__dict__:
        monkeypatch.delattr(sys.modules["tallow"], "llm")
    monkeypatch.setitem(sys.modules, lost, None)  # importing it raises ImportError
    with pytest.warns(UserWarning, match="left out"):
        found = __spark_entry__.queries()
    assert set(catalog.QUERIES) <= set(found) and "pipeline" not in found
    assert lost == "corpus_pipeline" or set(found) == set(catalog.QUERIES)
    with warnings.catch_warnings(action="ignore"):
        assert set(__spark_entry__.oracle_sql()) <= set(found)
