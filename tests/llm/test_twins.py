"""The queries with SQL twins, and rules that the subpackage keeps."""

import pathlib
import re

import pytest

import check
from tabflow.llm import queries  # noqa: F401
from tabflow.llm.catalogue import QUERIES, SQL

LIBRARY = pathlib.Path(__file__).parents[2] / "tabflow"


@pytest.fixture(scope="module")
def twin(smoke):
    return check.oracle(smoke)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, smoke, twin, name):
    verdict, _ = check.compare(spark, twin, name, smoke)
    assert verdict.startswith("ok"), verdict


def test_queries_take_whole_tables():
    assert len(QUERIES) >= 10
    text = "\n".join(p.read_text() for p in (LIBRARY / "llm").glob("*.py"))
    for bad in (r"localCheckpoint", r"crossJoin", r"coalesce\(1\)", r"toPandas\(", r"except ImportError", r"tempfile"):
        assert not re.search(bad, text), bad


def test_nothing_else_imports_the_subpackage():
    for path in LIBRARY.rglob("*.py"):
        if "llm" not in path.parts:
            assert "tabflow.llm" not in path.read_text(), path
