"""Every operator and the pipeline are registered, and SQL agrees where it exists."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check import compare, connect  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
import corpus_pipeline  # noqa: E402
from corvane.llm import registry  # noqa: E402


def test_all_are_registered():
    names = set(entry_module.queries())
    assert set(registry.queries()) <= names and set(registry.oracle_sql()) <= set(entry_module.oracle_sql())
    for n in range(1, 14):
        assert len([x for x in registry.queries() if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_sql(spark, sf):
    for name, sql in registry.oracle_sql().items():
        assert compare(registry.queries()[name](spark, sf), connect(sf), sql) == []
