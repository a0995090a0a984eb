"""Every registered query against its SQL, and the entry points."""

import os

import pytest

from chronoprep.plans import registry
from tests.compare import same

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SMALL)
    if name in registry.oracle_sql():
        same(df, SMALL, registry.oracle_sql()[name])
    else:
        assert df.count() > 0 or name == "boruta_select"  # no feature may be relevant


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["event_id", "ts", "split", "z"]
    assert set(registry.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_nothing_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(registry.__file__)))
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read()
