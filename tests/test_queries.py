"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import compare, connect
from girolens import catalog, model


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(oracle.all_sql()) == set(catalog.all_queries())


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query(spark, con, folder, name):
    assert compare(spark, con, folder, name) is None


def test_entry(spark, folder):
    rows = entry.entry(spark)
    assert rows.columns == ["currency", "tx_count", "total_value", "min_amt", "max_amt", "avg_amt"]
    assert rows.count() > 0


def test_every_rule_fires_in_a_query():
    """On the larger tables each of the 38 rules is in the result of some query."""
    if not Path("/root/testdata/sf0.01").exists():
        pytest.skip("driver tables are not here")
    larger, sql = connect("/root/testdata/sf0.01"), oracle.all_sql()
    found = set()
    for name in [n for n in sql if n.startswith("rules_") or n == "corpus_outcomes"]:
        for row in larger.execute(sql[name]).fetchall():
            found |= set(re.findall(r"BR-\d{3}", " ".join(map(str, row))))
    assert found == set(model.RULES)
