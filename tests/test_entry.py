from __future__ import annotations

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5
