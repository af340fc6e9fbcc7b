"""The registered queries against their SQL."""

from __future__ import annotations

import pytest
from compare import duck

from tristrata.llm.queries import ORACLES, QUERIES


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(df.collect(), df.columns) == plain(cursor.fetchall(), columns)
