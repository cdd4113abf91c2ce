"""Every registered query against its SQL on the smallest tables."""

import pytest

from catalog import ORACLES, QUERIES


def shown(rows, names):
    order = [names.index(n) for n in sorted(names)]
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, folder, name):
    result = QUERIES[name](spark, folder)
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(result.columns)
    assert shown(rows, result.columns) == shown(answer.fetchall(), names)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
