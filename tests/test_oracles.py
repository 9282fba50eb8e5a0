"""Every load query against its SQL, row for row."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from histload.plans.oracles import ORACLES
from histload.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir) / t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = Counter(tuple(r) for r in got.select(*columns).collect())
    expected = Counter(want.fetchall())
    assert sum(rows.values()) > 0
    assert rows == expected
