"""The queries and their SQL, over the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

from tessera.llm import oracles, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "conversations")


def plain(row):
    return tuple(float(f"{x:.9g}") if isinstance(x, float) and math.isfinite(x) else x for x in row)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = db.execute(oracles.ORACLES[name])
    columns = sorted(c[0] for c in found.description)
    want = found.df().astype(object)
    want = want.where(want.notna(), None)[columns]
    got = queries.QUERIES[name](spark, SF).select(*columns)
    assert Counter(map(plain, got.collect())) == Counter(map(plain, want.itertuples(index=False, name=None)))
