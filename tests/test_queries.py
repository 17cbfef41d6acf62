"""Each query of the catalogue against its SQL, on the small tables where they are."""

import os

import duckdb
import pytest

from corpusmill.plans.catalogue import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "pages", "conversations", "benchmark", "labels", "events")


def plain(rows):
    return sorted(repr(tuple(float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r)) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = plain(df.select(*[f"`{n}`" for n in names]).collect())
    rel = c.execute("select " + ", ".join(f'"{n}"' for n in names) + f" from ({ORACLES[name]})")
    assert got == plain(rel.fetchall())
