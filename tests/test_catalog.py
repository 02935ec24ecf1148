"""Every query against its SQL, on the smallest tables."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from sessionlens.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def values(rows, columns):
    def plain(x):
        return round(float(x), 6) if isinstance(x, float) or type(x).__name__ == "Decimal" else x

    return Counter(tuple(plain(r[c]) for c in sorted(columns)) for r in rows)


def duck(sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return names, [dict(zip(names, r, strict=True)) for r in got.fetchall()]


def test_same_names():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, SF)
    names, want = duck(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(names)
    assert values([r.asDict() for r in df.collect()], names) == values(want, names)
