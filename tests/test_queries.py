import glob
import math
import os

import duckdb
import pytest

from evimap.plans import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return format(float(v), ".6g") if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_against_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in queries.ORACLE_SQL:
        assert len(set(columns)) == len(df.columns)
        return
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    rel = db.sql(queries.ORACLE_SQL[name])
    names = rel.columns
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(tuple(plain(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in order) for r in rel.fetchall()) == got
