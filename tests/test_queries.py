"""Every query with oracle SQL gives the oracle's rows."""

from pathlib import Path

import duckdb
import pytest

from cadastra.plans import queries as records
from cadastra.plans import artifacts, golden, linking, mapping, marts, merges, scopes, summaries

MODULES = (records, summaries, linking, merges, artifacts, marts, scopes, mapping, golden)
QUERIES = {k: f for m in MODULES for k, f in m.queries().items()}
ORACLE = {k: q for m in MODULES for k, q in m.oracle_sql().items()}
DATA = "/root/testdata/sf0.001"


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(repr, ([None if v is None or v != v else (float(v) if isinstance(v, float) else str(v)) for v in r] for r in frame.astype(object).values.tolist())))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    assert _rows(QUERIES[name](spark, DATA).toPandas()) == _rows(con.execute(ORACLE[name]).df())
