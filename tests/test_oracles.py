"""Every evidence query gives the rows of its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from quarrylight.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(x):
        if pd.isna(x):
            return "NULL"
        return repr(round(float(x), 5)) if not isinstance(x, (str, bool)) and hasattr(x, "__float__") and not hasattr(x, "isoformat") else str(x)

    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", list(Q.SQL))
def test_query(spark, con, name):
    got, want = Q.QUERIES[name](spark, SF).toPandas(), con.sql(Q.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_supplement_families_beside_a_ledger(spark, tmp_path):
    """Papers of region 1 have attachment 1 in the ledger, so that theirs begin with 2, also alone; sf0.001 has none of them."""
    pd.DataFrame({"n_nationkey": [0, 1, 2], "n_name": ["A", "NATION_1", "C 2020"], "n_regionkey": [0, 1, 1]}).to_parquet(tmp_path / "nation.parquet")
    keys, nations = [1, 2, 4, 5, 8, 10, 3, 7], [0, 1, 1, 1, 2, 0, 1, 1]
    supplier = pd.DataFrame({"s_suppkey": keys, "s_name": [f"S{k:02d}" for k in keys], "s_nationkey": nations})
    supplier.to_parquet(tmp_path / "supplier.parquet")
    c = duckdb.connect()
    for t in ("nation", "supplier"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = Q.QUERIES["supplement_families"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(c.sql(Q.SQL["supplement_families"]).df())
    numbers = {k: None if pd.isna(n) else int(n) for k, n in zip(got["s_suppkey"], got["attachment_number"])}
    assert numbers == {1: 1, 10: 2, 2: 2, 4: 3, 5: 4, 8: 2, 3: None, 7: None}
