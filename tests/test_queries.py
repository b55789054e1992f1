"""Every registered query next to its SQL twin, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.compare import normalized  # noqa: E402

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toArrow()
    if name in ORACLES:
        assert normalized(got) == normalized(duck.sql(ORACLES[name]).to_arrow_table())
    else:
        assert got.num_rows > 0


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["order_dt", "status", "order_cnt", "amount_sum"]
    assert frame.count() > 0
