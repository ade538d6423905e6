"""Hits told apart by return flag and line status: own rows, in which the flag alone says less."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E

ROWS = [(1, "R", "F"), (1, "R", "F"), (1, "R", "O"), (2, "R", "O"), (2, "N", "O"), (3, "R", "F"), (None, "R", "F"), (4, None, "F"), (4, "A", None)]


@pytest.fixture(scope="module")
def hits(tmp_path_factory):
    path = tmp_path_factory.mktemp("hits")
    cols = [*zip(*ROWS)]
    pq.write_table(pa.table({"l_orderkey": pa.array(cols[0], pa.int64()), "l_returnflag": pa.array(cols[1], pa.string()),
                             "l_linestatus": pa.array(cols[2], pa.string()), "l_extendedprice": pa.array([1.0] * len(ROWS))}), path / "lineitem.parquet")
    return str(path)


@pytest.mark.parametrize("name, want", [
    ("dedup_rows", {("1", "RF"), ("1", "RO"), ("2", "RO"), ("2", "NO"), ("3", "RF"), (None, "RF"), ("4", None)}), ("distinct_sessions", {(2, 4)})])
def test_actions_hold_the_line_status(spark, hits, name, want):
    got = [tuple(r) for r in E.queries()[name](spark, hits).collect()]
    assert len(got) == len(want) and set(got) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{hits}/lineitem.parquet')")
    assert set(con.execute(E.oracle_sql()[name]).fetchall()) == want
