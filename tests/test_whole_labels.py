"""Labels by return flag and line status: own rows, in which the flag alone says more."""

import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as E

HITS = [(1, "R", "F"), (1, "R", "F"), (2, "R", "O"), (3, "A", "F"), (3, "R", None), (4, "R", "O"), (4, "N", "F"), (5, "N", "O"), (5, "R", "F"), (None, "R", "F"), (9, "R", "F")]


def test_label_needs_flag_and_status_in_one_hit(spark, tmp_path):
    keys = [1, 2, 3, 4, 5, 6, 6]
    n = len(keys)
    text = lambda v: pa.array([v] * n, pa.string())
    pq.write_table(pa.table({"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([7] * n, pa.int64()), "o_orderstatus": text("F"),
                             "o_orderdate": pa.array([datetime.datetime(2021, 1, 1)] * n, pa.timestamp("us")), "o_orderpriority": text("1-URGENT")}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"c_custkey": pa.array([7], pa.int64()), "c_nationkey": pa.array([0], pa.int64()), "c_mktsegment": ["BUILDING"]}), tmp_path / "customer.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([0], pa.int64()), "n_name": ["NATION_0"], "n_regionkey": pa.array([0], pa.int64())}), tmp_path / "nation.parquet")
    pq.write_table(pa.table({"r_regionkey": pa.array([0], pa.int64()), "r_name": ["ASIA"]}), tmp_path / "region.parquet")
    cols = [*zip(*HITS)]
    pq.write_table(pa.table({"l_orderkey": pa.array(cols[0], pa.int64()), "l_returnflag": pa.array(cols[1], pa.string()),
                             "l_linestatus": pa.array(cols[2], pa.string()), "l_extendedprice": pa.array([1.0] * len(HITS))}), tmp_path / "lineitem.parquet")
    got = sorted(tuple(r) for r in E.queries()["label_sessions"](spark, str(tmp_path)).collect())
    assert got == [("1", 1), ("2", 0), ("3", 0), ("4", 0), ("5", 1), ("6", 0), ("6", 0)]
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    assert sorted(con.execute(E.oracle_sql()["label_sessions"]).fetchall()) == got
