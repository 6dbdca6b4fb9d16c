from __future__ import annotations

from datetime import datetime
from functools import partial

from tidemark.streaming import landing
from workload import queries
from workload.queries import QUERIES

AT = datetime(1996, 2, 3)


def _tables(spark, folder, keys):
    """A customer and an order for each key, and a line."""
    for name, rows, columns in (
            ("customer", [(k, f"n{k}", 1, "a") for k in keys],
             "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            ("orders", [(i, k, "F", 1.0, AT, "1-URGENT") for i, k in enumerate(keys)],
             "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
             "o_orderdate timestamp, o_orderpriority string"),
            ("lineitem", [(0, 1, keys[1], 1, 2.0, 3.0, "A", "F", datetime(1997, 1, 1))],
             "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
             "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, columns).write.parquet(str(folder / f"{name}.parquet"))


def test_customers_beyond_the_millionth_stay_apart(spark, tmp_path):
    """Their ids were cut to six places, so that several customers had one id."""
    keys = [100000, 1000000, 1000001, 7]
    _tables(spark, tmp_path, keys)
    merged = QUERIES["merge_gold"](spark, str(tmp_path)).collect()
    assert sorted((r["transaction_id"], r["customer_id"], r["customer_name"]) for r in merged) == [
        ("T00000000", "C1000000", "n1000000"), ("T00000001", "C1000000", "n1000000"),
        ("T00000002", "C1000001", "n1000001"), ("T00000003", "C7", "n7")]
    named = QUERIES["medallion_run"](spark, str(tmp_path)).collect()
    assert {r["customer_id"]: r["customer_name"] for r in named} == {f"C{k}": f"n{k}" for k in keys}


def test_rows_of_a_file_of_several_messages_count_once(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path, list(range(1000, 1300)))
    monkeypatch.setattr(queries, "start_landing", partial(landing.start_landing, inline_bytes=100))
    monkeypatch.setattr(landing, "parse_large_files",
                        partial(landing.parse_large_files, chunk_bytes=200))
    found = QUERIES["land_audit"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [("customers", 300, 300, True), ("transactions", 300, 300, True)]
