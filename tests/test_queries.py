import duckdb
import numpy as np
import pytest

import __spark_entry__
from gridframe import queries as q
from gridframe.operators import tables as z
from gridframe.sources import datasource, scan
from gridframe.sources import writer as w
from gridframe.sources.discovery import discover
from tests.oracle import TABLES, both

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the tables aren't here")


@pytest.mark.parametrize("name", [
    "arrays_walked", "chunks_of_sparse_array", "cells_2d_edges", "cells_u8", "cells_missing_absent", "cells_sharded_bitshuffle", "filter_in", "filter_or", "filter_is_null", "sql_view", "self_join", "agg_cube", "window_moving_sum", "join_chunks", "groups_walked", "groups_consolidated", "arrays_by_nation_v2", "arrays_listed_unreadable", "region_or", "region_not", "region_shifted", "region_projected", "sql_cells_function", "sql_runs_function", "sql_runs_function_pruned",
    "sql_view_twice", "sql_packed_mean", "packed_cells", "aligned_inner", "aligned_full", "aligned_pruned", "lookup_of_lines", "lookup_of_events", "scan_agg_blocks", "scan_agg_filtered", "scan_agg_shards", "count_cells", "window_extremes", "window_rank", "rank_of_ties", "join_theta", "order_by_value",
    "diff_of_versions", "diff_of_unlike_arrays", "stacked_levels", "stacked_levels_pruned", "set_except", "window_stencil", "labelled_cells", "labelled_cells_pruned",
])
def test_query_equals_its_sql(spark, name):
    by_spark, by_sql = both(spark, q.QUERIES[name], q.ORACLE_SQL[name])
    assert by_spark == by_sql


def test_every_array_query_has_sql():
    assert set(q.QUERIES) == set(q.ORACLE_SQL)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 64


@pytest.mark.parametrize(("name", "first", "last"), [("cells_u4", 967_200, 967_400), ("cells_i4", 2_147_900, 2_148_100)])
def test_values_beyond_four_bytes(spark, tmp_path, name, first, last):
    # Keys around the first one whose value outgrows the type; cells between key 0 and the first aren't in the tables.
    spark.range(first, last).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["dim_0"]: r["value"] for r in q.QUERIES[name](spark, str(tmp_path)).where(f"dim_0 >= {first}").collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert got == dict(con.sql(q.ORACLE_SQL[name]).fetchall())


def test_written_integers_beyond_the_type_raise(spark, tmp_path):
    w.v2_array(str(tmp_path), "a", (3,), (2,), "<u4")
    with pytest.raises(Exception, match="can't hold values from 7 to 4294967296"):
        w.write_cells(spark.createDataFrame([(0, 7), (1, 2**32)], "dim_0 long, value long"), str(tmp_path), "a")


def test_small_chunks_are_written_in_many_tasks_without_a_group_each(spark, tmp_path):
    # 3,000 files took a Python call each, in a task that Spark had put all small partitions into.
    n, before = 12_000, spark.sparkContext.statusTracker()
    w.v2_array(str(tmp_path), "a", (n,), (4,), "|i1", fill=-1)
    cells = spark.range(0, n, 1, 8).where("id % 8 < 4 OR id = 6").selectExpr("id AS dim_0", "CASE WHEN id % 3 > 0 THEN id % 100 END AS value")
    spark.sparkContext.setJobGroup("written", "")
    assert w.write_cells(cells, str(tmp_path), "a") == 1_501
    spark.sparkContext.setJobGroup("", "")
    stages = [before.getStageInfo(s) for j in before.getJobIdsForGroup("written") for s in before.getJobInfo(j).stageIds]
    assert 11 in [s.numTasks for s in stages if s]
    got = {r["dim_0"]: r["value"] for r in z.zarr_cells(spark, str(tmp_path), "a").collect()}
    # A null value is a cell without a row.
    assert got == {k: k % 100 if k % 3 and (k % 8 < 4 or k == 6) else -1 for k in range(n)}


def test_listing_of_one_folder_is_shared_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(datasource, "PARTITION_FILES", 10)
    w.v2_group(str(tmp_path))
    w.v2_array(str(tmp_path), "a", (100,), (1,), "|i1")
    w.write_values(str(tmp_path), "a", np.arange(100), skip={(k,) for k in range(0, 100, 3)})
    reader = datasource.MetadataReader("chunks", discover(str(tmp_path)), 6)
    shares = [[r[3][0] for r in reader.read(p)] for p in reader.partitions()]
    assert len(shares) == 6 and max(map(len, shares)) < 30
    assert sorted(k for s in shares for k in s) == [k for k in range(100) if k % 3]


def test_batches_of_small_chunks_are_put_together(tmp_path):
    w.v2_group(str(tmp_path))
    w.v2_array(str(tmp_path), "a", (400,), (4,), "|i1")
    w.write_values(str(tmp_path), "a", np.arange(400) % 100)
    batches = list(scan.cell_scan(discover(str(tmp_path)), "a").read(0, 100))
    assert [b.num_rows for b in batches] == [400]
    assert batches[0].column(0).to_pylist() == list(range(400))
