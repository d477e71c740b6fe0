"""Operators inside the scan against Spark's own and NumPy; what they open, and their plans."""

import itertools
import math
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridframe.operators import grids, ranks
from gridframe.operators import tables as z
from gridframe.plans.metadata import StoreError
from gridframe.plans.pruning import Selection
from gridframe.plans.regions import MOST_BOXES, Region
from gridframe.sources import discovery, scan
from gridframe.sources import writer as w
from gridframe.sources.windows import WindowReader


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def kept(path, *keys):
    """Leaves the chunk files with these keys as they are and damages all others of array `a`: whoever opens one of those fails."""
    for name in os.listdir(f"{path}/a"):
        if name[0] != "." and name not in keys:
            with open(f"{path}/a/{name}", "wb") as f:
                f.write(b"not a chunk")


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    """a: 20 x 30 in chunks of 4 x 7; b: 18 x 33 in chunks of 5 x 3 without the first two rows of chunks; s: shards."""
    path = str(tmp_path_factory.mktemp("g") / "g.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (20, 30), (4, 7), "<i4")
    w.write_values(path, "a", A)
    w.v2_array(path, "b", (18, 33), (5, 3), "<f8", fill=None)
    w.write_values(path, "b", B)
    for k, j in itertools.product(range(2), range(11)):
        os.remove(f"{path}/b/{k}.{j}")
    return path


A = np.random.default_rng(1).integers(-50, 50, (20, 30)).astype("<i4")
B = np.random.default_rng(2).normal(size=(18, 33))


@pytest.fixture(scope="module")
def shards(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("g") / "s.zarr")
    w.v3_group(path)
    w.v3_array(path, "a", (20, 30), (8, 12), "int64", [w.sharding((2, 4), [w.BYTES, w.blosc("shuffle", 8)])], fill=5)
    w.write_values(path, "a", A.astype("<i8"))
    os.remove(f"{path}/a/c/1/1")
    return path


# Regions and conditions.

SPANS = st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)).map(lambda s: tuple(sorted(s))), max_size=3)


@settings(max_examples=200, deadline=None)
@given(boxes=st.lists(st.tuples(SPANS, SPANS), max_size=4), chunks=st.tuples(st.integers(1, 5), st.integers(1, 5)), simple=st.booleans())
def test_regions_have_each_chunk_and_cell_once(boxes, chunks, simple):
    shape = (10, 12)
    region = Region(shape, tuple(Selection.whole(shape).narrowed(0, a).narrowed(1, b) for a, b in boxes))
    wanted = {(x, y) for x in range(10) for y in range(12) if any(any(p <= x <= q for p, q in a) and any(p <= y <= q for p, q in b) for a, b in boxes)}
    region = region.simple() if simple else region
    found = region.chunks(chunks)
    coords = [found.coords(k) for k in range(len(found))]
    assert len(set(coords)) == len(coords) and set(coords) == {(x // chunks[0], y // chunks[1]) for x, y in wanted}
    cells = []
    for c in coords:
        for part in region.parts(tuple(k * n for k, n in zip(c, chunks, strict=True)), chunks):
            cells += itertools.product(*([x for a, b in spans for x in range(a, b + 1)] for spans in part.intervals))
    assert len(set(cells)) == len(cells) and set(cells) == wanted


def test_many_boxes_become_one_that_holds_all():
    shape = (10_000, 10_000)
    region = Region(shape, tuple(Selection.whole(shape).narrowed(0, [(20 * k, 20 * k)]).narrowed(1, [(30 * k, 30 * k)]) for k in range(MOST_BOXES + 1))).simple()
    assert region.loose and len(region.boxes) == 1 and not Region.whole(shape).loose


CONDITIONS = {
    "dim_0 = 1 OR dim_0 = 13 OR dim_1 IN (3, 29)": 16, "NOT (dim_0 < 3 OR dim_1 > 4)": 5, "dim_0 + 3 BETWEEN 5 AND 7.5 AND NOT dim_1 IN (1, 2)": 10, "5 - dim_0 > 2": 5, "-dim_0 >= -3": 5,
    "dim_0 NOT BETWEEN 2 AND 17": 10, "value > 30 OR dim_0 = 0": 25, "value > 30 AND (dim_0 = 0 OR dim_0 = 19)": 10, "dim_0 % 2 = 0": 25, "true": 25, "false": 0, "dim_0 IS NULL": 0, "NOT dim_0 IS NULL AND dim_1 = 0": 5,
    "(dim_0 = 1 AND dim_1 = 2) OR (dim_0 = 19 AND dim_1 = 28)": 2, "dim_0 = dim_1": 25, "dim_0 = NULL OR dim_1 <=> 3": 5, "NOT (dim_0 = NULL) OR dim_1 = 8": 5, "dim_0 IN (1, NULL, 2.5, 7)": 10, "dim_0 > 1e30 OR dim_1 < -1e30": 0,
    "cast(dim_0 AS STRING) = '7'": 25, "cast(dim_0 AS DOUBLE) < 3.5": 5, "dim_0 - 1 - 1 = 2 * 3": 5, "NOT (dim_0 <> 4 OR NOT (dim_1 BETWEEN 8 AND 9))": 1, "cast(dim_0 AS TINYINT) = 3 AND dim_1 = 29": 5,
}


@pytest.mark.parametrize("condition", CONDITIONS)
def test_conditions(spark, store, condition):
    cells = z.zarr_cells(spark, store, "a")
    region = z.chosen(spark, scan.cell_scan(discovery.discover(store), "a"), condition)
    assert len(region.chunks((4, 7))) == CONDITIONS[condition]
    assert rows(z.zarr_cells(spark, store, "a", where=condition)) == rows(cells.where(condition))
    assert rows(z.zarr_cells(spark, store, "a", where=F.expr(condition), columns=["dim_1"])) == rows(cells.where(condition).select("dim_1"))
    assert rows(grids.packed_cells(spark, store, "a", condition)) == rows(cells.where(condition))


def test_wrong_conditions_raise(spark, store):
    with pytest.raises(Exception, match="nowhere"):
        z.zarr_cells(spark, store, "a", where="nowhere = 1")


def test_conditions_open_no_other_chunk(spark, tmp_path):
    path = str(tmp_path / "d.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (400, 40), (10, 10), "<i4")
    w.write_values(path, "a", np.arange(16_000, dtype="<i4").reshape(400, 40))
    kept(path, "0.0", "30.2")
    found = z.zarr_cells(spark, path, "a", where="dim_0 = 1 AND dim_1 < 5 OR dim_0 = 300 AND dim_1 IN (20, 29)")
    assert found.count() == 7
    assert grids.packed_cells(spark, path, "a", "dim_0 = 1 AND dim_1 < 5").agg(F.sum("value")).first()[0] == sum(range(40, 45))
    assert grids.aggregated(spark, path, "a", where="dim_0 IN (1, 2) AND dim_1 < 5").first()["n"] == 10
    keys = spark.createDataFrame([(1, 4), (300, 21), (7, 9)], "dim_0 bigint, dim_1 bigint")
    assert sorted(r["value"] for r in grids.cells_at(spark, path, "a", keys).collect()) == [44, 289, 12_021]


def test_statements_on_a_view_prune_for_themselves(spark, tmp_path):
    path = str(tmp_path / "v.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (400,), (10,), "<i4")
    w.write_values(path, "a", np.arange(400, dtype="<i4"))
    z.cells_view(spark, "pruned_view", path, "a")
    partitions = set()
    for k in range(21):
        found = spark.sql(f"SELECT * FROM pruned_view WHERE dim_0 BETWEEN {15 * k} AND {15 * k + 2}")
        assert found.count() == 3
        partitions.add(found.rdd.getNumPartitions())
    assert partitions <= {1, 2}
    both = spark.sql("SELECT * FROM pruned_view WHERE dim_0 = 3 UNION ALL SELECT * FROM pruned_view WHERE dim_0 = 399")
    assert rows(both) == ["(3, 3)", "(399, 399)"]
    assert spark.sql("SELECT count(*) FROM pruned_view").first()[0] == 400
    kept(path, "7")
    assert spark.sql("SELECT sum(value) FROM pruned_view WHERE dim_0 = 77").first()[0] == 77
    z.drop_view(spark, "pruned_view")
    assert not spark.catalog.tableExists("pruned_view")


# Joins, windows, aggregates and lookups.


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("order", [("a", "b"), ("b", "a"), ("a", "s"), ("s", "b", "a")])
def test_joins_by_coordinates(spark, store, shards, how, order):
    places = {"a": (store, "a"), "b": (store, "b"), "s": (shards, "a")}
    found = grids.joined_cells(spark, {n: places[n] for n in order}, how)
    frames = [z.zarr_cells(spark, *places[n]).withColumnRenamed("value", n) for n in order]
    wanted = frames[0]
    for f in frames[1:]:
        wanted = wanted.join(f, ["dim_0", "dim_1"], how)
    assert rows(found) == rows(wanted.select(*found.columns)) and found.count() > 100
    assert exchanges(found) == 0
    condition = f"dim_0 = 3 OR dim_1 BETWEEN 5 AND 8 AND {order[0]} > 0"
    pruned = grids.joined_cells(spark, {n: places[n] for n in order}, how, condition)
    assert rows(pruned) == rows(wanted.where(condition).select(*found.columns))


def test_joins_decode_nested_chunks_once(store):
    reader = WindowReader(store, discovery.discover(store).array("a"))
    for x in range(0, 20, 2):
        reader.read((x, 0), (2, 30))
    assert reader.opened == 25


def test_joins_of_unlike_arrays(spark, store, tmp_path):
    path = str(tmp_path / "one.zarr")
    w.v2_array(path, "o", (4,), (2,), "<i4", fill=0)
    with pytest.raises(StoreError, match="rank"):
        grids.joined_cells(spark, {"a": (store, "a"), "o": (path, "o")})
    with pytest.raises(ValueError, match="inner, left or full"):
        grids.joined_cells(spark, {"a": (store, "a")}, "cross")


@pytest.mark.parametrize("dim", [0, 1])
def test_windows_along_a_dimension(spark, store, shards, dim):
    along = Window.partitionBy(f"dim_{1 - dim}").orderBy(f"dim_{dim}")
    spans = {"near": (1, 1), "wide": (9, 13), "back": (3, -1)}
    for path in (store, shards):
        found = grids.neighbours(spark, path, "a", dim, {"before": -1, "later": 8}, {f"s_{k}": v for k, v in spans.items()}, {f"l_{k}": v for k, v in spans.items()}, {f"h_{k}": v for k, v in spans.items()})
        v = F.col("value")
        wanted = z.zarr_cells(spark, path, "a").select("dim_0", "dim_1", "value", F.lag(v).over(along), F.lead(v, 8).over(along), *(f(v).over(along.rowsBetween(-a, b)) for f in (F.sum, F.min, F.max) for a, b in spans.values()))
        assert rows(found) == rows(wanted) and exchanges(found) == 0
        pruned = grids.neighbours(spark, path, "a", dim, {"before": -1}, where="dim_0 = 4 OR dim_1 = 7")
        assert rows(pruned) == rows(wanted.select(*wanted.columns[:4]).where("dim_0 = 4 OR dim_1 = 7"))


def test_windows_over_missing_cells(spark, store):
    """b lacks its first ten rows: windows are told by coordinates, and absent cells add nothing."""
    found = {(r["dim_0"], r["dim_1"]): r for r in grids.neighbours(spark, store, "b", 0, {"before": -1}, {"s": (2, 1)}, {"l": (2, 0)}).collect()}
    assert set(found) == {(x, y) for x in range(10, 18) for y in range(33)}
    assert found[10, 4]["before"] is None and found[11, 4]["before"] == B[10, 4]
    assert math.isclose(found[10, 4]["s"], B[10:12, 4].sum()) and found[12, 0]["l"] == B[10:13, 0].min()


def test_windows_refuse(spark, store, tmp_path):
    path = str(tmp_path / "bool.zarr")
    w.v2_array(path, "o", (4,), (2,), "|b1", fill=False)
    assert [r["after"] for r in grids.neighbours(spark, path, "o", 0, {"after": 1}).orderBy("dim_0").collect()] == [False, False, False, None]
    for call in (lambda: grids.neighbours(spark, path, "o", 0, sums={"s": (1, 1)}), lambda: grids.neighbours(spark, store, "a", 2), lambda: grids.aggregated(spark, path, "o"), lambda: grids.aggregated(spark, store, "a", {"g": (5, 1)})):
        with pytest.raises(StoreError):
            call()


GROUPS = [{}, {"dim_1": (1, 1)}, {"x": (0, 3), "y": (1, 4)}, {"y": (1, 1), "x": (0, 7)}]


@pytest.mark.parametrize("by", GROUPS)
@pytest.mark.parametrize("where", [None, "dim_0 = 1 OR dim_0 > 13 AND dim_1 < 9", "dim_0 = 99"])
def test_aggregates_inside_the_scan(spark, store, shards, by, where):
    for path, name in ((store, "a"), (store, "b"), (shards, "a")):
        found = grids.aggregated(spark, path, name, by, where)
        cells = z.zarr_cells(spark, path, name)
        cells = cells if where is None else cells.where(where)
        keys = [F.floor(F.col(f"dim_{d}") / n).alias(k) for k, (d, n) in by.items()]
        total = (F.round(F.sum("value"), 9) if name == "b" else F.sum("value")).alias("total")
        wanted = cells.groupBy(*keys).agg(F.count("*").alias("n"), total, F.min("value").alias("low"), F.max("value").alias("high"))
        assert rows(found.withColumn("total", F.round("total", 9)) if name == "b" else found) == rows(wanted)


def test_aggregates_of_odd_values(spark, tmp_path):
    path = str(tmp_path / "odd.zarr")
    for name, dtype, values in (("nan", "<f4", [1, np.nan, -2, np.inf, np.nan, np.nan]), ("big", "<u8", [2**64 - 1, 5, 2**63, 0, 1, 2]), ("long", "<i8", [2**62, -(2**62), 7, 2**61, 1, 0]), ("half", "<f2", [0.5, 1, 2, 3, 4, 5])):
        w.v2_array(path, name, (6,), (2,), dtype)
        w.write_values(path, name, np.array(values, np.dtype(dtype)))
        found = grids.aggregated(spark, f"{path}/{name}", "", {"g": (0, 2)})
        total = F.sum("value").cast(found.schema["total"].dataType).alias("total")
        wanted = z.zarr_cells(spark, f"{path}/{name}", "").groupBy(F.floor(F.col("dim_0") / 2).alias("g")).agg(F.count("*"), total, F.min("value"), F.max("value"))
        assert rows(found) == rows(wanted)


def test_aggregates_leave_few_rows(spark, store):
    with pytest.raises(StoreError, match="only conditions on coordinates"):
        grids.aggregated(spark, store, "a", where="value > 3")
    partial = grids.aggregated(spark, store, "a", {"dim_1": (1, 1)})._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in partial and grids.aggregated(spark, store, "a", {"dim_1": (1, 1)}).count() == 30


def test_scalars_and_empty_arrays(spark, tmp_path):
    path = str(tmp_path / "s.zarr")
    w.v2_group(path)
    w.v2_array(path, "one", (), (), "<i4")
    w.write_values(path, "one", np.array(7, "<i4"))
    w.v2_array(path, "none", (0, 3), (2, 2), "<i4", fill=1)
    assert grids.aggregated(spark, path, "one").first()[:] == (1, 7, 7, 7)
    assert grids.aggregated(spark, path, "none").first()[:] == (0, None, None, None)
    assert rows(grids.packed_cells(spark, path, "one")) == ["(7,)"] and grids.packed_cells(spark, path, "none").count() == 0
    assert grids.joined_cells(spark, {"a": (path, "none"), "b": (path, "none")}).count() == 0
    assert [grids.cell_count(spark, path, n).first()[0] for n in ("one", "none")] == [1, 0]


def test_counts_without_reading(spark, store, tmp_path):
    path = str(tmp_path / "c.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (20, 30), (4, 7), "<i4", fill=None)
    w.write_values(path, "a", A)
    for key in ("0.4", "4.4", "2.2"):
        os.remove(f"{path}/a/{key}")
    kept(path)
    assert grids.cell_count(spark, path, "a").first()[0] == 600 - 8 - 8 - 28
    assert grids.cell_count(spark, store, "b").first()[0] == 8 * 33


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookups(spark, store, shards, how):
    keys = spark.createDataFrame([(k % 23, (k * 7) % 31, f"r{k}") for k in range(300)] + [(None, 3, "null"), (2, -1, "below")] + [(3, 3, "hot")] * 50, "dim_0 bigint, dim_1 int, tag string")
    for path, name in ((store, "a"), (store, "b"), (shards, "a")):
        found = grids.cells_at(spark, path, name, keys, how)
        assert rows(found) == rows(keys.join(z.zarr_cells(spark, path, name), ["dim_0", "dim_1"], how).select(*found.columns))
    assert grids.cells_at(spark, store, "a", keys.where("false"), how).count() == 0
    for wrong in (keys.drop("dim_1"), keys.withColumn("value", F.lit(1))):
        with pytest.raises(StoreError):
            grids.cells_at(spark, store, "a", wrong, how)


# Ranks.

VALUES = st.one_of(st.none(), st.integers(0, 3).map(float), st.just(math.nan), st.just(-0.0))


@settings(max_examples=8, deadline=None)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), VALUES), max_size=60), down=st.booleans(), grouped=st.booleans())
def test_ranks(spark, data, down, grouped):
    frame = spark.createDataFrame([(g, v, k) for k, (g, v) in enumerate(data)], "g int, v double, k int").repartition(3)
    found = ranks.ranked(frame, ["g"] if grouped else [], "v", down, ["k"])
    v = F.desc("v") if down else F.asc("v")
    group = Window.partitionBy("g") if grouped else Window.partitionBy(F.lit(0))
    assert rows(found) == rows(frame.select("*", F.rank().over(group.orderBy(v)).cast("long"), F.row_number().over(group.orderBy(v, "k")).cast("long")))


def test_ranks_of_a_value_over_many_ranges(spark):
    frame = spark.range(4000).select(F.col("id"), F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 7).alias("v"))
    found = ranks.ranked(frame, [], "v", ties=["id"])
    assert rows(found) == rows(frame.select("*", F.rank().over(Window.partitionBy(F.lit(0)).orderBy("v")), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("v", "id"))))
    with pytest.raises(ValueError, match="already"):
        ranks.ranked(frame.withColumn("rank", F.lit(1)), [], "v")


# Table functions and packed cells.


def test_functions_over_runs(spark, store, shards):
    for name, path in (("by_runs", store), ("by_shards", shards)):
        z.cells_function(spark, name, path, "a")
        found = spark.sql(f"SELECT * FROM {name}(TABLE(SELECT /*+ REPARTITION(6) */ * FROM zarr_runs('{path}', 'a', 6)))")
        assert rows(found) == rows(z.zarr_cells(spark, path, "a")) and found.rdd.getNumPartitions() == 6
    cut = spark.sql(f"""SELECT * FROM by_runs(TABLE(SELECT * FROM zarr_runs('{store}', 'a', 6, '{{"0": [[2, 3], [9, 9]], "1": [[7, 7]]}}')))""")
    assert rows(cut) == rows(z.zarr_cells(spark, store, "a").where("dim_0 IN (2, 3, 9) AND dim_1 = 7"))
    assert spark.sql(f"""SELECT * FROM zarr_runs('{store}', 'a', 6, '{{"0": [[50, 60]]}}')""").count() == 0
    z.cells_function(spark, "values_by_runs", store, "a", columns=["value"])
    assert spark.sql(f"SELECT * FROM values_by_runs(TABLE(SELECT * FROM zarr_runs('{store}', 'a', 2)))").columns == ["value"]


def python_bytes(df):
    """Bytes that Python workers returned, as Spark's own metric has it, in a plan that ran."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.metrics().contains("pythonDataReceived"):
            total += node.metrics().apply("pythonDataReceived").value()
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return total


def test_packed_cells_send_values_alone(spark, store):
    grids.packed_cells(spark, store, "a").createOrReplaceTempView("packed")
    mean = spark.sql("SELECT sum(value) AS s FROM packed")
    assert mean.first()[0] == A.sum()
    assert "dim_" not in mean._jdf.queryExecution().optimizedPlan().toString()
    wide = np.zeros((400, 300), "<i4")
    path = store + "-wide"
    w.v2_array(path, "w", wide.shape, (100, 300), "<i4")
    w.write_values(path, "w", wide)
    sent = python_bytes(grids.packed_cells(spark, path, "w").agg(F.sum("value")))
    assert 4 * wide.size <= sent < 1.1 * 4 * wide.size
    assert rows(spark.sql("SELECT dim_1, max(value) FROM packed WHERE dim_0 = 3 GROUP BY dim_1")) == rows(z.zarr_cells(spark, store, "a").where("dim_0 = 3").groupBy("dim_1").agg(F.max("value")))


# Stacks and differences.


def test_stacks(spark, store, tmp_path):
    path = str(tmp_path / "p.zarr")
    w.v2_group(path)
    for k, n in enumerate((16, 8, 4)):
        w.v2_array(path, str(k), (n, n), (4, 3), "<i4")
        w.write_values(path, str(k), np.arange(n * n, dtype="<i4").reshape(n, n))
    places = {f"L{k}": (path, str(k)) for k in range(3)}
    frames = [z.zarr_cells(spark, *p).select(F.lit(k).alias("level"), "*") for k, p in places.items()]
    wanted = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert rows(grids.stacked_cells(spark, places)) == rows(wanted) and exchanges(grids.stacked_cells(spark, places)) == 0
    condition = "dim_0 = 15 OR level = 'L2' AND dim_1 < 2"
    assert rows(grids.stacked_cells(spark, places, condition)) == rows(wanted.where(condition))
    assert grids.stacked_cells(spark, places, "dim_0 > 90").count() == 0
    with pytest.raises(StoreError, match="stacked: a, b"):
        grids.stacked_cells(spark, {"a": (store, "a"), "b": (store, "b")})


def test_differences_decode_changed_chunks_alone(tmp_path):
    paths, values = [], np.arange(600, dtype="<i8").reshape(20, 30)
    for kind in ("plain", "shard"):
        for k in range(2):
            path = str(tmp_path / f"{kind}{k}.zarr")
            w.v3_group(path)
            w.v3_array(path, "a", (20, 30), (8, 12), "int64", [w.sharding((4, 4), [w.BYTES])] if kind == "shard" else [w.BYTES], fill=0)
            changed = values.copy()
            changed[9, 17] += k
            w.write_values(path, "a", changed)
            paths.append(path)
    for pair in (paths[:2], paths[2:]):
        readers = [WindowReader(p, discovery.discover(p).array("a")) for p in pair]
        kinds, block = [r.kind for r in readers], readers[0].shape
        schema = scan.T.StructType([scan.T.StructField(c, scan._L) for c in ("dim_0", "dim_1", "old", "new")])
        found = []
        n, origin_of = grids._blocks(Region.whole((20, 30)), block)
        for k in range(n):
            o = origin_of(k)
            for b in grids._differing(readers, kinds, schema, Region.whole((20, 30)), o, tuple(min(x, s - y) for x, s, y in zip(block, (20, 30), o, strict=True))):
                found += b.to_pylist()
        assert found == [{"dim_0": 9, "dim_1": 17, "old": 287, "new": 288}]
        assert [r.unpacked for r in readers] == [1, 1]


def test_differences(spark, store, shards, tmp_path):
    for x, y in (((store, "a"), (store, "b")), ((store, "b"), (shards, "a")), ((shards, "a"), (store, "a"))):
        a, b = z.zarr_cells(spark, *x).withColumnRenamed("value", "old"), z.zarr_cells(spark, *y).withColumnRenamed("value", "new")
        wanted = a.join(b, ["dim_0", "dim_1"], "full").where("old IS DISTINCT FROM new").select("dim_0", "dim_1", "old", "new")
        found = grids.changed_cells(spark, x, y)
        assert rows(found) == rows(wanted) and exchanges(found) == 0
        assert rows(grids.changed_cells(spark, x, y, "dim_0 = 3 OR new > 0.5 AND dim_1 = 6")) == rows(wanted.where("dim_0 = 3 OR new > 0.5 AND dim_1 = 6"))
    assert grids.changed_cells(spark, (store, "a"), (store, "a")).count() == 0
    path = str(tmp_path / "nan.zarr")
    for name, fill in (("x", 1), ("y", 2)):
        w.v2_array(path, name, (6,), (2,), "<f8", fill=fill)
        w.write_values(path, name, np.array([np.nan, 1, 0, 0, 5, 5.0]), skip={(1,)})
    assert rows(grids.changed_cells(spark, (f"{path}/x", ""), (f"{path}/y", ""))) == ["(2, 1.0, 2.0)", "(3, 1.0, 2.0)"]


# Labels and stencils.


@pytest.fixture(scope="module")
def labelled(store, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("l") / "l.zarr")
    w.v2_group(path)
    w.v2_array(path, "lat", (17,), (5,), "<f8", fill=None)
    w.write_values(path, "lat", np.linspace(0, 40, 17))
    w.v2_array(path, "lon", (30,), (8,), "<i2")
    w.write_values(path, "lon", np.arange(30) * 3 % 11)
    return {"lat": (0, path, "lat"), "lon": (1, path, "lon")}


@pytest.mark.parametrize("where", [None, "lat BETWEEN 5 AND 9", "lat > 30 OR lat IS NULL", "lat IS NULL AND dim_1 = 3", "lon IN (3, 4) AND lat < 10 AND value > 20", "lat > 30 OR dim_1 = 2", "lat > 90", "lat > rand() AND dim_0 = 99"])
def test_labels(spark, store, labelled, where):
    lat, lon = (z.zarr_cells(spark, p, a).toDF(f"dim_{d}", n) for n, (d, p, a) in labelled.items())
    whole = z.zarr_cells(spark, store, "a").join(lat, "dim_0", "left").join(lon, "dim_1", "left").select("dim_0", "dim_1", "value", "lat", "lon")
    found = grids.labelled_cells(spark, store, "a", labelled, where)
    assert rows(found) == rows(whole if where is None else whole.where(where)) and exchanges(found) == 0


def test_labels_decide_what_is_opened(spark, labelled, tmp_path):
    path = str(tmp_path / "t.zarr")
    w.v2_group(path)
    w.v2_array(path, "a", (17, 4), (5, 4), "<i4")
    w.write_values(path, "a", np.arange(68, dtype="<i4").reshape(17, 4))
    kept(path, "1.0")
    assert grids.labelled_cells(spark, path, "a", {"lat": labelled["lat"]}, "lat BETWEEN 13 AND 18 AND value >= 0").count() == 8
    for wrong in ({"lat": (2, *labelled["lat"][1:])}, {"value": labelled["lat"]}, {"a": (0, path, "a")}):
        with pytest.raises(StoreError):
            grids.labelled_cells(spark, path, "a", wrong)


def test_stencils(spark, store, shards):
    for path, values in ((store, A), (shards, None)):
        if values is None:
            values = A.astype("<i8")
            values[8:16, 12:24] = 5
        found = grids.neighbours(spark, path, "a", 0, {"up": -1, "corner": (3, -9), "far": (0, 25)}, sums={"s": (1, 0)})
        for r in found.collect():
            x, y = r["dim_0"], r["dim_1"]
            assert r["value"] == values[x, y] and r["up"] == (values[x - 1, y] if x else None) and r["s"] == values[max(0, x - 1) : x + 1, y].sum()
            assert r["corner"] == (values[x + 3, y - 9] if x + 3 < 20 and y >= 9 else None) and r["far"] == (values[x, y + 25] if y < 5 else None)
        assert exchanges(found) == 0
    with pytest.raises(StoreError, match="a number for each"):
        grids.neighbours(spark, store, "a", 0, {"bad": (1, 2, 3)})
