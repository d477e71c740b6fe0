"""The results to match over the small fixture stores: names, numbers and values here are fixed values."""

import pytest
from pyspark.sql import functions as F

from gridframe.operators import tables as z
from tests import stores


@pytest.fixture(scope="module")
def v2(tmp_path_factory):
    return stores.simple_v2(str(tmp_path_factory.mktemp("s") / "simple_v2.zarr"))


@pytest.fixture(scope="module")
def v3(tmp_path_factory):
    return stores.simple_v3(str(tmp_path_factory.mktemp("s") / "simple_v3.zarr"))


@pytest.fixture(scope="module")
def image(tmp_path_factory):
    return stores.image_v2(str(tmp_path_factory.mktemp("s") / "image.zarr"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_v2_groups(spark, v2):
    found = rows(z.zarr_groups(spark, v2))
    assert [(g[1], g[2]) for g in found] == [("/", 2), ("stations", 2)]
    assert [g[3] for g in found] == [f"{v2}/.zmetadata#.zgroup", f"{v2}/.zmetadata#stations/.zgroup"]


def test_v2_arrays(spark, v2):
    found = z.zarr_arrays(spark, v2).select("array_path", "rank", F.col("shape").cast("string"), F.col("chunk_shape").cast("string"), "dtype", "order", F.expr("coalesce(nullif(compressor, ''), '<none>')"), "dimension_separator")
    assert rows(found) == [
        ("half_precision", 2, "[2, 2]", "[2, 2]", "<f2", "C", "<none>", "."),
        ("mask", 2, "[2, 3]", "[2, 2]", "|b1", "C", "<none>", "."),
        ("sparse_fill", 2, "[2, 3]", "[2, 2]", "<i4", "C", "<none>", "."),
        ("stations/elevation", 1, "[2]", "[2]", "<i4", "C", "<none>", "/"),
        ("temperature", 2, "[4, 3]", "[2, 2]", "<f8", "C", '{"id":"gzip","level":1}', "."),
    ]
    assert rows(z.zarr(spark, v2)) == rows(z.zarr_arrays(spark, v2))


def test_v2_chunks(spark, v2):
    found = z.zarr_chunks(spark, v2)
    assert found.where("file_size_bytes > 0").count() == 9
    keys = [(r[1], r[2], list(r[3])) for r in found.collect()]
    assert ("sparse_fill", "0.0", [0, 0]) in keys and ("sparse_fill", "0.1", [0, 1]) not in keys
    assert ("stations/elevation", "0", [0]) in keys


def test_v2_cells(spark, v2):
    assert rows(z.zarr_cells(spark, v2, "stations/elevation")) == [(0, 100), (1, 200)]
    assert rows(z.zarr_cells(spark, v2, "/stations/elevation/")) == [(0, 100), (1, 200)]
    assert [r[2] for r in rows(z.zarr_cells(spark, v2, "half_precision"))] == [1.5, -2.0, 0.5, 4.0]
    assert [r[2] for r in rows(z.zarr_cells(spark, v2, "mask"))] == [True, False, False, True, True, True]
    assert [r[2] for r in rows(z.zarr_cells(spark, v2, "sparse_fill"))] == [1, 2, -1, 4, 5, -1]
    temperature = z.zarr(spark, v2, "temperature")
    assert [r[2] for r in rows(temperature)] == [1.5 + k for k in range(12)]
    assert temperature.agg(F.sum("value")).first()[0] == 84.0


def test_v2_filters(spark, v2):
    temperature = z.zarr_cells(spark, v2, "temperature")
    assert temperature.where("dim_0 = 0").count() == 3
    assert [r[2] for r in rows(temperature.where("dim_0 >= 2 AND dim_1 = 1"))] == [8.5, 11.5]
    elevation = z.zarr_cells(spark, v2, "stations/elevation")
    assert rows(elevation.where("value >= 150")) == [(1, 200)]
    assert rows(elevation.where("dim_0 = 1").select("value")) == [(200,)]


def test_image(spark, image):
    cells = z.zarr_cells(spark, image, "0")
    assert [r[3] for r in rows(cells)] == list(range(1, 13))
    assert [r[3] for r in rows(cells.where("dim_1 = 1 AND dim_2 = 2"))] == [6, 12]


def test_v3(spark, v3):
    assert [(g[1], g[2]) for g in rows(z.zarr_groups(spark, v3))] == [("/", 3)]
    assert rows(z.zarr_arrays(spark, v3).select("array_path", "chunk_key_encoding", "order")) == [("fortran_v3", "default", "F"), ("mask_v3", "v2", "C"), ("temperature_v3", "default", "C")]
    assert rows(z.zarr_chunks(spark, v3).select("array_path", "chunk_key")) == [("fortran_v3", "c/0/0"), ("mask_v3", "0.0"), ("mask_v3", "0.1"), ("temperature_v3", "c/0/0"), ("temperature_v3", "c/1/0")]
    assert [r[2] for r in rows(z.zarr_cells(spark, v3, "fortran_v3"))] == [1, 2, 3, 4]
    assert z.zarr(spark, v3, "temperature_v3", "v3").agg(F.sum("value")).first()[0] == 21.0
    assert [r[2] for r in rows(z.zarr_cells(spark, v3, "mask_v3"))] == [True, False, False, True, True, True]
    assert z.zarr_arrays(spark, v3, "auto").count() == 3


def test_sql_functions(spark, v2, v3):
    z.register(spark)
    assert spark.sql(f"SELECT count(*) FROM zarr_groups('{v2}')").first()[0] == 2
    assert spark.sql(f"SELECT count(*) FROM zarr('{v2}')").first()[0] == 5
    assert spark.sql(f"SELECT sum(value) FROM zarr('{v3}', 'temperature_v3', 'v3')").first()[0] == 21.0
    assert spark.sql(f"SELECT count(*) FROM zarr_chunks('{v2}', '2')").first()[0] == 9
    assert spark.sql(f"SELECT value FROM zarr_cells('{v2}', 'stations/elevation') WHERE dim_0 = 1").first()[0] == 200
    with pytest.raises(Exception, match="takes the versions auto, v2 and v3"):
        spark.sql(f"SELECT * FROM zarr_groups('{v2}', 'v4')").collect()
    with pytest.raises(Exception, match="needs the paths of a store and of an array"):
        spark.sql(f"SELECT * FROM zarr_cells('{v2}', NULL)").collect()


def test_view_and_source(spark, v2):
    z.cells_view(spark, "temps", v2, "temperature")
    assert spark.sql("SELECT count(*) FROM temps WHERE dim_0 = 0").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM temps").first()[0] == 12
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW raw_temps USING gridframe OPTIONS (path '{v2}', array 'temperature')")
    assert spark.sql("SELECT count(*) FROM raw_temps WHERE dim_0 = 0").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM raw_temps").first()[0] == 12
