"""

BENCH_CPUS names the number of local cores. The array is written before the clock starts, twice: in
format 3 as shards of 1 x 10 x 512 x 512 with inner chunks of 1 x 1 x 256 x 256 (Blosc/Zstandard),
and in format 2 as gzip chunks of two dimensions. Each row is timed twice, the second time counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.operators import grids
from gridframe.operators import tables as z
from gridframe.sources import writer as w

CPUS = os.environ.get("BENCH_CPUS", "8")
SHAPE = (2, 236, 275, 271)


def ran(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", CPUS).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="gridframe-bench-")
    values = np.random.default_rng(0).poisson(40, SHAPE).astype("<u2")
    shards, flat, many = f"{folder}/shards.zarr", f"{folder}/flat.zarr", f"{folder}/many.zarr"
    w.v3_array(shards, "", SHAPE, (1, 10, 512, 512), "uint16", [w.sharding((1, 1, 256, 256), [w.BYTES, w.blosc("shuffle", 2)])], fill=0)
    w.write_values(shards, "", values)
    w.v2_array(flat, "", (472 * 275, 271), (2750, 271), "<f4", compressor={"id": "gzip", "level": 1})
    w.write_values(flat, "", values.reshape(-1, 271).astype("<f4"))
    w.v2_array(many, "", (100, 100), (1, 1), "<i4", separator="/")
    w.write_values(many, "", np.ones((100, 100), "<i4"))

    cases: dict[str, Callable[[], DataFrame]] = {
        "full scan, shards": lambda: z.zarr_cells(spark, shards, ""), "full scan, 2-D gzip": lambda: z.zarr_cells(spark, flat, ""), "full scan, shards, packed": lambda: grids.packed_cells(spark, shards, ""),
        "one cell of shards": lambda: z.zarr_cells(spark, shards, "").where("dim_0 = 1 AND dim_1 = 100 AND dim_2 = 7 AND dim_3 = 270"), "one plane or one line of shards": lambda: z.zarr_cells(spark, shards, "", where="dim_0 = 1 AND dim_1 = 100 OR dim_2 = 0 AND dim_3 = 5"),
        "sum by one dimension, cells of shards": lambda: z.zarr_cells(spark, shards, "").groupBy("dim_1").agg(F.sum("value")), "sum by one dimension, packed": lambda: grids.packed_cells(spark, shards, "").groupBy("dim_1").agg(F.sum("value")),
        "sum by one dimension, inside the scan": lambda: grids.aggregated(spark, shards, "", {"dim_1": (1, 1)}), "sum by one dimension, cells of 2-D gzip": lambda: z.zarr_cells(spark, flat, "").groupBy("dim_1").agg(F.sum("value")),
        "sum of all, cells of shards": lambda: z.zarr_cells(spark, shards, "").agg(F.sum("value")), "sum of all, packed": lambda: grids.packed_cells(spark, shards, "").agg(F.sum("value")), "count of cells": lambda: grids.cell_count(spark, shards, ""),
        "two arrays by coordinates, inside the scan": lambda: grids.joined_cells(spark, {"a": (shards, ""), "b": (shards, "")}).agg(F.sum(F.col("a") * F.col("b"))), "moving sum along dim_1, inside the scan": lambda: grids.neighbours(spark, shards, "", 1, sums={"s": (1, 1)}).agg(F.max("s")),
        "listing of 10,000 chunk files": lambda: z.zarr_chunks(spark, many),
    }
    took = {}
    for name, make in cases.items():
        for _ in range(2):
            began = time.time()
            ran(make())
            took[name] = round(time.time() - began, 2)
    print(json.dumps({"cpus": int(CPUS), "cells": int(values.size), "seconds": took}))


if __name__ == "__main__":
    main()
