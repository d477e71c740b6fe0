"""Ranks and row numbers over groups of any size: a sort by ranges, and counts of the ranges before."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.shared import written
from gridframe.shipping import ship

#: Ranges' summaries that are broadcast at most.
MOST_SUMMARIES = 1_000_000


def ranked(rows: DataFrame, by: Sequence[str], value: str, descending: bool = False, ties: Sequence[str] = (), rank: str = "rank", row: str = "row") -> DataFrame:
    """`rows` with `rank` (as rank() over a window by `by` in the order of `value`) and `row` (row_number(), equal values in the order of `ties`), both long.

    No task holds a group: rows are sorted into ranges by group, value and ties, so that neither a
    large group nor a value that many rows share is one range. A range numbers its rows as they
    stream by; a group's numbers begin after its rows in the ranges before, and a value that began in
    an earlier range has the rank it has there. What meets by group is one row a range. Nulls come
    first in ascending and last in descending order, NaN is the largest value, as in Spark. Rows that
    are equal in all of these may be numbered in any order.
    """
    spark = rows.sparkSession
    ship(spark)
    if clash := {rank, row} & set(rows.columns):
        raise ValueError(f"the rows already have the columns {', '.join(sorted(clash))}")
    order = [*(F.col(c) for c in by), F.col(value).desc() if descending else F.col(value).asc(), *(F.col(c) for c in ties)]
    ranged = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    schema = T.StructType([*rows.schema.fields, T.StructField("__range", T.IntegerType()), T.StructField("__at", T.LongType()), T.StructField("__first", T.LongType())])
    groups, at = [rows.columns.index(c) for c in by], rows.columns.index(value)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        group, last, place, first = None, None, 0, 0
        for b in batches:
            keys = [b.column(k).to_pylist() for k in groups]
            values = [_same(v) for v in b.column(at).to_pylist()]
            places, firsts = [], []
            for k, v in enumerate(values):
                own = tuple(c[k] for c in keys)
                if own != group:
                    group, place, first = own, 0, 0
                elif v != last:
                    first = place
                last = v
                places.append(place)
                firsts.append(first)
                place += 1
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int32()), pa.array(places, pa.int64()), pa.array(firsts, pa.int64())], names=schema.names)

    numbered = written(ranged.mapInArrow(number, schema), "ranked")
    v = F.col(value)
    ranges = numbered.groupBy(*by, "__range").agg(F.count("*").alias("__n"), F.min_by(F.struct(v.alias("v")), "__at").alias("__head"), F.max_by(F.struct(v.alias("v"), F.col("__first").alias("f")), "__at").alias("__tail"))
    along = Window.partitionBy(*by).orderBy("__range")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({"__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)), "__last": F.lag("__tail").over(along)})
    carried = F.col("__last").isNotNull() & F.col("__last.v").eqNullSafe(F.col("__head.v"))
    ranges = ranges.withColumn("__carried", carried)
    # Where the range's last value began, if it began in this range.
    began = F.when(F.col("__carried") & (F.col("__tail.f") == 0), F.lit(None)).otherwise(F.col("__before") + F.col("__tail.f"))
    ranges = ranges.withColumn("__began", began).withColumn("__start", F.when(F.col("__carried"), F.last("__began", True).over(earlier)).otherwise(F.col("__before")))
    ranges = written(ranges.select(*(F.col(c).alias(f"__by_{k}") for k, c in enumerate(by)), F.col("__range").alias("__of"), "__before", "__start"), "ranges")
    same = F.col("__range") == F.col("__of")
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{k}"))
    met = numbered.join(F.broadcast(ranges) if ranges.count() <= MOST_SUMMARIES else ranges, same)
    place = F.when(F.col("__first") == 0, F.col("__start")).otherwise(F.col("__before") + F.col("__first"))
    return met.select(*rows.columns, (place + 1).alias(rank), (F.col("__before") + F.col("__at") + 1).alias(row))


def _same(v: object) -> object:
    """The value, so that NaN equals itself."""
    return "NaN" if isinstance(v, float) and v != v else v
