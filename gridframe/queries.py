"""Registered queries over array stores, each with the SQL that gives the same rows.

The stores are made from the driver's tables: `Stores` writes an array when a query
first asks for it, by a Spark job, into the folder that all machines share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridframe.operators import grids, ranks
from gridframe.operators import tables as z
from gridframe.shared import new_path
from gridframe.sources import writer as w

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_MADE: dict[tuple[str, str, str], str] = {}

GZIP = {"id": "gzip", "level": 1}
GZIP_V3 = {"name": "gzip", "configuration": {"level": 1}}


class Stores:
    """Paths of one session's stores for one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def size(self, table: str, key: str) -> int:
        return (self.table(table).agg(F.max(key)).first()[0] or 0) + 1

    def once(self, name: str, make: Callable[[str], None]) -> str:
        """The path of the store `name`; made at the first call."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _MADE:
            path = new_path(self.spark, "store") + f"/{name}.zarr"
            make(path)
            _MADE[key] = path
        return _MADE[key]

    def v2(self, name: str, shape: tuple, chunks: tuple, dtype: str, cells: DataFrame, **options: object) -> str:
        def make(path: str) -> None:
            w.v2_group(path)
            w.v2_array(path, "a", shape, chunks, dtype, **options)
            w.write_cells(cells, path, "a")

        return self.once(name, make)

    def v3(self, name: str, shape: tuple, chunks: tuple, dtype: str, cells: DataFrame, **options: object) -> str:
        def make(path: str) -> None:
            w.v3_group(path)
            w.v3_array(path, "a", shape, chunks, dtype, **options)
            w.write_cells(cells, path, "a")

        return self.once(name, make)

    # Arrays that several queries read.

    def vectors(self) -> str:
        """embeddings as float32 [vec_id, 64], gzip, chunks that don't divide the shape."""
        cells = self.table("embeddings").select(F.col("vec_id").alias("dim_0"), F.posexplode("embedding").alias("dim_1", "value"))
        return self.v2("vectors", (self.size("embeddings", "vec_id"), 64), (100, 24), "<f4", cells.withColumn("dim_1", F.col("dim_1").cast("long")), compressor=GZIP)

    def prices(self) -> str:
        """p_retailprice as float64 [p_partkey], gzip."""
        cells = self.table("part").select(F.col("p_partkey").alias("dim_0"), F.col("p_retailprice").alias("value"))
        return self.v2("prices", (self.size("part", "p_partkey"),), (300,), "<f8", cells, compressor=GZIP)

    def quantities(self) -> DataFrame:
        """Cells of sum(l_quantity) by [l_suppkey, l_linenumber - 1]."""
        return self.table("lineitem").groupBy(F.col("l_suppkey").cast("long").alias("dim_0"), (F.col("l_linenumber") - 1).cast("long").alias("dim_1")).agg(F.sum("l_quantity").alias("value"))

    def quantity_shape(self) -> tuple[int, int]:
        return self.size("supplier", "s_suppkey"), 7

    def part_values(self, expression: str) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("dim_0"), F.expr(expression).alias("value"))

    def cells(self, path: str, **options: object) -> DataFrame:
        return z.zarr_cells(self.spark, path, "a", **options)


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Registers a query of a Stores, and its SQL."""

    def add(f: Callable[[Stores], DataFrame]) -> Callable:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(Stores(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[key] = sql
        return f

    return add


VECTORS = "SELECT vec_id AS dim_0, CAST(i - 1 AS BIGINT) AS dim_1, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)"
PRICES = "SELECT p_partkey AS dim_0, p_retailprice AS value FROM part"
_GRID = "(SELECT s AS dim_0, l AS dim_1 FROM (SELECT unnest(range(0, (SELECT max(s_suppkey) + 1 FROM supplier))) AS s), (SELECT unnest(range(0, 7)) AS l))"
QUANTITIES = f"SELECT g.dim_0, g.dim_1, coalesce(q.v, 0) AS value FROM {_GRID} g LEFT JOIN (SELECT l_suppkey AS dim_0, l_linenumber - 1 AS dim_1, sum(l_quantity) AS v FROM lineitem GROUP BY ALL) q ON g.dim_0 = q.dim_0 AND g.dim_1 = q.dim_1"


def doubles(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.col("value").cast("double"))


# Metadata relations.


def _overview(s: Stores) -> str:
    """A consolidated format 2 store with a nested group; its shapes are the tables' sizes."""

    def make(path: str) -> None:
        n, v = s.size("part", "p_partkey"), s.size("embeddings", "vec_id")
        groups = {"": w.v2_group(path), "inner": w.v2_group(path, "inner")}
        arrays = {
            "prices": w.v2_array(path, "prices", (n,), (300,), "<f8", compressor=GZIP),
            "inner/vectors": w.v2_array(path, "inner/vectors", (v, 64), (100, 24), "<f4", order="F", fill=0, separator="/"),
        }
        w.consolidate(path, groups, arrays)

    return s.once("overview", make)


def _walked(s: Stores) -> str:
    """A format 3 store: a group below a plain folder, and arrays of three key encodings."""

    def make(path: str) -> None:
        n = s.size("part", "p_partkey")
        w.v3_group(path)
        w.v3_group(path, "plain/deep")
        w.v3_array(path, "plain/deep/a", (n,), (300,), "int32", [w.BYTES, GZIP_V3])
        w.v3_array(path, "b", (n, 2), (300, 2), "bool", [{"name": "bytes"}], fill=False, encoding="v2")
        w.v3_array(path, "c", (2, 2), (2, 2), "uint16", [{"name": "transpose", "configuration": {"order": [1, 0]}}, w.BYTES], separator=".")

    return s.once("walked", make)


def _nations(s: Stores, consolidated: bool) -> str:
    """A group for each region and in it an array for each nation, as long as the nation has customers."""

    def make(path: str) -> None:
        regions = {r["r_regionkey"]: r["r_name"] for r in s.table("region").toLocalIterator()}
        sizes = s.table("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
        nations = s.table("nation").join(sizes, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        group, array = (w.v2_group, w.v2_array) if consolidated else (w.v3_group, w.v3_array)
        groups = {"": group(path)} | {r: group(path, r) for r in regions.values()}
        arrays = {}
        for r in nations.toLocalIterator():
            name = f"{regions[r['n_regionkey']]}/{r['n_name']}"
            arrays[name] = array(path, name, (r["n"] or 0,), (16,), "<f8" if consolidated else "float64")
        if consolidated:
            w.consolidate(path, groups, arrays)

    return s.once(f"nations_{consolidated}", make)


def _placed(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(name, "zarr_format", F.expr("substring(metadata_path, length(store_path) + 2)").alias("place"))


@query("SELECT '/' AS group_path, CAST(2 AS BIGINT) AS zarr_format, '.zmetadata#.zgroup' AS place UNION ALL SELECT r_name, 2, '.zmetadata#' || r_name || '/.zgroup' FROM region")
def groups_consolidated(s: Stores) -> DataFrame:
    return _placed(z.zarr_groups(s.spark, _nations(s, True)), "group_path")


@query("SELECT '/' AS group_path, CAST(3 AS BIGINT) AS zarr_format, 'zarr.json' AS place UNION ALL SELECT r_name, 3, r_name || '/zarr.json' FROM region")
def groups_walked(s: Stores) -> DataFrame:
    return _placed(z.zarr_groups(s.spark, _nations(s, False)), "group_path")


_SIZES = "SELECT r_name || '/' || n_name AS array_path, CAST({0} AS BIGINT) AS zarr_format, coalesce(n, 0) AS n_cells, coalesce(n, 0) // 16 + CAST(coalesce(n, 0) % 16 > 0 AS BIGINT) AS n_chunks FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey"


def _sized(arrays: DataFrame) -> DataFrame:
    n = F.element_at("shape", 1)
    return arrays.select("array_path", "zarr_format", n.alias("n_cells"), F.ceil(n / F.element_at("chunk_shape", 1)).alias("n_chunks"))


@query(_SIZES.format(2))
def arrays_by_nation_v2(s: Stores) -> DataFrame:
    return _sized(z.zarr_arrays(s.spark, _nations(s, True), "2"))


@query(_SIZES.format(3))
def arrays_by_nation_v3(s: Stores) -> DataFrame:
    return _sized(z.zarr_arrays(s.spark, _nations(s, False), "auto"))


def _arrays(df: DataFrame) -> DataFrame:
    return df.select("array_path", "zarr_format", "rank", F.col("shape").cast("string").alias("shape"), F.col("chunk_shape").cast("string").alias("chunk_shape"), "dtype", F.col("order").alias("cell_order"), F.expr("coalesce(nullif(compressor, ''), '<none>')").alias("compressor"), "chunk_key_encoding", "dimension_separator")


_COLUMNS = "t(array_path, zarr_format, rank, shape, chunk_shape, dtype, cell_order, compressor, chunk_key_encoding, dimension_separator)"
_PARTS, _VECS = "(SELECT max(p_partkey) + 1 FROM part)", "(SELECT max(vec_id) + 1 FROM embeddings)"
_V2_ARRAYS = f"SELECT * FROM (VALUES ('prices', CAST(2 AS BIGINT), CAST(1 AS BIGINT), '[' || {_PARTS} || ']', '[300]', '<f8', 'C', '{{\"id\":\"gzip\",\"level\":1}}', 'v2', '.'), ('inner/vectors', 2, 2, '[' || {_VECS} || ', 64]', '[100, 24]', '<f4', 'F', '<none>', 'v2', '/')) {_COLUMNS}"


@query(_V2_ARRAYS)
def arrays_consolidated(s: Stores) -> DataFrame:
    return _arrays(z.zarr_arrays(s.spark, _overview(s)))


@query(_V2_ARRAYS)
def zarr_overview(s: Stores) -> DataFrame:
    return _arrays(z.zarr(s.spark, _overview(s)))


@query(f"SELECT * FROM (VALUES ('plain/deep/a', CAST(3 AS BIGINT), CAST(1 AS BIGINT), '[' || {_PARTS} || ']', '[300]', '<i4', 'C', '{{\"id\":\"gzip\",\"level\":1}}', 'default', '/'), ('b', 3, 2, '[' || {_PARTS} || ', 2]', '[300, 2]', '|b1', 'C', '<none>', 'v2', '.'), ('c', 3, 2, '[2, 2]', '[2, 2]', '<u2', 'F', '<none>', 'default', '.')) {_COLUMNS}")
def arrays_walked(s: Stores) -> DataFrame:
    return _arrays(z.zarr_arrays(s.spark, _walked(s), "v3"))


@query("SELECT 'a' AS array_path, CAST(k AS VARCHAR) AS chunk_key, '[' || k || ']' AS chunk_coords, true AS has_bytes FROM (SELECT DISTINCT p_partkey // 300 AS k FROM part)")
def chunks_listing(s: Stores) -> DataFrame:
    return z.zarr_chunks(s.spark, s.prices()).select("array_path", "chunk_key", F.col("chunk_coords").cast("string").alias("chunk_coords"), (F.col("file_size_bytes") > 0).alias("has_bytes"))


@query("SELECT count(DISTINCT doc_id // 4) AS n_files FROM labels")
def chunks_of_sparse_array(s: Stores) -> DataFrame:
    return z.zarr_chunks(s.spark, _quality(s, True)).agg(F.count("*").alias("n_files"))


@query("SELECT count(*) AS n_files FROM (SELECT DISTINCT l_suppkey // 16, (l_linenumber - 1) // 4 FROM lineitem)")
def chunks_of_shards(s: Stores) -> DataFrame:
    return z.zarr_chunks(s.spark, _sharded(s, "shuffle")).agg(F.count("*").alias("n_files"))


# Cells by layout, codec and value type.


@query(PRICES)
def cells_1d_gzip(s: Stores) -> DataFrame:
    return s.cells(s.prices())


@query(VECTORS)
def cells_2d_edges(s: Stores) -> DataFrame:
    return doubles(s.cells(s.vectors()))


@query(QUANTITIES)
def cells_fortran_v2(s: Stores) -> DataFrame:
    return s.cells(s.v2("fortran", s.quantity_shape(), (16, 4), "<f8", s.quantities(), order="F"))


@query(QUANTITIES)
def cells_transposed_v3(s: Stores) -> DataFrame:
    transpose = {"name": "transpose", "configuration": {"order": [1, 0]}}
    return s.cells(s.v3("transposed", s.quantity_shape(), (16, 4), "float64", s.quantities(), codecs_=[transpose, w.BYTES, GZIP_V3]))


@query(QUANTITIES)
def cells_v2_keys_in_v3(s: Stores) -> DataFrame:
    return s.cells(s.v3("v2keys", s.quantity_shape(), (32, 7), "float64", s.quantities(), encoding="v2", separator="/"))


@query(QUANTITIES)
def cells_3d(s: Stores) -> DataFrame:
    """The same values as [suppkey // 10, suppkey % 10, line]."""
    n = -(-s.quantity_shape()[0] // 10)
    cells = s.quantities().select((F.col("dim_0") / 10).cast("long").alias("dim_0"), (F.col("dim_0") % 10).alias("dim_1"), F.col("dim_1").alias("dim_2"), "value")
    back = s.cells(s.v2("cube", (n, 10, 7), (3, 4, 3), "<f8", cells))
    return back.select((F.col("dim_0") * 10 + F.col("dim_1")).alias("dim_0"), F.col("dim_2").alias("dim_1"), "value").where(f"dim_0 < {s.quantity_shape()[0]}")


#: Value expressions in the range of each type, the same in Spark and in SQL; the Spark type to cast to and how results are compared.
TYPED = {
    "<i1": ("p_size - 25", "BIGINT"), "<i2": ("p_partkey % 60000 - 30000", "BIGINT"), "<i4": ("p_partkey * 1000 - 500000", "BIGINT"), "<i8": ("p_partkey * 4000000000 - 7", "BIGINT"),
    "<u1": ("p_size * 5", "BIGINT"), "<u2": ("p_partkey % 65536", "BIGINT"), "<u4": ("p_partkey + 4294000000", "BIGINT"), "<f2": ("p_partkey % 2048", "DOUBLE"),
    ">i4": ("p_partkey - 1000", "BIGINT"), ">f8": ("p_retailprice", "DOUBLE"), "<f8": ("p_retailprice * 2", "DOUBLE"),
}


#: Types whose values outgrow them with the tables (p_partkey from 967,296 and 2,147,984 on), and the least value of each.
WORDS = {"<u4": 0, "<i4": -(2**31)}


def _of_words(s: Stores, name: str, dtype: str, expression: str) -> DataFrame:
    """64-bit values as two arrays of a 4-byte type, joined by coordinates: `low` has what the type holds, `high` how often 2^32 is added to it."""

    def make(path: str) -> None:
        w.v2_group(path)
        values = s.part_values(expression)
        high = F.shiftright(F.col("value") - WORDS[dtype], 32)
        for word, value in (("high", high), ("low", F.col("value") - high * F.lit(2**32))):
            w.v2_array(path, word, (s.size("part", "p_partkey"),), (700,), dtype)
            w.write_cells(values.withColumn("value", value), path, word)

    path = s.once(name, make)
    cells = grids.joined_cells(s.spark, {"low": (path, "low"), "high": (path, "high")})
    return cells.select("dim_0", (F.col("high").cast("long") * F.lit(2**32) + F.col("low")).alias("value"))


def _typed(dtype: str, expression: str, kind: str) -> None:
    label = ("big_" if dtype[0] == ">" else "") + dtype[1:]

    @query(f"SELECT p_partkey AS dim_0, CAST({expression} AS {kind}) AS value FROM part", f"cells_{label}")
    def run(s: Stores) -> DataFrame:
        if dtype in WORDS:
            return _of_words(s, f"typed_{label}", dtype, expression)
        stored = "|" + dtype[1:] if dtype[2:] == "1" else dtype
        path = s.v2(f"typed_{label}", (s.size("part", "p_partkey"),), (700,), stored, s.part_values(expression))
        return s.cells(path).withColumn("value", F.col("value").cast(kind.lower()))


for _dtype, (_expression, _kind) in TYPED.items():
    _typed(_dtype, _expression, _kind)


@query("SELECT p_partkey AS dim_0, CAST(p_partkey + 9223372036854775808 AS VARCHAR) AS value FROM part")
def cells_u8(s: Stores) -> DataFrame:
    values = s.part_values("cast(p_partkey as decimal(20, 0)) + 9223372036854775808")
    path = s.v3("typed_u8", (s.size("part", "p_partkey"),), (700,), "uint64", values, codecs_=[w.BYTES, GZIP_V3])
    return s.cells(path).withColumn("value", F.col("value").cast("string"))


@query("SELECT c_custkey AS dim_0, c_acctbal < 0 AS value FROM customer")
def cells_bool(s: Stores) -> DataFrame:
    cells = s.table("customer").select(F.col("c_custkey").alias("dim_0"), (F.col("c_acctbal") < 0).alias("value"))
    return s.cells(s.v2("negative", (s.size("customer", "c_custkey"),), (128,), "|b1", cells, fill=False))


def _quality(s: Stores, filled: bool) -> str:
    cells = s.table("labels").select(F.col("doc_id").alias("dim_0"), F.col("quality").alias("value"))
    return s.v2(f"quality_{filled}", (s.size("documents", "doc_id"),), (4,), "|i1", cells, fill=-1 if filled else None)


@query("SELECT d AS dim_0, CAST(coalesce(quality, -1) AS BIGINT) AS value FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS d) LEFT JOIN labels ON doc_id = d")
def cells_missing_filled(s: Stores) -> DataFrame:
    return s.cells(_quality(s, True)).withColumn("value", F.col("value").cast("long"))


@query("SELECT d AS dim_0, CAST(coalesce(quality, 0) AS BIGINT) AS value FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS d) LEFT JOIN labels ON doc_id = d WHERE d // 4 IN (SELECT doc_id // 4 FROM labels)")
def cells_missing_absent(s: Stores) -> DataFrame:
    return s.cells(_quality(s, False)).withColumn("value", F.col("value").cast("long"))


def _sharded(s: Stores, kind: str) -> str:
    inner = {"raw": [w.BYTES], "gzip": [w.BYTES, GZIP_V3], "shuffle": [w.BYTES, w.blosc("shuffle", 8)], "bitshuffle": [{"name": "bytes"}, w.blosc("bitshuffle", 1)], "noshuffle": [w.BYTES, w.blosc("noshuffle", 8)]}[kind]
    codec = w.sharding((4, 2), inner, "start" if kind in ("raw", "bitshuffle") else "end", kind != "gzip")
    cells = s.quantities() if kind != "bitshuffle" else s.quantities().withColumn("value", F.col("value").cast("long") % 100)
    return s.v3(f"sharded_{kind}", s.quantity_shape(), (16, 4), "int8" if kind == "bitshuffle" else "float64", cells, codecs_=[codec], fill=0)


def _sharded_query(kind: str, sql: str) -> None:
    @query(sql, f"cells_sharded_{kind}")
    def run(s: Stores) -> DataFrame:
        return doubles(s.cells(_sharded(s, kind)))


for _kind in ("raw", "gzip", "shuffle", "noshuffle"):
    _sharded_query(_kind, QUANTITIES)
_sharded_query("bitshuffle", f"SELECT dim_0, dim_1, CAST(CAST(value AS BIGINT) % 100 AS DOUBLE) AS value FROM ({QUANTITIES})")


# Filters, projection, names and versions.

#: Conditions on cells, the same in Spark and in SQL.
FILTERS = {
    "eq": "dim_0 = 7", "ne": "dim_0 <> 3 AND dim_1 = 5", "lt": "dim_0 < 101 AND dim_1 <= 2", "ge": "dim_0 >= 180 AND dim_1 > 61", "between": "dim_0 BETWEEN 95 AND 105 AND dim_1 BETWEEN 20 AND 30",
    "in": "dim_0 IN (0, 99, 100, 100000) AND dim_1 IN (1, 63)", "or": "dim_0 = 1 OR dim_1 = 3", "is_null": "dim_0 IS NULL", "is_not_null": "dim_0 IS NOT NULL AND dim_1 = 0", "value": "value > 0.2",
    "value_and_dim": "value < 0 AND dim_1 = 10", "fraction": "dim_0 < 2.5", "outside": "dim_0 = -1", "contradiction": "dim_0 > 5 AND dim_0 < 3",
}


def _filtered(label: str, condition: str) -> None:
    @query(f"SELECT * FROM ({VECTORS}) WHERE {condition}", f"filter_{label}")
    def run(s: Stores) -> DataFrame:
        return doubles(s.cells(s.vectors())).where(condition)


for _label, _condition in FILTERS.items():
    _filtered(_label, _condition)


@query(f"SELECT * FROM ({VECTORS}) WHERE dim_0 BETWEEN 3 AND 5 OR dim_0 = 120")
def filter_dim_ranges(s: Stores) -> DataFrame:
    return doubles(s.cells(s.vectors(), dim_ranges={0: [(3, 5), (120, 120)]}))


#: Conditions that become unions of boxes.
REGIONS = {
    "or": "dim_0 = 1 OR dim_0 = 300 OR dim_1 IN (3, 40)", "not": "NOT (dim_0 > 3 AND dim_0 < 190 OR dim_1 NOT BETWEEN 20 AND 30)", "shifted": "dim_0 + 3 BETWEEN 90 AND 104.5 AND 70 - dim_1 <= 9 OR dim_0 - 5 = -2",
    "with_values": "(dim_0 < 20 OR dim_1 = 63) AND value > 0", "points": "dim_0 = 5 AND dim_1 = 7 OR dim_0 = 150 AND dim_1 = 60 OR dim_0 = 199 AND NOT dim_1 <> 0",
}


def _region(label: str, condition: str) -> None:
    @query(f"SELECT * FROM ({VECTORS}) WHERE {condition}", f"region_{label}")
    def run(s: Stores) -> DataFrame:
        return doubles(s.cells(s.vectors(), where=condition))


for _label, _condition in REGIONS.items():
    _region(_label, _condition)


@query(f"SELECT dim_1 FROM ({VECTORS}) WHERE value > 0.1 OR dim_0 = 3")
def region_projected(s: Stores) -> DataFrame:
    """The columns that a condition needs besides those that are asked for."""
    return s.cells(s.vectors(), where="value > 0.1 OR dim_0 = 3", columns=["dim_1"])


@query(f"SELECT value FROM ({VECTORS}) WHERE dim_0 = 12")
def project_value(s: Stores) -> DataFrame:
    return doubles(s.cells(s.vectors())).where("dim_0 = 12").select("value")


@query(f"SELECT dim_1 FROM ({VECTORS})")
def project_dim(s: Stores) -> DataFrame:
    return s.cells(s.vectors(), columns=["dim_1"])


@query(f"SELECT count(*) AS n FROM ({VECTORS})")
def count_only(s: Stores) -> DataFrame:
    return s.cells(s.vectors()).agg(F.count("*").alias("n"))


@query(PRICES)
def alias_zarr_cells(s: Stores) -> DataFrame:
    return z.zarr(s.spark, s.prices(), "a", "v2")


@query("SELECT 'groups' AS relation, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'arrays', 1 UNION ALL SELECT 'overview', 1 UNION ALL SELECT 'chunks', count(DISTINCT p_partkey // 300) FROM part")
def sql_metadata_functions(s: Stores) -> DataFrame:
    z.register(s.spark)
    calls = {"groups": "zarr_groups({p})", "arrays": "zarr_arrays({p}, 'v2')", "overview": "zarr({p})", "chunks": "zarr_chunks({p})"}
    return s.spark.sql(" UNION ALL ".join(f"SELECT '{k}' AS relation, count(*) AS n FROM {f}" for k, f in calls.items()).replace("{p}", f"'{s.prices()}'"))


@query(PRICES)
def sql_cells_function(s: Stores) -> DataFrame:
    z.register(s.spark)
    return s.spark.sql("SELECT dim_0, value FROM zarr_cells({path}, 'a', 'auto')".replace("{path}", f"'{s.prices()}'"))


def _by_runs(s: Stores, name: str, n: int, ranges: str = "null", columns: list[str] | None = None) -> DataFrame:
    z.cells_function(s.spark, name, s.vectors(), "a", columns=columns)
    return s.spark.sql(f"SELECT * FROM {name}(TABLE(SELECT /*+ REPARTITION({n}) */ * FROM zarr_runs('{s.vectors()}', 'a', {n}, {ranges})))")


@query(VECTORS)
def sql_runs_function(s: Stores) -> DataFrame:
    """A table function that reads an array in many tasks, as Arrow batches."""
    return doubles(_by_runs(s, "gridframe_vectors", 12))


@query(f"SELECT value FROM ({VECTORS}) WHERE dim_0 BETWEEN 95 AND 120 OR dim_0 = 3")
def sql_runs_function_pruned(s: Stores) -> DataFrame:
    found = _by_runs(s, "gridframe_vector_values", 6, """'{"0": [[95, 120], [3, 3]]}'""", ["value"])
    return doubles(found)


@query(f"SELECT dim_1, count(*) AS n, max(value) AS high FROM ({VECTORS}) WHERE dim_0 < 50 GROUP BY dim_1 UNION ALL SELECT dim_1, count(*), max(value) FROM ({VECTORS}) WHERE dim_0 >= 150 GROUP BY dim_1")
def sql_view_twice(s: Stores) -> DataFrame:
    """A view that a statement reads twice with other filters; each statement prunes for itself."""
    z.cells_view(s.spark, "gridframe_vectors_view", s.vectors(), "a")
    part = "SELECT dim_1, count(*) AS n, CAST(max(value) AS DOUBLE) AS high FROM gridframe_vectors_view WHERE {} GROUP BY dim_1"
    return s.spark.sql(f"{part.format('dim_0 < 50')} UNION ALL {part.format('dim_0 >= 150')}")


@query(f"SELECT count(*) AS n, CAST(round(avg(value), 9) AS DOUBLE) AS mean FROM ({VECTORS})")
def sql_packed_mean(s: Stores) -> DataFrame:
    """SQL over a view of packed cells: no coordinate is made."""
    grids.packed_cells(s.spark, s.vectors(), "a").createOrReplaceTempView("gridframe_packed")
    return s.spark.sql("SELECT count(*) AS n, round(avg(CAST(value AS DOUBLE)), 9) AS mean FROM gridframe_packed")


@query(f"SELECT * FROM ({VECTORS}) WHERE dim_0 = 7 OR dim_1 = 13")
def packed_cells(s: Stores) -> DataFrame:
    return doubles(grids.packed_cells(s.spark, s.vectors(), "a", "dim_0 = 7 OR dim_1 = 13"))


@query("SELECT count(*) AS n, min(value) AS low, max(value) AS high FROM (" + PRICES + ") WHERE dim_0 BETWEEN 250 AND 650")
def sql_view(s: Stores) -> DataFrame:
    z.cells_view(s.spark, "gridframe_prices", s.prices(), "a")
    return s.spark.sql("SELECT count(*) AS n, min(value) AS low, max(value) AS high FROM gridframe_prices WHERE dim_0 BETWEEN 250 AND 650")


# What Spark adds: joins, aggregates, windows, sorts, set operations.


def _order_stores(s: Stores) -> tuple[str, str]:
    n = s.size("orders", "o_orderkey")
    orders = s.table("orders")
    totals = s.v2("totals", (n,), (4096,), "<f8", orders.select(F.col("o_orderkey").alias("dim_0"), F.col("o_totalprice").alias("value")), compressor=GZIP)
    customers = s.v3("customers", (n,), (5000,), "int64", orders.select(F.col("o_orderkey").alias("dim_0"), F.col("o_custkey").cast("long").alias("value")))
    return totals, customers


def _orders(s: Stores) -> tuple[DataFrame, DataFrame]:
    totals, customers = _order_stores(s)
    return s.cells(totals).withColumnRenamed("value", "total"), s.cells(customers).withColumnRenamed("value", "customer")


@query("SELECT o_orderkey AS dim_0, o_totalprice AS total, CAST(o_custkey AS BIGINT) AS customer FROM orders")
def join_coordinates(s: Stores) -> DataFrame:
    totals, customers = _orders(s)
    return totals.join(customers, "dim_0").select("dim_0", "total", "customer")


@query("SELECT o_orderkey AS dim_0, o_totalprice AS total FROM orders WHERE o_custkey < 20")
def join_semi(s: Stores) -> DataFrame:
    totals, customers = _orders(s)
    return totals.join(customers.where("customer < 20"), "dim_0", "left_semi")


@query("SELECT o_orderkey AS dim_0, o_totalprice AS total FROM orders WHERE NOT o_custkey >= 20")
def join_anti(s: Stores) -> DataFrame:
    totals, customers = _orders(s)
    return totals.join(customers.where("customer >= 20"), "dim_0", "left_anti")


def _balances(s: Stores) -> str:
    """c_acctbal as float64 [c_custkey], in chunks that prices' chunks don't fit."""
    cells = s.table("customer").select(F.col("c_custkey").alias("dim_0"), F.col("c_acctbal").alias("value"))
    return s.v3("balances", (s.size("customer", "c_custkey"),), (128,), "float64", cells, codecs_=[w.BYTES, GZIP_V3])


_WHOLE = f"(SELECT dim_0, dim_1, CAST(value AS BIGINT) AS value FROM ({QUANTITIES}))"
BALANCES = "SELECT c_custkey AS dim_0, c_acctbal AS value FROM customer"


def _aligned(how: str, word: str) -> None:
    @query(f"SELECT dim_0, a.value AS price, b.value AS balance FROM ({PRICES}) a {word} JOIN ({BALANCES}) b USING (dim_0)", f"aligned_{how}")
    def run(s: Stores) -> DataFrame:
        """Two arrays of unequal length and unequal chunks, joined inside one scan."""
        return grids.joined_cells(s.spark, {"price": (s.prices(), "a"), "balance": (_balances(s), "a")}, how)


for _how, _word in (("inner", "INNER"), ("left", "LEFT"), ("full", "FULL")):
    _aligned(_how, _word)


@query("SELECT o_orderkey AS dim_0, o_totalprice AS total, CAST(o_custkey AS BIGINT) AS customer FROM orders")
def aligned_orders(s: Stores) -> DataFrame:
    """join_coordinates without an exchange."""
    totals, customers = _order_stores(s)
    return grids.joined_cells(s.spark, {"total": (totals, "a"), "customer": (customers, "a")})


@query("SELECT o_orderkey AS dim_0, o_totalprice AS total, CAST(o_custkey AS BIGINT) AS customer FROM orders WHERE o_orderkey < 100 OR o_orderkey > 5000 AND o_custkey < 30")
def aligned_pruned(s: Stores) -> DataFrame:
    totals, customers = _order_stores(s)
    return grids.joined_cells(s.spark, {"total": (totals, "a"), "customer": (customers, "a")}, where="dim_0 < 100 OR dim_0 > 5000 AND customer < 30")


def _labels(s: Stores) -> dict[str, tuple[int, str, str]]:
    """The suppliers' balances along dim_0, and how many lines have each number along dim_1."""
    suppliers = s.table("supplier").select(F.col("s_suppkey").alias("dim_0"), F.col("s_acctbal").alias("value"))
    balances = s.v2("supplier_balances", (s.size("supplier", "s_suppkey"),), (24,), "<f8", suppliers)
    lines = s.table("lineitem").groupBy((F.col("l_linenumber") - 1).cast("long").alias("dim_0")).agg(F.count("*").alias("value"))
    return {"balance": (0, balances, "a"), "lines": (1, s.v2("line_counts", (7,), (3,), "<i8", lines), "a")}


_LABELLED = f"SELECT q.dim_0, q.dim_1, q.value, s_acctbal AS balance, n AS lines FROM {_WHOLE} q JOIN supplier ON s_suppkey = q.dim_0 JOIN (SELECT l_linenumber - 1 AS line, count(*) AS n FROM lineitem GROUP BY 1) ON line = q.dim_1"


@query(_LABELLED)
def labelled_cells(s: Stores) -> DataFrame:
    """Cells with the values of two arrays that belong to their dimensions, in one scan."""
    return grids.labelled_cells(s.spark, _quantities_i8(s), "a", _labels(s))


@query(f"SELECT * FROM ({_LABELLED}) WHERE balance > 6000 AND (lines < 5000 OR value > 50)")
def labelled_cells_pruned(s: Stores) -> DataFrame:
    """A condition on a label decides which chunks are opened."""
    return grids.labelled_cells(s.spark, _quantities_i8(s), "a", _labels(s), "balance > 6000 AND (lines < 5000 OR value > 50)")


def _corrected(s: Stores) -> str:
    """The quantities with those of one supplier in sixteen doubled."""
    cells = s.quantities().withColumn("value", F.when(F.col("dim_0") % 16 == 5, F.col("value") * 2).otherwise(F.col("value")))
    return s.v2("quantity_corrected", s.quantity_shape(), (16, 4), "<i8", cells)


@query(f"SELECT dim_0, dim_1, value AS old, 2 * value AS new FROM {_WHOLE} WHERE dim_0 % 16 = 5 AND value <> 0")
def diff_of_versions(s: Stores) -> DataFrame:
    """Cells that differ between two versions of an array; chunks of equal bytes aren't decoded."""
    return grids.changed_cells(s.spark, (_quantities_i8(s), "a"), (_corrected(s), "a"))


@query(f"SELECT coalesce(a.dim_0, b.dim_0) AS dim_0, a.value AS old, b.value AS new FROM ({PRICES}) a FULL JOIN ({BALANCES}) b ON a.dim_0 = b.dim_0 WHERE a.value IS DISTINCT FROM b.value")
def diff_of_unlike_arrays(s: Stores) -> DataFrame:
    return grids.changed_cells(s.spark, (s.prices(), "a"), (_balances(s), "a"))


def _coarse(s: Stores, width: int) -> str:
    cells = s.quantities().groupBy(F.floor(F.col("dim_0") / width).alias("dim_0"), "dim_1").agg(F.sum("value").alias("value"))
    return s.v2(f"quantity_coarse_{width}", (-(-s.quantity_shape()[0] // width), 7), (16, 7), "<i8", cells)


_COARSE = "SELECT '{0}' AS level, dim_0 // {0} AS dim_0, dim_1, CAST(sum(value) AS BIGINT) AS value FROM {1} GROUP BY ALL"


def _levels(s: Stores) -> dict[str, tuple[str, str]]:
    return {"1": (_quantities_i8(s), "a")} | {str(n): (_coarse(s, n), "a") for n in (2, 10)}


@query(" UNION ALL ".join(_COARSE.format(n, _WHOLE) for n in (1, 2, 10)))
def stacked_levels(s: Stores) -> DataFrame:
    """Three resolutions of an array as one relation, in one job."""
    return grids.stacked_cells(s.spark, _levels(s))


@query("SELECT * FROM (" + " UNION ALL ".join(_COARSE.format(n, _WHOLE) for n in (1, 2, 10)) + ") WHERE dim_1 = 3 OR dim_0 = 4 AND level <> '2'")
def stacked_levels_pruned(s: Stores) -> DataFrame:
    return grids.stacked_cells(s.spark, _levels(s), "dim_1 = 3 OR dim_0 = 4 AND level <> '2'")


@query("SELECT l_orderkey, l_linenumber, l_suppkey AS dim_0, l_linenumber - 1 AS dim_1, CAST(q AS BIGINT) AS quantity FROM lineitem JOIN (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) USING (l_suppkey, l_linenumber)")
def lookup_of_lines(s: Stores) -> DataFrame:
    """Every line item with its supplier's cell: the keys go to the chunks, no cell is exchanged."""
    keys = s.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("long").alias("dim_0"), (F.col("l_linenumber") - 1).cast("long").alias("dim_1"))
    return grids.cells_at(s.spark, _quantities_i8(s), "a", keys, value="quantity")


@query(f"SELECT e.event_id, e.user_id AS dim_0, p.value AS price FROM events e LEFT JOIN ({PRICES}) p ON e.user_id = p.dim_0")
def lookup_of_events(s: Stores) -> DataFrame:
    """Events by user, a few users with many; users beyond the array keep a null."""
    return grids.cells_at(s.spark, s.prices(), "a", s.table("events").select("event_id", F.col("user_id").alias("dim_0")), "left", value="price")


@query(f"SELECT p_partkey // 300 AS chunk, count(*) AS n, CAST(max(p_retailprice) AS DOUBLE) AS high FROM part GROUP BY 1")
def join_chunks(s: Stores) -> DataFrame:
    chunks = z.zarr_chunks(s.spark, s.prices()).select(F.col("chunk_coords")[0].alias("chunk"))
    cells = s.cells(s.prices()).withColumn("chunk", F.floor(F.col("dim_0") / 300))
    return cells.join(chunks, "chunk").groupBy("chunk").agg(F.count("*").alias("n"), F.max("value").alias("high"))


def _quantities_i8(s: Stores) -> str:
    return s.v2("quantity_i8", s.quantity_shape(), (16, 4), "<i8", s.quantities())


def _quantity_cells(s: Stores) -> DataFrame:
    return s.cells(_quantities_i8(s))


@query(f"SELECT dim_1, CAST(sum(value) AS BIGINT) AS total, min(value) AS low, max(value) AS high, count(*) AS n FROM {_WHOLE} GROUP BY dim_1")
def agg_by_dimension(s: Stores) -> DataFrame:
    return _quantity_cells(s).groupBy("dim_1").agg(F.sum("value").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))


@query(f"SELECT dim_0 // 10 AS block, dim_1, count(*) AS n, CAST(sum(value) AS BIGINT) AS total, min(value) AS low, max(value) AS high FROM {_WHOLE} GROUP BY ALL")
def scan_agg_blocks(s: Stores) -> DataFrame:
    """Partial results of each chunk leave the scan, no cells."""
    return grids.aggregated(s.spark, _quantities_i8(s), "a", {"block": (0, 10), "dim_1": (1, 1)})


@query(f"SELECT dim_1, count(*) AS n, CAST(sum(value) AS BIGINT) AS total, min(value) AS low, max(value) AS high FROM {_WHOLE} WHERE dim_0 < 30 OR dim_0 >= 60 AND dim_1 <> 2 GROUP BY dim_1")
def scan_agg_filtered(s: Stores) -> DataFrame:
    return grids.aggregated(s.spark, _quantities_i8(s), "a", {"dim_1": (1, 1)}, "dim_0 < 30 OR dim_0 >= 60 AND dim_1 <> 2")


@query(f"SELECT count(*) AS n, round(CAST(sum(value) AS DOUBLE), 6) AS total, CAST(min(value) AS DOUBLE) AS low, CAST(max(value) AS DOUBLE) AS high FROM ({VECTORS})")
def scan_agg_whole(s: Stores) -> DataFrame:
    found = grids.aggregated(s.spark, s.vectors(), "a")
    return found.select("n", F.round("total", 6).alias("total"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))


@query(f"SELECT count(*) AS n, round(CAST(sum(value) AS DOUBLE), 6) AS total FROM {_WHOLE}")
def scan_agg_shards(s: Stores) -> DataFrame:
    """Large sums over a sharded array."""
    return grids.aggregated(s.spark, _sharded(s, "shuffle"), "a").select("n", F.round("total", 6).alias("total"))


@query("SELECT (max(doc_id) + 1) AS n FROM documents UNION ALL SELECT count(*) FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS d) WHERE d // 4 IN (SELECT doc_id // 4 FROM labels)")
def count_cells(s: Stores) -> DataFrame:
    """Counts from metadata, and from the listing where missing chunks have no cells."""
    return grids.cell_count(s.spark, _quality(s, True), "a").unionByName(grids.cell_count(s.spark, _quality(s, False), "a"))


@query(f"SELECT dim_0 // 10 AS block, dim_1, CAST(sum(value) AS BIGINT) AS total FROM {_WHOLE} GROUP BY ROLLUP (dim_0 // 10, dim_1)")
def agg_rollup(s: Stores) -> DataFrame:
    return _quantity_cells(s).withColumn("block", F.floor(F.col("dim_0") / 10)).rollup("block", "dim_1").agg(F.sum("value").alias("total"))


@query(f"SELECT dim_0 // 10 AS block, dim_1, CAST(sum(value) AS BIGINT) AS total FROM {_WHOLE} GROUP BY CUBE (dim_0 // 10, dim_1)")
def agg_cube(s: Stores) -> DataFrame:
    return _quantity_cells(s).withColumn("block", F.floor(F.col("dim_0") / 10)).cube("block", "dim_1").agg(F.sum("value").alias("total"))


@query(f"SELECT DISTINCT value % 10 AS digit FROM {_WHOLE}")
def distinct_values(s: Stores) -> DataFrame:
    return _quantity_cells(s).select((F.col("value") % 10).alias("digit")).distinct()


@query(f"SELECT dim_0, dim_1, CAST(sum(value) OVER w AS BIGINT) AS around, value - lag(value) OVER (PARTITION BY dim_1 ORDER BY dim_0) AS step FROM {_WHOLE} WINDOW w AS (PARTITION BY dim_1 ORDER BY dim_0 ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)")
def window_moving_sum(s: Stores) -> DataFrame:
    """Along dim_0, from the cells beyond a chunk's borders: nothing is exchanged."""
    found = grids.neighbours(s.spark, _quantities_i8(s), "a", 0, shifted={"before": -1}, sums={"around": (1, 1)})
    return found.select("dim_0", "dim_1", "around", (F.col("value") - F.col("before")).alias("step"))


@query(f"SELECT dim_0, dim_1, value, min(value) OVER (PARTITION BY dim_0 ORDER BY dim_1 ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS low, max(value) OVER (PARTITION BY dim_0 ORDER BY dim_1 ROWS BETWEEN 3 PRECEDING AND 30 FOLLOWING) AS high, lead(value, 5) OVER (PARTITION BY dim_0 ORDER BY dim_1) AS later FROM ({VECTORS})")
def window_extremes(s: Stores) -> DataFrame:
    """Along dim_1, in windows that are wider than a chunk."""
    found = grids.neighbours(s.spark, s.vectors(), "a", 1, shifted={"later": 5}, lows={"low": (20, 0)}, highs={"high": (3, 30)})
    return found.select("dim_0", "dim_1", *(F.col(c).cast("double").alias(c) for c in ("value", "low", "high", "later")))


@query(f"SELECT a.dim_0, a.dim_1, a.value, b.value AS below, c.value AS across, 4 * a.value - coalesce(b.value, 0) - coalesce(u.value, 0) - coalesce(l.value, 0) - coalesce(r.value, 0) AS laplace FROM {_WHOLE} a LEFT JOIN {_WHOLE} b ON b.dim_0 = a.dim_0 + 1 AND b.dim_1 = a.dim_1 LEFT JOIN {_WHOLE} u ON u.dim_0 = a.dim_0 - 1 AND u.dim_1 = a.dim_1 LEFT JOIN {_WHOLE} l ON l.dim_0 = a.dim_0 AND l.dim_1 = a.dim_1 - 1 LEFT JOIN {_WHOLE} r ON r.dim_0 = a.dim_0 AND r.dim_1 = a.dim_1 + 1 LEFT JOIN {_WHOLE} c ON c.dim_0 = a.dim_0 - 2 AND c.dim_1 = a.dim_1 + 3")
def window_stencil(s: Stores) -> DataFrame:
    """Neighbours along both dimensions: four self joins in SQL, one scan here."""
    found = grids.neighbours(s.spark, _quantities_i8(s), "a", 0, shifted={"below": 1, "above": -1, "left": (0, -1), "right": (0, 1), "across": (-2, 3)})
    around = sum((F.coalesce(c, F.lit(0)) for c in ("below", "above", "left", "right")), F.lit(0))
    return found.select("dim_0", "dim_1", "value", "below", "across", (4 * F.col("value") - around).alias("laplace"))


@query(f"SELECT dim_0, dim_1, rank() OVER (PARTITION BY dim_1 ORDER BY value DESC) AS place, row_number() OVER (PARTITION BY dim_1 ORDER BY value DESC, dim_0) AS row FROM {_WHOLE}")
def window_rank(s: Stores) -> DataFrame:
    """Seven groups that grow with the array: ranked by ranges, none is in one task."""
    ranked = ranks.ranked(_quantity_cells(s), ["dim_1"], "value", True, ["dim_0"], "place")
    return ranked.select("dim_0", "dim_1", "place", "row")


@query(f"SELECT dim_0, dim_1, value, rank() OVER (ORDER BY value) AS place FROM (SELECT dim_0, dim_1, value % 5 AS value FROM {_WHOLE})")
def rank_of_ties(s: Stores) -> DataFrame:
    """One group and few values: each of them is shared by many ranges."""
    return ranks.ranked(_quantity_cells(s).withColumn("value", F.col("value") % 5), [], "value", ties=["dim_0", "dim_1"], rank="place").drop("row")


@query(f"SELECT * FROM ({VECTORS}) ORDER BY value DESC, dim_0, dim_1 LIMIT 10")
def topk_values(s: Stores) -> DataFrame:
    return doubles(s.cells(s.vectors())).orderBy(F.desc("value"), "dim_0", "dim_1").limit(10)


def _digits(cells: DataFrame) -> DataFrame:
    return cells.select((F.col("dim_0") % 50).alias("key"), (F.floor("value") % 10).alias("digit"))


def _two(s: Stores) -> tuple[DataFrame, DataFrame]:
    return _digits(s.cells(s.prices())), _digits(s.cells(_balances(s)))


_DIGITS = "SELECT dim_0 % 50 AS key, CAST(floor(value) AS BIGINT) % 10 AS digit FROM ({})"


@query(f"{_DIGITS.format(PRICES)} UNION ALL {_DIGITS.format(BALANCES)}")
def set_union(s: Stores) -> DataFrame:
    a, b = _two(s)
    return a.unionByName(b)


@query(f"{_DIGITS.format(PRICES)} INTERSECT {_DIGITS.format(BALANCES)}")
def set_intersect(s: Stores) -> DataFrame:
    a, b = _two(s)
    return a.intersect(b)


@query(f"{_DIGITS.format(PRICES)} EXCEPT ALL {_DIGITS.format(BALANCES)}")
def set_except(s: Stores) -> DataFrame:
    a, b = _two(s)
    return a.exceptAll(b)


@query(f"SELECT a.dim_0, a.value AS value, b.value AS other FROM ({PRICES}) a JOIN ({PRICES}) b ON b.dim_0 = a.dim_0 + 60")
def self_join(s: Stores) -> DataFrame:
    """One relation scanned twice with different filters."""
    cells = s.cells(s.prices())
    high = cells.where("dim_0 >= 60").select((F.col("dim_0") - 60).alias("dim_0"), F.col("value").alias("other"))
    return cells.join(high, "dim_0")


_LINE = f"SELECT dim_0, dim_1, value, row_number() OVER w AS n, dense_rank() OVER (PARTITION BY dim_0 ORDER BY value) AS dense, ntile(3) OVER w AS third, round(percent_rank() OVER (PARTITION BY dim_0 ORDER BY value), 9) AS share, round(cume_dist() OVER (PARTITION BY dim_0 ORDER BY value), 9) AS upto, lead(value, 2, -1) OVER w AS ahead, first(value) OVER f AS head, last(value) OVER f AS tail, nth_value(value, 2) OVER f AS second, CAST(sum(value) OVER (PARTITION BY dim_0 ORDER BY dim_1 RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent FROM {_WHOLE} WINDOW w AS (PARTITION BY dim_0 ORDER BY dim_1), f AS (PARTITION BY dim_0 ORDER BY dim_1 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


@query(_LINE)
def window_functions(s: Stores) -> DataFrame:
    """Windows over the lines of one supplier, of which there are seven."""
    own = Window.partitionBy("dim_0")
    along, ranked = own.orderBy("dim_1"), own.orderBy("value")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = F.col("value")
    return _quantity_cells(s).select(
        "dim_0", "dim_1", "value", F.row_number().over(along).cast("long").alias("n"), F.dense_rank().over(ranked).cast("long").alias("dense"), F.ntile(3).over(along).cast("long").alias("third"), F.round(F.percent_rank().over(ranked), 9).alias("share"), F.round(F.cume_dist().over(ranked), 9).alias("upto"),
        F.lead("value", 2, -1).over(along).alias("ahead"), F.first(v).over(whole).alias("head"), F.last(v).over(whole).alias("tail"), F.nth_value("value", 2).over(whole).alias("second"), F.sum(v).over(along.rangeBetween(-2, 0)).alias("recent"),
    )


@query(f"SELECT dim_1, count(DISTINCT value) AS kinds, round(stddev_samp(value), 6) AS spread, round(var_pop(value), 6) AS variance, quantile_cont(value, 0.5) AS middle, round(avg(value), 6) AS mean, count(*) FILTER (WHERE value > 100) AS large FROM {_WHOLE} GROUP BY dim_1")
def agg_statistics(s: Stores) -> DataFrame:
    v = F.col("value")
    return _quantity_cells(s).groupBy("dim_1").agg(F.count_distinct(v).alias("kinds"), F.round(F.stddev_samp(v), 6).alias("spread"), F.round(F.var_pop(v), 6).alias("variance"), F.percentile(v, 0.5).alias("middle"), F.round(F.avg(v), 6).alias("mean"), F.count_if(v > 100).alias("large"))


@query(f"SELECT dim_0 // 10 AS block, dim_1, CAST(sum(value) AS BIGINT) AS total FROM {_WHOLE} GROUP BY GROUPING SETS ((dim_0 // 10), (dim_1), ())")
def agg_grouping_sets(s: Stores) -> DataFrame:
    block = F.floor(F.col("dim_0") / 10).alias("block")
    cells = _quantity_cells(s).select(block, "dim_1", "value")
    return cells.groupingSets([["block"], ["dim_1"], []], "block", "dim_1").agg(F.sum("value").alias("total"))


@query(f"SELECT a.dim_0, a.dim_1, a.value AS quantity, b.value AS twice FROM {_WHOLE} a JOIN (SELECT dim_0, dim_1, 2 * value AS value FROM {_WHOLE}) b USING (dim_0, dim_1)")
def join_two_dimensions(s: Stores) -> DataFrame:
    doubled = s.cells(s.v3("quantity_twice", s.quantity_shape(), (32, 7), "int64", s.quantities().withColumn("value", F.col("value") * 2), codecs_=[w.BYTES, GZIP_V3]))
    return _quantity_cells(s).withColumnRenamed("value", "quantity").join(doubled.withColumnRenamed("value", "twice"), ["dim_0", "dim_1"])


def _joined(how: str, word: str) -> None:
    @query(f"SELECT dim_0, a.value AS low, b.value AS high FROM ({PRICES}) a {word} JOIN ({BALANCES}) b USING (dim_0)", f"join_{how}")
    def run(s: Stores) -> DataFrame:
        low, high = s.cells(s.prices()).withColumnRenamed("value", "low"), s.cells(_balances(s)).withColumnRenamed("value", "high")
        return low.join(high, "dim_0", how).select("dim_0", "low", "high")


for _how, _word in (("left", "LEFT"), ("right", "RIGHT"), ("full", "FULL")):
    _joined(_how, _word)


@query(f"SELECT a.dim_0 AS dim_0, count(*) AS dearer FROM ({PRICES}) a JOIN ({BALANCES}) b ON b.value > a.value GROUP BY a.dim_0")
def join_theta(s: Stores) -> DataFrame:
    """For each price how many balances are larger, an unequal join of all with all: by their places in one order and in their own, no pair is made."""
    prices = s.cells(s.prices()).select("dim_0", "value", F.lit(1).alias("kind"))
    balances = s.cells(_balances(s)).select("dim_0", "value", F.lit(0).alias("kind"))
    n = grids.cell_count(s.spark, _balances(s), "a").first()["n"]
    among = ranks.ranked(prices.unionByName(balances), [], "value", ties=["kind", "dim_0"], rank="all_rank", row="all_row").where("kind = 1")
    own = ranks.ranked(among.drop("all_rank"), [], "value", ties=["dim_0"], rank="own_rank", row="own_row")
    return own.select("dim_0", (n - (F.col("all_row") - F.col("own_row"))).alias("dearer")).where("dearer > 0")


@query(f"SELECT a.dim_0 AS dim_0, count(*) AS n, CAST(max(b.value) AS DOUBLE) AS high FROM ({PRICES}) a JOIN ({PRICES}) b ON b.dim_0 BETWEEN a.dim_0 - 5 AND a.dim_0 + 5 GROUP BY a.dim_0")
def join_range(s: Stores) -> DataFrame:
    """Cells with those at most five places away. Both are cut into blocks of 64, so that the join has equal keys."""
    cells = s.cells(s.prices())
    block = F.floor(F.col("dim_0") / 64)
    left = cells.select(F.col("dim_0").alias("at"), block.alias("block"))
    right = cells.select("dim_0", "value", F.explode(F.array_distinct(F.array(*(F.floor((F.col("dim_0") + k) / 64) for k in (-5, 5))))).alias("block"))
    near = left.join(right, (left["block"] == right["block"]) & F.col("dim_0").between(F.col("at") - 5, F.col("at") + 5))
    return near.groupBy(F.col("at").alias("dim_0")).agg(F.count("*").alias("n"), F.max("value").alias("high"))


@query(f"SELECT dim_0, dim_1, value, row_number() OVER (ORDER BY value DESC, dim_0, dim_1) AS place FROM ({VECTORS}) QUALIFY place BETWEEN 21 AND 40")
def order_with_offset(s: Stores) -> DataFrame:
    page = doubles(s.cells(s.vectors())).orderBy(F.desc("value"), "dim_0", "dim_1").limit(40).offset(20)
    return page.withColumn("place", F.row_number().over(Window.orderBy(F.desc("value"), "dim_0", "dim_1")).cast("long") + 20)


@query(f"SELECT dim_0, value, row_number() OVER (ORDER BY value DESC, dim_0) AS place FROM ({PRICES})")
def order_by_value(s: Stores) -> DataFrame:
    """All cells in order, each with its place in it."""
    return ranks.ranked(s.cells(s.prices()), [], "value", True, ["dim_0"], row="place").drop("rank").orderBy("place")


@query(f"SELECT DISTINCT value % 1000 AS rest FROM {_WHOLE} WHERE dim_1 = 0 EXCEPT SELECT value % 1000 FROM {_WHOLE} WHERE dim_1 = 6")
def set_subtract(s: Stores) -> DataFrame:
    rest = (F.col("value") % 1000).alias("rest")
    return _quantity_cells(s).where("dim_1 = 0").select(rest).subtract(_quantity_cells(s).where("dim_1 = 6").select(rest))


@query(f"SELECT value % 10 AS digit FROM {_WHOLE} WHERE dim_1 = 0 INTERSECT ALL SELECT value % 10 FROM {_WHOLE} WHERE dim_1 = 1")
def set_intersect_all(s: Stores) -> DataFrame:
    digit = (F.col("value") % 10).alias("digit")
    return _quantity_cells(s).where("dim_1 = 0").select(digit).intersectAll(_quantity_cells(s).where("dim_1 = 1").select(digit))


@query(f"SELECT * FROM (VALUES ('inner/vectors', 2, 64 * {_VECS}, CAST(64 AS BIGINT), CAST(NULL AS VARCHAR), 'nested'), ('prices', 1, {_PARTS}, {_PARTS}, 'gzip', 'top')) t(array_path, sizes, n_cells, last_size, codec, level)")
def metadata_functions(s: Stores) -> DataFrame:
    arrays = z.zarr_arrays(s.spark, _overview(s))
    cells = F.aggregate("shape", F.lit(1).cast("long"), lambda x, y: x * y)
    level = F.when(F.col("array_path").like("%/%"), "nested").otherwise("top")
    return arrays.select("array_path", F.size("shape").alias("sizes"), cells.alias("n_cells"), F.element_at("shape", -1).alias("last_size"), F.get_json_object(F.nullif("compressor", F.lit("")), "$.id").alias("codec"), level.alias("level"))


@query(f"SELECT * FROM ({VECTORS}) WHERE dim_0 + dim_1 = 70 AND NOT dim_0 IN (8, 9) AND CAST(dim_0 AS VARCHAR) LIKE '%1%' AND CASE WHEN dim_1 < 20 THEN value > 0 ELSE true END")
def filter_not_pushed(s: Stores) -> DataFrame:
    """Arithmetic, NOT IN, LIKE and CASE: kinds that the source leaves to Spark."""
    return doubles(s.cells(s.vectors())).where("dim_0 + dim_1 = 70 AND NOT dim_0 IN (8, 9) AND CAST(dim_0 AS STRING) LIKE '%1%' AND CASE WHEN dim_1 < 20 THEN value > 0 ELSE true END")


@query("SELECT 'packed/' || n_name AS array_path, 'zstd' AS codec FROM nation")
def arrays_listed_unreadable(s: Stores) -> DataFrame:
    """Arrays of a codec that can't be read, one for each nation: they are listed all the same."""

    def make(path: str) -> None:
        w.v3_group(path)
        for r in s.table("nation").select("n_name").toLocalIterator():
            w.v3_array(path, f"packed/{r[0]}", (4,), (2,), "int32", [w.BYTES, {"name": "zstd"}])

    return z.zarr_arrays(s.spark, s.once("refused", make)).select("array_path", F.get_json_object("compressor", "$.name").alias("codec"))


@query("SELECT p_partkey AS dim_0, p_retailprice AS value FROM part")
def path_with_slashes(s: Stores) -> DataFrame:
    return z.zarr_cells(s.spark, s.prices() + "/", "/a/")


def flagship(s: Stores) -> DataFrame:
    """Mean of each dimension of the embeddings, from the array store."""
    return s.cells(s.vectors()).groupBy("dim_1").agg(F.count("*").alias("n"), F.avg(F.col("value").cast("double")).alias("mean"))
