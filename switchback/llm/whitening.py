"""Embedding whitening by MLlib block matrices.

Centred rows are cut into blocks of a distributed matrix A, written as Parquet
and read by MLlib as matrices. The scatter matrix is A transposed times A, its
eigenvectors are found on the driver (it has one row a dimension), and A times
the whitening matrix projects the rows. Products are joins and sums of blocks
on executors; the driver holds the numbers of the blocks, not their rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchback.session import cut_lineage, table_path

#: Values become whole numbers of this fraction of one.
SCALE = 256
COMPONENTS = 4
#: Rows of a block, fewer where it would have more than so many values. The driver holds one pair of numbers a block.
BLOCK_ROWS, BLOCK_VALUES = 4096, 1 << 18
#: Blocks that meet in one task of a product.
BLOCKS_A_TASK = 4
#: An eigenvalue below this share of the largest one is none: the vectors have fewer dimensions than entries.
LEAST_SHARE = 1e-12
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) as long; null for a null vector and for one with a null or non-finite entry."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda v: F.floor(v * scale).cast("long")))


def _centred_blocks(rows: DataFrame, n: int, sums: list[int], block_rows: int, carry: list[str]) -> DataFrame:
    """Blocks of x - sums / n, a row a block: the task and its block, how many rows are rows, the values by row, ``carry`` columns and deviations.

    A task's last block is filled with rows of zeros, which add nothing to a scatter matrix.
    """
    dims = len(sums)
    mean = np.array([s / n for s in sums], np.float64)
    total = np.array(sums, object)
    types = {f.name: f.dataType for f in rows.schema.fields}
    kept = T.StructType([T.StructField(c, T.ArrayType(types[c])) for c in carry])

    def deviations(x: np.ndarray) -> list[int | None]:
        most = float(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
        if dims * most * most < 2.0**62:
            return ((n * x - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((n * x.astype(object) - total) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, waiting = TaskContext.get().partitionId(), 0, None

        def made(part: pa.Table, block: int) -> pa.RecordBatch:
            x = part.column("x").combine_chunks()
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
            values = np.zeros((block_rows, dims))
            np.subtract(x, mean, out=values[: part.num_rows])
            columns = [
                pa.array([task], pa.int64()), pa.array([block], pa.int64()), pa.array([part.num_rows], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, block_rows * dims], pa.int32()), pa.array(values.ravel())),
            ]
            for c in carry:
                own = part.column(c).combine_chunks()
                columns.append(pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), own))
            if carry:
                columns.append(pa.array([deviations(x)], pa.list_(pa.int64())))
            names = ["task", "block", "filled", "values", *carry, *(["deviation"] if carry else [])]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            more = pa.Table.from_batches([batch])
            waiting = more if waiting is None else pa.concat_tables([waiting, more])
            while waiting.num_rows >= block_rows:
                yield made(waiting.slice(0, block_rows), block)
                waiting, block = waiting.slice(block_rows), block + 1
        if waiting is not None and waiting.num_rows:
            yield made(waiting, block)

    schema = "task long, block long, filled int, values array<double>" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return rows.select("x", *carry).mapInArrow(run, schema + (", deviation array<long>" if carry else ""))


def _as_matrix(values: Column, rows: int, dims: int) -> Column:
    """A dense matrix by row, as MLlib's type lies in Parquet."""
    null = F.lit(None)
    return F.struct(
        F.lit(1).cast("tinyint").alias("type"), F.lit(rows).alias("numRows"), F.lit(dims).alias("numCols"),
        null.cast("array<int>").alias("colPtrs"), null.cast("array<int>").alias("rowIndices"), values.alias("values"), F.lit(True).alias("isTransposed"),
    )


class Blocks:
    """A distributed matrix of centred rows, read from a Parquet table with a block a row."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int], block_rows: int = BLOCK_ROWS, carry: tuple[str, ...] = ()):
        self.spark, self.dims = rows.sparkSession, len(sums)
        self.block_rows = max(1, min(block_rows, BLOCK_VALUES // self.dims))
        made = _centred_blocks(rows, n, sums, self.block_rows, list(carry))
        made = made.withColumn("matrix", _as_matrix(F.col("values"), self.block_rows, self.dims)).drop("values")
        self.schema, self.path = made.schema, table_path(self.spark)
        made.write.parquet(self.path)
        # numbered without gaps: a task's blocks come after those of the tasks before
        per_task = self._read(made.schema).groupBy("task").agg(F.count("*").alias("n")).collect()
        self.before, self.count = [], 0
        for r in sorted(per_task):
            self.before.append((r["task"], self.count))
            self.count += r["n"]

    def _read(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)

    def _numbered(self, table: DataFrame) -> DataFrame:
        """With ``i``, the block's number; one row a task is broadcast."""
        before = self.spark.createDataFrame(self.before, "task long, before long")
        return table.join(F.broadcast(before), "task").withColumn("i", F.col("before") + F.col("block")).drop("task", "block", "before")

    def matrix(self) -> BlockMatrix:
        schema = T.StructType([self.schema["task"], self.schema["block"], T.StructField("matrix", MatrixUDT())])
        at = F.struct("i", F.lit(0).cast("long").alias("j"))
        blocks = self._numbered(self._read(schema)).select(at.alias("at"), "matrix")
        made = callMLlibFunc("createBlockMatrix", blocks, self.block_rows, self.dims, self.count * self.block_rows, self.dims)
        return BlockMatrix(made, self.block_rows, self.dims)

    def beside(self) -> DataFrame:
        """``i`` and the carried columns, a row a block."""
        return self._numbered(self._read(self.schema).drop("matrix"))


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product, its sums over the inner dimension dealt to so many tasks before they are added."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(a: BlockMatrix) -> np.ndarray:
    """A transposed times A: one small block, summed over tasks of a few blocks each."""
    return times(a.transpose(), a, -(-a.numRowBlocks // BLOCKS_A_TASK)).toLocalMatrix().toArray()


def projected(blocks: Blocks, by: BlockMatrix) -> DataFrame:
    """``i, matrix``: the blocks of A times ``by``, written by MLlib's type and read as plain structs."""
    made = callMLlibFunc("getMatrixBlocks", times(blocks.matrix(), by)._java_matrix_wrapper._java_model)
    made = made.select(F.col(f"`{made.columns[0]}`").alias("at"), F.col(f"`{made.columns[1]}`").alias("matrix"))
    path = table_path(blocks.spark)
    made.write.parquet(path)
    plain = T.StructType([made.schema["at"], T.StructField("matrix", MatrixUDT.sqlType())])
    table = blocks.spark.read.schema(plain).parquet(path)
    return table.select(F.col("at").getField(made.schema["at"].dataType.names[0]).cast("long").alias("i"), "matrix")


def whitening_matrix(scatter_matrix: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors over the roots of their eigenvalues, a column each by falling eigenvalue, and the shares of the trace."""
    values, vectors = np.linalg.eigh(scatter_matrix / n)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > LEAST_SHARE * max(float(values[-1]), 0.0)]
    return vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(scatter_matrix / n)


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id`` and RESULT, a row for each usable row of ``rows`` and component.

    Entries become whole numbers x = floor(scale * entry). Mean, covariance
    (divisor n) and eigenvectors are those of the distinct x-vectors, so copies
    don't count; ``identity_error`` is how far the covariance of their whitened
    rows is from the identity. Dropped are null vectors, those with null or
    non-finite entries, empty ones, and those of another length than most rows
    have (of equally frequent lengths the larger). There are at most as many
    components as dimensions in which the vectors differ, so none for an empty
    table or equal rows: the result is empty then. Rows may repeat and ids be
    null; other columns are not looked at, whatever their names. A deviation
    beyond 64 bits is null.
    """
    spark = rows.sparkSession
    usable = rows.select(F.col(f"`{id_column}`").alias("vec_id"), whole_numbers(F.col(f"`{vector}`"), scale).alias("x")).filter(F.size("x") > 0)
    lengths = usable.groupBy(F.size("x").alias("k")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("k")).first()
    empty = spark.createDataFrame([], f"vec_id {rows.schema[id_column].dataType.simpleString()}, {RESULT}")
    if most is None:
        return empty
    usable = usable.filter(F.size("x") == most["k"])
    fit = cut_lineage(usable.select("x").distinct())
    n = fit.count()
    sums = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(sums)]

    fit_blocks = Blocks(fit, n, sums, block_rows)
    a = fit_blocks.matrix()
    by, shares = whitening_matrix(scatter(a), n, components)
    width = by.shape[1]
    if not width:
        return empty
    # one block of the height of A's blocks is one of its dimensions
    local = DenseMatrix(len(sums), width, by.ravel(order="F"))
    by_blocks = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), len(sums), width)
    cover = scatter(times(a, by_blocks)) / n
    error = float(np.abs(cover - np.eye(width)).max())

    all_blocks = Blocks(usable, n, sums, block_rows, carry=("vec_id",))
    values = F.col("matrix.values")
    by_row = F.col("matrix.isTransposed")
    column = lambda c: F.when(by_row, F.filter(values, lambda _, p: p % width == c)).otherwise(
        F.slice(values, c * all_blocks.block_rows + 1, all_blocks.block_rows)
    )
    both = all_blocks.beside().join(projected(all_blocks, by_blocks), "i")
    columns = [F.slice(column(c), F.lit(1), F.col("filled")).alias(f"z{c}") for c in range(width)]
    each = both.select(F.explode(F.arrays_zip("vec_id", "deviation", *columns)).alias("r"))
    parts = [F.struct(F.lit(c + 1).alias("component"), F.col(f"r.z{c}").alias("whitened"), F.lit(float(shares[c])).alias("explained")) for c in range(width)]
    each = each.select(F.col("r.vec_id").alias("vec_id"), F.col("r.deviation").alias("deviation"), F.explode(F.array(*parts)).alias("p"))
    return each.select(
        "vec_id", "p.component", F.lit(n).cast("long").alias("n"), "deviation", "p.whitened", "p.explained", F.lit(error).alias("identity_error")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
