"""Rows of feature vectors as sparse blocks, and sums over them.

``sparse_blocks`` turns a vector column into one row per block of some
thousand vectors (compressed rows in binary columns) that is persisted once
and read by every pass of a learner.  ``fold`` sends a state to the tasks,
folds each task's blocks into one array and adds the arrays up by chunks: the
sum of a chunk is a grouped job, in several levels when there are many tasks,
until few partial arrays (bounded in number and bytes) are left for the driver.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Numbers in a chunk of a partial array, and partial arrays added up in one group.
CHUNK, FAN_IN = 1 << 15, 32
#: Bytes of partial arrays that the driver adds up itself.
DRIVER_BYTES = 64 << 20
#: Columns up to which a product goes row by row, a transposed one column by column.
FEW = 16
#: Non-zeros of a transposed product taken at a time, so that its arrays stay in the processor's cache.
RUN = 1 << 17
#: Rows that a task of a pass over all rows has.
ROWS_PER_PASS = 5_000
#: Spark's setting that removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MAKING = threading.Lock()
_SCHEMA = "n long, width long, indptr binary, indices binary, data binary, extra binary"


@dataclass
class Block:
    """Compressed sparse rows with their extra columns (rows x columns)."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    extra: np.ndarray

    def __len__(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.indptr))

    def times(self, m: np.ndarray, budget: int = 1 << 21) -> np.ndarray:
        """Block x m, a bounded run of non-zeros at a time."""
        if len(self.data) == len(self) * m.shape[0]:  # every row has every column
            return self.data.reshape(len(self), m.shape[0]) @ m
        out = np.zeros((len(self), m.shape[1]))
        if m.shape[1] <= FEW:
            m = np.ascontiguousarray(m)   # a feature's weights of all classes lie together
            for i, (lo, hi) in enumerate(zip(self.indptr[:-1].tolist(), self.indptr[1:].tolist())):
                if lo < hi:
                    out[i] = self.data[lo:hi] @ m.take(self.indices[lo:hi], axis=0)
            return out
        for a, b in self._runs(budget // max(1, m.shape[1])):
            lo, hi = self.indptr[a], self.indptr[b]
            if lo < hi:
                filled = np.flatnonzero(np.diff(self.indptr[a:b + 1]))
                products = self.data[lo:hi, None] * m[self.indices[lo:hi]]
                out[a + filled] = np.add.reduceat(products, self.indptr[a:b][filled] - lo, axis=0)
        return out

    def transposed_times(self, y: np.ndarray, width: int, budget: int = 1 << 21, out: np.ndarray | None = None) -> np.ndarray:
        """Transposed block x y, added to ``out`` if given."""
        out = np.zeros((width, y.shape[1])) if out is None else out
        if len(self.data) == len(self) * width:
            out += self.data.reshape(len(self), width).T @ y
            return out
        if y.shape[1] <= FEW:
            columns, total = np.ascontiguousarray(y.T), np.zeros((y.shape[1], width))
            for a, b in self._runs(max(RUN, width)):
                lo, hi = self.indptr[a], self.indptr[b]
                data, indices, size = self.data[lo:hi], self.indices[lo:hi], np.diff(self.indptr[a:b + 1])
                for c, column in enumerate(columns):
                    total[c] += np.bincount(indices, data * np.repeat(column[a:b], size), minlength=width)
            out += total.T
            return out
        at = self.rows()
        for a, b in self._runs(budget // max(1, y.shape[1])):
            lo, hi = self.indptr[a], self.indptr[b]
            if lo < hi:
                order = np.argsort(self.indices[lo:hi], kind="stable") + lo
                column = self.indices[order]
                first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
                out[column[first]] += np.add.reduceat(self.data[order, None] * y[at[order]], first, axis=0)
        return out

    def _runs(self, most: int):
        """Runs of rows with about ``most`` non-zeros."""
        a = 0
        while a < len(self):
            b = max(a + 1, int(np.searchsorted(self.indptr, self.indptr[a] + most, "right")) - 1)
            yield a, min(b, len(self))
            a = b


def csr(column: pa.Array) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """``(width, indptr, indices, data)`` of an Arrow column of ML vectors;
    sparse and dense vectors may alternate."""
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values = column.field("values")
    size = np.diff(values.offsets.to_numpy())
    data = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    dense = kind == 1
    if dense.any():
        indices = column.field("indices")
        n = np.where(dense, 0, np.diff(indices.offsets.to_numpy()))
        out = np.empty(len(data), np.int32)
        at = np.repeat(dense, size)
        start = np.repeat(np.cumsum(size) - size, size)
        out[at] = (np.arange(len(data)) - start)[at]
        out[~at] = indices.flatten().to_numpy(zero_copy_only=False)[:int(n.sum())]
        widths = np.where(dense, size, column.field("size").fill_null(0).to_numpy(zero_copy_only=False))
    else:
        out = column.field("indices").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        widths = column.field("size").to_numpy(zero_copy_only=False)
    return int(widths.max(initial=0)), np.r_[0, np.cumsum(size)], out, data


class Blocks:
    """A persisted block table; ``width`` features, ``n`` rows."""

    def __init__(self, table: DataFrame):
        self.table = table.persist(StorageLevel.MEMORY_AND_DISK)
        n, width = self.table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("width"), F.lit(0))).first()
        self.n, self.width, self.tasks = int(n), int(width), self.table.rdd.getNumPartitions()

    def release(self) -> None:
        self.table.unpersist()

    def fold(self, state, step, size: int, sums: bool = False) -> np.ndarray:
        """The sum over tasks of ``step(state, blocks iterator)``, an array of
        ``size`` numbers (zeros for no rows).  ``step`` sees a task's blocks
        in order and may keep a state of its own between them.  With ``sums``
        it only adds up, so that tasks may be joined: there are then no more
        partial arrays than the cluster has cores, or twice as many if small."""
        spark, table, many = self.table.sparkSession, self.table, self.tasks
        sent = spark.sparkContext.broadcast(state)
        at_driver = max(1, min(FAN_IN, DRIVER_BYTES // (8 * max(size, 1))))
        cores = spark.sparkContext.defaultParallelism
        if sums and many > max(cores, min(at_driver, 2 * cores)):
            many = max(cores, min(at_driver, 2 * cores))
            table = table.coalesce(many)

        def run(batches):
            def blocks():
                for b in batches:
                    for i in range(b.num_rows):
                        n = b.column("n")[i].as_py()
                        indptr, indices, data, extra = (np.frombuffer(b.column(c)[i].as_py(), kind) for c, kind in (
                            ("indptr", np.int64), ("indices", np.int32), ("data", np.float64), ("extra", np.float64)))
                        if n:
                            if not len(indices):   # every row has every column
                                indices = np.tile(np.arange(len(data) // n, dtype=np.int32), n)
                            yield Block(indptr, indices, data, extra.reshape(n, -1))
            total = step(sent.value, blocks())
            if total is not None:
                flat = np.asarray(total, np.float64).reshape(-1)
                for at in range(0, size, CHUNK):
                    yield pa.RecordBatch.from_pydict({"at": pa.array([at]), "part": pa.array([flat[at:at + CHUNK].tobytes()])})

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.float64) for x in table["part"].to_pylist())
            return pa.table({"at": table["at"][:1], "part": pa.array([total.tobytes()])})

        parts = table.mapInArrow(run, "at long, part binary")
        while many > at_driver:
            many = -(-many // FAN_IN)
            parts = parts.groupBy("at", (F.spark_partition_id() % many).alias("slice")).applyInArrow(add, "at long, part binary")
        out, got = np.zeros(size), _cleaned(parts).toArrow()
        for at, part in zip(got["at"].to_pylist(), got["part"].to_pylist()):
            out[at:at + len(part) // 8] += np.frombuffer(part, np.float64)
        sent.destroy()
        return out


def _cleaned(parts: DataFrame) -> DataFrame:
    """``parts`` as a query whose shuffle files go when it ends (Spark reads the
    setting when the query is made): a learner makes hundreds of them."""
    conf = parts.sparkSession.conf
    with _MAKING:
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            return parts.select("at", "part")
        finally:
            conf.set(CLEANUP, before)


def compact(df: DataFrame, rows_per_task: int = ROWS_PER_PASS) -> DataFrame:
    """``df`` persisted in no more tasks than its rows need, without a
    shuffle: iterative learners pay for every task in every step."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    tasks = max(1, -(-held.count() // rows_per_task))
    if tasks >= held.rdd.getNumPartitions():
        return held
    out = held.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    held.unpersist()
    return out


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_PASS) -> DataFrame:
    """``df`` as it is, or dealt anew over the cluster where its files keep the
    rows in so few tasks (one large row group is one task) that a task has more than
    four times its share."""
    most, rows = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-(rows or 0) // rows_per_task))
    return df.repartition(tasks) if rows and most * tasks > 4 * rows else df


def sparse_blocks(df: DataFrame, features: str, extra: list[Column | str] = (), rows_per_task: int | None = None,
                  n: int | None = None) -> Blocks:
    """Blocks of the vectors in ``features`` with ``extra`` number columns
    (label, weight).  ``rows_per_task`` deals the rows anew by a hash, so that
    a task has about that many and each task's order is the same in every run.
    ``n`` is their number if known; else rows that are not persisted yet are
    while they are counted and dealt."""
    columns = [F.col(features).alias("features"), *(F.col(c).cast("double").alias(f"x{i}") if isinstance(c, str)
                                                      else c.cast("double").alias(f"x{i}") for i, c in enumerate(extra))]
    rows = df.select(*columns)
    held = None
    if rows_per_task:
        level = df.storageLevel
        if n is None and not (level.useMemory or level.useDisk):
            rows = held = rows.persist(StorageLevel.MEMORY_AND_DISK)
        tasks = max(1, -(-(rows.count() if n is None else n) // rows_per_task))
        rows = rows.withColumn("h", F.xxhash64("features", *[f"x{i}" for i in range(len(extra))]))
        rows = (rows.repartition(tasks, "h") if tasks > 1 else rows.coalesce(1)).sortWithinPartitions("h").drop("h")

    beside = len(extra)

    def pack(batches):
        for b in batches:
            width, indptr, indices, data = csr(b.column("features"))
            more = [b.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(beside)]
            side = np.stack(more, axis=1) if more else np.zeros((b.num_rows, 0))
            full = len(data) == b.num_rows * width and bool((indices.reshape(b.num_rows, width) == np.arange(width)).all())
            yield pa.RecordBatch.from_pydict({
                "n": [b.num_rows], "width": [width], "indptr": [indptr.astype(np.int64).tobytes()], "indices": [b"" if full else indices.tobytes()],
                "data": [data.tobytes()], "extra": [np.ascontiguousarray(side, np.float64).tobytes()]})

    out = Blocks(rows.mapInArrow(pack, _SCHEMA))
    if held is not None:
        held.unpersist()
    return out


def dense_vectors(rows: np.ndarray) -> pa.StructArray:
    """An Arrow column of dense ML vectors."""
    n, width = rows.shape
    values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.reshape(-1)))
    return pa.StructArray.from_arrays([pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), values],
                                      ["type", "size", "indices", "values"])


def sparse_vectors(width: int, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray) -> pa.StructArray:
    """An Arrow column of sparse ML vectors from compressed rows."""
    n, at = len(indptr) - 1, pa.array(indptr, pa.int32())
    lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (indices.astype(np.int32), data.astype(np.float64))]
    return pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width, np.int32)), *lists],
                                      ["type", "size", "indices", "values"])


def with_scores(df: DataFrame, features: str, matrix: np.ndarray, out: dict[str, DataType], finish) -> DataFrame:
    """``df`` with the columns ``finish(scores)`` gives (name -> Arrow array)
    for vectors x matrix, its last row the intercepts; other columns pass
    through untouched."""
    sent = df.sparkSession.sparkContext.broadcast(matrix)
    fields = [f for f in df.schema if f.name not in out] + [StructField(n, t) for n, t in out.items()]

    def run(batches):
        m = sent.value
        for b in batches:
            _, indptr, indices, data = csr(b.column(features))
            scores = Block(indptr, indices, data, np.zeros((b.num_rows, 0))).times(m[:-1]) + m[-1]
            got = finish(scores)
            names = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([got[n] if n in got else b.column(n) for n in names], names=names)

    return df.mapInArrow(run, StructType(fields))
