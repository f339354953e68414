"""Helpers shared by the training-data operators.

Row identity.  A document row is identified by ``(doc_id, xxhash64(text))``.
Rows that agree in both are repeated rows of one document and always get the
same result; rows that share only the doc_id stay apart.  The hash is used to
carry a result back to its row, never to decide that two texts are equal.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

#: Spark's setting that removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only; null becomes the empty string.  ``lower`` is the
    fast path for texts without multi-byte characters."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: the lineage is cut, and the table survives lost executors.  The files
    go when the session's JVM ends; the shuffle files behind the table go as
    soon as it is written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarry-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete materialized tables that no later step reads."""
    for t in tables:
        path = getattr(t, "_written_to", None)
        if path:
            sc = t.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus``; a null doc_id is text ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus) == remainder


def map_batches(df: DataFrame, fn, schema: str, partitions_closure=None, most: int = 8 << 20) -> DataFrame:
    """``mapInArrow`` with ``fn(dict of python lists) -> dict of lists``; one
    Arrow batch at a time, so memory is bounded by a batch.  ``fn`` comes from
    ``partitions_closure()`` when given (state built once per task).  Batches
    are cut into runs of about ``most`` bytes."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    out = to_arrow_schema(_parse_datatype_string(schema), prefers_large_types=False)

    def run(batches):
        f = partitions_closure() if partitions_closure else fn
        for b in batches:
            for part in slices(b, most):
                got = f({n: part.column(i) for i, n in enumerate(part.schema.names)})
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[x.name], x.type) for x in out], schema=out)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = 8 << 20):
    """Cut an Arrow batch into runs of about ``most`` bytes (a longer row alone)."""
    n = batch.num_rows
    step = n if batch.nbytes <= most else max(1, int(n * most / batch.nbytes))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return [x or b"" for x in column.to_pylist()]
