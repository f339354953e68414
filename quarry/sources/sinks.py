"""Sinks.  Every writer is a plain DataFrame writer: the
data is written by the executors, never gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_ready(df: DataFrame, date_fmt: str = "yyyy-MM-dd") -> DataFrame:
    """S7 projection: NaN → null, dates/timestamps → ``yyyy-MM-dd`` text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, date_fmt)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON output (one writer per path; a second path is a second write)."""
    json_ready(df).write.mode(mode).json(path)


def write_stage(df: DataFrame, path: str) -> None:
    """Materialise an intermediate stage table (parquet)."""
    df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a stage table; fail clearly when the stage never ran."""
    from quarry.sources.files import first_existing
    first_existing(spark, [path])
    return spark.read.parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append finished rows, so a crash keeps everything written so far."""
    json_ready(df).write.mode("append").json(path)


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_named_report(df: DataFrame, base: str, name: str) -> None:
    """Report rows tagged with the config name and a timestamp,
    written under ``<base>/name=<name>/``."""
    out = df.withColumn("config", F.lit(name)).withColumn("timestamp", F.current_timestamp())
    json_ready(out).write.mode("append").partitionBy("config").json(base)
