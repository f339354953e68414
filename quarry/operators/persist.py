"""Saving and loading of the library's own pipeline stages.

A stage saves its params as MLlib metadata, plain facts as JSON beside them,
tables and number arrays as Parquet, and inner stages in folders of their
own, so a ``PipelineModel`` of built-in and own stages is written and read
by MLlib's usual ``save`` / ``load`` on any Hadoop path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame


@dataclass
class Parts:
    """What a stage consists of besides its params."""
    plain: dict = field(default_factory=dict)
    arrays: dict[str, np.ndarray] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stages: list = field(default_factory=list)


class StageWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark, parts = self.sparkSession, self.stage._parts()
        shapes = {n: list(a.shape) for n, a in parts.arrays.items()}
        DefaultParamsWriter.saveMetadata(self.stage, path, spark, extraMetadata={
            "plain": parts.plain, "arrays": shapes, "tables": list(parts.tables), "n_stages": len(parts.stages)})
        for name, a in parts.arrays.items():
            rows = np.asarray(a, np.float64).reshape(len(a), -1)
            width = rows.shape[1]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(rows.reshape(-1)))
            spark.createDataFrame(pa.table({"i": np.arange(len(rows)), "row": flat})).write.parquet(f"{path}/arrays/{name}")
        for name, t in parts.tables.items():
            t.write.parquet(f"{path}/tables/{name}")
        for i, s in enumerate(parts.stages):
            s.write().save(f"{path}/stages/{i}")


class StageReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        parts = Parts(plain=meta["plain"])
        for name, shape in meta["arrays"].items():
            # Model parameters: as large as the model was on the driver that fitted it.
            rows = spark.read.parquet(f"{path}/arrays/{name}").orderBy("i").toArrow()
            parts.arrays[name] = rows["row"].combine_chunks().flatten().to_numpy().reshape(shape)
        parts.tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in meta["tables"]}
        parts.stages = [DefaultParamsReader.loadParamsInstance(f"{path}/stages/{i}", spark) for i in range(meta["n_stages"])]
        stage = self.cls._from_parts(parts)
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        return stage


class Saved(MLWritable, MLReadable):
    """Mixin: a stage names its ``_parts`` and is built again ``_from_parts``."""

    def write(self) -> StageWriter:
        return StageWriter(self)

    @classmethod
    def read(cls) -> StageReader:
        return StageReader(cls)
