"""What the operators share about the session: worker imports and intermediate tables."""

from __future__ import annotations

import ctypes
import gc
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.session import scratch_path


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def trim() -> None:
    """Give what a task has freed back to the system, so that an idle Python worker stays small."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (back := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        back(0)


def values(docs: DataFrame) -> list[Column]:
    """All columns, of any name, as values that can be hashed, each with whether it is null (hashes pass over nulls)."""
    out = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        out += [c.isNull(), F.to_json(F.struct(c.alias("c"))) if "map<" in f.dataType.simpleString() else c]
    return out


def map_texts(docs: DataFrame, run, keep: int = 0) -> DataFrame:
    """``docs.mapInArrow(run)`` of a function that gives all columns back but the last ``keep``; columns may have any name.
    The function sees ``text`` and the last ``keep`` columns by name, the others by number."""
    n = len(docs.columns) - keep
    plain = docs.toDF(*(c if c == "text" or i >= n else f"c{i}" for i, c in enumerate(docs.columns)))
    return plain.mapInArrow(run, T.StructType(plain.schema.fields[:n])).toDF(*docs.columns[:n])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends
    at files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
