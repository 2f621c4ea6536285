"""Sinks (K1-K6).

* :func:`write_partitions` - partitioned Parquet with dynamic partition
  overwrite (only the partitions present in the batch are replaced). Rows
  are ``rebalance``d on the partition columns first: AQE then sizes the
  write tasks and splits a hot partition value over several tasks/files.
* :func:`replace_table` - full overwrite of a path.
* :func:`publish_snapshot` - safe "overwrite of a table the same job read":
  the result goes to a NEW snapshot folder, then the catalog table is pointed
  at it. The files being read are never deleted mid-job, and a failed write
  leaves the old snapshot in place.
* :func:`register_external` - catalog table over a path with a declared
  schema (a real replace: an existing definition is dropped first).
* :func:`serve` - project/cast a DataFrame to a declared serving schema.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitions(df: DataFrame, path: str, by: Sequence[str], dynamic: bool = True,
                     mode: str = "overwrite", fmt: str = "parquet") -> None:
    by = list(by)
    (df.hint("rebalance", *by).write.mode(mode)
       .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
       .partitionBy(*by).format(fmt).save(path))


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def publish_snapshot(spark: SparkSession, df: DataFrame, table: str, root: str) -> str:
    """Write ``df`` to ``root/snapshot=<id>`` and point ``table`` at it."""
    target = f"{root.rstrip('/')}/snapshot={uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").format("parquet").save(target)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {_quote(table)} SET LOCATION '{target}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=target, source="parquet")
    return target


def register_external(spark: SparkSession, name: str, path: str, schema: T.StructType) -> DataFrame:
    """(Re)create a catalog table over ``path`` exposing only ``schema``."""
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def serve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
