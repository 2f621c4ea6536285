"""Readers and input guards.

All reads are lazy DataFrames: filters on partition columns (``dt``,
``trade_date``, ``symbol``) become PartitionFilters, and column selections
become the scan's ReadSchema.

:func:`parse_documents` reads JSON text to a declared schema without losing
anything silently: text that does not fit the schema is kept in
``_corrupt_record``, fields that the schema does not know, at any depth, in
``_rescued``; :func:`quarantine` lists both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT, RESCUED = "_corrupt_record", "_rescued"
_FIELDS = "array<struct<path:string,value:string>>"


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              where: Column | str | None = None, multi_line: bool = False) -> DataFrame:
    """JSON documents (one per line; a root array yields one row per element).

    With ``schema`` the layout is fixed and unknown fields are ignored;
    without it the schema is inferred. ``where`` on partition columns of a
    ``key=value`` directory layout prunes directories.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("multiLine", multi_line).json(path)
    return df.filter(where) if where is not None else df


def _unknown(raw: Column, kind: T.DataType, path: Column) -> Column:
    """(path, JSON value) of the fields in ``raw`` that ``kind`` does not declare, at any depth."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        parts = F.transform(F.from_json(raw, "array<string>"), lambda e, i: _unknown(
            e, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(parts), F.array().cast(_FIELDS))
    if not isinstance(kind, T.StructType):
        return F.array().cast(_FIELDS)
    fields = F.from_json(raw, "map<string,string>")
    below = F.when(path == "", F.lit("")).otherwise(F.concat(path, F.lit(".")))
    # entries, not map functions: a document may repeat a key
    own = F.transform(F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(kind.names)),
                      lambda e: F.struct(F.concat(below, e["key"]).alias("path"), e["value"].alias("value")))
    deeper = [_unknown(F.element_at(fields, f.name), f.dataType, F.concat(below, F.lit(f.name))) for f in kind.fields
              if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    return F.concat(F.coalesce(own, F.array()).cast(_FIELDS), *deeper)


def parse_documents(df: DataFrame, schema: T.StructType, value: str = "value", keep: Mapping[str, str] | None = None) -> DataFrame:
    """JSON text to the columns of ``schema``: one row for a document, one for each element of a root array.

    Added: ``keep`` (name -> column of ``df``), ``_corrupt_record`` (the text, where it is no JSON or does not fit the
    schema; what fits is still read), ``_rescued`` (path and value of undeclared fields, null where there are none).
    Blank and null text gives no row.
    """
    text = F.col(value)
    begins = F.ltrim(F.regexp_replace(text, r"^\s+", ""))
    elements = F.when(begins.startswith("["), F.from_json(text, "array<string>"))
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    kept = {n: F.col(c) for n, c in (keep or {}).items()}
    rows = df.filter(begins != "").select(
        *[c.alias(n) for n, c in kept.items()], F.explode(F.coalesce(elements, F.array(text))).alias("_raw"))
    # a lone null or text in a root array is broken too
    doc = F.from_json("_raw", declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = rows.select(*kept, "_raw", doc.alias("_doc"), _unknown(F.col("_raw"), schema, F.lit("")).alias("_more"))
    broken = F.when(F.col("_doc").isNull(), F.coalesce("_raw", F.lit("null"))).otherwise(F.col(f"_doc.{CORRUPT}"))
    return rows.select(*[F.col(f"_doc.{n}").alias(n) for n in schema.names], *kept, broken.alias(CORRUPT),
                       F.when(F.size("_more") > 0, F.col("_more")).alias(RESCUED))


def quarantine(parsed: DataFrame, keep: tuple[str, ...] = ("dt", "key_symbol")) -> DataFrame:
    """What :func:`parse_documents` could not place: (keep, reason, path, value), a row for each broken document
    (its text) and for each undeclared field."""
    broken = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(
        F.lit("broken").alias("reason"), F.lit("").alias("path"), F.col(CORRUPT).alias("value"))))
    extra = F.transform(RESCUED, lambda e: F.struct(F.lit("undeclared").alias("reason"), e["path"].alias("path"), e["value"].alias("value")))
    none = F.array().cast("array<struct<reason:string,path:string,value:string>>")
    return parsed.select(*keep, F.explode(F.concat(F.coalesce(broken, none), F.coalesce(extra, none))).alias("q")).select(*keep, "q.*")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", text: tuple[str, ...] = ()) -> DataFrame:
    """A table directory; partition columns are discovered from the path. Columns in ``text`` are read as strings: a
    partition value such as ``0700`` stays as it was written."""
    if schema is None and text:
        found = spark.read.format(fmt).load(path).schema
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in text else f.dataType, f.nullable) for f in found.fields])
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stored_max(spark: SparkSession, path: str, column: str):
    """Largest value of a column of a stored Parquet table (None if it has none), from the files' footers or the partition
    values: the aggregate is pushed into the scan, which reads no row group. Dates, numbers and booleans
    are pushed; for other types Spark reads the column. The settings that this needs hold in a session of its own."""
    aside = spark.newSession()
    aside.conf.set("spark.sql.sources.useV1SourceList", "")
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return aside.read.parquet(path).agg(F.max(F.col(f"`{column}`"))).first()[0]


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when the path can be read. Only "path not found" means absent;
    any other error (permissions, corrupt files) is raised."""
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    return spark.read.format(fmt).load(path) if table_exists(spark, path, fmt) else None


def is_empty(df: DataFrame) -> bool:
    """Empty-input guard: stops at the first row instead of counting all."""
    return df.isEmpty()


def empty_like(df: DataFrame) -> DataFrame:
    """An empty DataFrame with the same schema (no scan is run)."""
    return df.limit(0)
