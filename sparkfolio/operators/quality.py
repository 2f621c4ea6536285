"""Flattening, validation and missing-value operators.

Validation rules for a price row, first match wins (``is_valid``):

1. close missing or negative        -> invalid
2. volume missing or negative       -> invalid
3. trade date missing (or unparsable) -> invalid
4. open > high                      -> invalid
5. low > close                      -> invalid
otherwise valid. Zero prices pass (only ``< 0`` is rejected) and null
open/high/low pass rules 4-5 (a null comparison falls through).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.columns import as_date, as_double, as_long

PRICE_COLUMNS = ["symbol", "trade_date", "open", "high", "low", "close", "volume"]


def flatten_prices(raw: DataFrame) -> DataFrame:
    """Raw price documents (meta + values[]) -> one typed row per bar.

    Unparsable values become null (they are then caught by validation);
    documents with a null ``values`` array produce no rows.
    """
    return raw.select(
        F.col("meta.symbol").alias("symbol"),
        F.explode(F.col("values")).alias("data"),
    ).select(
        F.col("symbol"),
        as_date("data.datetime").alias("trade_date"),
        as_double("data.open").alias("open"),
        as_double("data.high").alias("high"),
        as_double("data.low").alias("low"),
        as_double("data.close").alias("close"),
        as_long("data.volume").alias("volume"),
    )


def with_lineage(df: DataFrame, source_api: str, ingestion_date: str | None = None,
                 ingestion_ts: Column | None = None) -> DataFrame:
    """Add ``ingestion_ts``, ``source_api`` and (optionally) ``ingestion_date``."""
    cols = {
        "ingestion_ts": ingestion_ts if ingestion_ts is not None else F.current_timestamp(),
        "source_api": F.lit(source_api),
    }
    if ingestion_date is not None:
        cols["ingestion_date"] = F.lit(ingestion_date).cast(T.DateType())
    return df.withColumns(cols)


def validity_expr() -> Column:
    c, v = F.col("close"), F.col("volume")
    return (
        F.when(c.isNull() | (c < 0), F.lit(False))
        .when(v.isNull() | (v < 0), F.lit(False))
        .when(F.col("trade_date").isNull(), F.lit(False))
        .when(F.col("open") > F.col("high"), F.lit(False))
        .when(F.col("low") > F.col("close"), F.lit(False))
        .otherwise(F.lit(True))
    )


def add_validity(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid", validity_expr())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the flag, invalid rows with the flag)."""
    flagged = df if "is_valid" in df.columns else add_validity(df)
    return (flagged.filter(F.col("is_valid")).drop("is_valid"),
            flagged.filter(~F.col("is_valid")))


def validity_counts(df: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Valid / invalid row counts per group in ONE aggregation (partial agg
    map-side, so a hot symbol is combined before the shuffle)."""
    flagged = df if "is_valid" in df.columns else add_validity(df)
    return flagged.groupBy(*by).agg(
        F.count_if(F.col("is_valid")).alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
    )


def invalid_sample(df: DataFrame, n: int = 10,
                   order: Sequence[str] = ("symbol", "trade_date")) -> DataFrame:
    """The first n invalid rows in a fixed order (a bounded report)."""
    flagged = df if "is_valid" in df.columns else add_validity(df)
    cols = [c for c in PRICE_COLUMNS if c in flagged.columns]
    sort = [F.col(c).asc_nulls_last() for c in order] + \
           [F.col(c).asc_nulls_last() for c in cols if c not in order]
    return flagged.filter(~F.col("is_valid")).select(*cols).orderBy(*sort).limit(n)


def validity_metrics(n: int = 10) -> list[Column]:
    """Aggregates for ``DataFrame.observe`` over rows with ``is_valid``: how many there are of each kind, and up to ``n``
    invalid rows (the least of each of ``n`` hash slots). Their size does not grow with the input."""
    row = F.struct(*PRICE_COLUMNS)
    slot = F.pmod(F.xxhash64(*PRICE_COLUMNS), F.lit(n))
    return [F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"),
            *[F.min(F.when(~F.col("is_valid") & (slot == i), row)).alias(f"sample_{i}") for i in range(n)]]


def ensure_columns(df: DataFrame, expected: Mapping[str, T.DataType]) -> DataFrame:
    """Add expected columns that are absent as typed nulls."""
    missing = {n: F.lit(None).cast(t) for n, t in expected.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN, for doubles) in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def fill_missing(df: DataFrame, cols: Sequence[str], value: float = 0) -> DataFrame:
    """Replace null (and NaN) numerics in ``cols`` by ``value``."""
    return df.na.fill(value, subset=list(cols))


def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: count of null-or-NaN values per column (``nb_null_<col>``)."""
    def missing(c: str) -> Column:
        cond = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(F.col(c))
        return F.count_if(cond).alias(f"nb_null_{c}")
    return df.agg(*[missing(c) for c in cols])
