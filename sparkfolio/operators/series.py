"""Long-series evaluation with bounded task size.

A plain ``Window.partitionBy("symbol")`` sends one whole series to one task.
A daily series is bounded by the calendar (one row per trading day), but a
series may also be intraday or one symbol may hold a large share of the rows.
These helpers evaluate the same window code over fixed-size *chunks* of a
series instead:

Small derived tables (bucket offsets, chunk prefixes) are joined without a
hint: adaptive execution measures their materialised size and turns the
join into a broadcast only when they are small.

1. :func:`sequence_index` gives each row its position ``_idx`` (0-based) in
   its series with a two-level prefix: row counts per (key, time bucket) ->
   running offsets per key over the small bucket table -> offset + row
   number inside the bucket. No step sees more than one bucket of one key.
2. :func:`chunked_apply` cuts the series into chunks of ``chunk_rows`` rows,
   copies the last ``back`` rows of each chunk into the next one (halo) and
   the first ``fwd`` rows into the previous one, runs ``fn`` partitioned by
   ``(key, chunk)`` ordered by ``_idx`` and keeps each chunk's own rows.
   Exact as long as ``fn`` looks at most ``back`` rows behind and ``fwd``
   rows ahead (25 and 1 for the indicator/feature set).
3. :func:`prefix_scan` computes running sums and running maxima of these
   sums (unbounded frames): each chunk is scanned on its own and summed up as
   a pair (sum, maximum of its running sums); the pairs of earlier chunks are
   composed by a window over the small chunk table and joined back once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.columns import null_safe_join
from sparkfolio.operators.indicators import MAX_LOOKAHEAD, MAX_LOOKBACK

DEFAULT_BUCKET_DAYS = 366


def _bucket(df: DataFrame, order: str, bucket_days: int):
    t = df.schema[order].dataType
    if isinstance(t, T.DateType):
        return F.floor(F.datediff(F.col(order), F.lit("1970-01-01").cast("date")) / bucket_days)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / (86400 * bucket_days))
    return F.floor(F.col(order) / bucket_days)


def sequence_index(df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "trade_date",
                   bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Add ``_idx``: 0-based position of each row in its series (by ``order``;
    ``(keys, order)`` is expected unique)."""
    keys = list(keys)
    b = df.withColumn("_bucket", _bucket(df, order, bucket_days))
    counts = b.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per (key, bucket); no hint: AQE measures it at
    # runtime and broadcasts it when small, else keeps the shuffle join.
    b = null_safe_join(b, offsets, [*keys, "_bucket"])
    inner = Window.partitionBy(*keys, "_bucket").orderBy(order)
    return b.withColumn("_idx", F.col("_off") + F.row_number().over(inner) - 1).drop("_bucket", "_off", "_n")


def chunked_apply(df: DataFrame, fn: Callable[..., DataFrame], keys: Sequence[str] = ("symbol",),
                  order: str = "trade_date", chunk_rows: int = 100_000,
                  back: int = MAX_LOOKBACK, fwd: int = MAX_LOOKAHEAD,
                  indexed: bool = False) -> DataFrame:
    """Run ``fn(df, keys=..., order=...)`` on chunks of each series with halos."""
    if back >= chunk_rows or fwd >= chunk_rows:
        raise ValueError("chunk_rows must exceed the halo sizes")
    keys = list(keys)
    x = df if indexed else sequence_index(df, keys, order)
    own = F.floor(F.col("_idx") / chunk_rows)
    pos = F.col("_idx") - own * chunk_rows
    chunks = F.array(
        own,
        F.when(pos >= chunk_rows - back, own + 1),
        F.when((pos < fwd) & (own > 0), own - 1),
    )
    x = x.withColumn("_chunk", F.explode(F.filter(chunks, lambda c: c.isNotNull())))
    out = fn(x, keys=[*keys, "_chunk"], order="_idx")
    return out.filter(F.col("_chunk") == F.floor(F.col("_idx") / chunk_rows)).drop("_chunk", "_idx")


def _chunk(df: DataFrame, keys: Sequence[str], order: str, chunk_rows: int) -> tuple[DataFrame, str]:
    """``df`` with ``_chunk`` (at most ``chunk_rows`` rows of a series) and the column that orders a chunk. A series
    has at most one row a day, so with dates a chunk is that many days; other orders are numbered first."""
    if isinstance(df.schema[order].dataType, T.DateType):
        return df.withColumn("_chunk", F.floor(F.unix_date(order) / chunk_rows)), order
    x = sequence_index(df, keys, order)
    return x.withColumn("_chunk", F.floor(F.col("_idx") / chunk_rows)), "_idx"


def prefix_scan(df: DataFrame, sums: dict[str, str], maxes: dict[str, str] | None = None,
                keys: Sequence[str] = ("symbol",), order: str = "trade_date", chunk_rows: int = 100_000) -> DataFrame:
    """Running sums ``{out: column}`` and running maxima of running sums ``{out: out of sums}`` of each series.

    The rows shuffle once, by (series, chunk). The chunk table reads every column, so that it is computed from that same
    shuffle: Spark reuses an exchange only where both sides ask it for the same columns. Like a plain running sum,
    a sum is null until the first value; later nulls add nothing.
    """
    keys, maxes = list(keys), maxes or {}
    x, at = _chunk(df, keys, order, chunk_rows)
    everything = [F.col(f"`{c}`") for c in x.columns]
    w = Window.partitionBy(*keys, "_chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"_ls_{o}": F.sum(c).over(w) for o, c in sums.items()})
    totals = x.groupBy(*keys, "_chunk").agg(
        *[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()],
        *[F.max(f"_ls_{s}").alias(f"_m_{o}") for o, s in maxes.items()],
        F.bit_xor(F.xxhash64(*everything)).alias("_same"))
    prev = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.withColumns({f"_p_{o}": F.sum(f"_t_{o}").over(prev) for o in sums})
    # the highest running sum within a chunk, from the start of the series
    prefix = prefix.withColumns({f"_q_{o}": F.max(F.coalesce(F.col(f"_p_{s}") + F.col(f"_m_{o}"), F.col(f"_m_{o}"))).over(prev) for o, s in maxes.items()})
    # kept so that the optimiser does not drop it; the value is never looked at
    prefix = prefix.filter(F.col("_same").isNotNull()).select(*keys, "_chunk", *[f"_p_{o}" for o in sums], *[f"_q_{o}" for o in maxes])
    x = x.withColumns({f"_lm_{o}": F.max(f"_ls_{s}").over(w) for o, s in maxes.items()})
    x = null_safe_join(x, prefix, [*keys, "_chunk"])       # one row per chunk; AQE broadcasts it when small
    out = x.withColumns(
        {o: F.coalesce(F.col(f"_p_{o}") + F.col(f"_ls_{o}"), f"_p_{o}", f"_ls_{o}") for o in sums}
        | {o: F.greatest(F.col(f"_q_{o}"), F.coalesce(F.col(f"_p_{s}") + F.col(f"_lm_{o}"), F.col(f"_lm_{o}"))) for o, s in maxes.items()})
    return out.select(*df.columns, *sums, *maxes)
