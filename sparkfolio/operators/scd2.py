"""Slowly changing dimension, type 2, for fundamentals.

History rows carry ``effective_date``, ``expiration_date`` and
``is_current``. A merge with an incoming batch, effective ``as_of``:

* key present in both, tracked values changed -> current version expired
  (``is_current = false``, ``expiration_date = as_of``), incoming appended
* key present in both, unchanged -> current version kept, incoming dropped
* key only incoming -> appended as current
* key only in history / non-current history -> kept

:func:`scd2_merge` does this with ONE full outer join of current rows and
incoming rows on the key, then explodes each joined row into its 1-2 output
versions; expired history passes through untouched (no shuffle). No counts
drive the control flow. Defaults fix two quirks of the reference:
null -> value counts as a change (``null_safe``), and unchanged incoming
rows are not appended a second time (``reappend_unchanged``).

:func:`scd2_merge_reference` reproduces the reference's rows exactly
(``!=`` change test, every incoming row appended, expiry by anti-join on
(symbol, report_date, effective_date)).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.columns import any_changed, as_date, as_double
from sparkfolio.operators.asof import first_per_group
from sparkfolio.operators.quality import drop_missing, ensure_columns
from sparkfolio.schemas import RAW_RATIOS_FIELDS, SILVER_FUNDAMENTALS

KEYS = ("symbol", "report_date")
TRACKED = ("pe_ratio", "debt_to_equity")
HISTORY_COLUMNS = [f.name for f in SILVER_FUNDAMENTALS.fields]
VERSION_KEYS = ("symbol", "report_date", "effective_date")


def _date(d: str | Column) -> Column:
    return F.lit(d).cast(T.DateType()) if isinstance(d, str) else d.cast(T.DateType())


def standardize_fundamentals(raw: DataFrame, as_of: str | Column, source_api: str = "fmp",
                             ingestion_ts: Column | None = None) -> DataFrame:
    """Raw ratio objects -> (symbol, report_date, pe_ratio, debt_to_equity,
    effective_date, source_api, ingestion_ts); rows without symbol or report
    date are dropped; unparsable values become null."""
    raw = ensure_columns(raw, RAW_RATIOS_FIELDS)
    out = raw.select(
        F.col("symbol").cast(T.StringType()).alias("symbol"),
        as_date(F.col("date").cast(T.StringType())).alias("report_date"),
        as_double("priceToEarningsRatio").alias("pe_ratio"),
        as_double("debtToEquityRatio").alias("debt_to_equity"),
        _date(as_of).alias("effective_date"),
        F.lit(source_api).alias("source_api"),
        (ingestion_ts if ingestion_ts is not None else F.current_timestamp()).alias("ingestion_ts"),
    )
    return drop_missing(out, ["symbol", "report_date"])


def scd2_init(new: DataFrame) -> DataFrame:
    """Initial load: every row current, no expiry."""
    return new.withColumns({"is_current": F.lit(True), "expiration_date": F.lit(None).cast(T.DateType())})


def upgrade_history(df: DataFrame, source_api: str = "fmp", ingestion_ts: Column | None = None) -> DataFrame:
    """Add SCD2/lineage columns missing from an older stored history."""
    add: dict[str, Column] = {}
    if "is_current" not in df.columns:
        add["is_current"] = F.lit(True)
        add["expiration_date"] = F.lit(None).cast(T.DateType())
    if "source_api" not in df.columns:
        add["source_api"] = F.lit(source_api)
    if "ingestion_ts" not in df.columns:
        add["ingestion_ts"] = ingestion_ts if ingestion_ts is not None else F.current_timestamp()
    return df.withColumns(add) if add else df


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def as_of(df: DataFrame, date: str | Column) -> DataFrame:
    """Versions valid on ``date`` (time travel over the history)."""
    d = _date(date)
    return df.filter((F.col("effective_date") <= d)
                     & (F.col("expiration_date").isNull() | (F.col("expiration_date") > d)))


def scd2_changes(cur: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS,
                 tracked: Sequence[str] = TRACKED, null_safe: bool = True) -> DataFrame:
    """Current versions whose tracked values differ in the incoming batch
    (old columns only)."""
    o, n = cur.alias("o"), new.alias("n")
    cond = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    diff = any_changed([(F.col(f"o.{t}"), F.col(f"n.{t}")) for t in tracked], null_safe)
    return o.join(n, cond, "inner").where(diff).select("o.*")


def scd2_new_keys(new: DataFrame, cur: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Incoming rows whose key has no current version."""
    return new.join(cur.select(*keys), list(keys), "left_anti")


def scd2_unchanged(hist: DataFrame, changes: DataFrame, keys: Sequence[str] = VERSION_KEYS) -> DataFrame:
    """History rows not hit by a change (anti-join on the version key)."""
    return hist.join(changes.select(*keys), list(keys), "left_anti")


def scd2_expire(changes: DataFrame, as_of_date: str | Column) -> DataFrame:
    return changes.withColumns({"is_current": F.lit(False), "expiration_date": _date(as_of_date)})


def scd2_merge(hist: DataFrame, new: DataFrame, as_of_date: str | Column,
               keys: Sequence[str] = KEYS, tracked: Sequence[str] = TRACKED,
               null_safe: bool = True, reappend_unchanged: bool = False) -> DataFrame:
    """Merge an incoming batch into the history (see module doc).

    A key with several current versions keeps its newest one; each other one
    is closed on the day its successor took effect. Rows with a null key
    match nothing and stay as they are.
    """
    cols = HISTORY_COLUMNS
    hist = upgrade_history(hist).select(*cols)
    incoming = first_per_group(new, list(keys), [F.col("ingestion_ts").desc_nulls_last()])
    incoming = scd2_init(incoming).select(*cols)

    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in ("effective_date", "ingestion_ts")],
        *[F.col(c).asc_nulls_last() for c in cols if c not in {*keys, "effective_date", "ingestion_ts"}])
    has_key = reduce(and_, [F.col(k).isNotNull() for k in keys])
    cur = hist.filter(F.col("is_current")).withColumns({
        "_stale": has_key & (F.row_number().over(newest) > 1),
        "_until": F.lag("effective_date").over(newest),
    }).select(*[F.col(c).alias(f"o_{c}") for c in cols], "_stale", "_until", F.lit(True).alias("_o"))
    old = hist.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    inc = incoming.select(*[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("_n"))

    cond = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys]
    j = cur.join(inc, cond, "full_outer")
    has_o, has_n = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    stale = F.col("_stale")
    chg = has_o & has_n & any_changed([(F.col(f"o_{t}"), F.col(f"n_{t}")) for t in tracked], null_safe)

    def old_col(c: str) -> Column:
        if c == "is_current":
            return F.when(stale | chg, F.lit(False)).otherwise(F.col("o_is_current"))
        if c == "expiration_date":
            return F.when(stale, F.coalesce("_until", _date(as_of_date))).when(chg, _date(as_of_date)) \
                .otherwise(F.col("o_expiration_date"))
        return F.col(f"o_{c}")

    old_v = F.when(has_o, F.struct(*[old_col(c).alias(c) for c in cols]))
    keep_new = has_n & (~has_o | (~stale & (chg | F.lit(reappend_unchanged))))
    new_v = F.when(keep_new, F.struct(*[F.col(f"n_{c}").alias(c) for c in cols]))
    versions = j.select(F.explode(F.filter(F.array(old_v, new_v), lambda v: v.isNotNull())).alias("v"))
    return old.unionByName(versions.select("v.*"))


def scd2_merge_reference(hist: DataFrame, new: DataFrame, as_of_date: str | Column,
                         keys: Sequence[str] = KEYS, tracked: Sequence[str] = TRACKED,
                         null_safe: bool = False) -> DataFrame:
    """The reference's merge rows: unchanged + expired + ALL incoming."""
    hist = upgrade_history(hist).select(*HISTORY_COLUMNS)
    changes = scd2_changes(current(hist), new, keys, tracked, null_safe)
    expired = scd2_expire(changes.drop("is_current", "expiration_date"), as_of_date)
    unchanged = scd2_unchanged(hist, changes)
    return unchanged.unionByName(expired).unionByName(scd2_init(new))


def scd2_metrics(df: DataFrame) -> DataFrame:
    """One row: total / current / expired versions."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_current")).alias("current_rows"),
        F.count_if(~F.col("is_current")).alias("expired_rows"),
    )


def change_counts(cur: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS,
                  tracked: Sequence[str] = TRACKED) -> DataFrame:
    """One row: incoming, matched keys, changed (null-safe and ``!=``), new keys,
    from one full outer join."""
    o = cur.select(*[F.col(k).alias(f"o_{k}") for k in keys], *[F.col(t).alias(f"o_{t}") for t in tracked],
                   F.lit(True).alias("_o"))
    n = new.select(*[F.col(k).alias(f"n_{k}") for k in keys], *[F.col(t).alias(f"n_{t}") for t in tracked],
                   F.lit(True).alias("_n"))
    j = o.join(n, [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys], "full_outer")
    both = F.col("_o").isNotNull() & F.col("_n").isNotNull()
    pairs = [(F.col(f"o_{t}"), F.col(f"n_{t}")) for t in tracked]
    return j.agg(
        F.count_if(F.col("_n").isNotNull()).alias("incoming_rows"),
        F.count_if(both).alias("matched_rows"),
        F.count_if(both & any_changed(pairs, True)).alias("changed_null_safe"),
        F.count_if(both & any_changed(pairs, False)).alias("changed_null_unsafe"),
        F.count_if(F.col("_o").isNull()).alias("new_keys"),
    )
