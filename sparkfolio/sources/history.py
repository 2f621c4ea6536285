"""Stored SCD2 history, copy on write.

Rows are kept in parts, one folder for each (is current, year of the report date) and run:

``parts/run=<id>/_current=<bool>/_period=<year>/``  Parquet files of one part
``manifests/version=<n>/``                          one row for each part that version n consists of

A key holds the report date, so a batch can only meet current rows of its own years. A merge finds the years in which
anything changes, reads and rewrites the current parts of these years alone, adds what it closes as new parts, and
publishes a manifest; every other part keeps its files, closed history above all. A reader opens the parts of a manifest and sees one version
whole; a merge that dies leaves the last version as it was. One merge runs at a time.

:func:`vacuum` drops old manifests and the parts that no kept one names.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.functions.columns import any_changed
from sparkfolio.operators import scd2
from sparkfolio.schemas import SILVER_FUNDAMENTALS
from sparkfolio.sources.paths import delete_path, folders, partition_folder, path_exists

MANIFEST = "is_current boolean, period int, path string, n_rows bigint"
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"
#: Closed parts of one year that may pile up before a merge in that year joins them.
MAX_CLOSED_PARTS = 16


@dataclass(frozen=True)
class Part:
    is_current: bool
    period: int | None
    path: str
    n_rows: int


def _period(date: str = "report_date") -> Column:
    return F.year(date)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    base = f"{root.rstrip('/')}/manifests"
    found = sorted(int(name.removeprefix("version=")) for name, _ in folders(spark, base) if name.startswith("version="))
    return [v for v in found if path_exists(spark, f"{base}/version={v}/_SUCCESS")]


def parts(spark: SparkSession, root: str, version: int | None = None) -> list[Part]:
    """Parts of a version (the last one by default): two for each year and a few closed ones more."""
    found = versions(spark, root)
    if not found or (version is not None and version not in found):
        return []
    rows = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifests/version={found[-1] if version is None else version}").collect()
    return sorted((Part(*r) for r in rows), key=lambda p: p.path)


def _read(spark: SparkSession, root: str, chosen: Sequence[Part]) -> DataFrame:
    if not chosen:
        return spark.createDataFrame([], SILVER_FUNDAMENTALS)
    return spark.read.schema(SILVER_FUNDAMENTALS).parquet(*[f"{root.rstrip('/')}/parts/{p.path}" for p in chosen])


def read_history(spark: SparkSession, root: str, version: int | None = None, current: bool | None = None,
                 periods: Sequence[int | None] | None = None) -> DataFrame:
    """Rows of a version. ``current`` and ``periods`` choose parts: others are not opened."""
    return _read(spark, root, [p for p in parts(spark, root, version)
                               if (current is None or p.is_current == current) and (periods is None or p.period in periods)])


def _write(spark: SparkSession, rows: DataFrame, root: str) -> list[Part]:
    """Write rows as new parts: one for each (is current, year) they hold."""
    run = f"run={uuid.uuid4().hex[:12]}"
    place = f"{root.rstrip('/')}/parts/{run}"
    tagged = rows.select(*scd2.HISTORY_COLUMNS).withColumns({"_current": F.coalesce("is_current", F.lit(False)), "_period": _period()})
    tagged.hint("rebalance", "_current", "_period").write.partitionBy("_current", "_period").parquet(place)
    written = spark.read.schema("_current boolean, _period int").parquet(place)          # footers and folder names alone
    counts = written.groupBy("_current", "_period").agg(F.count(F.lit(1)).alias("n")).collect()      # two for each year

    def folder(current: bool, period: int | None) -> str:
        year = f"_period={NO_PERIOD}" if period is None else partition_folder(spark, "_period", str(period))
        return f"{run}/_current={str(current).lower()}/{year}"

    return [Part(r["_current"], r["_period"], folder(r["_current"], r["_period"]), r["n"]) for r in counts]


def _publish(spark: SparkSession, root: str, chosen: Sequence[Part]) -> int:
    version = max(versions(spark, root), default=0) + 1
    rows = spark.createDataFrame([(p.is_current, p.period, p.path, p.n_rows) for p in chosen], MANIFEST)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/manifests/version={version}")
    return version


def start(spark: SparkSession, root: str, history: DataFrame) -> int:
    """Store a history for the first time. Of several current versions of a key the newest stays open."""
    if versions(spark, root):
        raise ValueError(f"{root} holds a history already")
    history = scd2.upgrade_history(history)
    batch = spark.createDataFrame([], SILVER_FUNDAMENTALS).drop("is_current", "expiration_date")
    return _publish(spark, root, _write(spark, scd2.scd2_merge(history, batch, "1970-01-01"), root))


def changed_periods(current: DataFrame, new: DataFrame, null_safe: bool = True,
                    reappend_unchanged: bool = False) -> dict[int | None, tuple[int, int]]:
    """{year: (changed keys, new keys)} for the years in which the batch changes anything."""
    o = current.select(*[F.col(k).alias(f"o_{k}") for k in scd2.KEYS], *[F.col(t).alias(f"o_{t}") for t in scd2.TRACKED], F.lit(True).alias("_o"))
    j = new.join(o, [F.col(k) == F.col(f"o_{k}") for k in scd2.KEYS], "left")
    differ = F.col("_o").isNotNull() & any_changed([(F.col(f"o_{t}"), F.col(t)) for t in scd2.TRACKED], null_safe)
    counts = j.groupBy(_period().alias("period")).agg(
        F.count_if(differ).alias("changed"), F.count_if(F.col("_o").isNull()).alias("new"), F.count(F.lit(1)).alias("n"))
    touched = counts.filter((F.col("changed") > 0) | (F.col("new") > 0) | ((F.col("n") > 0) & F.lit(reappend_unchanged)))
    return {r.period: (r.changed, r.new) for r in touched.collect()}                 # one for each year


def merge(spark: SparkSession, root: str, new: DataFrame, as_of_date: str, null_safe: bool = True,
          reappend_unchanged: bool = False) -> dict:
    """Merge a batch (see :func:`~sparkfolio.operators.scd2.scd2_merge`) and publish the next version.

    Returns the version, the counts of changed and new keys, and the years rewritten. A batch that changes nothing
    publishes nothing. ``new`` is read twice; hand in a stored table if it is dear.
    """
    old = parts(spark, root)
    batch = scd2.first_per_group(new, list(scd2.KEYS), [F.col("ingestion_ts").desc_nulls_last()])
    years = {r.period for r in new.select(_period().alias("period")).distinct().collect()}
    touched = changed_periods(_read(spark, root, [p for p in old if p.is_current and p.period in years]), batch, null_safe, reappend_unchanged)
    counts = {"changed": sum(c for c, _ in touched.values()), "new": sum(n for _, n in touched.values())}
    if not touched:
        return {"version": max(versions(spark, root), default=0), **counts, "periods": []}
    closed = Counter(p.period for p in old if not p.is_current)
    gone = [p for p in old if p.period in touched and (p.is_current or closed[p.period] > MAX_CLOSED_PARTS)]
    inside = F.lit(False)
    for year in touched:
        inside = inside | _period().eqNullSafe(F.lit(year))
    merged = scd2.scd2_merge(_read(spark, root, gone), batch.filter(inside), as_of_date,
                             null_safe=null_safe, reappend_unchanged=reappend_unchanged)
    kept = [p for p in old if p not in gone]
    version = _publish(spark, root, [*kept, *_write(spark, merged, root)])
    return {"version": version, **counts, "periods": sorted(touched, key=lambda y: (y is not None, y))}


def publish_view(spark: SparkSession, root: str, name: str) -> None:
    """Point the catalog name at the last version: a view over the folders of its parts."""
    chosen = parts(spark, root)
    if not chosen:
        return
    if spark.catalog.tableExists(name) and (kind := spark.catalog.getTable(name).tableType) != "VIEW":
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is a {kind} table with files of its own")
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in SILVER_FUNDAMENTALS.fields)
    folder = f"{root.rstrip('/')}/parts/{{{','.join(p.path for p in chosen)}}}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}`")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drop all but the last ``keep`` versions and the parts that none of these names; returns the folders dropped.
    Folders of a merge that died go too, so none may be running."""
    root = root.rstrip("/")
    found = versions(spark, root)
    kept = found[-max(1, keep):]
    named = {p.path for v in kept for p in parts(spark, root, v)}
    dropped = []
    for version in found[:-max(1, keep)]:
        delete_path(spark, f"{root}/manifests/version={version}")
        dropped.append(f"manifests/version={version}")
    for run, _ in folders(spark, f"{root}/parts"):
        paths = [f"{run}/{c}/{y}" for c, _ in folders(spark, f"{root}/parts/{run}") for y, _ in folders(spark, f"{root}/parts/{run}/{c}")]
        used = [p for p in paths if p in named]
        for path in paths if used else [run]:
            if path not in named:
                delete_path(spark, f"{root}/parts/{path}")
                dropped.append(f"parts/{path}")
    return dropped
