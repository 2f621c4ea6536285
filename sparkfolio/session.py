"""Session and scratch-storage helpers.

Nothing here runs at import time. On a cluster the session comes from the
launcher and ``spark.checkpoint.dir`` names shared storage; only when it is
unset (local tests, the driver smoke run) do we point it at a local folder.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sparkfolio.sources.paths import delete_at_exit, delete_path, folders

RUN_PREFIX = "sparkfolio-run-"
_RUNS: set[str] = set()
_HOLDERS: Counter[str] = Counter()
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch scope", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sparkfolio") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local data is tiny: with the 1MB default AQE folds a whole shuffle
        # into one task and the window stages run on one core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32KB")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it is unset, a local master gets a
    local one; a cluster has to name shared storage."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name shared storage on a cluster")
    base = configured or tempfile.mkdtemp(prefix="sparkfolio-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """This run's scratch folder under the shared checkpoint folder; it goes when the driver ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{RUN_PREFIX}{spark.sparkContext.applicationId}"
    if root not in _RUNS:
        _RUNS.add(root)
        delete_at_exit(spark, root)
    return root


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder in the run's scratch folder, held by the :func:`scratch_scope` it is made in."""
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    hold(path)
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    else:
        _HOLDERS[path] += 1                                  # the run holds it to its end
    return path


def hold(path: str) -> str:
    """One holder more for a scratch folder; each :func:`release` takes one away."""
    _HOLDERS[path] += 1
    return path


def release(spark: SparkSession, path: str) -> bool:
    """One holder less; the folder goes with the last one. True if it went."""
    _HOLDERS[path] -= 1
    if _HOLDERS[path] > 0:
        return False
    del _HOLDERS[path]
    return delete_path(spark, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch folders made inside go at the end, but for those that something else holds. Results that read them
    must be read, or written, inside."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)
        for path in made:
            release(spark, path)


def clean_scratch(spark: SparkSession, older_than_hours: float = 72) -> list[str]:
    """Remove what runs that died left: scratch folders of other runs unchanged for so long. A run changes its folder
    whenever it makes a scratch folder, so choose an age above the longest pause of a run."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    own, limit = run_folder(spark).rsplit("/", 1)[1], (time.time() - older_than_hours * 3600) * 1000
    gone = [name for name, changed in folders(spark, root) if name.startswith(RUN_PREFIX) and name != own and changed < limit]
    for name in gone:
        delete_path(spark, f"{root}/{name}")
    return gone


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written to a scratch folder and read back: what reads it next reads only its own columns, and a lost
    executor does not run its lineage again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage and cut its lineage (never a local checkpoint)."""
    return stored(df, "checkpoint")


def unique_name(prefix: str) -> str:
    """A unique catalog table name for a run."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
