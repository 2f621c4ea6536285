"""Whitening of embeddings by weighted multiplicity covariance.

Entries are put on a grid (``x = floor(256 c)``), rows of equal x are grouped, and everything after is done once for each
distinct x:

1. group equal x, with their count; the fit weight of a group is its count or one
2. exact sums in each dimension; then the centred vectors are multiplied, each task adding up its own matrix
3. eigenvectors of the covariance on the driver (dimension squared numbers, whatever the rows)
4. each distinct x is projected once; rows get the result back by a join on x

Rows of an x that holds more than a thousandth of all rows (a thousand such x at most) meet it by broadcast, the others by
a shuffle on x, so one very common vector never lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import prepare, stored, trim

#: Steps of the grid in one unit.
SCALE = 256
COMPONENTS = 4
#: An x is common when more than 1 / HOT_SHARE of all rows hold it (and at least HOT_ROWS do); HOT_SHARE bounds how many there are.
HOT_SHARE = 1000
HOT_ROWS = 1000
#: Least variance of a component, as a share of the whole.
LEAST = 1e-12
_LONG = 2**63 - 1


def grid(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that take part: a vector that is not null, not empty, of finite entries whose x fit a long."""
    entries = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    limit = F.lit(2.0**63)
    fits = F.coalesce(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < limit)), F.lit(False))
    return vectors.select(F.col(f"`{id_col}`").alias("vec_id"), entries.alias("c")).filter(fits & (F.size("c") > 0)) \
        .select("vec_id", F.transform("c", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def exact_sums(groups: DataFrame, d: int) -> tuple[int, list[int]]:
    """(sum of weights, weighted sum of each dimension), in whole numbers of any size."""
    part = groups.select(F.posexplode("x").alias("at", "x"), "weight").groupBy("at").agg(
        F.sum(F.col("x").cast("decimal(38,0)") * F.col("weight").cast("decimal(19,0)")).alias("s"), F.sum("weight").alias("w"))
    sums, weight = [0] * d, 0
    for r in part.collect():
        sums[r["at"]], weight = int(r["s"]), r["w"]
    return weight, sums


def covariance(groups: DataFrame, mean: np.ndarray, weight: int) -> np.ndarray:
    """Weighted covariance: vectors are centred, then multiplied; one matrix a task, added up by cell."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            centred = _matrix(batch.column(0), d) - mean
            total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at])], names=["cell", "v"])
        trim()

    cells = groups.select("x", "weight").mapInArrow(run, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(d * d)
    for r in cells.collect():
        out[r["cell"]] = r["v"]
    out = out.reshape(d, d) / weight
    return (out + out.T) / 2


def components(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of at most ``most`` components that vary at all. Of the two
    signs of an eigenvector the one whose largest entry is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = [i for i in range(len(values) - 1, -1, -1) if values[i] > LEAST * max(np.trace(cov), 0)][:most]
    values, vectors = values[order], vectors[:, order]
    if len(order):
        vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0) < 0, -1, 1)
    return values, vectors


def _project(sums: list[int], n: int, mean: np.ndarray, transform: np.ndarray):
    """Whitened values and the exact squared deviation of each x. Whole numbers go by 64 bits where they fit, else by Python's."""
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, object)
        small = None if max(map(abs, sums), default=0) >= 2**62 else np.array(sums, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            most = n * int(max(x.max(initial=0), -int(x.min(initial=0)))) + max(map(abs, sums), default=0)
            if small is not None and most < 2**62 and d * most * most < 2**62:
                deviation = (np.square(n * x - small)).sum(1).tolist()
            else:
                deviation = [int(v) for v in np.square(n * x.astype(object) - exact).sum(1)]
            white = (x - mean) @ transform
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([v if v <= _LONG else None for v in deviation], pa.int64()), pa.array([str(v) for v in deviation], pa.string()),
                pa.array(white.tolist(), pa.list_(pa.float64()))], names=["x", "rows", "deviation", "deviation_exact", "white"])
        trim()
    return run


def identity_error(white: DataFrame, k: int, weight: int) -> float:
    """Largest entry of |covariance of the whitened values - identity| over the fit list, centred first."""
    if not k:
        return 0.0
    mean = np.array(white.agg(*[F.sum(F.col("white")[i] * F.col("weight")) for i in range(k)]).first(), float) / weight
    part = [(F.col("white")[i] - F.lit(float(mean[i]))) * (F.col("white")[j] - F.lit(float(mean[j]))) * F.col("weight")
            for i in range(k) for j in range(i, k)]
    cov = np.array(white.agg(*map(F.sum, part)).first(), float) / weight
    return float(np.abs(cov - np.array([float(i == j) for i in range(k) for j in range(i, k)])).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", weights: str = "one",
           most: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, x, n, rows, deviation, deviation_exact, whitened (array), explained (array) and identity_error of each row that takes part.

    ``weights``: "one" fits on each distinct x once, "count" on all rows. n is the weight of the fit list, rows how many
    rows hold the x. deviation is null where it exceeds a long; deviation_exact has its digits at any size. Out of the fit and the
    result stay null and empty vectors, vectors with null or non-finite entries, entries whose x exceeds a long, and vectors of
    another length than most rows have (ties: the longest). Repeated rows and ids each come back. Components without
    variance are left out: the arrays are empty where all x are equal. No rows in, no rows out; other columns are not read.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    spark = prepare(vectors.sparkSession)
    rows = grid(vectors, id_col, vector, scale)
    lengths = [(r["n"], r["d"]) for r in rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).limit(1).collect()]
    total, d = lengths[0] if lengths else (0, 0)
    rows = rows.filter(F.size("x") == d)
    weight = F.col("rows") if weights == "count" else F.lit(1).cast("bigint")
    groups = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")).withColumn("weight", weight), "whiten-groups")

    n, sums = exact_sums(groups, d)
    mean = np.array([s / n for s in sums]) if n else np.zeros(d)
    cov = covariance(groups, mean, n) if n else np.zeros((0, 0))
    values, axes = components(cov, most)
    transform = axes / np.sqrt(values)
    explained = F.array(*[F.lit(float(v / np.trace(cov))) for v in values]).cast("array<double>")

    out = "x array<bigint>, rows bigint, deviation bigint, deviation_exact string, white array<double>"
    white = stored(groups.select("x", "rows").mapInArrow(_project(sums, n, mean, transform), out), "whiten-distinct")
    error = identity_error(white.withColumn("weight", weight), len(values), n)

    hot = max(HOT_ROWS, total // HOT_SHARE)
    common = white.filter(F.col("rows") > hot)                     # HOT_SHARE of them at most
    rest = white.filter(F.col("rows") <= hot)
    back = rows.join(F.broadcast(common), "x").unionByName(
        rows.join(F.broadcast(common.select("x")), "x", "left_anti").join(rest.hint("merge"), "x"))
    return back.select("vec_id", "x", F.lit(n).cast("bigint").alias("n"), "rows", "deviation", "deviation_exact",
                       F.col("white").alias("whitened"), explained.alias("explained"), F.lit(error).alias("identity_error"))
