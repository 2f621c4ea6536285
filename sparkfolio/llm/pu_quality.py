"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all other text is unlabelled, a mixture. With the class prior p estimated
from both, a logistic model minimises the non-negative unbiased risk

    p * R(positives, +1) + max(0, R(unlabelled, -1) - p * R(positives, -1)).

The features describe a text's form (lengths, case, signs, repeated lines and words), each as a few steps.

Each text is described once, by ten numbers that are written to a table; all else reads that table. Risks, their slopes
and the tails of the scores are sums over all positives and all unlabelled rows, each task adding up its own; the driver
takes Newton steps on these sums, whose number does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import prepare, stored
from sparkfolio.llm.words import Words, range_hash, slices

#: Most Newton steps, step lengths tried at once, slope at which to stop, weight decay.
STEPS = 25
LENGTHS = tuple(0.5 ** i for i in range(8))
FLAT = 1e-5
DECAY = 1e-3
#: How sharply the unlabelled part of the risk is cut off at zero: by less than 1 / SHARP.
SHARP = 500.0
#: Places of the score axis at which the tails are counted.
BINS, REACH = 4096, 40.0
#: Steps of each feature.
KNOTS = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7)
NAMES = ("upper", "symbols", "exclamations", "digits", "repeated_words", "echoes", "repeated_lines", "long_words", "short_words", "few_words")

_IS = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
_UPPER = _IS("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SYMBOL = _IS("#*$%&|<>@^~=_\\{}[]")
_LOUD = _IS("!?")
_DIGIT = _IS("0123456789")
_LETTER = _UPPER | _IS("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0xC0)


def _share(total: np.ndarray, of: np.ndarray) -> np.ndarray:
    return total / np.maximum(of, 1)


def describe(words: Words) -> np.ndarray:
    """A row of ``NAMES`` for each text; all zero but the last for a text without words."""
    texts = len(words.first) - 1
    sums = lambda flag: np.diff(np.concatenate(([0], np.cumsum(flag)))[words.bounds])
    data, n = words.data, words.n
    letters = sums(_LETTER[data])
    hashes = words.hashes()
    owner = words.owner()
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(hashes), bool)
    echo = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    per_text = lambda flag: np.bincount(owner[flag], minlength=texts)
    size = words.ends - words.starts
    # lines: from one line break to the next, within a text
    cuts = np.unique(np.concatenate((words.bounds, np.flatnonzero(data == 10) + 1)))
    start, end = cuts[:-1], cuts[1:]
    full = np.searchsorted(words.starts, end) > np.searchsorted(words.starts, start)
    start, end = start[full], end[full]
    end = end - (data[np.maximum(end - 1, 0)] == 10) if len(end) else end
    line = range_hash(data.astype(np.uint64) + np.uint64(7), start, end) if len(start) else np.zeros(0, np.uint64)
    of = np.searchsorted(words.bounds, start, side="right") - 1
    order_l = np.lexsort((line, of))
    again = np.zeros(len(line), bool)
    if len(line) > 1:
        again[1:] = (line[order_l][1:] == line[order_l][:-1]) & (of[order_l][1:] == of[order_l][:-1])
    lines, lines_again = np.bincount(of, minlength=texts), np.bincount(of[order_l][again], minlength=texts)
    repeated = np.bincount(owner[order][same], minlength=texts) if len(same) else np.zeros(texts)
    # words used again are normal in long texts: what counts is what exceeds the growth of a natural vocabulary
    excess = np.maximum(0, _share(repeated, n) - 0.6) * 2.5
    return np.column_stack((
        _share(sums(_UPPER[data]), letters), _share(sums(_SYMBOL[data]), n), _share(sums(_LOUD[data]), n),
        _share(sums(_DIGIT[data]), n) / 4, excess, _share(per_text(echo), n), _share(lines_again, lines),
        _share(per_text(size > 15), n), np.maximum(0, 4 - _share(per_text(size > 0) * 0 + np.bincount(owner, weights=size, minlength=texts), n)) / 4,
        np.maximum(0, 10 - n) / 10)).astype(np.float64)


def steps(x: np.ndarray) -> np.ndarray:
    """Each feature as the share of each step it has climbed."""
    low = np.array((0.0, *KNOTS[:-1]))
    out = np.clip((x[:, :, None] - low) / (np.array(KNOTS) - low), 0, 1)
    return np.hstack((np.ones((len(x), 1)), out.reshape(len(x), -1)))


def _soft(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _bins(z: np.ndarray) -> np.ndarray:
    return np.bincount(np.clip((z + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int64), minlength=BINS)


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in the unlabelled text, from the counts of both by score: the least ratio of the shares that score
    above a threshold, over thresholds that a tenth of the positives reach or more."""
    p, u = (np.cumsum(h[::-1])[::-1] / max(h.sum(), 1) for h in (positive, unlabelled))
    far = p >= 0.1
    return float(np.clip((u[far] / p[far]).min(initial=1.0), 0.01, 0.99))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """:func:`prior_of` the counts of scores."""
    return prior_of(_bins(positive), _bins(unlabelled))


class Sums:
    """Sums over the rows (x, kind 1: positive, 0: unlabelled) of a table, by Spark."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("x", "kind")

    def _add(self, size: int, part) -> np.ndarray:
        """The sum over all batches of ``part(steps of a kind's rows, kind)``, an array of ``size`` numbers for each kind."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size))
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    cut = batch.slice(at, 4096)
                    x = steps(cut.column(0).flatten().to_numpy().reshape(-1, len(NAMES)))
                    kind = cut.column(1).to_numpy()
                    for k in (0, 1):
                        if (kind == k).any():
                            total[k] += part(x[kind == k])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at])], ["at", "v"])

        out = np.zeros(2 * size)
        for r in self.rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
            out[r["at"]] = r["v"]
        return out.reshape(2, size)

    def counts(self) -> np.ndarray:
        """Rows of each kind."""
        return self._add(1, lambda x: len(x))[:, 0]

    def tails(self, w: np.ndarray) -> np.ndarray:
        return self._add(BINS, lambda x: _bins(x @ w))

    def losses(self, ws: list[np.ndarray]) -> np.ndarray:
        """(kind, w): sums of softplus(z), then of softplus(-z)."""
        def part(x: np.ndarray) -> np.ndarray:
            z = x @ np.array(ws).T
            return np.concatenate([_soft(z).sum(0), _soft(-z).sum(0)])
        return self._add(2 * len(ws), part)

    def slopes(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind: sums of z's softplus and of -z's, of sigmoid(z) x and of sigmoid(-z) x, of the common second derivative)."""
        d = len(w)

        def part(x: np.ndarray) -> np.ndarray:
            z = x @ w
            q = _sigmoid(z)
            return np.concatenate([[_soft(z).sum(), _soft(-z).sum()], q @ x, (1 - q) @ x, ((x * (q * (1 - q))[:, None]).T @ x).ravel()])
        out = self._add(2 + 2 * d + d * d, part)
        return out[:, :2], out[:, 2:2 + 2 * d].reshape(2, 2, d), out[:, 2 + 2 * d:].reshape(2, d, d)


def _newton(sums: Sums, n: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights of least risk: of positives against unlabelled text (no ``prior``), or the non-negative unbiased risk."""
    def risk(loss: np.ndarray) -> np.ndarray:
        up, down = loss[:, 0] / n[:, None], loss[:, 1] / n[:, None]          # mean softplus of z and of -z: (kind, w)
        if prior is None:
            return down[1] + up[0]
        return prior * down[1] + _soft(SHARP * (up[0] - prior * up[1])) / SHARP

    w = np.zeros(1 + len(NAMES) * len(KNOTS))
    for _ in range(STEPS):
        loss, slope, bend = sums.slopes(w)
        loss, slope, bend = loss / n[:, None], slope / n[:, None, None], bend / n[:, None, None]
        if prior is None:
            g, h = slope[0, 0] - slope[1, 1], bend[0] + bend[1]
        else:                                                # where the unlabelled part is below zero it counts as none
            on, down = float(_sigmoid(SHARP * (loss[0, 0] - prior * loss[1, 0]))), slope[0, 0] - prior * slope[1, 0]
            g = on * down - prior * slope[1, 1]
            h = on * bend[0] + prior * (1 - on) * bend[1] + SHARP * on * (1 - on) * np.outer(down, down)
        g, h = g + DECAY * w, h + DECAY * np.eye(len(w))
        if np.abs(g).max() < FLAT:
            break
        step = -np.linalg.solve(h, g)
        tried = [w, *(w + a * step for a in LENGTHS)]
        found = risk(sums.losses(tried).reshape(2, 2, len(tried))) + DECAY / 2 * np.array([t @ t for t in tried])
        best = int(np.argmin(found))
        if best == 0 or found[0] - found[best] < 1e-9:
            break
        w = tried[best]
    return w


def learn(rows: DataFrame) -> np.ndarray | None:
    """Weights of the model from the table of (x, kind); None without positives or without unlabelled text."""
    sums = Sums(rows)
    n = sums.counts()
    if not n.all():
        return None
    tails = sums.tails(_newton(sums, n, None))
    return _newton(sums, n, prior_of(tails[1], tails[0]))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in slices(batch.column("text")):
            rows = describe(words)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * len(NAMES), pa.int32()), pa.array(rows.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], flat], ["doc_id", "x"])


def quality(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id, held_out, score (0 to 1).

    Positives are documents with quality 1 in ``labels`` (doc_id, quality 0/1) where ``held_out`` (a boolean Column over
    doc_id) is not true; everything else that is not held out is unlabelled. Without positives or unlabelled text every score is
    0.5. Null and empty texts are scored by their lack of words; rows that repeat score alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    good = labels.filter((F.col("quality") == 1) & ~held_out).select(F.col("doc_id").cast("long")).distinct().withColumn("good", F.lit(1))
    described = texts.mapInArrow(_described, "doc_id long, x array<double>").join(good, "doc_id", "left").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    described = stored(described.select("doc_id", "held_out", "x", F.when(~F.col("held_out"), F.coalesce("good", F.lit(0))).alias("kind")), "described")
    weights = learn(described.filter("kind is not null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, len(NAMES))
            score = np.full(len(x), 0.5) if weights is None else _sigmoid(steps(x) @ weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["doc_id", "held_out", "score"])

    return described.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id long, held_out boolean, score double")
