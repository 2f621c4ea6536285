"""Mixing sources to target weights.

The words of each source form one stream, its documents one after the other, cut into blocks of ``BLOCK_WORDS`` words, the
last one shorter. A source needs as many slots as its blocks, taken in order, hold its target in words; the last slot takes
the beginning of its block only, so that each source meets its target to the word, however small it is.

Output shards hold ``SHARD_SLOTS`` slots each. How many slots of each source a shard holds is a multinomial draw, given that all
shards together hold what each source needs: the slots of a range of shards are split between its two halves by a
multivariate hypergeometric draw, from all shards down to one, with a generator of its own for each range. So any task draws
its shards without the others', and knows the numbers of their slots. Slot ``j`` of a source takes block
``permutation[j // blocks](j % blocks)``, where the permutations are keyed Feistel networks on the block numbers, so each
pass over a source takes every block once. Blocks are joined to slots by their number.

The recipe (a row for each source) is the one thing sent to every task; its size is checked against ``MAX_SOURCES``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkfolio.llm.spark_env import map_texts, prepare, stored, values
from sparkfolio.llm.words import mix, slices

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its size.
MAX_REPEATS = 3
SEED = 20240311
MAX_SOURCES = 100_000
#: Documents that one window partition of a running sum holds on average.
RUN_ROWS = 50_000
#: Words of equal rows that are placed in the stream as one piece.
COPY_WORDS = 1_000_000
#: Shards that one row of the draw covers, and slots beyond which a range is split in proportion, without a draw.
DRAW_SHARDS = 64
MOST_DRAWN = 10**9


def _running(df: DataFrame, by: str, bucket: Column, order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` in all rows before, within ``by`` and in the order (bucket, *order): sums of
    buckets first, then rows within a bucket, so that no task orders a whole group."""
    df = df.withColumn("_bucket", bucket)
    sums = df.groupBy(by, "_bucket").agg(F.sum(value).alias("_n"))
    sums = sums.select(by, "_bucket", (F.sum("_n").over(Window.partitionBy(by).orderBy("_bucket")) - F.col("_n")).alias("_before"))
    within = Window.partitionBy(by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn("_upto", F.sum(value).over(within)).join(sums, [by, "_bucket"])
            .withColumn(out, F.col("_before") + F.col("_upto") - F.col(value)).drop("_bucket", "_upto", "_before"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [words.n for _, _, words in slices(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("source"),
                                          pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())],
                                         ["row", "doc_id", "source", "size"])


def recipe(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, number (by code point, null last), source_size, target. Weights repeat over the sources; targets share all
    words by weight and stop at ``MAX_REPEATS`` times the source's size, the excess going to the others by weight."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())       # a row for each source
    table = total.withColumn("number", (F.row_number().over(order) - 1).cast("int")).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1).cast("double")).withColumn(
        "cap", (F.col("source_size") * MAX_REPEATS).cast("double"))
    full = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    table = table.withColumn("level", level).withColumn("free", F.col("level") <= F.col("cap") / F.col("weight"))
    share = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "number", "level"))).over(everything)["level"]
    return table.withColumn("share", share).select(
        "source", "number", "source_size", F.least("cap", F.coalesce(F.col("share") * F.col("weight"), "cap")).alias("target"))


def permute(index: np.ndarray, blocks: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..blocks-1 for each key: four Feistel rounds on the next even power of two, walked on
    until the value is below ``blocks``; ``back`` gives its inverse."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(blocks, 2).astype(float))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            if back:
                left, right = right ^ (mix(left + key[todo] * np.uint64(7 - 2 * turn)) & mask[todo]), left
            else:
                left, right = right, left ^ (mix(right + key[todo] * np.uint64(2 * turn + 1)) & mask[todo])
        out[todo] = left << half[todo] | right
        todo = todo[out[todo] >= blocks[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _key(number: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The key of a source's permutation in one pass over it."""
    return mix(mix(number.astype(np.uint64) + np.uint64(SEED)) + turn.astype(np.uint64))


def quotas(size: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, words of the last slot or 0 for all of its block) that give each source, in the order of its number, its target in words. Targets are
    rounded so that their sum stays within a word."""
    upto = np.floor(np.cumsum(target) + 0.5)
    words = np.clip(np.diff(upto, prepend=0), np.floor(target + 1e-6), np.ceil(target - 1e-6)).astype(np.int64)
    blocks = -(-size // BLOCK_WORDS)
    turn, rest = words // np.maximum(size, 1), words % np.maximum(size, 1)
    missing = blocks * BLOCK_WORDS - size                    # words that the last block is short of
    number = np.arange(len(size))
    last = np.zeros(len(size), np.int64)                     # place of the last block in the pass that is not whole
    some = np.flatnonzero(blocks > 0)
    last[some] = permute(blocks[some] - 1, blocks[some], _key(number[some], turn[some]), back=True)
    n = -(-rest // BLOCK_WORDS)
    n = np.where(last < n, -(-(rest + missing) // BLOCK_WORDS), n)
    end = rest - np.maximum(n - 1, 0) * BLOCK_WORDS + np.where(last < n - 1, missing, 0)
    return turn * blocks + n, np.where(rest > 0, end, 0)


def split(number: np.ndarray, counts: np.ndarray, left: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of each source's slots the first ``left`` of a range's slots are."""
    total = int(counts.sum())
    if total > MOST_DRAWN:                                   # numpy draws no further; there the draw would hardly show
        part = counts * (left / total)
        out = np.minimum(np.floor(part).astype(np.int64), counts)
        short = left - int(out.sum())
        out[np.argsort(out - part, kind="stable")[:short]] += 1
        return out
    return np.random.default_rng((SEED, *seed)).multivariate_hypergeometric(counts, left, method="marginals")


def draw(need: np.ndarray, first_shard: int, last_shard: int, size: int, how: Callable = split) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, numbers of its sources, number of its first slot of each, its slots of each) for first_shard <= shard < last_shard, shards of ``size`` slots."""
    n = int(need.sum())
    number = np.flatnonzero(need)
    todo = [(0, -(-n // size), number, np.zeros(len(number), np.int64), need[number])]
    while todo:
        low, high, number, first, counts = todo.pop()
        if high <= first_shard or low >= last_shard:
            continue
        if high - low == 1:
            yield low, number, first, counts
            continue
        middle = (low + high) // 2
        left = how(number, counts, min(n, middle * size) - low * size, (low, high))
        right = counts - left
        for a, b, start, part in ((middle, high, first + left, right), (low, middle, first, left)):
            some = part > 0
            todo.append((a, b, number[some], start[some], part[some]))


def slots(table: DataFrame) -> DataFrame:
    """The mix: number (of the source), block, shard, slot (within the source) of every slot, and cut: the words that the
    source's last slot takes from the beginning of its block (0: the slot takes the whole block)."""
    spark = table.sparkSession
    rows = table.orderBy("number").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    size = np.array([r.source_size for r in rows], np.int64)
    blocks = -(-size // BLOCK_WORDS)
    need, end = quotas(size, np.array([r.target for r in rows], float))
    shard_slots, each, how = SHARD_SLOTS, DRAW_SHARDS, split
    shards = -(-int(need.sum()) // shard_slots)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in batch["id"]:
                for shard, number, first, n in draw(need, int(at) * each, int(at + 1) * each, shard_slots, how):
                    slot = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                    number = np.repeat(number, n)
                    block = permute(slot % blocks[number], blocks[number], _key(number, slot // blocks[number]))
                    yield pd.DataFrame({"number": number, "block": block, "shard": shard, "slot": slot,
                                        "cut": np.where(slot == need[number] - 1, end[number], 0)})

    return spark.range(-(-shards // each)).mapInPandas(fill, "number int, block long, shard long, slot long, cut int")


#: What names a document, with its type.
_KEY = ("doc_id long", "source string", "text string")


def keyed(docs: DataFrame, name: str = "row", every: bool = False) -> DataFrame:
    """``docs`` with the column ``name``: hashes that name equal rows alike in every run of a task. Rows are equal in id,
    source and text, or (``every``) in all columns. A null is a value of its own. Rows come in the same order either way."""
    known = [F.col(c).cast(t) for c, t in map(str.split, _KEY)]
    known = [x for c in known for x in (c.isNull(), c)]
    return docs.withColumn(name, F.struct(F.xxhash64(*known).alias("a"), F.xxhash64(F.lit(SEED), *known).alias("b"),
                                          (F.xxhash64(*values(docs)) if every else F.lit(0).cast("long")).alias("c")))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). Documents: row, doc_id, size, number, source_size, target, first (the place in the source's
    stream), copy and copies: a row stands for ``copies`` equal documents, numbered from ``copy`` on, one after the other
    in the stream. Pieces: row, copy, block, at, words, times, shards: words of one document that lie in one block, and
    the shards that take them."""
    prepare(docs.sparkSession)
    sizes = keyed(docs, every=every).select("row", F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")) \
        .mapInArrow(_sizes, "row struct<a:bigint,b:bigint,c:bigint>, doc_id long, source string, size long")
    per = F.greatest(F.lit(1), F.lit(COPY_WORDS).cast("long") / F.greatest("size", F.lit(1))).cast("long")
    sizes = sizes.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.first("size").alias("size"),
                                     F.count(F.lit(1)).alias("rows")).withColumn("per", per)
    sizes = sizes.select("row", "doc_id", "source", "size", "rows", "per", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(rows - 1) div per"))).alias("chunk")) \
        .select("row", "doc_id", "source", "size", (F.col("chunk") * F.col("per")).alias("copy"),
                F.least("per", F.col("rows") - F.col("chunk") * F.col("per")).alias("copies")).withColumn("run", F.col("size") * F.col("copies"))
    sizes = stored(sizes, "sizes")
    table = stored(recipe(sizes.select("source", F.col("run").alias("size")), weights), "recipe")
    known = sizes.join(table, sizes["source"].eqNullSafe(table["source"])) \
        .select("row", "doc_id", "size", "copy", "copies", "run", "number", "source_size", "target")
    n = sizes.count()
    placed = _running(known, "number", F.pmod(F.xxhash64("row.a", "copy", F.lit(SEED)), F.lit(max(1, n // RUN_ROWS) * 4)), ["row", "copy"], "run", "first")
    placed = stored(placed, "placed")
    whole = F.col("cut") == 0
    used = slots(table).groupBy("number", "block").agg(                       # a block has MAX_REPEATS slots at most
        F.sort_array(F.collect_list(F.when(whole, F.col("shard")))).alias("shards"), F.max(F.when(~whole, F.col("shard"))).alias("cut_shard"), F.max("cut").alias("cut"))
    low, high = F.expr(f"first div {BLOCK_WORDS}"), F.expr(f"(first + run - 1) div {BLOCK_WORDS}")
    start = F.greatest(F.col("first"), F.col("block") * BLOCK_WORDS)
    runs = (placed.filter("run > 0").select("row", "number", "first", "size", "run", "copy", F.explode(F.sequence(low, high)).alias("block"))
            .withColumn("lo", start - F.col("first"))
            .withColumn("hi", F.least(F.col("first") + F.col("run"), (F.col("block") + 1) * BLOCK_WORDS) - F.col("first"))
            .join(used.hint("merge"), ["number", "block"], "left"))           # as many rows as blocks: not one to broadcast
    # the copies that lie in a block, and of each the words in the part that the last slot takes, then the others
    runs = runs.withColumn("k", F.explode(F.sequence(F.expr("lo div size"), F.expr("(hi - 1) div size"))))
    begin, stop = F.greatest("lo", F.col("k") * F.col("size")), F.least("hi", (F.col("k") + 1) * F.col("size"))
    border = F.least(stop, F.greatest(begin, F.col("block") * BLOCK_WORDS + F.coalesce("cut", F.lit(0)) - F.col("first")))
    shards = F.coalesce("shards", F.array().cast("array<bigint>"))
    both = F.when(F.col("cut_shard").isNotNull(), F.array_append(shards, F.col("cut_shard"))).otherwise(shards)
    piece = lambda a, b, by: F.struct((a - F.col("k") * F.col("size")).alias("at"), (b - a).alias("words"), F.size(by).cast("long").alias("times"), by.alias("shards"))
    parts = F.array(piece(begin, border, both), piece(border, stop, shards))
    pieces = runs.select("row", (F.col("copy") + F.col("k")).alias("copy"), "block", F.inline(F.filter(parts, lambda p: p["words"] > 0)))
    return placed, pieces


def _each(placed: DataFrame, *columns: str) -> DataFrame:
    """One row for each document."""
    return placed.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))) \
        .select("row", *columns, (F.col("copy") + F.col("_k")).alias("copy"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id long, text string, source string; other columns are ignored): doc_id, size,
    source_size, target, taken (words of it that the mix takes, repeats counted), shards (those that hold any of them).

    Null and empty texts have no words and are not taken; a null source is a source of its own, the last one; rows that repeat
    are documents of their own, as are rows without an id; an empty table gives no rows. The same input gives the same mix.
    """
    placed, pieces = plan(docs, weights)
    taken = pieces.filter("times > 0").groupBy("row", "copy").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("shards")))).alias("shards"))
    return _each(placed, "doc_id", "size", "source_size", "target").join(taken, ["row", "copy"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("shards", F.array().cast("array<bigint>")).alias("shards"))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each document from its pieces: pass by pass, the pieces that the pass takes."""
    for batch in batches:
        out = []
        uses = batch.column("__uses")
        for a, b, words in slices(batch.column("text")):
            raw = words.data.tobytes()
            for i in range(a, b):
                f, t = int(words.first[i - a]), int(words.first[i - a + 1])
                begin = words.starts[f:t].tolist()
                begin[:1], stop = [int(words.bounds[i - a])], int(words.bounds[i - a + 1])
                begin.append(stop)
                taken = [u for u in uses[i].as_py()]
                passes = []
                for turn in range(max((u["times"] for u in taken), default=0)):
                    passes.append(b"".join(raw[begin[u["at"]]:begin[u["at"] + u["words"]]] for u in taken if u["times"] > turn))
                out.append(b"\n".join(passes).decode())
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(out, pa.string())).drop_columns(["__uses"])


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``docs`` as the mix takes them: a document's text holds what each pass over its source takes of it, passes on lines of
    their own; documents of which nothing is taken go. ``n_chars``, if there is one, follows the new text. Each row that
    repeats is taken for itself; null and empty texts go; an empty table stays empty."""
    _, pieces = plan(docs, weights, every=True)
    uses = pieces.filter("times > 0").groupBy("row", "copy").agg(F.sort_array(F.collect_list(F.struct("at", "words", "times"))).alias("uses"))
    names = [f.name for f in docs.schema.fields]
    texts = docs.withColumn("text", F.col("text").cast("string"))
    # equal rows are equal in all columns: one of them stands for each copy
    one = keyed(texts, "__row", every=True).dropDuplicates(["__row"])
    out = one.join(uses.select(F.col("row").alias("__row"), F.col("uses").alias("__uses")), "__row").select(*[F.col(f"`{c}`") for c in names], "__uses")
    out = map_texts(out, _rebuild, keep=1)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
