"""N-gram Jaccard join: documents whose word 5-gram sets are similar.

Method: rare-first prefix filter. A document's shingles are ordered by
(document frequency, key); two sets with Jaccard similarity of at least
``percent / 100`` share a shingle in their prefixes. Shingles of one text only
cannot match, so they fill prefixes without being sent anywhere; most documents
have more of them than their prefix is long and drop out at once. Length and
positional filters act in the join on prefix shingles, the suffix filter (an
overlap bound from counts per hash partition) before a pair's one verification.

Texts with equal shingle sets share a node (a 64-bit digest of the set), so
copies meet in one aggregate and never form pairs. Before the exact join, linear
passes compare each document with one pivot per posting list and label what is
connected; the join then takes only pairs of different labels, so a large group
of near copies costs verifications in proportion to its size. No candidate is
capped. Links inside a component that is already connected need no
verification, because the result is the component.

Shingle keys have 52 bits. A collision can raise a frequency, which only
changes the order; verification compares the keys of two documents, where a
false match has a chance below 1e-9 for documents of 2,000 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm import postings as ps
from sparkfolio.llm.graph import components
from sparkfolio.llm.spark_env import prepare, stored, trim, values
from sparkfolio.llm.words import Words, mix, slices

SHINGLE_WORDS = 5
PERCENT = 80
PIVOT_ROUNDS = 3
#: Partitions of the shingle space for the suffix filter.
PARTS = 16

_OWN_BITS = 64 - ps.KEY_BITS


def _sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key) of the distinct shingles of each text in order of the owner, and a set digest per text."""
    hashes = words.hashes()
    at, grams = words.grams(hashes, k)
    owner = words.owner()[at] if len(at) else at
    n = words.n
    if (few := np.flatnonzero((n > 0) & (n < k))).size:      # the whole sequence is the one shingle
        whole = [mix(np.sum(mix(hashes[words.first[i]:words.first[i + 1]] + np.arange(n[i], dtype=np.uint64)),
                            keepdims=True, dtype=np.uint64))[0] for i in few]
        owner, grams = np.concatenate((owner, few)), np.concatenate((grams, np.array(whole, np.uint64)))
    both = np.sort((owner.astype(np.uint64) << np.uint64(ps.KEY_BITS)) | (grams >> np.uint64(_OWN_BITS)))
    if len(both):
        both = both[np.concatenate(([True], both[1:] != both[:-1]))]
    owner, key = (both >> np.uint64(ps.KEY_BITS)).astype(np.int64), both & np.uint64((1 << ps.KEY_BITS) - 1)
    digest = np.zeros(len(n), np.uint64)
    first, _ = ps.runs(owner)
    if len(first):
        digest[owner[first]] = mix(np.add.reduceat(mix(key), first) + np.bincount(owner)[owner[first]].astype(np.uint64))
    return owner, key, digest


def _profile(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The columns but text, n_shingles and node of each row."""
    for batch in batches:
        names = [c for c in batch.schema.names if c != "text"]
        for at, to, words in slices(batch.column("text"), lower=True):
            owner, _, digest = _sets(words, k)
            n = np.bincount(owner, minlength=to - at).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c)[at:to] for c in names), pa.array(n), pa.array(digest.view(np.int64), mask=n == 0)],
                [*names, "n_shingles", "node"])


def _post(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, nodes, sizes, idx, keys): the pairs of one slice that fall into one bucket."""
    shift = np.uint64(ps.KEY_BITS - bits)
    for batch in batches:
        for _, _, words in slices(batch.column("text"), lower=True):
            owner, key, digest = _sets(words, k)
            size = np.bincount(owner, minlength=len(digest))
            keep = np.zeros(len(digest), bool)               # one copy of each set in the slice
            keep[np.unique(digest, return_index=True)[1]] = True
            owner, key = owner[keep[owner]], key[keep[owner]]
            order = np.argsort(key)
            owner, key = owner[order], key[order]
            bucket = (key >> shift).astype(np.int64)
            first, length = ps.runs(bucket)
            rows = []
            for f, m in zip(first, length, strict=True):
                own, idx = np.unique(owner[f:f + m], return_inverse=True)
                rows.append((int(bucket[f]), digest[own].tobytes(), size[own].astype("<i4").tobytes(),
                             idx.astype("<u2").tobytes(),
                             ps.pack48(key[f:f + m] & np.uint64((1 << (ps.KEY_BITS - bits)) - 1))))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                ["bucket", "nodes", "sizes", "idx", "keys"])
    trim()


def _shared(pdf: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Of one bucket: the pairs whose shingle is in two texts or more, with its frequency, by node bucket."""
    nodes, sizes, keys = [], [], []
    for row in pdf.itertuples():
        idx = np.frombuffer(row.idx, "<u2")
        nodes.append(np.frombuffer(row.nodes, np.uint64)[idx])
        sizes.append(np.frombuffer(row.sizes, "<i4")[idx])
        keys.append(ps.unpack48(row.keys))
    node, size, key = map(np.concatenate, (nodes, sizes, keys))
    order = np.argsort(key)
    first, length = ps.runs(key[order])
    order = order[np.repeat(length, length) >= 2]            # the large rest is gone before the costlier sort
    node, size, key = node[order], size[order], key[order]
    order = np.lexsort((node, key))
    node, size, key = node[order], size[order], key[order]
    if len(key):                                             # copies of a text in several slices count once
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        node, size, key = node[new], size[new], key[new]
    first, length = ps.runs(key)
    df = np.repeat(length, length)
    node, size, key, df = (x[df >= 2] for x in (node, size, key, df))
    key |= np.uint64(int(pdf.bucket.iloc[0])) << np.uint64(ps.KEY_BITS - bits)
    to = (mix(node) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    out = []
    for f, m in zip(*ps.runs(to[order]), strict=True):
        part = order[f:f + m]
        out.append((int(to[part[0]]), node[part].tobytes(), size[part].astype("<i4").tobytes(),
                    key[part].tobytes(), df[part].astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=["bucket", "nodes", "sizes", "keys", "dfs"])


def _rare_first(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of one node bucket: the texts whose prefix holds a shared shingle, with their shared shingles in rare-first order."""
    get = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
    node, size, key, df = get("nodes", np.uint64), get("sizes", "<i4"), get("keys", np.uint64), get("dfs", "<i4")
    order = np.lexsort((key, df, node))
    node, size, key = node[order], size[order].astype(np.int64), key[order]
    first, length = ps.runs(node)
    n = size[first]
    prefix = n - (percent * n + 99) // 100 + 1
    head = prefix - (n - length)                             # what unshared shingles leave of the prefix
    out = []
    for f, m, s, h in zip(first, length, n, head, strict=True):
        if h > 0:
            mine = key[f:f + m]
            out.append((int(node[f].view(np.int64)), int(s), int(s - m), int(min(h, m)), mine.view(np.int64),
                        np.bincount((mine % np.uint64(PARTS)).astype(np.int64), minlength=PARTS).astype(np.int32)))
    return pd.DataFrame(out, columns=["node", "n", "alone", "head", "keys", "parts"])


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity suffices: length and suffix filter, then the intersection."""
    side = lambda s: texts.select(*(F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "keys", "parts")))
    both = (pairs.join(side("a"), F.col("a") == F.col("a_node")).drop("a_node")
            .join(side("b"), (F.col("b") == F.col("b_node"))
                  & (F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)))
    bound = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y)), F.lit(0), lambda t, x: t + x)
    enough = lambda i: (100 + percent) * i >= percent * (F.col("a_n") + F.col("b_n"))
    return both.filter(enough(bound)).filter(
        enough(F.size(F.array_intersect("a_keys", "b_keys")))).select("a", "b")


def _links(texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what the similarity join connects."""
    heads = stored(texts.select("node", "n", "alone", F.posexplode(F.expr("slice(keys, 1, head)")).alias("at", "key"))
                   .withColumn("left", F.col("n") - F.col("alone") - F.col("at") - 1).drop("at"), "heads")
    links = None
    label = texts.select(F.col("node").alias("id"), F.col("node").alias("component")).limit(0)
    for turn in range(PIVOT_ROUNDS + 1):
        rows = heads.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn(
            "label", F.coalesce("component", "node")).drop("component")
        # the text with the fewest shingles of its own is the likeliest centre of a group; later turns vary it
        rank = F.struct("alone", "node") if turn == 0 else F.struct(F.expr(f"alone div {4 ** turn}"), F.xxhash64("node", F.lit(turn)))
        lists = rows.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.min(F.struct(rank, "node", "label")).alias("pivot")).filter("low != high")
        if turn < PIVOT_ROUNDS:
            pairs = rows.join(lists.select("key", "pivot.node", "pivot.label").toDF("key", "pivot", "other"), "key") \
                .filter("label != other").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        else:
            mixed = rows.join(lists.select("key"), "key", "left_semi")
            one, two = mixed.alias("x"), mixed.alias("y")
            most = F.least("x.left", "y.left") + 1
            pairs = one.join(two, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label"))
                             & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
                             & (most * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)) \
                .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = stored(_verified(pairs, texts, percent), "links")
        new = not found.isEmpty()
        links = found if links is None else links.union(found)
        if new or turn == 0:
            label = stored(components(links), "labels")
    return label


def _grouped(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The columns of ``texts`` (doc_id, text and others of type long) but text, and n_shingles, node, component (one of its
    nodes) and component_id (its smallest doc_id); the last three are null for texts without shingles."""
    prepare(texts.sparkSession)
    others = "".join(f"{c} long, " for c in texts.columns if c != "text")
    rows = stored(texts.mapInArrow(lambda it: _profile(it, k), f"{others}n_shingles long, node long"), "shingle-sets")
    bits = ps.bucket_bits(rows.agg(F.sum("n_shingles")).first()[0] or 0)
    shared = (texts.select("text").mapInArrow(lambda it: _post(it, k, bits),
                                              "bucket int, nodes binary, sizes binary, idx binary, keys binary")
              .groupBy("bucket").applyInPandas(lambda pdf: _shared(pdf, bits),
                                               "bucket int, nodes binary, sizes binary, keys binary, dfs binary"))
    profiles = stored(shared.groupBy("bucket").applyInPandas(
        lambda pdf: _rare_first(pdf, percent),
        "node long, n long, alone long, head int, keys array<long>, parts array<int>"), "profiles")
    label = _links(profiles, percent)
    nodes = (rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
             .join(label.withColumnRenamed("id", "node"), "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(nodes.join(least, "component").select("node", "component", "component_id"), "node", "left")


def ngram_jaccard(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored):
    doc_id, n_shingles, component_id (smallest doc_id among the documents reachable by links).

    Null, empty and word-less texts have no shingles and are their own component. Texts of fewer
    than ``k`` words have one shingle. Rows that repeat are kept; rows with a null doc_id take
    part, and their component_id is null only if no member has an id. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _grouped(texts, k, percent).select(
        "doc_id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, apart: bool = True) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, an id before none, then with the smallest
    hash of all columns; of rows that are equal in all columns one stays.

    ``apart`` treats the rows of a component that have no doc_id as a component of their own, so that one of them stays too.
    Rows without words are copies only of rows with the same id; those that have no id either all stay.
    """
    by = F.xxhash64(*values(docs))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), by.alias("digest"))
    rows = _grouped(texts, k, percent)
    # rows that are equal in all columns are counted first, in partial sums: a document that repeats is not gathered
    group = ["component", F.when(F.col("node").isNull(), F.col("doc_id")).alias("own"), (F.lit(apart) & F.col("doc_id").isNull()).alias("side")]
    equal = rows.filter("node is not null or doc_id is not null").groupBy(*group, "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    one = equal.groupBy("component", "own", "side").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")).alias("one")).select("one.doc_id", "one.digest", "one.n")
    free = rows.filter("node is null and doc_id is null").select("doc_id", "digest").distinct().withColumn("n", F.lit(1).cast("long"))
    chosen = stored(one.union(free), "chosen").toDF("__id", "__digest", "__n")
    marked = docs.withColumn("__own", by)
    match = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))
    single = marked.join(chosen.filter("__n = 1"), match, "left_semi")
    repeated = marked.join(chosen.filter("__n > 1"), match, "left_semi").dropDuplicates(["doc_id", "__own"])
    return single.unionByName(repeated).select(*(F.col(f"`{c}`") for c in docs.columns))
