"""Substring dedup: remove words covered by a passage that occurs more than once.

Method: FM-indexes over shards; each shard's sequences are streamed against its index by backward
search over a wavelet matrix, and positions whose match reaches the threshold are reported.

What goes to which shard: every window of ``window`` words has an anchor, the word ``ANCHOR_WORDS``-gram of
smallest hash in it (the leftmost of equals). Equal windows have equal anchors, so the stretch of text whose
windows share an anchor occurrence is sent to the shard of the anchor's hash, and all occurrences of a window meet
in one index. Anchors that occur once in the corpus cannot lie in a repeated window; their stretches are never sent.
An anchor that occurs more than ``HOT`` times has its windows sent one by one to the shard of the window's own hash, so
a passage that a third of all documents share is spread; equal stretches within a slice of text travel once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm import postings as ps
from sparkfolio.llm.fm_index import FMIndex
from sparkfolio.llm.spark_env import prepare, stored
from sparkfolio.llm.words import Words, mix, range_hash, slices

WINDOW = 35
ANCHOR_WORDS = 8
#: Occurrences of an anchor from which its windows are dealt one by one.
HOT = 1000
#: Words of one shard on average.
SHARD_WORDS = 1 << 20


def _anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, windows, text) of the stretches of windows that have the same anchor occurrence."""
    span = window - ANCHOR_WORDS + 1
    owner = words.owner()
    last = words.first[1:][owner] if len(owner) else owner
    starts = np.flatnonzero(np.arange(len(hashes)) + window <= last)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    at = np.arange(len(hashes) - ANCHOR_WORDS + 1)
    gram = range_hash(hashes, at, at + ANCHOR_WORDS)
    best, where, width = gram, at, 1
    while width < span:                                      # smallest in spans of doubling width, leftmost of equals
        step = min(width, span - width)
        n = len(best) - step
        take = best[step:] < best[:n]
        best, where = np.where(take, best[step:], best[:n]), np.where(take, where[step:], where[:n])
        width += step
    pos = where[starts]
    new = np.concatenate(([True], (pos[1:] != pos[:-1]) | (np.diff(starts) != 1)))
    first = np.flatnonzero(new)
    return gram[pos[first]], starts[first], np.diff(np.append(first, len(starts))), owner[starts[first]]


def _post(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, nodes, idx, keys): the anchors of one slice in one bucket, and the rows that hold them."""
    shift = np.uint64(ps.KEY_BITS - bits)
    for batch in batches:
        row = batch.column("row").to_numpy(zero_copy_only=False)
        for a, _, words in slices(batch.column("text")):
            anchor, _, _, text = _anchors(words, words.hashes(), window)
            key = anchor >> np.uint64(64 - ps.KEY_BITS)
            order = np.argsort(key)
            key, text = key[order], text[order]
            bucket = (key >> shift).astype(np.int64)
            rows = []
            for f, m in zip(*ps.runs(bucket), strict=True):
                own, idx = np.unique(text[f:f + m], return_inverse=True)
                rows.append((int(bucket[f]), row[a + own].astype("<i8").tobytes(), idx.astype("<u2").tobytes(),
                             ps.pack48(key[f:f + m] & np.uint64((1 << (ps.KEY_BITS - bits)) - 1))))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                             ["bucket", "nodes", "idx", "keys"])


def _repeated_anchors(pdf: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Of one bucket: (row, key, hot) of the anchors that occur twice or more."""
    node = np.concatenate([np.frombuffer(r.nodes, "<i8")[np.frombuffer(r.idx, "<u2")] for r in pdf.itertuples()])
    key = np.concatenate([ps.unpack48(x) for x in pdf["keys"]])
    order = np.lexsort((node, key))
    node, key = node[order], key[order]
    _, length = ps.runs(key)
    times = np.repeat(length, length)
    keep = times >= 2
    node, key, times = node[keep], key[keep], times[keep]
    if len(key):
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        node, key, times = node[new], key[new], times[new]
    key |= np.uint64(int(pdf.bucket.iloc[0])) << np.uint64(ps.KEY_BITS - bits)
    hot = times >= HOT
    return pd.DataFrame({"row": node, "key": np.where(hot, -key.view(np.int64) - 1, key.view(np.int64))})


def _stretches(batches: Iterator[pa.RecordBatch], window: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, row, start, windows, weight, report, words) of the stretches with a repeated anchor; a word is the
    lower 48 bits of its hash.
    ``report``: the shard has to tell whether the place is repeated. Places that are equal within the slice are
    repeated; they come without ``words``, and one row of weight 2 stands for them in the shard."""
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
    for batch in batches:
        row = batch.column("row").to_numpy(zero_copy_only=False)
        lists = batch.column("keys")
        for a, b, words in slices(batch.column("text")):
            hashes = words.hashes()
            anchor, start, count, text = _anchors(words, hashes, window)
            key = (anchor >> np.uint64(64 - ps.KEY_BITS)).astype(np.int64)
            part = lists.slice(a, b - a)
            have = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(have) or not len(key):
                continue
            of = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            hot = have < 0
            have = np.where(hot, -have - 1, have)
            tag = lambda t, k: mix(mix(t.astype(np.uint64)) + k.astype(np.uint64))
            wanted = tag(of, have)
            order = np.argsort(wanted)
            wanted, hot = wanted[order], hot[order]
            mine = tag(text, key)
            at = np.minimum(np.searchsorted(wanted, mine), len(wanted) - 1)
            found = wanted[at] == mine
            one = np.flatnonzero(found & hot[at])
            each = np.repeat(one, count[one])
            within = np.arange(len(each)) - np.repeat(np.cumsum(count[one]) - count[one], count[one])
            cold = np.flatnonzero(found & ~hot[at])
            s = np.concatenate((start[cold], start[each] + within))
            c = np.concatenate((count[cold], np.ones(len(each), np.int64)))
            t = np.concatenate((text[cold], text[each]))
            if not len(s):
                continue
            digest = range_hash(hashes, s, s + c + window - 1)
            place = np.concatenate((anchor[cold], digest[len(cold):]))
            shard = (mix(place) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(digest, kind="stable")
            first, length = ps.runs(digest[order])
            lead = np.zeros(len(order), bool)
            lead[first] = True
            out = []
            for i, head, many in zip(order.tolist(), lead.tolist(), np.repeat(length, length).tolist(), strict=True):
                here = (int(row[a + t[i]]), int(s[i] - words.first[t[i]]), int(c[i]))
                if head:
                    out.append((int(shard[i]), *here, min(many, 2), many == 1,
                                ps.pack48(hashes[s[i]:s[i] + c[i] + window - 1])))
                if many > 1:
                    out.append((here[0] % shards, *here, 2, True, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, y) for x, y in zip(zip(*out, strict=True), kinds, strict=True)],
                ["shard", "row", "start", "windows", "weight", "report", "words"])


def _search(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """One shard: index its stretches and stream them; (row, start, end) of the words that repeated windows cover."""
    known = pdf[pdf["words"].isna()]
    out = list(zip(known["row"], known["start"], known["start"] + known["windows"] + window - 1, strict=True))
    sent = pdf[pdf["words"].notna()]
    if len(sent):
        body = list(sent["words"])
        number, _ = pd.factorize(np.array([hashlib.blake2b(x, digest_size=16).hexdigest() for x in sent["words"]], object))
        weight = np.bincount(number, weights=sent["weight"].to_numpy())    # equal stretches are indexed once
        lead = np.unique(number, return_index=True)[1]
        lengths = np.array([len(body[i]) // 6 for i in lead])
        code = np.unique(ps.unpack48(b"".join([body[i] for i in lead])), return_inverse=True)[1] + 1
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        text[np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(len(code))] = code
        hit = FMIndex(text, window).repeated(text, starts, lengths)
        for k, r, s, report in zip(number, sent["row"], sent["start"], sent["report"], strict=True):
            if not report:
                continue
            if weight[k] >= 2:
                out.append((r, s, s + lengths[k]))
                continue
            yes = np.flatnonzero(hit[starts[k]:starts[k] + lengths[k] - window + 1])
            if len(yes):
                cut = np.flatnonzero(np.diff(yes) > window)
                out += [(r, s + yes[x], s + yes[y] + window)
                        for x, y in zip(np.append(0, cut + 1), np.append(cut, len(yes) - 1), strict=True)]
    return pd.DataFrame(out, columns=["row", "start", "end"]).astype("int64")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the covered words of each text: (doc_id, n_words, n_removed, kept)."""
    for batch in batches:
        lists = batch.column("spans")
        for a, b, words in slices(batch.column("text")):
            part = lists.slice(a, b - a)
            span = part.flatten()
            of = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            edge = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(edge, words.first[of] + span.field("start").to_numpy(), 1)
            np.add.at(edge, words.first[of] + span.field("end").to_numpy(), -1)
            covered = np.cumsum(edge)[:-1] > 0
            gone = np.diff(np.concatenate(([0], np.cumsum(covered)))[words.first])
            raw = words.data.tobytes()
            kept = []
            for f, t in zip(words.first[:-1], words.first[1:], strict=True):
                use = np.flatnonzero(~covered[f:t]) + f
                kept.append(b" ".join([raw[x:y] for x, y in zip(words.starts[use].tolist(), words.ends[use].tolist(),
                                                                strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[a:b], pa.array(words.n.astype(np.int64)), pa.array(gone.astype(np.int64)),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id, n_words, n_removed,
    kept (the words left, joined by one space).

    A word goes if a window of ``window`` words that covers it starts anywhere else too, judged on the input. Null and
    empty texts have no words; texts under ``window`` words lose none; rows that repeat are copies of each other
    and lose every window. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text"))          # the same in every run of a task
    bits = ps.bucket_bits((texts.agg(F.sum(F.length("text"))).first()[0] or 0) // 80)
    anchors = (texts.select("row", "text")
               .mapInArrow(lambda it: _post(it, window, bits), "bucket int, nodes binary, idx binary, keys binary")
               .groupBy("bucket").applyInPandas(lambda pdf: _repeated_anchors(pdf, bits), "row long, key long"))
    of_row = stored(anchors.groupBy("row").agg(F.collect_list("key").alias("keys")), "anchors")
    shards = max(4, (of_row.agg(F.sum(F.size("keys"))).first()[0] or 0) * (window + 15) // SHARD_WORDS)
    sent = (texts.join(of_row, "row").sortWithinPartitions("row").select("row", "text", "keys")
            .mapInArrow(lambda it: _stretches(it, window, shards), "shard int, row long, start long, windows int, "
                        "weight int, report boolean, words binary"))
    spans = (sent.groupBy("shard").applyInPandas(lambda pdf: _search(pdf, window), "row long, start long, end long")
             .groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    return texts.join(spans, "row", "left").select(
        "doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans")
    ).mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept string")
