"""Importance resampling against a plain version, on odd rows and on the smallest table."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Regex, pre_tokenizers

from sparkfolio.llm import importance, queries
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, n_words int, score string, buckets int, `a.b` int, id0 int, fit int, `row` int"
SPLIT = pre_tokenizers.Split(Regex(importance.WORD), behavior="removed", invert=True)


def plain_features(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(docs, target):
    own, want, feats = [0] * 10000, [0] * 10000, []
    for _, text in docs:
        feats.append(plain_features(text))
        for b in feats[-1][1]:
            own[b] += 1
    for text in target:
        for b in plain_features(text)[1]:
            want[b] += 1
    s_all, t_all = sum(own), sum(want)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) for s, t in zip(own, want)]
    rows = []
    for (i, _), (n, bs) in zip(docs, feats):
        weight = sum(gain[b] for b in bs)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(bs), weight, score, None, n])
    fit = sorted((r for r in rows if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(fit[:5 * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]
    target = [r["text"] for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    rows = got(queries.op12_importance_resampling(spark, SF_SMALL))
    assert rows == plain(docs, target)
    assert sum(r[4] is not None for r in rows) > 5


@pytest.mark.parametrize("piece", [1 << 18, 7])
def test_odd_rows(spark, monkeypatch, piece):
    long = " ".join(f"W{i % 37}" for i in range(40000))
    texts = [None, "", " .,\n", "one", "ONE", "One  two\tthree\x00four{five}", "naïve café – 日本語 🙂 İ ſ\xa0x", "x" * 300000, long, "a-b " * 30]
    docs = list(enumerate(texts)) + [(None, "word " * 40), (None, None)] + [(100, "many words of one text " * 9)] * 60
    docs += [(200 + i, " ".join(f"t{(i * 7 + j) % 50}" for j in range(25))) for i in range(80)]
    target = [None, "", "t1 t2 t3 t4", "many words"]
    # the size of a piece changes nothing; workers have the default, so small pieces are compared here
    monkeypatch.setattr(importance, "PIECE", piece)
    for _, text in docs:
        n, buckets = importance.text_buckets(SPLIT, text)
        want = plain_features(text)
        assert (n, buckets.tolist()) == (want[0], sorted(want[1]))
        assert importance.unpack(importance.pack(buckets)).tolist() == buckets.tolist()
    if piece > 7:
        df = spark.createDataFrame([(i, t, "en", 1, "s", 2, 3, 4, 5, 6) for i, t in docs], DOCS).repartition(5)
        aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
        assert got(importance.resample(df, aim)) == plain(docs, target)


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert got(importance.resample(none, some)) == []
    assert got(importance.resample(some, none)) == plain([(1, "a b")], [])


def test_windows_are_offsets():
    words = [w for w, _ in SPLIT.pre_tokenize_str("ab cd  ef.gh")]
    assert words == ["ab", "cd", "ef", "gh"]
    assert np.isin(zlib.crc32(b"cd ef gh"), list(importance.windows([w.encode() for w in words])))
