"""Toxicity: noisy-channel deobfuscation, then a score from restored words.

A word that is spelt with look-alike signs ("1d!0t"), letters apart ("i d i o t", "i.d.i.o.t") or letters repeated ("idiooot") becomes a
lattice of characters: each sign with the letters it may stand for, each run of separators as nothing or the end of a word, each
run of two or more letters as one or two. A sign at an edge of a word may be punctuation as well; both are tried.
The Viterbi path under a character trigram model is the restored word. The trigram counts come from all texts of the corpus.

Evidence is the words and word beginnings of the text and of its restored words. A feature counts if the labels rule out chance: its
documents times the divergence of their toxic share from the overall share exceeds the logarithm of the number of
features tried. A text's score is that of its strongest feature.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import prepare, stored
from sparkfolio.llm.words import slices

#: Letters a sign may stand for, and separators that may stand for nothing.
SIGNS = {"0": "o", "1": "il", "!": "i", "|": "il", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "+": "t", "8": "b", "9": "g"}
SEPARATORS = ".-_*~'"
SIGN_COST = 1.0
PREFIXES = (4, 5, 6)
PRIOR_DOCS = 2.0
ERROR = 0.05
#: Most labelled documents learnt from: those of the smallest hash of doc_id. Their ids are what is broadcast; the lexicon is of
#: their words, those that the labels rule out as chance.
MAX_LABELS = 20_000

#: Codes of characters. 0: outside a word, 1-26: a-z, 27: characters beyond, 28 on: the Latin-1 letters from ß to ÿ.
_N = 61
_CODES = {" ": 0, **{chr(97 + i): 1 + i for i in range(26)}, **{chr(0xDF + i): 28 + i for i in range(33)}}
_CODE = np.full(256, 0, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\x20\x09-\x0d]+")
_APART = re.compile(r"(?<![^\W_])[\w@$!|+](?<!_)(?:[\s.\-_*~']+[\w@$!|+](?<!_)(?![^\W_])){2,}")
_NOISY = re.compile(r"[^\W\d_][0-9@$!|+.\-_*~']+[^\W\d_]|[0-9@$!|+][^\W\d_]|[^\W\d_][0-9@$]|([^\W\d_])\1")
_EDGE = "\"'()[]{}<>,;:?.!"
_PLAIN = "".join(c for c in _EDGE if c not in SIGNS)
#: Most tokens whose words a task remembers.
KNOWN = 250_000
_NONE: frozenset[str] = frozenset()


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of character trigrams in one task's texts."""
    total = np.zeros(_N ** 3, np.int64)
    for batch in batches:
        for _, _, words in slices(batch.column("text")):
            data, code = words.data, _CODE[words.data].astype(np.int64)
            if len(data) > 1:                                # a letter of two bytes is one character
                letter = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
                low = data[1:][letter] & 0x3F
                code[:-1][letter] = 28 + np.where(low < 0x1F, low + 0x20, low) - 0x1F
            bounds = np.append(0, np.cumsum((data & 0xC0) != 0x80))[words.bounds]
            code = np.insert(code[(data & 0xC0) != 0x80], bounds[:-1], 0)
            total += np.bincount(code[:-2] * _N * _N + code[1:-1] * _N + code[2:], minlength=_N ** 3) if len(code) > 2 else 0
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(third | first two) from all texts, add-one smoothed: ``_N ** 3`` numbers, whatever the size of the corpus."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string")).mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    count = np.ones(_N ** 3)
    for r in rows:
        count[r.gram] += r.n
    count = count.reshape(_N, _N, _N)
    return np.log(count / count.sum(2, keepdims=True))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place of a lower-cased token: the strings it may stand for, with their cost. A blank ends a word."""
    out, at, n = [], 0, len(token)
    while at < n:
        c, end = token[at], at + 1
        apart = not c.isalnum() and (c in SEPARATORS or c.isspace())
        if apart:
            while end < n and (token[end] in SEPARATORS or token[end].isspace()):
                end += 1
        else:
            while end < n and token[end] == c:
                end += 1
        run, letters = end - at, SIGNS.get(c)
        if letters:
            choice = [(x, SIGN_COST) for x in letters]
            if run == 2:
                choice += [(x + y, 2 * SIGN_COST) for x in letters for y in letters]
            elif run > 2:
                choice += [(x * 2, SIGN_COST) for x in letters]
            out.append(choice)
        elif apart:
            out.append([("", 0.0), (" ", 0.0)])
        elif run >= 2:
            out.append([(c, 0.0), (c * 2, 0.0)])
        else:
            out.append([(c, 0.0)])
        at = end
    return out


def restore(token: str, model: np.ndarray | list) -> str:
    """The Viterbi path through the lattice of a token: a word, or words with blanks between them."""
    code = _CODES.get
    states = {(0, 0): (0.0, None)}
    for pieces in lattice(token):
        if len(pieces) == 1 and len(pieces[0][0]) == 1:      # one character, one way
            piece, extra = pieces[0]
            z = code(piece, 27)
            new = {}
            for (a, b), (cost, path) in states.items():
                total, have = cost + extra - model[a][b][z], new.get((b, z))
                if have is None or total < have[0]:
                    new[b, z] = (total, (path, piece))
            states = new
            continue
        choice = [(piece, extra, [code(c, 27) for c in piece]) for piece, extra in pieces]
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for piece, extra, codes in choice:
                x, y, total = a, b, cost + extra
                for z in codes:
                    total -= model[x][y][z]
                    x, y = y, z
                have = new.get((x, y))
                if have is None or total < have[0]:
                    new[x, y] = (total, (path, piece))
        states = new
    _, path = min(((cost - (model[a][b][0] if b else 0.0), path) for (a, b), (cost, path) in states.items()), key=lambda s: s[0])
    out = []
    while path:
        path, piece = path
        out.append(piece)
    return "".join(reversed(out)).strip()


def _meant(token: str, model: np.ndarray | list) -> set[str]:
    """Words that a token with signs, separators or repeated letters stands for."""
    ways = {token.strip(_EDGE), token.strip(_PLAIN), token.lstrip(_PLAIN).rstrip(_EDGE)}
    return {w for t in ways if t for w in _WORD.findall(restore(t, model))}


def restored(text: str, model: np.ndarray | list, known: dict[str, set[str] | frozenset[str]] | None = None) -> set[str]:
    """Words of a lower-cased text, those that its obfuscated words stand for included; ``known`` remembers them by token."""
    known = {} if known is None else known
    words = set(_WORD.findall(text))
    for token in set(_TOKEN.findall(text)):
        have = known.get(token)
        if have is None:
            have = _meant(token, model) if _NOISY.search(token) else _NONE
            if len(known) >= KNOWN:
                known.clear()
            if len(token) <= 64:
                known[token] = have
        words |= have
    for m in _APART.finditer(text):
        words.update(_WORD.findall(restore(m.group(), model)))
    return words


def features(text: str, model: np.ndarray | list, known: dict[str, set[str] | frozenset[str]] | None = None) -> set[str]:
    words = restored(text.lower(), model, known)
    return words | {f"{w[:n]}*" for n in PREFIXES for w in words if len(w) > n}


def strongest(text: str, model: np.ndarray | list, lexicon: dict[str, float], base: float, known: dict[str, float]) -> float:
    """The score of the strongest feature of a text, ``base`` without any; ``known`` remembers scores by token. Words lie
    within tokens, so the tokens' features are the text's, but for words that are spelt apart."""
    text, get = text.lower(), lexicon.get
    tokens = set(_TOKEN.findall(text))
    if not tokens:
        return base

    def score(words: set[str]) -> float:
        return max((get(f, base) for w in words for f in (w, *(f"{w[:n]}*" for n in PREFIXES if len(w) > n))), default=-1.0)

    out = -1.0
    for token in tokens:
        have = known.get(token)
        if have is None:
            words = set(_WORD.findall(token))
            have = score(words | _meant(token, model) if _NOISY.search(token) else words)
            if len(known) >= KNOWN:
                known.clear()
            if len(token) <= 64:
                known[token] = have
        if have > out:
            out = have
    for m in _APART.finditer(text):
        out = max(out, score(set(_WORD.findall(restore(m.group(), model)))))
    return out if out >= 0 else base


def learn(texts: DataFrame, model: np.ndarray | list) -> tuple[dict[str, float], float]:
    """(feature -> share of toxic documents, score of a text without evidence) from rows (text, toxic 0/1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[str] | frozenset[str]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                names, flags = [], []
                for t, y in zip(part.column("text"), part.column("toxic"), strict=True):
                    f = features(t.as_py() or "", model, known)
                    names += f
                    flags += [y.as_py()] * len(f)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(flags, pa.int64())], ["feature", "toxic"])

    docs, toxic = texts.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not docs or not toxic or toxic == docs:
        return {}, 0.0 if not toxic else 1.0
    share = toxic / docs
    counts = texts.mapInArrow(run, "feature string, toxic long").groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
    rate = F.col("t") / F.col("n")
    part = lambda p, q: F.when(p > 0, p * F.log(p / F.lit(q))).otherwise(0.0)
    gain = F.col("n") * (part(rate, share) + part(1 - rate, 1 - share))
    counts = stored(counts.withColumn("gain", gain), "features")
    number = counts.agg(F.count(F.lit(1))).first()[0]
    strong = counts.filter((rate > share) & (F.col("gain") >= math.log(number / ERROR)))
    return {r.feature: (r.t + PRIOR_DOCS * share) / (r.n + PRIOR_DOCS) for r in strong.collect()}, share / 4


def toxicity(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id, held_out, score (0 to 1).

    ``labels`` (doc_id, toxic 0/1) are learnt from where ``held_out`` (a boolean Column over doc_id) is not true, at most
    ``MAX_LABELS`` of them; null labels
    and ids are ignored, and a document that is labelled twice counts twice. Null and empty texts have the score of no evidence,
    as have all if there is nothing to learn; rows that repeat score alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = language_model(texts).tolist()                   # read number by number, where lists are faster
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("long")).filter("doc_id is not null and toxic is not null")
    chosen = known.filter(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(MAX_LABELS)
    lexicon, base = learn(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            score = [strongest(t.as_py(), model, lexicon, base, known) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score")
