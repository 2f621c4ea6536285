"""Token files: ids of each document, compressed one by one with a shared zstandard dictionary.

Format. One row of the table ``files`` is one file of up to ``FILE_TEXTS`` documents in ascending doc_id order:

========== ====== ==============================================================
part, seq  int    order of the files
dictionary string SHA-256 of the dictionary ("" if none)
doc_ids    array  ids of the documents
offsets    array  byte offset of each document's frame in ``frames``, and the end
starts     array  tokens of the file before each document, and their sum
frames     binary a zstandard frame for each document: its ids as little-endian unsigned 16-bit integers
========== ====== ==============================================================

The table ``dictionary`` holds (hash, content) once. A short document is read by its offsets alone: one frame is
decompressed, nothing before it. The files are written as Parquet to the folder given, so any store that Spark
can write serves.

Ids come from the tokenizers library. Its tokenizer lower-cases and never joins what stands on both sides of white space,
nor letters with the signs and digits beside them (the apostrophe aside). So texts are cut into such pieces, each distinct piece
is encoded once, and a text is its pieces' ids in a row.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, pre_tokenizers

from sparkfolio.llm import words as split_words
from sparkfolio.llm.spark_env import prepare, trim

END_ID = 2
FILE_TEXTS = 1024
#: Texts encoded at once.
BATCH = 1024
FILE_BYTES = 4 << 20
#: The dictionary: its size, the documents it is trained on (those of the smallest hash, over the whole table, with what
#: repeats them), and the windows of their id arrays, from any place in them.
DICT_BYTES = 64 << 10
DICT_TEXTS = 1000
WINDOW_BYTES = 2 << 10
DICT_WINDOWS = 4096
#: Bytes of text whose equal words are looked up together.
SLICE_BYTES = 2 << 20
LEVEL = 1
#: Pieces whose ids a worker keeps at hand, some 30 bytes each.
CACHE = 2_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def _lower(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the Latin-1 capitals (second bytes of 0xC3) in lower case."""
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][capital] += 32
    return out


def _pieces(words: split_words.Words) -> tuple[split_words.Words, np.ndarray]:
    """Words cut where letters meet signs or digits, and whether each piece is letters alone. A word with an apostrophe
    or with characters beyond ASCII and the Latin-1 letters stays whole."""
    data, n = words.data, len(words.data)
    high = data >= 0x80
    second = np.zeros(n, bool)                               # of a Latin-1 letter
    second[1:] = (data[:-1] == 0xC3) & high[1:] & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    latin = second.copy()
    latin[:-1] |= second[1:]
    odd = np.append(0, np.cumsum((high & ~latin) | (data == 0x27)))
    whole = odd[words.ends] > odd[words.starts]
    letter = _LETTER[data]
    cover = np.zeros(n + 1, np.int32)                        # 1 inside words that may be cut
    cover[words.starts[~whole]] += 1
    cover[words.ends[~whole]] -= 1
    inside = np.cumsum(cover[:n]).astype(bool)
    start, end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    start[words.starts], end[words.ends] = True, True
    border = np.flatnonzero((letter[1:] != letter[:-1]) & inside[1:] & inside[:-1]) + 1
    start[border], end[border] = True, True
    at = np.flatnonzero(start)
    return (split_words.Words(data, words.bounds, at, np.flatnonzero(end), np.searchsorted(at, words.bounds)),
            letter[at] & inside[at])


class Words:
    """Ids of texts by their words; made once for each worker process."""

    _made: dict[str, Words] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        vocab = self.model.get_vocab(with_added_tokens=True)
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("ids of over 16 bits")
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.special = special
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.model.encode_batch_fast(words, add_special_tokens=False)]

    def forget(self) -> None:
        """Known pieces: sorted hash, second hash, place and number of the ids in ``ids``."""
        self.hash, self.again = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u2")

    def _learn(self, pieces: split_words.Words, plain: np.ndarray, new: np.ndarray, hashes: np.ndarray, again: np.ndarray) -> None:
        """Pieces of letters end at an id that closes a word: all are encoded in one text. The others one by one."""
        letters, other = new[plain[new]], new[~plain[new]]
        ids, sizes = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        if len(letters):
            length = pieces.ends[letters] - pieces.starts[letters]
            upto = np.cumsum(length + 1)
            text = np.full(int(upto[-1]), 0x20, np.uint8)
            step = np.arange(int(length.sum()))
            owner_start = np.cumsum(length) - length
            text[np.repeat(upto - length - 1 - owner_start, length) + step] = pieces.data[np.repeat(pieces.starts[letters] - owner_start, length) + step]
            got = np.array(self.letters.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, "<u2")
            ends = np.flatnonzero(self.closes[got]) + 1
            if len(ends) != len(letters):
                raise ValueError("the tokenizer does not close each word")
            ids.append(got)
            sizes.append(np.diff(ends, prepend=0))
        if len(other):
            raw = pieces.data.tobytes()
            each = self._each([raw[x:y].decode() for x, y in zip(pieces.starts[other].tolist(), pieces.ends[other].tolist(), strict=True)])
            ids.append(np.frombuffer(b"".join(each), "<u2"))
            sizes.append(np.fromiter(map(len, each), np.int64, len(each)) // 2)
        order = np.concatenate([letters, other])
        size = np.concatenate(sizes)
        place = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids])
        by = np.argsort(hashes[order])
        order, size, place = order[by], size[by], place[by]
        at = np.searchsorted(self.hash, hashes[order])
        self.hash, self.again = np.insert(self.hash, at, hashes[order]), np.insert(self.again, at, again[order])
        self.place, self.size = np.insert(self.place, at, place), np.insert(self.size, at, size)

    def _slice(self, words: split_words.Words) -> list[bytes] | None:
        """The ids of the texts of one slice. Equal pieces are found by two 64-bit hashes; None where only one of them agrees."""
        pieces, plain = _pieces(words)
        n = len(pieces.first) - 1
        if not len(pieces.starts):
            return [b""] * n
        hashes, again = pieces.hashes(), pieces.hashes(again=True)
        distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if (again[index][inverse] != again).any():
            return None
        if len(self.hash) > CACHE:
            self.forget()
        at = np.minimum(np.searchsorted(self.hash, distinct), max(len(self.hash) - 1, 0))
        new = index if not len(self.hash) else index[self.hash[at] != distinct]
        if len(new):
            self._learn(pieces, plain, new, hashes, again)
            at = np.searchsorted(self.hash, distinct)
        if (self.again[at] != again[index]).any():
            return None
        each = self.size[at][inverse].astype(np.int64)
        upto = np.cumsum(each)
        take = np.repeat(self.place[at][inverse] - upto + each, each) + np.arange(int(upto[-1]))
        out = self.ids[take].tobytes()
        ends = (2 * np.append(0, upto)[pieces.first]).tolist()
        return [out[x:y] for x, y in zip(ends, ends[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 16-bit integers, without special tokens of its own."""
        out = []
        for a, b, words in split_words.slices(pa.array(texts, pa.large_string()), limit=SLICE_BYTES):
            words.data = _lower(words.data)
            got = self._slice(words)
            out += self._each(texts[a:b]) if got is None else got
        for i, t in enumerate(texts):                        # special tokens are matched before words are split
            if any(s in t for s in self.special):
                out[i] = self._each([t])[0]
        return out


def _windows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                rows = batch.slice(at, 16)
                ids = Words.of(path).encode(rows.column("text").to_pylist())
                cut = [(r, x // WINDOW_BYTES, raw[x:x + WINDOW_BYTES]) for r, raw in zip(rows.column("rank").to_pylist(), ids, strict=True)
                       for x in range(0, len(raw), WINDOW_BYTES)]
                for x in range(0, len(cut), 4096):
                    rank, number, window = zip(*cut[x:x + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(rank, pa.int64()), pa.array(number, pa.int64()), pa.array(window, pa.binary())],
                                                     names=["rank", "number", "ids"])
    return run


def _dictionary(texts: DataFrame, path: str) -> bytes:
    """A dictionary from the whole id arrays of a bounded sample of documents, those of the smallest hash, cut into windows
    of which those of the smallest hash are taken; b"" if there is too little to train on."""
    rank = F.xxhash64("doc_id", F.length("text"), "text")
    last = texts.select(rank.alias("rank")).orderBy("rank").limit(DICT_TEXTS).agg(F.max("rank")).first()[0]
    if last is None:
        return b""
    sample = texts.filter(rank <= last).select("text", rank.alias("rank")).mapInArrow(_windows(path), "rank long, number long, ids binary")
    rows = [bytes(r.ids) for r in sample.orderBy(F.xxhash64("rank", "number"), "ids").limit(DICT_WINDOWS).select("ids").collect()]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, rows)) // 4), rows).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content) if content else None)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every row of ``docs`` (doc_id long, text string; other columns are ignored) and write files and dictionary
    below ``folder``. Rows are in ascending doc_id order, null ids first, ties by text; null and empty texts are the end id alone;
    rows that repeat are written each time; an empty table gives no files."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    content = _dictionary(texts, tokenizer)
    name = hashlib.sha256(content).hexdigest() if content else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, press = Words.of(tokenizer), _compressor(content)
        gc.set_threshold(1_000_000)                          # millions of short-lived lists, no cycles
        end, part, seq = np.array([end_id], "<u2").tobytes(), TaskContext.get().partitionId(), 0
        ids, frames, sizes, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            offsets = np.append(0, np.cumsum([len(f) for f in frames]))
            starts = np.append(0, np.cumsum(sizes))
            return pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "dictionary": name, "doc_ids": list(ids), "offsets": offsets.tolist(),
                "starts": starts.tolist(), "frames": b"".join(frames)}], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                rows = batch.slice(at, BATCH)
                for i, raw in zip(rows.column("doc_id").to_pylist(), words.encode(rows.column("text").to_pylist()), strict=True):
                    ids.append(i)
                    frames.append(press.compress(raw + end))
                    sizes.append(len(raw) // 2 + 1)
                    total += sizes[-1]
                    if len(ids) >= FILE_TEXTS or 2 * total > FILE_BYTES:
                        yield flush()
                        ids, frames, sizes, seq, total = [], [], [], seq + 1, 0
        if ids:
            yield flush()
        trim()

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("dictionary", pa.string()), ("doc_ids", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("frames", pa.binary())])
    spark.createDataFrame([(name, bytearray(content))], "hash string, content binary").write.parquet(f"{folder}/dictionary")
    # many rows of one id, or without one, are dealt by how their texts begin
    (texts.repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, "part int, seq int, dictionary string, doc_ids array<long>, offsets array<long>, starts array<long>, frames binary")
     .write.parquet(f"{folder}/files"))


def _open(spark: SparkSession, folder: str) -> dict[str, bytes]:
    """The dictionary (one row of at most ``DICT_BYTES``), checked against its hash."""
    found = {r.hash: bytes(r.content) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    if any(h != (hashlib.sha256(c).hexdigest() if c else "") for h, c in found.items()):
        raise ValueError("the dictionary does not match its hash")
    return found


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), ids (binary, little-endian unsigned
    32-bit integers). A file that names another dictionary than the folder's fails."""
    content = _open(spark, folder)
    files = spark.read.parquet(f"{folder}/files")
    size = F.element_at("starts", -1)
    parts = files.groupBy("part").agg(F.sum(size).alias("n"))          # one row for each task of the writer
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    base = files.select("part", "seq", (F.sum(size).over(Window.partitionBy("part").orderBy("seq")) - size).alias("seq_start"))
    base = base.join(before, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                unpress = _decompressor(content[f["dictionary"]])
                rows = [np.frombuffer(unpress.decompress(f["frames"][a:b]), "<u2").astype("<u4").tobytes()
                        for a, b in zip(f["offsets"], f["offsets"][1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f["doc_ids"], pa.int64()), pa.array(np.array(f["starts"][:-1], np.int64) + f["base"]),
                     pa.array(rows, pa.binary())], ["doc_id", "start", "ids"])

    return files.join(base, ["part", "seq"]).mapInArrow(run, "doc_id long, start long, ids binary")


def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id (more than one if rows repeat), by the offset index: only their frames are read on."""
    content = _open(spark, folder)
    at = F.posexplode("doc_ids").alias("at", "doc_id")
    rows = (spark.read.parquet(f"{folder}/files").filter(F.array_contains("doc_ids", F.lit(doc_id)))
            .select("part", "seq", "dictionary", "offsets", "frames", at).filter(F.col("doc_id") == doc_id)
            .select("part", "seq", "at", "dictionary", F.expr("substring(frames, int(offsets[at]) + 1, int(offsets[at + 1] - offsets[at]))").alias("frame"))
            .orderBy("part", "seq", "at").collect())
    return [np.frombuffer(_decompressor(content[r.dictionary]).decompress(bytes(r.frame)), "<u2").tolist() for r in rows]


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what :func:`read` returns."""
    return tokens.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

