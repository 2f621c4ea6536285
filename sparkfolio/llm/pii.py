"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, plus signs, digits, URL schemes, identifier cues) in one pass over
the text; a small deterministic parser for each kind expands an anchor to both sides and validates what it finds.

Kinds: email, ip, card, phone (the base kinds), then url (a scheme and a host) and account (an identifier after a cue
such as "account" or "password", or an access key id). Offsets are code points, ends exclusive. Within a kind, spans go from
left to right and do not overlap; an expansion that fails validation is dropped without another try inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.spark_env import map_texts, prepare

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
#: URL schemes, and words that announce an identifier.
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "konto", "cuenta", "compte", "passport", "ssn", "password", "passwd", "token", "api_key", "apikey",
        "secret", "customer id", "user id")
KEY_PREFIX = "akia"

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _DIGITS | _LETTERS | {"-"}
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\x0b\x0c\r<>\"'`{}|\\^")
_LOWER = {c: c + 32 for c in range(65, 91)}
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _run(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    whole = None
    while end < len(text) and text[end] == "." and (stop := _run(text, end + 1, _LABEL)) > end + 1:
        whole = end = stop
    return (start, whole, True) if whole else None


def _ip(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    end, valid = at, True
    for part in range(4):
        if part:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        stop = _run(text, end, _DIGITS)
        if stop == end:
            return None
        value = text[end:stop].lstrip("0")
        valid &= len(value) < 3 or len(value) == 3 and value <= "255"
        end = stop
    return at, end, valid


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _card(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    end = _run(text, at, _DIGITS)
    while end + 1 < len(text) and text[end] in " -" and text[end + 1] in _DIGITS:
        end = _run(text, end + 1, _DIGITS)
    if end - at < 2:
        return None
    digits = text[at:end].replace(" ", "").replace("-", "") if end - at <= 64 else ""
    return at, end, 13 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _run(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return at, end, 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15


def _url(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    """``at``: where the scheme begins."""
    host = text.index("://", at) + 3
    end = host
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > host and text[end - 1] in ".,;:!?)]":
        end -= 1
    name = text[host:_run(text, host, _LABEL | {"."})]
    return (at, end, True) if "." in name.strip(".") else None


def _account(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    """``at``: the end of the cue. The identifier follows within a few separators."""
    start = at
    while start < len(text) and start - at < 6 and text[start] in " :=#\"'":
        start += 1
    end = _run(text, start, _LABEL | {"_"})
    value = text[start:end]
    ok = start > at and 6 <= end - start <= 64 and sum(c in _DIGITS for c in value) >= 3
    return (start, end, True) if ok else None


def _key(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    """``at``: where an access key id begins; 20 upper-case letters and digits."""
    end = _run(text, at, _DIGITS | _LETTERS)
    value = text[at:end]
    return (at, end, True) if end - at == 20 and value == value.upper() and (at == 0 or text[at - 1] not in _LABEL) else None


_FINDER: list = []


def _finder() -> ahocorasick.Automaton:
    if not _FINDER:
        made = ahocorasick.Automaton()
        for word, name in (("@", "@"), ("+", "+"), *((c, "9") for c in "0123456789"), *((s, "url") for s in SCHEMES),
                           *((c, "cue") for c in CUES), (KEY_PREFIX, "key")):
            made.add_word(word, (name, len(word)))
        made.make_automaton()
        _FINDER.append(made)
    return _FINDER[0]


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by kind as listed, then start."""
    found = {k: [] for k in KINDS}
    floor = dict.fromkeys(KINDS, 0)
    digits = 0                                               # end of the digit run seen last
    plans = {"@": (("email", _email),), "+": (("phone", _phone),), "9": (("ip", _ip), ("card", _card)),
             "url": (("url", _url),), "cue": (("account", _account),), "key": (("account", _key),)}
    for last, (name, size) in _finder().iter(text.translate(_LOWER)):
        at = last + 1 if name == "cue" else last + 1 - size
        if name == "9":
            if at < digits:
                continue
            digits = _run(text, at, _DIGITS)
        for kind, parser in plans[name]:
            if at >= floor[kind] and (span := parser(text, at, floor[kind])):
                floor[kind] = span[1]
                if span[2]:
                    found[kind].append((kind, span[0], span[1]))
    return [s for k in KINDS for s in found[k]]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t.as_py() or "")] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id and spans, an array of
    (kind, start, end) by kind as listed in ``KINDS``, then start.

    Null and empty texts have no spans; rows that repeat get the same spans; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_spans, f"doc_id long, spans {SPANS}")


def redact_text(text: str) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans, one bracket for all."""
    out, end = [], 0
    for kind, start, stop in sorted(find(text), key=lambda s: (s[1], -s[2])):
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]]) if out else text


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = pa.array([None if (t := x.as_py()) is None else redact_text(t) for x in batch.column(at)], pa.string())
        yield batch.set_column(at, "text", text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by the kind in brackets; null texts stay null, all rows stay,
    and ``n_chars``, if there is one, follows the new text."""
    prepare(docs.sparkSession)
    out = map_texts(docs.withColumn("text", F.col("text").cast("string")), _redact)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
