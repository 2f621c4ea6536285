"""Quality rules: a threshold table compiled into Spark projections, without user functions.

Counts come from built-in string and array functions only; the verdict is one boolean
expression built from :data:`RULES`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators of words, symbols, stop words.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "sie", "und", "von", "zu",
    "au", "avec", "ce", "dans", "du", "est", "et", "il", "la", "le", "les", "pas", "pour", "que", "qui", "sur", "un", "une",
    "al", "con", "de", "el", "en", "es", "los", "las", "no", "para", "por", "se", "su", "una", "y",
)
GRAM = 5


#: Letters beyond ASCII of the languages that the stop words cover.
LETTERS = "ÀÂÄÆÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜàâäæçèéêëìíîïñòóôöùúûüßÿœŒ¿¡"
#: A text is in a script (or a language) that the rules know if it has at most so many bytes of other characters a character.
FOREIGN = 0.02


@dataclass(frozen=True)
class Rule:
    """Keep a document if low <= metric <= high; it applies from ``from_words`` words on. ``known``: it applies to
    texts in the scripts that the word list covers only; elsewhere words are longer or shorter, and stop words others."""

    name: str
    low: float | None
    high: float | None
    from_words: int = 10
    known: bool = False


#: metric, least, most, words from which the rule holds
RULES = (
    Rule("n_words", 10, None, 0),
    Rule("word_length", 2.0, 12.0, known=True),
    Rule("symbol_ratio", None, 0.10),
    Rule("upper_ratio", None, 0.50, known=True),
    Rule("exclamation_ratio", None, 0.50),
    Rule("line_ratio", None, 0.50),
    Rule("echo_ratio", None, 0.30),
    Rule("stop_word_ratio", 0.01, None, 100, known=True),
)


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def counts(docs: DataFrame) -> DataFrame:
    """The row itself (``_doc``), ``doc_id`` and the counts the rules need, for each row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(F.col("body"), f"[{SPACES}]+"), lambda w: w != "")
    w = F.col("words")
    gram = F.transform(F.sequence(F.lit(0), F.col("n_words") - GRAM),
                       lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(GRAM))))
    near = lambda x, j: (F.get("marks", j - 1)["h"].eqNullSafe(x["h"])
                         | F.get("marks", j + 1)["h"].eqNullSafe(x["h"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, p: F.struct((a["n"] + F.lit(GRAM) - F.greatest(F.lit(0), a["end"] - p)).alias("n"),
                                 (p + F.lit(GRAM)).alias("end"))
    return (docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.col("doc_id").cast("long"), text.alias("body"))
            .withColumn("words", words)
            .withColumn("n_words", F.size("words"))
            .withColumn("grams", F.when(F.col("n_words") > GRAM, gram).otherwise(F.array().cast("array<bigint>")))
            .withColumn("marks", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform(
                "grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
            .withColumn("places", F.sort_array(F.transform(F.filter("marks", near), lambda x: x["i"])))
            .withColumn("lines", F.filter(F.split("body", "\n"), lambda x: F.trim(F.translate(x, SPACES, " " * len(SPACES))) != ""))
            .select(
                "_doc", "doc_id", "n_words",
                _without(F.col("body"), SPACES).alias("word_chars"),
                (F.length("body") - _without(F.col("body"), SYMBOLS)).alias("n_symbols"),
                (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                F.coalesce(F.aggregate("places", start, step, lambda a: a["n"]), F.lit(0)).alias("n_repeat_words"),
                F.size("lines").alias("n_lines"),
                # bytes beyond one a character, but for those of the known letters (two bytes each)
                (F.octet_length("body") - F.length("body") - (F.length("body") - _without(F.col("body"), LETTERS))).alias("n_foreign"),
                (F.length("body") - _without(F.col("body"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊÍÑÓÔÖÚÜ")).alias("n_upper"),
                (F.length("body") - _without(F.col("body"), "!")).alias("n_exclamations"),
                F.size(F.filter("words", lambda x: F.lower(x).isin(*STOP_WORDS))).alias("n_stop_words"),
                F.size(F.filter("words", lambda x, i: x.eqNullSafe(F.get(w, i - 1)))).alias("n_echoes")))


METRICS = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.try_divide("word_chars", "n_words"),
    "symbol_ratio": lambda: F.try_divide("n_symbols", "n_words"),
    "upper_ratio": lambda: F.try_divide("n_upper", "word_chars"),
    "exclamation_ratio": lambda: F.try_divide("n_exclamations", "n_words"),
    "line_ratio": lambda: F.try_divide("n_dup_lines", "n_lines"),
    "echo_ratio": lambda: F.try_divide("n_echoes", "n_words"),
    "stop_word_ratio": lambda: F.try_divide("n_stop_words", "n_words"),
}


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    out = F.lit(True)
    for r in rules:
        value = METRICS[r.name]()
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
        spared = F.col("n_words") < r.from_words
        if r.known:
            spared = spared | (F.col("n_foreign") > FOREIGN * F.col("word_chars"))
        out = out & (ok | spared)
    return F.coalesce(out, F.lit(False))


def _failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string; other columns are ignored): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean).

    base_failed: fewer than 10 words, or over 20 % of the words lie in 5-word windows that occur twice or more in the
    text. kept: not base_failed and within all thresholds that apply to its length and script. Null and empty texts have no words and fail; rows
    that repeat are judged alike; an empty table gives no rows.
    """
    out = counts(docs)
    return out.select(
        "doc_id", *(F.col(c).cast("long") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        _failed().alias("base_failed"), (~_failed() & verdict(rules)).alias("kept"))


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all columns of ``docs``. A row is judged by its text alone.

    Rows go by exploding an array of one row or none: the optimizer would push a filter below the projections
    and evaluate the word arrays anew for each of their elements."""
    kept = F.when(~_failed() & verdict(rules), F.array("_doc"))
    return counts(docs).select(F.explode(kept).alias("_doc")).select("_doc.*")
