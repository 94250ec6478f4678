"""Quality rules: a table of thresholds compiled into one projection.

Every measure and every rule is a built-in expression over one row, so the whole
operator is a single pass over the texts without a shuffle or a user function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import BLANK_WORD, text_or_empty

WINDOW = 8

# Frequent function words of LANGUAGES. Rules on words can only judge these languages;
# others may have no such words, or write no blanks between words.
LANGUAGES = ["en", "de", "fr", "es"]
STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "with", "was", "on", "as", "are", "by", "an", "at",
    "der", "die", "das", "und", "ist", "ein", "eine", "von", "zu", "den", "für", "nicht", "mit", "des", "im",
    "le", "la", "les", "de", "et", "un", "une", "du", "en", "que", "pour", "dans", "est", "par", "au",
    "el", "los", "las", "y", "por", "con", "una", "para", "del", "no", "se", "lo", "su", "al", "es",
]

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"

# What a document is rejected for: measure, comparison, threshold, the number of words from
# which on the rule applies (ratios of short texts say little), and whether only texts whose
# ``lang`` is one of LANGUAGES are judged by it.
BASE_RULES = [
    ("n_words", "<", 20, 0, False),
    ("repeat_percent", ">", 30, 0, False),
]
RULES = [
    ("mean_word_chars", "<", 1.5, 0, False),
    ("mean_word_chars", ">", 30.0, 0, True),
    ("symbol_ratio", ">", 0.25, 0, False),
    ("capital_ratio", ">", 0.6, 0, False),
    ("dup_line_ratio", ">", 0.6, 0, False),
    ("stop_word_ratio", "<", 0.002, 300, True),
]


def _in_order(array: Column, change) -> Column:
    """``change`` applied to an array that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(array), change), 1)


def repeat_words(words: Column, n_words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words found twice or more in the text."""

    def covered(at: Column) -> Column:
        # Positions in order; each run covers what lies before the next one.
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
            lambda s, p: F.struct(
                (s["n"] + F.least(F.lit(window), p - s["last"])).alias("n"), p.alias("last")
            ),
            lambda s: s["n"],
        )

    def positions(runs: Column) -> Column:
        # Equal hashes stand side by side once sorted.
        return _in_order(
            F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"])
                        | x["h"].eqNullSafe(F.get(s, i + 1)["h"]),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    runs = F.transform(
        F.sequence(F.lit(1), n_words - window + 1), lambda i: F.xxhash64(F.slice(words, i, window))
    )
    counted = _in_order(
        runs,
        lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0)).otherwise(covered(positions(r))),
    )
    return F.when(n_words <= window, F.lit(0)).otherwise(counted).cast("long")


def _compiled(rules) -> Column:
    """TRUE where any rule of the table rejects."""
    failed = F.lit(False)
    for measure, comparison, threshold, words, by_language in rules:
        value = F.col(f"__{measure}")
        broken = value < threshold if comparison == "<" else value > threshold
        applies = F.col("__n_words") >= words
        if by_language:
            applies = applies & F.col("__known")
        failed = failed | F.coalesce(broken & applies, F.lit(False))
    return failed


def judge(docs: DataFrame, base=BASE_RULES, rules=RULES) -> DataFrame:
    """Adds the measures, ``base_failed`` and ``kept`` to documents with a ``text``.

    A NULL text is empty: it has no words and is rejected by the base rules, as is any
    text of blanks. Ratios without a denominator are NULL and reject nothing. Repeated
    rows are judged alike, and columns of ``docs`` with the names of the measures are
    replaced. Texts are read whole, however long. Where ``lang`` is NULL, missing or none of
    LANGUAGES, the rules that need a language reject nothing. An empty table gives no rows.
    """
    text = F.col("__text")
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    out = (
        docs.withColumn("__text", text_or_empty())
        .withColumn("__known", F.col("lang").isin(LANGUAGES) if "lang" in docs.columns else F.lit(False))
        .withColumn("__words", F.regexp_extract_all("__text", F.lit(BLANK_WORD), F.lit(0)))
        .withColumn("__lines", lines)
        .withColumn("__n_words", F.size("__words").cast("long"))
        .withColumn("__n_lines", F.size("__lines"))
        .withColumn("__word_chars", F.length(F.translate(text, BLANKS, "")).cast("long"))
        .withColumn("__n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("__n_capitals", F.length(text) - F.length(F.translate(text, CAPITALS, "")))
        .withColumn("__n_stops", F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))))
        .withColumn("__n_dup_lines", (F.col("__n_lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("__n_repeat_words", repeat_words(F.col("__words"), F.col("__n_words").cast("int")))
        .drop("__words", "__lines", "__text")
    )
    words, chars = F.nullif("__n_words", F.lit(0)), F.nullif("__word_chars", F.lit(0))
    out = out.withColumns(
        {
            "__repeat_percent": F.lit(100) * F.col("__n_repeat_words") / words,
            "__mean_word_chars": F.col("__word_chars") / words,
            "__symbol_ratio": F.col("__n_symbols") / words,
            "__capital_ratio": F.col("__n_capitals") / chars,
            "__stop_word_ratio": F.col("__n_stops") / words,
            "__dup_line_ratio": F.col("__n_dup_lines") / F.nullif("__n_lines", F.lit(0)),
        }
    )
    named = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = out.withColumns({name: F.col(f"__{name}") for name in named} | {"base_failed": _compiled(base)})
    out = out.withColumn("kept", ~(F.col("base_failed") | _compiled(rules)))
    return out.drop(*[c for c in out.columns if c.startswith("__") and c not in docs.columns])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns only."""
    language = ["lang"] if "lang" in docs.columns else []
    judged = judge(docs.select(F.struct(*docs.columns).alias("__doc_"), "text", *language))
    # A filter on a row number stays above the measures. Without it, the optimizer would
    # write the measures into the filter, once for every place that uses them.
    numbered = judged.withColumn("row", F.monotonically_increasing_id())
    return numbered.filter("kept AND row >= 0").select("__doc_.*")
