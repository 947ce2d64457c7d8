"""Line-first cleaning with Spark expressions.

Every line is judged by punctuation, navigation and boilerplate rules; failing lines go, and a
document that loses too much of its text is rejected.  Counts over the whole text come first
(`base_counts`).  Nothing is shuffled: a document is judged inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Lines of at least this many words have to have the end of a sentence somewhere.
MIN_SENTENCE_WORDS = 6
SENTENCE_END = r"[.!?:;…。！？][\"'”’)\]]*(\s|$)"
#: Separators between menu entries.
NAVIGATION = r"(\s[|»•>·]\s.*){3}"
#: A line with more than one such character for this many words is markup or shouting.
NOISE_CHARS, WORDS_PER_NOISE = "#*$%&|<>!~^", 3
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|accept (all )?cookies|enable javascript"
    r"|click here|sign (in|up) (to|for|now)|subscribe to our|skip to (main )?content|lorem ipsum|^\s*licen[sc]ed under"
    r"|^\s*released under the|work is licensed under|^\s*copyright )"
)
#: Most that a kept document may lose, in percent of the characters of its lines.
MAX_LOST_PERCENT = 40


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def base_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text, lines and the counts of each document; null text has no words.

    Repeated 3-word windows are found by sorting their 64-bit hashes with their positions.
    Duplicate ids and repeated rows are judged row by row.
    """
    docs = docs.select(F.col(key), F.coalesce("text", F.lit("")).alias("text"))
    worded = docs.select(
        key, "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: F.translate(line, SPACES, "") != "").alias("lines"),
    )
    n = F.size("words")

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)])

    none = F.array().cast("array<bigint>")
    hashed = worded.select(
        key, "text", "lines", n.cast("long").alias("n_words"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window_hash)).otherwise(none).alias("hashes"),
    )
    # Only texts with a repeated window pay for the sort.
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    by_hash = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ranked = hashed.select(
        key, "text", "lines", "n_words",
        F.when(repeats, by_hash).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("ranked"),
    )

    def is_repeated(x: Column, k: Column) -> Column:
        same_before = (k > 0) & (F.get(F.col("ranked"), k - 1)["h"] == x["h"])
        return F.coalesce(same_before | (F.get(F.col("ranked"), k + 1)["h"] == x["h"]), F.lit(False))

    found = ranked.select(
        key, "text", "lines", "n_words",
        F.sort_array(F.transform(F.filter("ranked", is_repeated), lambda x: x["i"])).alias("at"),
    )
    # A window covers three words, or as many as there are up to the next repeated window.
    covered = F.transform(
        "at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - p, F.lit(WINDOW)))
    )
    return found.select(
        key,
        "text",
        "lines",
        "n_words",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda total, x: total + x).alias("n_repeat_words"),
    )


def line_fails(line: Column) -> Column:
    """Whether a line with a word fails a rule."""
    n_words = F.length(F.regexp_replace(line, WORD, "w")) - F.length(F.regexp_replace(line, WORD, ""))
    no_sentence = (n_words >= MIN_SENTENCE_WORDS) & ~line.rlike(SENTENCE_END)
    noisy = _count_of(line, NOISE_CHARS) * WORDS_PER_NOISE > n_words + 2 * WORDS_PER_NOISE
    return no_sentence | noisy | line.rlike(NAVIGATION) | line.rlike(BOILERPLATE)


def clean_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The base counts, cleaned (text without failing lines), lost_chars, line_chars and the verdict.

    Lines without a word are neither judged nor kept.  ``kept`` is false where the base rules
    fail, or where more than `MAX_LOST_PERCENT` of the characters of the lines were removed.
    """
    judged = base_counts(docs, key).withColumn("good", F.filter("lines", lambda line: ~line_fails(line)))
    chars = lambda name: F.length(F.array_join(name, "")).cast("long")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.col("line_chars") - F.length(F.array_join("good", ""))
    return (
        judged.withColumn("line_chars", chars("lines"))
        .withColumn("lost_chars", lost.cast("long"))
        .withColumn("base_failed", base_failed)
        .select(
            key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "lost_chars",
            F.array_join("good", "\n").alias("cleaned"), "base_failed",
            (~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("line_chars"))).alias("kept"),
        )
    )
