"""Line-first cleaning: lines that break a rule go, then texts that lost too much.

Everything is an expression over one row; no text is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import rows_of

# Fixed values of the base counts.
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50

# Line rules. A line ends like a sentence, perhaps with a closing mark behind.
ENDS = r"[.!?:;…。][\"')\]”’»]*[\x20\x09-\x0D]*$"
MAX_SYMBOL_PERCENT = 10
SEPARATORS = "|>»·•/"
NAVIGATION_MARKS = 3
NAVIGATION_WORDS = 12
BOILERPLATE = (
    r"(?i)(all rights reserved|copyright|licensed under|public license|terms of (use|service)|privacy policy"
    r"|accept cookies|use of cookies|enable javascript|lorem ipsum|click here|sign up for|subscribe to)"
)
MIN_KEPT_PERCENT = 50


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def repeated_words(w: Column) -> Column:
    """Words in 3-word windows that stand twice or more in the array ``w``.

    Windows are hashed, the place is put in the low bits, and after one sort
    equal windows are neighbours; neighbours are compared word by word.
    """
    def marked(w: Column, bits: Column, keys: Column) -> Column:
        place = lambda x: x.bitwiseAND(_low(bits))
        part = lambda x: F.call_function("shiftrightunsigned", x, bits)

        def same(x: Column, y: Column) -> Column:
            p, q = place(x), place(y)
            equal = part(x) == part(y)
            for i in range(3):
                equal = equal & (F.get(w, (p + i).cast("int")) == F.get(w, (q + i).cast("int")))
            return F.coalesce(equal, F.lit(False))

        hits = F.filter(keys, lambda x, k: same(x, F.get(keys, k - 1)) | same(x, F.get(keys, k + 1)))
        return F.size(F.array_distinct(F.flatten(F.transform(
            hits, lambda x: F.array(place(x), place(x) + 1, place(x) + 2)))))

    def keyed(w: Column, bits: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.call_function(
            "shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")))
        return let(F.sort_array(keys), lambda k: marked(w, bits, k))

    bits = F.length(F.bin(F.size(w)))
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(bits, lambda b: keyed(w, b)))


def _low(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1).cast("long")


def _marks(line: Column) -> Column:
    """Separators in a line, counted without a pattern: one that repeats a group needs stack for every repetition."""
    return F.length(line) - F.length(F.translate(line, SEPARATORS, ""))


def line_fails(line: Column) -> Column:
    """Whether a line that holds a word breaks a rule."""
    solid = _without(line, SPACES)
    symbols = _without(solid, f"[^{SYMBOLS}]+")
    n_words = F.size(words(line))
    return (
        ~line.rlike(ENDS)
        | (F.length(symbols) * 100 > F.length(solid) * MAX_SYMBOL_PERCENT)
        | ((n_words <= NAVIGATION_WORDS) & (_marks(line) >= NAVIGATION_MARKS))
        | line.rlike(BOILERPLATE)
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_kept: int = MIN_KEPT_PERCENT) -> DataFrame:
    """Counts, the cleaned text and the verdict for every text.

    One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines (with a word), n_lines_kept, chars_kept
    (without spaces, in kept lines), clean_text, kept. ``base_failed`` and
    ``kept`` follow the limits above; a text is kept if it doesn't fail the
    base and its good lines hold ``min_kept`` percent of its solid characters.
    A null text has no words and an empty clean text; it and an empty one fail.
    """
    rows = rows_of(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    t = F.col("text")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    good = lambda a: F.filter(a, lambda x: ~line_fails(x))

    def about_lines(a: Column) -> Column:
        return let(good(a), lambda g: F.struct(
            (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            F.size(a).cast("long").alias("n_lines"), F.size(g).cast("long").alias("n_lines_kept"),
            F.array_join(g, "\n").alias("clean_text")))

    def about_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))

    told = rows.select(
        "doc_id",
        F.length(_without(t, SPACES)).cast("long").alias("word_chars"),
        F.length(_without(t, f"[^{SYMBOLS}]+")).cast("long").alias("n_symbols"),
        let(words(t), about_words).alias("w"), let(lines, about_lines).alias("l"),
    )
    failed = (F.col("w.n_words") < MIN_WORDS) | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * REPEAT_PERCENT)
    left = F.length(_without(F.col("l.clean_text"), SPACES)).cast("long")
    return told.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
        failed.alias("base_failed"), "l.n_lines", "l.n_lines_kept", left.alias("chars_kept"), "l.clean_text",
        (~failed & (left * 100 >= F.col("word_chars") * min_kept)).alias("kept"),
    )
