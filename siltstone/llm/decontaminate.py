"""Benchmark passages in documents: a prefix-filtered join on rare shingles, verified word by word.

A document contains a window of an item if it contains all of the window's
shingles, so it is enough to look for one of them: with full containment the
necessary prefix of a window, its shingles ordered by rarity, is the rarest one.
Every hit of that shingle fixes where the window would have to start; the bounds
of the text (length and position) and then the words themselves decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import rows_of, same_row, save

WINDOW = 13
SHINGLE = 5
# Largest number of windows, by item, that are sent to every task (some 100 bytes each).
SENT = 200_000

# What separates words, and the letters that are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """The words of a text column in order; of null there are none."""
    t = F.coalesce(F.col(text), F.lit(""))
    # On plain ASCII, lower() does the same and is faster.
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def _shingle(array: str, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, start + i) for i in range(size)])


def _positions(n: Column) -> Column:
    """0, 1, .. n - 1; a null if there are none (an inner explode would compute its input twice)."""
    return F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)))


def item_windows(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item_id, words, window_id): the distinct windows of every item."""
    rows = items.select(F.col(item_col).alias("item_id"), words(text_col).alias("w")).filter(F.size("w") > 0)
    starts = rows.select("item_id", "w", _positions(F.greatest(F.size("w") - (size - 1), F.lit(1))).alias("i"))
    cut = starts.select("item_id", F.slice("w", F.col("i") + 1, F.lit(size)).alias("words"))
    pairs = cut.distinct().withColumn("window_id", F.xxhash64("words"))
    return save(pairs, "windows")


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", size: int = WINDOW, shingle: int = SHINGLE,
    one_in: int = 20,
) -> DataFrame:
    """Words of each document that lie in an occurrence of a window of an item.

    One row per input row: doc_id, th (hash of the text), n_words, n_hit, items
    (sorted ids, as strings, of the items with a window in the text), contaminated
    (some hit, and one word ``one_in`` or more is hit). A window is ``size``
    consecutive words of an item, or all of a shorter one. Null and empty texts
    have no words; items without words have no windows; a null item id is left
    out of ``items`` but its words count; repeated items and rows change nothing.
    """
    rows = rows_of(docs, id_col, text_col).withColumn("w", words("text")).drop("text")
    pairs = item_windows(items, item_col, item_text, size)
    windows = pairs.select("window_id", "words").distinct()
    few = pairs.limit(SENT + 1).count() <= SENT

    def sent(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if few else side

    # Windows shorter than a shingle are looked up by their first word.
    long_ = windows.filter(F.size("words") >= shingle)
    short = windows.filter(F.size("words") < shingle)
    tokens = [
        (s, part.select("window_id", "words", _positions(F.size("words") - (s - 1)).alias("at"))
         .withColumn("token", _shingle("words", F.col("at"), s)))
        for s, part in ((shingle, long_), (1, short)) if not part.isEmpty()
    ]
    hits = [_hits(rows, t, s, few, sent) for s, t in tokens]
    if hits:
        hits = reduce(DataFrame.unionByName, hits)
    else:
        hits = rows.limit(0).select("doc_id", "th", F.lit(0).alias("lo"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("window_id"))
    hits = save(hits, "hits")
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.col("spans"), lambda s: F.sequence(s["lo"], s["lo"] + s["n"] - 1)))))
    spans = hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    spans = spans.select("doc_id", "th", covered.cast("long").alias("n_hit"))
    found = hits.select("doc_id", "th", "window_id").distinct()
    found = found.join(sent(pairs.select("window_id", F.col("item_id").cast("string").alias("item_id"))), "window_id")
    found = found.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    spans = spans.join(found, same_row(spans, found), "left").select(spans["doc_id"], spans["th"], "n_hit", "items")
    spans = save(spans, "spans")
    base = rows.select("doc_id", "th", F.size("w").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return base.join(spans, same_row(base, spans), "left").select(
        base["doc_id"], base["th"], "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )


def _hits(rows: DataFrame, tokens: DataFrame, size: int, few: bool, sent) -> DataFrame:
    """(doc_id, th, lo, n, window_id) of the windows that stand in a text, by shingles of ``size`` words."""
    # Next to a small table the words stay in place; else only shingles are moved.
    held = ["w"] if few else []
    at = rows.select("doc_id", "th", "w", F.size("w").alias("all"), _positions(F.size("w") - (size - 1)).alias("i"))
    shingles = at.select("doc_id", "th", "all", "i", _shingle("w", F.col("i"), size).alias("token"), *held)
    known = sent(tokens.select("token").distinct())
    counts = shingles.select("token").join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    ranked = tokens.join(counts, "token", "left").fillna(0, ["c"])
    # Windows with a shingle that no document holds cannot occur.
    rarest = ranked.groupBy("window_id").agg(F.min(F.struct("c", "token", "at")).alias("r"))
    prefix = tokens.select("window_id", "words").distinct().join(rarest, "window_id").filter("r.c > 0")
    prefix = save(prefix.select("window_id", "words", "r.token", "r.at"), "prefixes")
    n, lo = F.size("words"), F.col("i") - F.col("at")
    near = shingles.join(sent(prefix), "token").filter((lo >= 0) & (lo + n <= F.col("all")))
    near = near.select("doc_id", "th", lo.alias("lo"), n.alias("n"), "window_id", "words", *held)
    if not few:
        texts = rows.select("doc_id", "th", "w").distinct()
        near = near.join(texts, same_row(near, texts)).drop(texts["doc_id"], texts["th"])
    return near.filter(F.slice("w", F.col("lo") + 1, F.col("n")) == F.col("words")).select(
        "doc_id", "th", "lo", "n", "window_id")
