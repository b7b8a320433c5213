"""Near-duplicate texts by order MinHash, verified by a banded alignment.

A text is its lower-cased words; its k-mers are ``K`` neighbouring words,
each labelled with the number of its occurrence, so repeats count. A sketch
takes the ``TAKEN`` k-mers of least hash and hashes them in the order in which
they stand in the text: texts that hold the same parts in another order get
another sketch, which follows edit similarity more closely than a set does.
Texts with one of ``SKETCHES`` sketches in common are candidates. Of a text of
few words an edit leaves few k-mers, so up to ``SHORT`` words all runs of
three words are added, which an edit similarity of 0.8 cannot all break.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import mixed, rows_of, save, signed
from siltstone.llm.graph import components

K = 5
TAKEN = 2
SKETCHES = 64
SIMILARITY = 0.8
# Up to SHORT words all runs of three words are keys, up to PAIR_WORDS those of two: with a
# fifth of the words edited one of them is left whole.
SHORT = 40
PAIR_WORDS = 8
# Size of the bitmap of a text's words: sharp up to some thousand words, right for any.
BAG_BITS = 4096
# A folded bitmap of this many 64-bit columns is compared first.
FOLDED = 16
# Copies of a group's first row, so that a large group is named in as many tasks.
SALTS = 16

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _word_hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        out[i] = h
    return out


def _labelled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-mers, each mixed with the number of earlier equal ones."""
    k = min(k, len(h))
    grams = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        grams = mixed(grams * np.uint64(31) + h[j:len(h) - k + 1 + j])
    order = np.argsort(grams, kind="stable")
    new = np.append(True, grams[order][1:] != grams[order][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    number = np.empty(len(order), np.uint64)
    number[order] = np.arange(len(order)) - first
    return mixed(grams ^ (number * np.uint64(0x9E3779B97F4A7C15)))


def sketches(h: np.ndarray, k: int = K, taken: int = TAKEN, count: int = SKETCHES) -> np.ndarray:
    """One 64-bit value per sketch, of the word hashes of one text (not empty)."""
    grams = _labelled(h, k)
    take = min(taken, len(grams))
    salts = mixed(np.arange(1, count + 1, dtype=np.uint64))
    # Well-mixed numbers times an odd one: an order of its own for each sketch.
    odd = salts | np.uint64(1)
    out = []
    step = max(1, (1 << 20) // len(grams))
    for begin in range(0, count, step):
        x = ((grams[None, :] * odd[begin:begin + step, None]) >> np.uint64(32)).astype(np.uint32)
        rows = np.arange(len(x))
        places = np.empty((len(x), take), np.int64)
        for t in range(take):
            places[:, t] = x.argmin(axis=1)
            if t + 1 < take:
                x[rows, places[:, t]] = 0xFFFFFFFF
        places.sort(axis=1)
        value = salts[begin:begin + step]
        for t in range(take):
            value = mixed(value * np.uint64(31) + grams[places[:, t]])
        out.append(value)
    return np.concatenate(out)


def run_keys(h: np.ndarray) -> np.ndarray:
    """All short runs of words of a short text as keys."""
    keys = [np.zeros(0, np.uint64)]
    for run, most in ((3, SHORT), (2, PAIR_WORDS)):
        if run <= len(h) <= most:
            keys.append(mixed(_labelled(h, run) + np.uint64(run)))
    return np.concatenate(keys)


def _sketch_rows(k: int, taken: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            n, bands = [], []
            for text in batch.column("text").to_pylist():
                if len(known) > 1 << 18:
                    known.clear()
                h = _word_hashes(words_of(text), known)
                n.append(len(h))
                bands.append(signed(np.concatenate([sketches(h, k, taken, count), run_keys(h)])) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), batch.column("text").is_null(),
                 pa.array(n, pa.int32()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "th", "none", "n", "bands"])

    return run


def distance_within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether the word edit distance of a and b is at most ``most``.

    Furthest-reaching points on the diagonals -d..d after d edits; equal words
    are run through along all diagonals at once. The band grows with d only.
    """
    if abs(len(a) - len(b)) > most:
        return False
    n, m = len(a), len(b)
    same = int(min(n, m))
    unequal = np.flatnonzero(a[:same] != b[:same])
    head = int(unequal[0]) if len(unequal) else same
    a, b = a[head:], b[head:]
    same = min(len(a), len(b))
    if same:
        unequal = np.flatnonzero(a[::-1][:same] != b[::-1][:same])
        tail = int(unequal[0]) if len(unequal) else same
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    n, m = len(a), len(b)
    if max(n, m) <= most:
        return True
    both, counts = np.unique(np.concatenate([a, b]), return_inverse=True)
    bag = np.minimum(np.bincount(counts[:n], minlength=len(both)), np.bincount(counts[n:], minlength=len(both))).sum()
    if max(n, m) - int(bag) > most:
        return False
    a, b = counts[:n], counts[n:]
    if max(n, m) <= BIT_WORDS:
        return _banded_bits(a.tolist(), b.tolist(), most)
    band = 8
    while True:
        band = min(band, most)
        if _banded(a, b, band):
            return True
        if band == most:
            return False
        band *= 4


# Up to here a column of the band is one integer; its masks grow with the square of the length.
BIT_WORDS = 50_000


def _banded_bits(a: list[int], b: list[int], most: int) -> bool:
    """Edit distance at most ``most``: the band's columns as bit vectors of their differences.

    Bit t of column c stands for row c - most + t. ``up`` and ``down`` hold the
    rows where the table grows or falls by one from the row before.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    full = (1 << (2 * most + 1)) - 1
    masks: dict[int, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << (i + most)
    up, down = full >> most << most, 0
    top, diagonal = 1 << (2 * most), n - most
    score = min(n, most)
    for c, w in enumerate(b, 1):
        match = masks.get(w, 0) >> (c - 1) & full
        level = (((match & up) + up) ^ up | match | down) & full
        right = down | full & ~(level | up)
        left = level & up
        if c <= diagonal:
            score += not level & top
        else:
            bit = 1 << (n - c + most)
            score += bool(right & bit) - bool(left & bit)
        up = left | full & ~(level >> 1 | right)
        down = level >> 1 & right
    return score <= most


def _banded(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Edit distance at most ``most``, over the cells with |i - j| <= most."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    width = 2 * most + 1
    shift = np.arange(width) - most
    far = n + m + 1
    padded = np.full(n + m + 2 * width + 1, -1, np.int64)
    padded[width:width + m] = b
    row = np.where(shift >= 0, shift, far)
    row = np.where(shift > m, far, row)
    for i in range(1, n + 1):
        j = shift + i
        start = width + i - 1 - most
        step = row + (padded[start:start + width] != a[i - 1])
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        if i <= most:
            step[most - i] = i
        step[(j < 0) | (j > m)] = far
        row = np.minimum.accumulate(step - shift) + shift
        if row.min() > most:
            return False
    return bool(row[m - n + most] <= most)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """1 - distance / length of the longer is ``least`` or more."""
    longer = max(len(a), len(b))
    return distance_within(a, b, int(np.floor((1 - least) * longer + 1e-9)))


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            last, a, good = None, None, []
            columns = (batch.column(x).to_pylist() for x in ("a", "text_a", "text_b"))
            for key, text_a, text_b in zip(*columns):
                if len(known) > 1 << 18:
                    known.clear()
                if key != last or last is None:
                    last, a = key, _word_hashes(words_of(text_a), known)
                good.append(similar(a, _word_hashes(words_of(text_b), known), least))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def bag_bits(h: np.ndarray, combine: np.ufunc = np.bitwise_or) -> np.ndarray:
    """The words of one text, each labelled with its occurrence, as a bitmap of ``BAG_BITS`` bits.

    Each bit that one text has and another has not stands for a word of the
    first that has no partner in the second, so it costs an edit. Combined by
    ``np.bitwise_xor`` a bit tells whether an odd number of words fell on it:
    words that two texts share cancel out, so long texts blur it no more than
    short ones, and no more bits differ than words of both lack a partner.
    """
    bits = _labelled(h, 1) % np.uint64(BAG_BITS)
    out = np.zeros(BAG_BITS // 64, np.uint64)
    combine.at(out, bits // np.uint64(64), np.uint64(1) << bits % np.uint64(64))
    return out


def folded(parity: np.ndarray) -> np.ndarray:
    """The bitmap of odd counts in ``FOLDED`` words: parts laid over one another count together."""
    return np.bitwise_xor.reduce(parity.reshape(-1, FOLDED), axis=0)


BAGS = "th long, bands array<long>, bag array<long>, " + ", ".join(f"b{i} long" for i in range(FOLDED))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for batch in batches:
        bags, small = [], np.zeros((len(batch), FOLDED), np.uint64)
        for i, text in enumerate(batch.column("text").to_pylist()):
            if len(known) > 1 << 18:
                known.clear()
            bag = bag_bits(_word_hashes(words_of(text), known), np.bitwise_xor)
            bags.append(signed(bag))
            small[i] = folded(bag)
        yield pa.RecordBatch.from_arrays(
            [batch.column("th"), batch.column("bands"), pa.array(bags, pa.list_(pa.int64())),
             *[pa.array(signed(np.ascontiguousarray(c))) for c in small.T]],
            names=["th", "bands", "bag", *[f"b{i}" for i in range(FOLDED)]])


def _unlike(x: str, y: str) -> Column:
    """Bits in which two bitmaps differ."""
    each = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(each, F.lit(0), lambda total, bits: total + bits)


def _unlike_folded(x: str, y: str) -> Column:
    """The same of the folded bitmaps, as a plain sum."""
    return reduce(Column.__add__, [F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))) for i in range(FOLDED)])


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are in different groups."""
    x = groups.select(F.col("node").alias("a"), F.col("root").alias("x"))
    y = groups.select(F.col("node").alias("b"), F.col("root").alias("y"))
    told = pairs.join(x, "a", "left").join(y, "b", "left")
    return told.filter(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def _open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that still hold more than one group, with the root of their group."""
    told = members.join(groups, members["th"] == groups["node"], "left").select(
        "band", "th", "n", F.coalesce("root", "th").alias("root"))
    told = save(told, "members")
    several = told.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return save(told.join(several.select("band"), "band"), "members")


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs that stand in ``tried`` neither way round."""
    swapped = tried.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return pairs.join(tried.unionByName(swapped), ["a", "b"], "left_anti")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    k: int = K, taken: int = TAKEN, count: int = SKETCHES, least: float = SIMILARITY,
) -> DataFrame:
    """Groups of texts linked by an edit similarity of ``least`` or more over words.

    One row per input row: doc_id, th (hash of the text), n_words, class_id (the
    least doc_id of its group), kept (the row stands for its group), n_same
    (rows with this id and text; one of them is to stay). Equal texts are one
    class from the start and are never compared. A text without words (null and
    empty ones too) is grouped with equal texts only; a null text with no other
    row. Groups with null ids only have a null class_id.

    Candidates share a sketch or a key of ``run_keys``. A class is verified against the least one that it
    meets in any bucket, then, if still apart from them, against the least ones
    of its other buckets; at last classes of one bucket that are still in
    different groups are verified against each other, but for pairs whose words
    alone show that they are too far apart, which a bitmap tells before a pair is
    made. So no link within a bucket is lost, and a group of true copies costs
    about one comparison per member.
    """
    texts = rows_of(docs, id_col, text_col)
    rows = save(texts.mapInArrow(
        _sketch_rows(k, taken, count), "doc_id long, th long, none boolean, n int, bands array<long>"), "sketches")
    classes = save(rows.filter("not none").groupBy("th").agg(
        F.min("doc_id").alias("id"), F.max("n").alias("n")), "classes")
    links = _links(texts, rows, classes, count, least)
    groups = components(links)
    named = classes.drop("n").join(groups, classes["th"] == groups["node"], "left").select(
        "th", "id", "root", F.pmod("th", F.lit(SALTS)).alias("salt"))
    named = save(named, "classes")
    first = named.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("f"))
    # A large group is named in several tasks; classes of their own meet nothing.
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    linked = named.filter("root is not null").join(first, ["root", "salt"])
    linked = linked.select("th", F.col("f.id").alias("class_id"), F.col("f.th").alias("stays"))
    named = linked.unionByName(named.filter("root is null").select("th", F.col("id").alias("class_id"), F.col("th").alias("stays")))
    same = rows.groupBy("doc_id", "th", "none").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("n_same"))
    told = same.join(named, "th", "left").select(
        "doc_id", "th", "none", "n_same", F.col("n").cast("long").alias("n_words"),
        F.when(F.col("none"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("none") | ((F.col("th") == F.col("stays")) & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"),
    )
    told = save(told, "groups")
    # One row per input row: repeated rows come back as often as they stood.
    return told.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n_same")))).select(
        "doc_id", "th", "n_words", "class_id", "kept", "n_same")


def _links(texts: DataFrame, rows: DataFrame, classes: DataFrame, count: int, least: float) -> DataFrame:
    """Verified pairs (a, b) of classes that join all that share a bucket and are similar."""
    bands = rows.select("th", "n", F.posexplode("bands").alias("i", "v")).select(
        # Behind the sketches stand single k-mers, whose place says nothing.
        F.xxhash64(F.least("i", F.lit(count)), "v").alias("band"), "th", "n")
    buckets = bands.groupBy("band").agg(F.min("th").alias("pivot"), F.max("th").alias("top"))
    buckets = save(buckets.filter("pivot <> top").drop("top"), "buckets")
    members = save(bands.join(buckets, "band").distinct(), "members")
    ends = members.select("th").distinct().join(classes, "th")
    shown = texts.join(ends, (texts["th"] == ends["th"]) & texts["doc_id"].eqNullSafe(ends["id"]))
    # Repeated rows are one text.
    shown = save(shown.select(ends["th"], "text").dropDuplicates(["th"]), "candidates")

    def verified(pairs: DataFrame) -> DataFrame:
        left = shown.select(F.col("th").alias("a"), F.col("text").alias("text_a"))
        right = shown.select(F.col("th").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return save(both.mapInArrow(_verify(least), "a long, b long"), "links")

    sizes = classes.select(F.col("th").alias("pivot"), F.col("n").alias("m"))
    fits = F.least("n", "m") >= F.greatest("n", "m") * least - 1e-6
    stars = members.filter("th <> pivot").select("pivot", "th", "n").distinct()
    stars = save(stars.join(sizes, "pivot").filter(fits).select(F.col("pivot").alias("a"), F.col("th").alias("b")), "pairs")
    # One comparison per class joins nearly all; then what stands apart of its other buckets' least ones.
    links = verified(save(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs"))
    links = save(links.unionByName(verified(save(_apart(stars, components(links)), "pairs"))), "links")
    rest = _open(members, components(links))
    # Before a pair is made, words without a partner bound its distance from below: d edits leave at most
    # 2 d of them, less the difference of the lengths. First a small bitmap tells, then the whole one; of
    # the buckets that two texts share, the least one makes the pair.
    bags = shown.join(rest.groupBy("th").agg(F.collect_set("band").alias("bands")), "th")
    bags = save(bags.select("th", "text", "bands").mapInArrow(_bags, BAGS), "bags")
    left = save(rest.join(bags, "th"), "members")
    right = left.select(
        "band", F.col("th").alias("b"), F.col("n").alias("m"), F.col("root").alias("other"), F.col("bands").alias("bands_b"),
        F.col("bag").alias("bag_b"), *[F.col(f"b{i}").alias(f"c{i}") for i in range(FOLDED)])
    most = F.floor(F.greatest("n", "m") * (1 - least) + 1e-6)
    lone = most * 2 - F.abs(F.col("n") - F.col("m"))
    near = (F.col("root") < F.col("other")) & fits & (_unlike_folded("b", "c") <= lone) & (_unlike("bag", "bag_b") <= lone)
    near = near & (F.array_min(F.array_intersect("bands", "bands_b")) == F.col("band"))
    more = left.join(right, "band").filter(near).select(F.col("th").alias("a"), "b")
    more = save(_untried(more, stars), "pairs")
    return links.unionByName(verified(more))
