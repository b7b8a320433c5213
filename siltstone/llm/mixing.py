"""Sample documents so that their tokens meet target shares per source, language and topic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import save

SWEEPS = 60
CLOSE = 1e-6

# An example of topics for texts without a label: the first pattern that matches, else "prose".
TOPICS = (
    ("legal", r"(?i)licen[cs]e"),
    ("contact", r"[\w.]@[\w]|\d{3}[- ]\d{3}"),
    ("table", r" \| "),
    ("markup", r"[#*$%&<>]{2}"),
)


def topic_of(text: str, topics: Sequence[tuple[str, str]] = TOPICS) -> Column:
    told = F.when(F.lit(False), F.lit("prose"))
    for name, pattern in topics:
        told = told.when(F.col(text).rlike(pattern), F.lit(name))
    return told.otherwise(F.lit("prose"))


def tempered(cells: DataFrame, column: str, power: float) -> DataFrame:
    """(column, share): shares in proportion to tokens to a power; 1 leaves them, 0 evens them out."""
    totals = cells.groupBy(column).agg(F.sum("tokens").alias("t")).filter("t > 0")
    weight = F.pow("t", F.lit(float(power)))
    # One number comes to the driver; the values stay where they are.
    total = totals.agg(F.sum(weight)).first()[0] or 1.0
    return totals.select(column, (weight / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, close: float = CLOSE) -> DataFrame:
    """Iterative proportional fitting of the weights of ``cells`` (columns of ``targets``, tokens).

    Adds ``weight``: starting from its tokens, every cell is scaled until the
    weights' shares meet the target shares of each column in turn, and so on
    until no share is off by more than ``close``, or ``sweeps`` are done, or as
    many more at the last one's pace would not get there. ``gap``
    is the largest difference that is left, the same in each row: above
    ``close`` the weights have not converged, as when targets contradict each
    other. Cells without tokens or of a value without a target weigh nothing.
    The table has one row per combination of values, and stays a distributed
    table; sums per value are aggregated and joined back.
    """
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for column, target in targets.items():
        share = target.select(F.col(column).alias("_v"), F.col("share").alias(f"_{column}"))
        cells = cells.join(share, cells[column].eqNullSafe(share["_v"]), "left").drop("_v")
    cells = save(cells, "cells")
    gap = 0.0
    for sweep in range(sweeps):
        step = cells
        for column in targets:
            sums = step.groupBy(F.col(column).alias("_v")).agg(F.sum("weight").alias("_sum"))
            step = step.join(sums, step[column].eqNullSafe(sums["_v"]), "left")
            step = step.withColumn("weight", F.when(
                F.col("_sum") > 0, F.col("weight") * F.coalesce(F.col(f"_{column}"), F.lit(0.0)) / F.col("_sum")
            ).otherwise(0.0)).drop("_v", "_sum")
        cells = save(step, "cells")
        last, gap = gap, _furthest(cells, list(targets))
        if gap <= close or (sweep > 2 and (last - gap) * sweeps < gap - close):
            break
    return cells.drop(*[f"_{c}" for c in targets]).withColumn("gap", F.lit(float(gap)))


def _furthest(cells: DataFrame, columns: list[str]) -> float:
    """The largest gap between a share and its target; targets that no cell can meet aside."""
    sums = cells.groupBy().agg(F.sum("weight")).first()[0] or 1.0
    gaps = [
        cells.groupBy(c).agg(F.abs(F.sum("weight") / sums - F.coalesce(F.max(f"_{c}"), F.lit(0.0))).alias("gap"))
        for c in columns
    ]
    both = gaps[0].select("gap")
    for g in gaps[1:]:
        both = both.unionByName(g.select("gap"))
    return both.agg(F.max("gap")).first()[0] or 0.0


def rates(cells: DataFrame, fraction: float) -> DataFrame:
    """Add ``rate``: the chance of a document of the cell, so that the expected tokens are ``fraction`` of all.

    rate = min(1, scale * weight / tokens). What full cells cannot give is
    shared out among the others by searching for the scale.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = save(cells.withColumn("_ratio", ratio), "rates")
    total, top = cells.agg(F.sum("tokens"), F.max("_ratio")).first()
    if not total or not top:
        return cells.withColumn("rate", F.lit(0.0)).drop("_ratio")
    low, high = 0.0, 1.0 / cells.filter("_ratio > 0").agg(F.min("_ratio")).first()[0]
    want = fraction * total
    # A grid search in parallel: 64 scales for each job.
    for _ in range(5):
        grid = [low + (high - low) * i / 64 for i in range(65)]
        sums = cells.agg(*[F.sum(F.least(F.lit(1.0), F.lit(s) * F.col("_ratio")) * F.col("tokens")) for s in grid]).first()
        at = next((i for i, s in enumerate(sums) if s >= want), 64)
        low, high = grid[max(at - 1, 0)], grid[at]
    return cells.withColumn("rate", F.least(F.lit(1.0), F.lit(high) * F.col("_ratio"))).drop("_ratio")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    fraction: float = 0.8, powers: tuple[float, float, float] = (0.7, 0.8, 1.0), seed: str = "mix", topic_col: str | None = None,
) -> DataFrame:
    """Which documents a sample calibrated to source, language and topic marginals takes.

    One row per input row: doc_id, th, source, lang, topic, tokens (words
    between blanks), rate, taken, gap. Targets are tempered shares. The draw is a
    hash of seed, id and text, so it can be repeated, and equal rows share it.
    ``gap`` is what the raking left, see :func:`rake`. Topics are the labels in
    ``topic_col``; without it the patterns of ``TOPICS`` stand in as an example.
    Null values are categories of their own; a text without words has no weight
    and its cell's rate.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tokens = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"),
        F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), (F.col(topic_col).cast("string") if topic_col else topic_of(text_col)).alias("topic"),
        tokens.alias("tokens"))
    rows = save(rows, "mix-rows")
    keys = ["source", "lang", "topic"]
    cells = save(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    fitted = rates(rake(cells, {k: tempered(cells, k, p) for k, p in zip(keys, powers)}), fraction).select(*keys, "rate", "gap")
    on = reduce(Column.__and__, [rows[k].eqNullSafe(fitted[k]) for k in keys])
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "th"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.join(fitted, on, "left").select(
        "doc_id", "th", rows["source"], rows["lang"], rows["topic"], "tokens", "rate", (draw < F.col("rate")).alias("taken"), "gap")
