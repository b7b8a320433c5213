"""Fill-in-the-middle texts, cut by a piecewise-linear learned index of code point boundaries.

A text is cut between code points, but it is stored as UTF-8 bytes. The byte
offsets of all code points of a run of texts are a rising sequence: rank to
offset. :class:`RankIndex` fits it by segments of straight lines that are off
by at most ``ERROR`` bytes and stores what each prediction misses by, one byte
a code point. A cut is predicted by its segment and corrected by its residual,
so it is exact. The texts of an Arrow batch are indexed end to end, in portions
of ``PORTION`` bytes; a longer text is a portion of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import flat

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of 100 texts: from here on they stay plain, and below this the suffix comes first.
PLAIN_FROM = 90
SPM_BELOW = 20
# Largest residual, so that it fits a signed byte.
ERROR = 127
PORTION = 4 << 20
# Points looked at first for a segment; twice as many as long as the line holds.
LOOK = 512


@dataclass(frozen=True)
class RankIndex:
    """Lines ``offset = base + slope * (rank - start)``, and what each rank is off by."""

    start: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Of a rising sequence. Each segment is as long as some line through its first point allows."""
        if not 1 <= error <= 127:
            raise ValueError("error must be between 1 and 127")
        starts, bases, slopes = [], [], []
        residual = np.zeros(len(offsets), np.int8)
        at, slack = 0, error - 1  # rounding a prediction down takes less than one byte
        while at < len(offsets):
            low, high, end = 0.0, np.inf, at + 1
            look = LOOK
            while end < len(offsets):
                stop = min(end + look, len(offsets))
                run = np.arange(end - at, stop - at, dtype=np.float64)
                rise = (offsets[end:stop] - offsets[at]).astype(np.float64)
                lows = np.maximum(np.maximum.accumulate((rise - slack) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + slack) / run), high)
                bad = np.flatnonzero(lows > highs)
                good = int(bad[0]) if len(bad) else stop - end
                if good:
                    low, high = float(lows[good - 1]), float(highs[good - 1])
                end += good
                if len(bad):
                    break
                look *= 2
            slope = (low + high) / 2 if np.isfinite(high) else 1.0
            starts.append(at)
            bases.append(int(offsets[at]))
            slopes.append(slope)
            guess = bases[-1] + np.floor(slope * np.arange(end - at)).astype(np.int64)
            residual[at:end] = offsets[at:end] - guess
            at = end
        return cls(np.array(starts, np.int64), np.array(bases, np.int64), np.array(slopes), residual)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """The exact offsets of these ranks."""
        segment = np.searchsorted(self.start, rank, "right") - 1
        steps = rank - self.start[segment]
        guess = self.base[segment] + np.floor(self.slope[segment] * steps).astype(np.int64)
        return guess + self.residual[rank]


def draws(doc_id: int | None, seed: str = "1") -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that the id decides; a null id counts as no digits."""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(told[4 * i:4 * i + 4], "big") for i in range(4))


def _portions(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, or of one row."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


_SENTINELS = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))


def _formatted(ids: list, raw: np.ndarray, bounds: np.ndarray, seed: str) -> tuple[list, ...]:
    """n, form, prefix_chars, middle_chars and output of texts that lie end to end."""
    # One more offset: the end, which is where a cut behind the last code point lies.
    offsets = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    index = RankIndex.fit(offsets)
    ranks = np.searchsorted(offsets, bounds)  # of each text's first code point, and the end
    n = np.diff(ranks)
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(len(ids), 4)
    one, two = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
    first, second = np.minimum(one, two), np.maximum(one, two)
    cuts = index.offset(ranks[:-1] + first), index.offset(ranks[:-1] + second)
    data = raw.tobytes()
    forms, prefixes, middles, outputs = [], [], [], []
    for i in range(len(ids)):
        begin, end = int(bounds[i]), int(bounds[i + 1])
        text = data[begin:end]
        if not text or drawn[i, 2] % 100 >= PLAIN_FROM or any(s in text for s in _SENTINELS):
            forms.append(PLAIN)
            prefixes.append(None)
            middles.append(None)
            outputs.append(text)
            continue
        a, b = int(cuts[0][i]) - begin, int(cuts[1][i]) - begin
        parts = [_SENTINELS[0] + text[:a], _SENTINELS[1] + text[b:]]
        spm = drawn[i, 3] % 100 < SPM_BELOW
        forms.append(SPM if spm else PSM)
        prefixes.append(int(first[i]))
        middles.append(int(second[i] - first[i]))
        outputs.append(b"".join([*(parts[::-1] if spm else parts), _SENTINELS[2], text[a:b]]))
    return n.tolist(), forms, prefixes, middles, outputs


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _rows(seed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = flat(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for first, last in _portions(bounds, PORTION):
                part = raw[bounds[first]:bounds[last]]
                told = _formatted(ids[first:last], part, bounds[first:last + 1] - bounds[first], seed)
                n, forms, prefixes, middles, outputs = told
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first:last], pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()),
                     pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1") -> DataFrame:
    """One row per input row: doc_id, n (code points), form, prefix_chars, middle_chars, output.

    The hash of seed and id decides two cuts and the form, so equal ids are cut
    alike and a task run again gives the same rows. ``psm`` is prefix, suffix,
    middle, ``spm`` suffix, prefix, middle, each behind its sentinel. A text
    that is null, empty, drawn to stay, or holds a sentinel is ``plain``: it
    comes out as it is (null as empty), with null counts. Repeated rows come
    out as often as they stand, an empty table gives none, and other columns
    are left out. No row moves between tasks.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_rows(seed), SCHEMA)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text of a formatted one. No part of a text holds a sentinel, so the first of each is the cut."""
    out = F.col(output)

    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        at, middle = F.instr(out, second), F.instr(out, MIDDLE)
        return (F.substr(out, F.lit(len(first) + 1), at - len(first) - 1),
                F.substr(out, at + len(second), middle - at - len(second)),
                F.substr(out, middle + len(MIDDLE)))

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    late_suffix, late_prefix, late_middle = between(SUFFIX, PREFIX)
    return (F.when(F.col(form) == PSM, F.concat(prefix, middle, suffix))
            .when(F.col(form) == SPM, F.concat(late_prefix, late_middle, late_suffix)).otherwise(out))
