"""Vector codes of four bytes: four codebooks of integers, fitted with adaptive distance bounds.

A vector's components become fixed-point integers and the vector is cut into
``PARTS`` equal parts; every part is replaced by the number of the nearest
entry of its position's codebook. Between rounds a part keeps its ``b`` closest
entries in order, a lower bound of the distance to each, and one outer bound
for all other entries. When the entries have moved, the bounds are lowered by
how far: a part whose own entry is certainly nearer than the first bound stays
without any work; otherwise only the entries before the first bound that is
certainly larger are measured, in integers, and all entries if not even the
outer bound is. ``b`` follows the ranks that were needed in the round before.

Bounds are distances (not squared), kept as 32-bit floats that were rounded
outwards, so a decision by bounds is never wrong; all others are made by exact
integers. Vectors, codes and bounds are one distributed table per round; only
the codebooks (entries x length of a vector) pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Steps, flat

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Closest entries kept at first and at least, and the part of all needs that the next number must cover.
KEPT, LEAST_KEPT, COVERED = 32, 4, 0.98
# Largest fixed-point component: distances of up to 2**14 components then fit 64 bits.
LARGEST = 1 << 23
# Float comparisons allow for this relative error on either side.
SAFE = 1e-6
# Values held at a time while distances to all entries are computed.
CHUNK = 1 << 21


def finite_vectors(df: DataFrame, vec_col: str) -> Column:
    """Whether a vector is there, without null and non-finite components."""
    v = F.col(vec_col)
    # A comparison with NaN is false only below, as Spark sorts NaN above all numbers.
    good = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(v.isNotNull() & good, F.lit(False))


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]`` and how far each entry moved in the last round."""

    entries: np.ndarray
    moved: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to all ``entries``."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * top * top * max(x.shape[1], 1) < 1 << 53:  # whole numbers that doubles hold exactly
        a, c = x.astype(np.float64), entries.astype(np.float64)
        out = a @ c.T
        out *= -2
        out += (a * a).sum(1)[:, None]
        out += (c * c).sum(1)[None, :]
        return out.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in entries], axis=1)


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - SAFE)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SAFE)).astype(np.float32), np.float32(np.inf))


def _measured(x: np.ndarray, entries: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entries of all rows by distances to all entries: (near, bounds, exact distance of the first).

    ``near`` (n, kept) is ordered by distance, then index; bounds[:, j] bounds
    the distance of entry j + 1 of it and all behind, the last one that of the entries left out.
    """
    k = len(entries)
    near, bounds, best = [np.zeros((0, kept), np.int64)], [np.zeros((0, kept), np.float32)], [np.zeros(0, np.int64)]
    for at in range(0, len(x), max(1, CHUNK // k)):
        d = squares(x[at:at + max(1, CHUNK // k)], entries)
        # Ties go to the lower index: a stable sort of the few, after a cut that keeps all ties below it.
        order = np.argsort(d, axis=1, kind="stable")[:, :min(kept + 1, k)]
        roots = _down(np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64)))
        if k <= kept:
            roots = np.concatenate([roots, np.full((len(d), kept + 1 - k), np.inf, np.float32)], axis=1)
            order = np.concatenate([order, np.repeat(order[:, :1], kept - k, axis=1)], axis=1) if k < kept else order
        near.append(order[:, :kept])
        bounds.append(roots[:, 1:kept + 1])
        best.append(np.take_along_axis(d, order[:, :1], 1)[:, 0])
    return np.concatenate(near), np.concatenate(bounds), np.concatenate(best)


def _assign(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, near: np.ndarray, bounds: np.ndarray, upper: np.ndarray, kept: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round for one part position: new (near, bounds, upper, rank that each row needed).

    Rank 0: the bounds alone decided; r: entries before the r-th bound were
    measured; more than the kept ones: all entries were.
    """
    n, b = near.shape
    near, need = near.copy(), np.zeros(n, np.int64)
    upper = _up(upper.astype(np.float64) + moved[near[:, 0]])
    far = float(moved.max(initial=0))
    # A bound holds for its entry and, ordered, for all behind it.
    drop = np.concatenate([moved[near[:, 1:]], np.full((n, 1), far)], axis=1)
    bounds = _down(np.maximum(bounds.astype(np.float64) - drop, 0))
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1].copy()
    open_ = np.flatnonzero(upper >= bounds[:, 0])
    if len(open_):
        exact = ((x[open_] - entries[near[open_, 0]]) ** 2).sum(1)
        upper[open_] = _up(np.sqrt(exact.astype(np.float64)))
        open_ = open_[upper[open_] >= bounds[open_, 0]]
    if len(open_):
        # The first bound that is certainly larger; b if none is.
        larger = upper[open_, None] < bounds[open_]
        rank = np.where(larger.any(1), larger.argmax(1), b)
        need[open_] = rank
        for rows, ranks in _by_rank(open_[rank < b], rank[rank < b], x.shape[1]):
            wide = int(ranks.max()) + 1
            some = near[rows, :wide]
            d = ((x[rows, None, :] - entries[some]) ** 2).sum(2)
            beyond = np.arange(wide)[None, :] > ranks[:, None]
            # Order by distance, then index; entries behind the rank keep their places.
            key = np.lexsort((some, d, beyond), axis=1)
            key = np.where(beyond, np.arange(wide)[None, :], key)
            near[rows, :wide] = np.take_along_axis(some, key, 1)
            root = np.sqrt(np.take_along_axis(d, key, 1).astype(np.float64))
            upper[rows] = _up(root[:, 0])
            bounds[rows, :wide - 1] = np.where(beyond[:, 1:], bounds[rows, :wide - 1], _down(root[:, 1:]))
            bounds[rows, :wide] = np.minimum.accumulate(bounds[rows, :wide][:, ::-1], axis=1)[:, ::-1]
        rest = open_[rank == b]
        if len(rest):
            found, limits, best = _measured(x[rest], entries, b)
            near[rest], bounds[rest], upper[rest] = found, limits, _up(np.sqrt(best.astype(np.float64)))
    if kept < b:
        near, bounds = near[:, :kept], bounds[:, :kept]
    elif kept > b and n:
        # More places than before: the outer bound stands for what is not known.
        near = np.concatenate([near, np.repeat(near[:, :1], kept - b, axis=1)], axis=1)
        bounds = np.concatenate([bounds, np.repeat(bounds[:, -1:], kept - b, axis=1)], axis=1)
    return near, bounds, upper, need


def _by_rank(rows: np.ndarray, ranks: np.ndarray, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of like rank, in blocks of bounded size."""
    order = np.argsort(ranks, kind="stable")
    at = 0
    while at < len(order):
        wide = int(ranks[order[at]]) + 1
        size = max(1, CHUNK // (max(dim, 1) * max(2 * wide, 2)))
        take = order[at:at + size]
        take = take[ranks[take] < 2 * wide]
        yield rows[take], ranks[take]
        at += len(take)


def _blob(x: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as a binary column."""
    x = np.ascontiguousarray(x)
    wide = x.dtype.itemsize * x.shape[1]
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(wide)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(x.tobytes())])


def _unblob(column: pa.Array, kind: type, wide: int) -> np.ndarray:
    raw, _ = flat(column)
    return np.frombuffer(raw.tobytes(), kind).reshape(len(column), wide)


def _fixed(scale: int):
    """vec_id, label and the fixed-point components as 32-bit integers end to end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            values = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.floor(values * scale)
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError(f"a component exceeds {LARGEST // scale}; squared distances may not fit 64 bits")
            lengths = set(v.value_lengths().to_pylist())
            if len(lengths) > 1:
                raise ValueError("vectors of unequal length")
            wide = lengths.pop() if lengths else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _blob(x.astype(np.int32).reshape(len(v), wide))],
                names=["vec_id", "label", "x"])

    return run


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """(part, row, position) as 64-bit integers."""
    if batch.column("x").nbytes and (np.diff(flat(batch.column("x"))[1]) != 4 * dim).any():
        raise ValueError("vectors of unequal length")
    x = _unblob(batch.column("x"), np.int32, dim) if len(batch) else np.zeros((0, dim), np.int32)
    return np.ascontiguousarray(x.reshape(len(batch), PARTS, dim // PARTS).transpose(1, 0, 2)).astype(np.int64)


def _round(books: Codebooks, dim: int, kept: int, before: int | None, last: bool):
    """Assign every part; ``before`` is the number of entries kept so far, None at the start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x = len(batch), _vectors(batch, dim)
            if before is not None:
                old_near = _unblob(batch.column("near"), np.uint8, PARTS * before).reshape(n, PARTS, before).astype(np.int64)
                old_bounds = _unblob(batch.column("bounds"), np.float32, PARTS * before).reshape(n, PARTS, before)
                old_upper = _unblob(batch.column("upper"), np.float32, PARTS)
            near, bounds = np.empty((n, PARTS, kept), np.uint8), np.empty((n, PARTS, kept), np.float32)
            upper, need, error = np.empty((n, PARTS), np.float32), np.zeros((n, PARTS), np.int16), np.zeros(n, np.int64)
            for p in range(PARTS):
                entries = books.entries[p]
                if before is None:
                    near[:, p], bounds[:, p], best = _measured(x[p], entries, kept)
                    upper[:, p] = _up(np.sqrt(best.astype(np.float64)))
                else:
                    near[:, p], bounds[:, p], upper[:, p], need[:, p] = _assign(
                        x[p], entries, books.moved[p], old_near[:, p], old_bounds[:, p], old_upper[:, p], kept)
                if last:
                    error += ((x[p] - entries[near[:, p, 0].astype(np.int64)]) ** 2).sum(1)
            if last:
                told = [bytes(row).hex() for row in near[:, :, 0]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array(told, pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("x"),
                     _blob(near.reshape(n, PARTS * kept)), _blob(bounds.reshape(n, PARTS * kept)), _blob(upper), _blob(need)],
                    names=["vec_id", "label", "x", "near", "bounds", "upper", "need"])

    return run


def _sums(dim: int, entries: int, kept: int):
    """Per task: count and componentwise sum per (part, entry), and how many parts needed which rank (part -1)."""
    wide = dim // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, wide), np.int64)
        needs = np.zeros(kept + 1, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = _vectors(batch, dim)
            near = _unblob(batch.column("near"), np.uint8, PARTS * kept).reshape(len(batch), PARTS, kept)
            need = _unblob(batch.column("need"), np.int16, PARTS)
            needs += np.bincount(np.minimum(need.ravel(), kept), minlength=kept + 1)
            for p in range(PARTS):
                code = near[:, p, 0].astype(np.int64)
                count[p] += np.bincount(code, minlength=entries)
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1]))
                total[p, code[order][first]] += np.add.reduceat(x[p][order], first, axis=0)
        part, entry = np.nonzero(count)
        rank = np.flatnonzero(needs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(part, np.full(len(rank), -1)).astype(np.int32)),
             pa.array(np.append(entry, rank).astype(np.int32)),
             pa.array(np.append(count[part, entry], needs[rank])),
             pa.array([*total[part, entry].tolist(), *([[0] * wide] * len(rank))], pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    return run


def _components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = flat(batch.column("x"))
        x = pa.ListArray.from_arrays(pa.array((bounds // 4).astype(np.int32)), pa.array(np.frombuffer(raw.tobytes(), np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), x], names=["vec_id", "x"])


def _first_books(rows: DataFrame, entries: int) -> Codebooks | None:
    """The parts of the least ids' vectors, in their order. Of rows with one id the least vector counts."""
    least = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()
    ids = [r.vec_id for r in least]
    if not ids:
        return None
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        wanted = F.coalesce(wanted, F.lit(False)) | F.col("vec_id").isNull()
    found = rows.filter(wanted).mapInArrow(_components, "vec_id long, x array<int>")
    by_id = {r.vec_id: r.x for r in found.groupBy("vec_id").agg(F.min("x").alias("x")).collect()}
    if len({len(x) for x in by_id.values()}) > 1:
        raise ValueError("vectors of unequal length")
    x = np.array([by_id[i] for i in ids], np.int64)
    if x.shape[1] % PARTS:
        raise ValueError(f"a vector's length must be a multiple of {PARTS}")
    books = np.ascontiguousarray(x.reshape(len(x), PARTS, -1).transpose(1, 0, 2))
    return Codebooks(books, np.zeros(books.shape[:2]))


def _moved(books: Codebooks, sums: list, kept: int) -> tuple[Codebooks, int]:
    """The means of the parts, and how many entries to keep from now on."""
    entries, needs = books.entries.copy(), np.zeros(kept + 1, np.int64)
    for r in sums:
        if r.part < 0:
            needs[r.entry] += r.n
        else:
            entries[r.part, r.entry] = np.floor_divide(np.array(r.total, np.int64), r.n)
    far = np.sqrt(((entries - books.entries) ** 2).sum(2).astype(np.float64)) * (1 + SAFE)
    some = needs[1:]  # by bounds alone: no entry needed
    if some.sum():
        covered = int(np.searchsorted(np.cumsum(some), COVERED * some.sum())) + 1
        # All ranks in use: more may be of use; else as many as were.
        kept = min(kept * 2, entries.shape[1]) if covered >= kept else max(covered + 1, min(LEAST_KEPT, kept))
    return Codebooks(entries, far), kept


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error) of every kept row, the codebooks).

    Rows whose vector is null or holds null or non-finite components go. A null
    id counts as the largest, repeated rows get equal codes and each counts, of
    several vectors with one id the least one may start the codebook. With
    fewer ids than ``entries`` the codebooks are that much shorter. An empty
    table gives no row and no codebooks. Vectors of unequal length, of one that
    ``PARTS`` does not divide, or with components beyond ``LARGEST / scale``
    are an error. Columns other than the three named are left out.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = vectors.sparkSession
    rows = vectors.filter(finite_vectors(vectors, vec_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    kind = rows.schema["label"].dataType.simpleString()
    steps = Steps(spark, "codes")
    state = steps.save(rows.mapInArrow(_fixed(scale), f"vec_id long, label {kind}, x binary"))
    books = _first_books(state, entries)
    if books is None:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), None
    dim = PARTS * books.entries.shape[2]
    kept, before = min(KEPT, books.entries.shape[1]), None
    told = f"vec_id long, label {kind}, x binary, near binary, bounds binary, upper binary, need binary"
    for _ in range(rounds):
        state = steps.save(state.mapInArrow(_round(books, dim, kept, before, False), told))
        before = kept
        parts = state.mapInArrow(
            _sums(dim, books.entries.shape[1], kept), "part int, entry int, n long, total array<long>")
        sums = parts.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[j]) for j in range(dim // PARTS)]).alias("total"))
        books, kept = _moved(books, sums.collect(), kept)
    coded = state.mapInArrow(_round(books, dim, kept, before, True), f"vec_id long, label {kind}, code string, error long")
    return steps.save(coded), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add label_error: the error summed over the rows of the same label, nulls together."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).drop("_label")
