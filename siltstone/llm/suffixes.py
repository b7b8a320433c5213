"""Repeated byte strings across a corpus by a depth-limited radix sort of its suffixes.

Only the first ``length`` bytes of a suffix matter: two suffixes that agree on
them form a repeated window. The suffixes are dealt into groups digit by
digit, most significant digit first, and each pass settles what it can: a group
of one leaves (its windows occur once), a group whose members agree on all that
is left is repeated as a whole, and the rest goes on to the next, finer digit.

* Digit 1 is the anchor: the ``gram`` bytes with the least hash in the window.
  Neighbouring suffixes share an anchor, so a run of them is one row; there is
  about one run for every 80 bytes instead of one row for every byte.
* Digit 2 is all the bytes a run covers.
* Digit 3 cuts what is open into blocks of ``BLOCK`` neighbouring suffixes, by
  the bytes that all of the block's windows share.
* Digit 4 is the whole window, for single suffixes.

Digits are compared by hashes of 64 bits each, and a window by 96 bits or
more. Groups are counted with map-side sums and joined back to their rows, so
a string that a third of all documents hold is spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import MASK, flat, mixed, rows_of, same_row, save, signed

LENGTH = 200
GRAM = 48
BLOCK = 8
# Bytes hashed at a time; longer texts go through in overlapping pieces.
PIECE = 1 << 20
# Texts and lists that become Python objects at a time: bytes, and what an item of a list counts for.
PORTION, ITEM = 1 << 20, 64

_BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, MASK + 1))):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a)
    return _powers["up"][:n], _powers["down"][:n]


class Hashes:
    """Hashes of any substrings of a buffer, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = _power(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        return mixed((self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k])


def _least(g: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of every ``width`` neighbours and its leftmost place."""
    low, at, size = g, np.arange(len(g), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        size += step
    return low, at


def _runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first suffix, suffixes, anchor place, anchor, all bytes) of the runs in a batch of texts."""
    out: list[tuple[np.ndarray, ...]] = []
    n = len(data)
    for begin in range(0, max(n - length + 1, 0), PIECE):
        piece = data[begin:begin + PIECE + length - 1]
        hashes = Hashes(piece)
        low, at = _least(hashes.grams(gram), length - gram + 1)
        starts = np.arange(begin, begin + len(low))
        row = np.searchsorted(bounds, starts, "right") - 1
        good = starts + length <= bounds[row + 1]
        edge = np.flatnonzero((at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (good[1:] != good[:-1])) + 1
        first, end = np.append(0, edge), np.append(edge, len(low))
        first, end = first[good[first]], end[good[first]]
        if not len(first):
            continue
        place = at[first].astype(np.int64)
        rest = hashes.of(first, end - 1 + length)
        shape = ((place - first) * 4096 + (end - first)).astype(np.uint64)
        r = row[first]
        out.append((r, first + begin - bounds[r], end - first, place + begin - bounds[r], low[first], mixed(rest ^ shape)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    return tuple(np.concatenate(x) for x in zip(*out))


RUNS = "doc_id long, th long, lo int, n int, at int, head long, rest long"


def _find_runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = flat(batch.column("text"))
            row, lo, n, at, head, rest = _runs(data, bounds, length, gram)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(lo, pa.int32()),
                 pa.array(n, pa.int32()), pa.array(at, pa.int32()), pa.array(signed(head)), pa.array(signed(rest))],
                names=["doc_id", "th", "lo", "n", "at", "head", "rest"])

    return run


def _groups(rows: DataFrame, keys: list[str], rest: str | None, purpose: str) -> DataFrame:
    """Keys of the groups of two or more, and whether their members agree on the rest."""
    whole = F.min(rest).eqNullSafe(F.max(rest)) if rest else F.lit(True)
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), whole.alias("whole"))
    return save(counted.filter("c > 1").drop("c"), purpose)


def _merge(spans: np.ndarray) -> np.ndarray:
    """Union of (start, end) spans as disjoint, non-touching ones."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], 1)


def _result(raw: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
    digest, place = hashlib.sha256(), 0
    for start, end in spans:
        digest.update(raw[place:start])
        place = end
    digest.update(raw[place:])
    return len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), digest.hexdigest()


def _blocks(raw: np.ndarray, lo, n, at, head, length: int) -> list[dict]:
    """Blocks of neighbouring suffixes of the open runs of one text."""
    first, last = (at - (lo + n - 1)) // BLOCK, (at - lo) // BLOCK
    count = last - first + 1
    run = np.repeat(np.arange(len(lo)), count)
    j = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]
    high = at[run] - BLOCK * j
    begin, end = np.maximum(lo[run], high - BLOCK + 1), np.minimum(lo[run] + n[run] - 1, high)
    hashes = Hashes(raw)
    core = mixed(hashes.of(high, high + length - BLOCK + 1) ^ (head[run].view(np.uint64) * np.uint64(3)) ^ j.astype(np.uint64))
    shape = ((high - begin) * 64 + (end - begin)).astype(np.uint64)
    rest = mixed(hashes.of(begin, end + length) ^ shape)
    return [
        {"core": c, "rest": r, "lo": b, "n": m}
        for c, r, b, m in zip(signed(core).tolist(), signed(rest).tolist(), begin.tolist(), (end - begin + 1).tolist())
    ]


SPANS = "array<struct<lo:int,n:int>>"
FIRST = (
    "doc_id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, "
    f"spans {SPANS}, blocks array<struct<core:long,rest:long,lo:int,n:int>>"
)
WINDOWS = "doc_id long, th long, lo int, high int, low long"


def _numbers(rows: list[dict], *names: str) -> list[np.ndarray]:
    seen = sorted({tuple(r[x] for x in names) for r in rows})
    return list(np.array(seen, np.int64).reshape(-1, len(names)).T.copy())


def _portions(batches: Iterator[pa.RecordBatch], *lists: str) -> Iterator[pa.RecordBatch]:
    """The batches cut where ``PORTION`` bytes of text, each list item counted as ``ITEM``, are exceeded.

    What is made of them as Python objects is many times as large.
    """
    for batch in batches:
        size = np.diff(flat(batch.column("text"))[1])
        for name in lists:
            size = size + ITEM * batch.column(name).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        # The portion in which each row begins.
        part = (np.cumsum(size) - size) // PORTION
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for begin, end in zip(cuts, [*cuts[1:], len(part)]):
            yield batch.slice(begin, end - begin)


def _settle(length: int):
    """Results of the texts without open runs; blocks of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, "runs"):
            rows = []
            for r in batch.to_pylist():
                raw = (r["text"] or "").encode()
                found = r["runs"] or []
                lo, n = _numbers([x for x in found if x["settled"]], "lo", "n")
                spans = _merge(np.stack([lo, lo + n - 1 + length], 1))
                row = dict.fromkeys(FIRST_NAMES) | {"doc_id": r["doc_id"], "th": r["th"]}
                if any(x["open"] for x in found):
                    lo, n, at, head = _numbers([x for x in found if x["open"]], "lo", "n", "at", "head")
                    row["text"] = r["text"]
                    row["spans"] = [{"lo": a, "n": b - a} for a, b in spans.tolist()]
                    row["blocks"] = _blocks(np.frombuffer(raw, np.uint8), lo, n, at, head, length)
                else:
                    row |= dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), _result(raw, spans)))
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=FIRST_ARROW)

    return run


_SPAN = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())]))
FIRST_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("th", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string()), ("spans", _SPAN),
    ("blocks", pa.list_(pa.struct([("core", pa.int64()), ("rest", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())]))),
])
FIRST_NAMES = FIRST_ARROW.names


def _spell_out(length: int):
    """One row for each suffix of the open blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, "open"):
            ids, ths, texts, lists = (batch.column(x).to_pylist() for x in ("doc_id", "th", "text", "open"))
            for doc_id, th, text, found in zip(ids, ths, texts, lists):
                lo, n = _numbers(found, "lo", "n")
                s = np.unique(np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                hashes = Hashes(np.frombuffer(text.encode(), np.uint8))
                low = hashes.of(s, s + length)
                # A second hash, of two overlapping parts of the window.
                other = hashes.of(s + length // 3, s + length) ^ (hashes.of(s, s + length // 2) * np.uint64(5))
                high = (mixed(other) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(s), pa.int64()), pa.array([th] * len(s), pa.int64()),
                     pa.array(s, pa.int32()), pa.array(high), pa.array(signed(low))],
                    names=["doc_id", "th", "lo", "high", "low"])

    return run


def _finish(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, "spans", "found"):
            rows = []
            for r in batch.to_pylist():
                raw = r["text"].encode()
                spans = [(x["lo"], x["lo"] + x["n"]) for x in r["spans"] or []]
                spans += [(x["lo"], x["lo"] + x["n"] - 1 + length) for x in r["found"] or []]
                spans = _merge(np.array(spans, np.int64).reshape(-1, 2))
                rows.append({"doc_id": r["doc_id"]} | dict(zip(FIRST_NAMES[2:6], _result(raw, spans))))
            names = ["doc_id", *FIRST_NAMES[2:6]]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([FIRST_ARROW.field(x) for x in names]))

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """What is left of each text without the bytes of any ``length``-byte string that also starts elsewhere.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the remaining bytes). Matches never cross texts and
    are judged on the input; overlapping ones count; repeated rows repeat each
    other. A null text is empty; a text shorter than ``length`` stays whole.
    Needs ``gram`` + BLOCK <= ``length``. Writes intermediate tables.
    """
    rows = rows_of(docs, id_col, text_col)
    runs = rows.filter(F.octet_length("text") >= length).mapInArrow(_find_runs(length, gram), RUNS)
    anchors = _groups(runs, ["head"], "rest", "suffix-anchors")
    shared = save(runs.join(anchors, "head"), "suffix-runs")
    # An open run may share windows with one of a settled context: each such
    # context sends one of its runs along.
    split = shared.filter("not whole").drop("whole").withColumn("lot", F.xxhash64("doc_id", "th", "lo"))
    twice = split.groupBy("head", "rest").agg(F.count(F.lit(1)).alias("c"), F.min("lot").alias("sent"))
    twice = save(twice.filter("c > 1").drop("c"), "suffix-contexts")
    settled = shared.filter("whole").select("doc_id", "th", "lo", "n", "at", "head", F.lit(False).alias("open"),
        F.lit(True).alias("settled"))
    told = split.join(twice, ["head", "rest"], "left").select(
        *settled.columns[:-2], (F.col("sent").isNull() | (F.col("lot") == F.col("sent"))).alias("open"),
        F.col("sent").isNotNull().alias("settled"))
    # Sets: repeated rows have the same runs, and each of them gets the list.
    lists = settled.unionByName(told).groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("lo", "n", "at", "head", "open", "settled")).alias("runs"))
    first = rows.join(lists, same_row(rows, lists), "left").select(rows["doc_id"], rows["th"], "text", "runs")
    first = save(first.mapInArrow(_settle(length), FIRST), "suffix-texts")

    blocks = first.select("doc_id", "th", F.explode("blocks").alias("b")).select("doc_id", "th", "b.*")
    cores = _groups(blocks, ["core"], "rest", "suffix-cores")
    alike = save(blocks.select("core", "doc_id", "th", "lo", "n").join(cores, "core"), "suffix-blocks")
    texts = first.filter("text is not null").select("doc_id", "th", "text", "spans")
    open_ = alike.filter("not whole").groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "n")).alias("open"))
    windows = texts.join(open_, same_row(texts, open_)).select(texts["doc_id"], texts["th"], "text", "open")
    windows = save(windows.mapInArrow(_spell_out(length), WINDOWS), "suffix-windows")
    equal = _groups(windows, ["low", "high"], None, "suffix-equal")
    hits = windows.join(equal, ["low", "high"]).select("doc_id", "th", "lo", F.lit(1).alias("n"))
    found = alike.filter("whole").select("doc_id", "th", "lo", "n").unionByName(hits)
    found = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "n")).alias("found"))
    last = texts.join(found, same_row(texts, found), "left").select(texts["doc_id"], "text", "spans", "found")
    names = ["doc_id", *FIRST_NAMES[2:6]]
    last = last.mapInArrow(_finish(length), ", ".join(x.strip() for x in FIRST.split(", ") if x.split()[0] in names))
    return first.filter("text is null").select(*names).unionByName(last.select(*names))
