"""Language spans of mixed texts: scripts narrow the candidates, Viterbi labels the words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import mixed, rows_of

# Texts for each language that the scores are learned from, about.
PER_LANG = 2_000
# Hashed letter triples; the model holds this many numbers for each language.
BUCKETS = 1 << 16
# What a change of language costs, in nats.
SWITCH = 12.0
# A language is a candidate for a script that holds this part of its letters.
SCRIPT_SHARE = 0.002
UNKNOWN = "und"

# Code point ranges of scripts; anything else is script 0.
SCRIPTS = (
    (0x0041, 0x024F, 1), (0x1E00, 0x1EFF, 1), (0x2C60, 0x2C7F, 1), (0xA720, 0xA7FF, 1), (0xFF21, 0xFF5A, 1),  # Latin
    (0x0370, 0x03FF, 2), (0x1F00, 0x1FFF, 2),  # Greek
    (0x0400, 0x052F, 3), (0x1C80, 0x1C8F, 3), (0x2DE0, 0x2DFF, 3), (0xA640, 0xA69F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5),  # Hebrew
    (0x0600, 0x06FF, 6), (0x0750, 0x077F, 6), (0x08A0, 0x08FF, 6), (0xFB50, 0xFDFF, 6), (0xFE70, 0xFEFF, 6),  # Arabic
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x09FF, 8),  # Bengali
    (0x0A00, 0x0A7F, 9),  # Gurmukhi
    (0x0A80, 0x0AFF, 10),  # Gujarati
    (0x0B80, 0x0BFF, 11),  # Tamil
    (0x0C00, 0x0C7F, 12),  # Telugu
    (0x0C80, 0x0CFF, 13),  # Kannada
    (0x0D00, 0x0D7F, 14),  # Malayalam
    (0x0E00, 0x0E7F, 15),  # Thai
    (0x10A0, 0x10FF, 16),  # Georgian
    (0x1100, 0x11FF, 17), (0x3130, 0x318F, 17), (0xAC00, 0xD7AF, 17),  # Hangul
    (0x3040, 0x30FF, 18),  # Kana
    (0x3400, 0x4DBF, 19), (0x4E00, 0x9FFF, 19), (0xF900, 0xFAFF, 19), (0x20000, 0x3FFFF, 19),  # Han
)
N_SCRIPTS = 20
# Cells (words times languages) that are labelled at a time, and letters scored at a time.
CELLS = 12_000_000
LETTERS = 1_000_000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 2 for letters, 1 for marks, else 0; and the script."""
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind[c] = {"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)
    script = np.zeros(0x110000, np.uint8)
    for low, high, s in SCRIPTS:
        script[low:high + 1] = s
    return kind, script


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Words:
    """The words of some texts: maximal runs of letters and marks, with a hash for each of their letter triples."""

    def __init__(self, texts: list[str]):
        kind, script = _tables()
        joined = "\n".join(map(_lowered, texts)) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        kinds = kind[codes]
        inside = kinds > 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.append(0, edge)
        self.start, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(starts, self.start, "right") - 1
        self.offset = starts[self.text]
        places = np.flatnonzero(inside)
        c = np.where(inside, codes, 0).astype(np.uint64)
        before = np.append(np.uint64(0), c)[places]
        after = np.append(c, np.uint64(0))[places + 1]
        self.triples = (mixed((before << np.uint64(42)) | (c[places] << np.uint64(21)) | after) % np.uint64(BUCKETS)).astype(np.int64)
        lengths = self.end - self.start
        self.first = np.cumsum(lengths) - lengths
        self.script = script[codes[self.start]]
        self.letters = np.add.reduceat((kinds[places] == 2).astype(np.int64), self.first) if len(places) else np.zeros(0, np.int64)
        self.lengths = lengths


def _portions(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield begin, i
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n): letter triples, and letters of script s as bucket -1 - s."""
    for batch in batches:
        langs, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
        for begin, end in _portions(texts, LETTERS):
            w = Words(texts[begin:end])
            of_word = langs[begin:end][w.text] if len(w.text) else np.zeros(0, object)
            for lang in sorted(set(of_word)):
                own = of_word == lang
                n = np.bincount(w.triples[np.repeat(own, w.lengths)], minlength=BUCKETS)
                s = np.bincount(w.script[own], weights=w.letters[own], minlength=N_SCRIPTS).astype(np.int64)
                b = np.flatnonzero(n)
                k = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(b) + len(k)), pa.string()), pa.array(np.append(b, -1 - k), pa.int32()),
                     pa.array(np.append(n[b], s[k]), pa.int64())], names=["lang", "bucket", "n"])


class Model:
    """Languages, log probabilities of letter triples (buckets x languages), candidates by script."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        at = {lang: i for i, lang in enumerate(self.langs)}
        n = np.zeros((BUCKETS, len(at)))
        scripts = np.zeros((N_SCRIPTS, len(at)))
        for lang, bucket, c in counts:
            (n if bucket >= 0 else scripts)[bucket if bucket >= 0 else -1 - bucket, at[lang]] += c
        self.logs = np.log((n + 0.5) / (n.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
        seen = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
        # A script that no language has leaves all of them.
        self.candidates = np.where(seen.any(1)[:, None], seen, True)


def learn(rows: DataFrame, per_lang: int = PER_LANG) -> Model:
    """A model of the rows' (text, lang), from about ``per_lang`` different texts of each language.

    The sample is drawn by a hash of the text, whole texts, each once. What
    comes to the driver is one number for each bucket and language.
    """
    rows = rows.filter("lang is not null and text is not null").select("lang", "text", "th")
    sizes = rows.groupBy("lang", "th").count().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    part = F.lit(float(per_lang)) / F.col("texts")
    drawn = rows.join(F.broadcast(sizes), "lang").filter(
        F.pmod(F.xxhash64(F.lit("sample"), "th"), F.lit(1_000_000)) < part * 1_000_000)
    drawn = drawn.dropDuplicates(["lang", "th"]).select("lang", "text")
    counts = drawn.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    return Model([tuple(r) for r in counts.collect()])


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """The best label for each word; ``first`` and ``count`` tell which words are a text's.

    All texts advance together, the longest ones to the end. Ties keep the
    label, or go to the lower one.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    steps = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(steps), "left")
    labels = np.zeros(len(scores), np.int16)
    if not steps:
        return labels
    jumped = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    best = scores[first[:active[0]]].copy()
    every = np.arange(len(first))
    for t in range(1, steps):
        k = active[t]
        at = first[:k] + t
        v = best[:k]
        top = v.argmax(1)
        floor = v[every[:k], top][:, None] - switch
        jump = v < floor
        jumped[at], source[at] = jump, top
        v = np.where(jump, floor, v) + scores[at]
        # Only differences matter: stay in a range where small ones are kept.
        best[:k] = v - v.max(1)[:, None]
    state = best.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        labels[at] = state[:k]
        state[:k] = np.where(jumped[at, state[:k]], source[at], state[:k])
    return labels


SPANS = "array<struct<lang:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _labelled(texts: list[str], model: Model, switch: float) -> Iterator[tuple[str, float, list[dict]]]:
    parts, scores = [], []
    for begin, end in _portions(texts, LETTERS):
        w = Words(texts[begin:end])
        parts.append((w.text + begin, w.start - w.offset, w.end - w.offset, w.letters))
        if len(w.start):
            s = np.add.reduceat(model.logs[w.triples], w.first, axis=0)
            scores.append(np.where(model.candidates[w.script], s, s - np.float32(60) * w.lengths[:, None].astype(np.float32)))
    text, start, end, letters = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*parts) if parts else [()] * 4))
    count = np.bincount(text, minlength=len(texts))
    first = np.cumsum(count) - count
    if scores and model.langs:
        labels = viterbi(np.concatenate(scores), first, count, switch)
    else:
        labels = np.zeros(len(text), np.int16)
    n_langs = max(len(model.langs), 1)
    sums = np.bincount(text * n_langs + labels, weights=letters, minlength=len(texts) * n_langs).reshape(-1, n_langs)
    for i in range(len(texts)):
        total = sums[i].sum()
        if not total or not model.langs:
            yield UNKNOWN, 0.0, []
            continue
        own = slice(first[i], first[i] + count[i])
        l, s, e = labels[own], start[own], end[own]
        new = np.append(True, l[1:] != l[:-1])
        last = np.append(np.flatnonzero(new)[1:] - 1, len(l) - 1)
        spans = [{"lang": model.langs[a], "start": b, "end": c} for a, b, c in zip(l[new].tolist(), s[new].tolist(), e[last].tolist())]
        top = int(sums[i].argmax())
        yield model.langs[top], float(sums[i, top] / total), spans


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH
) -> DataFrame:
    """doc_id, th, lang_pred, score, spans for every row.

    ``spans`` are the stretches of one language (code points, from the first
    to behind the last of their words); ``lang_pred`` has most letters in them,
    ``score`` is its part of the letters. A null text, one without letters and
    any text under a model without languages is ``und`` with score 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            # A word is two characters with its blank at least.
            for begin, end in _portions(texts, 2 * CELLS // max(len(model.langs), 1)):
                langs, scores, spans = zip(*_labelled(texts[begin:end], model, switch))
                cut = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [cut.column("doc_id"), cut.column("th"), pa.array(langs, pa.string()),
                     pa.array(scores, pa.float64()), pa.array(spans, _SPAN_TYPE)],
                    names=["doc_id", "th", "lang_pred", "score", "spans"])

    return rows_of(docs, id_col, text_col).mapInArrow(
        run, f"doc_id long, th long, lang_pred string, score double, spans {SPANS}")


def held_out(id_col: str = "doc_id"):
    """The third of the ids that no model learns from (crc32 of the id's text modulo 3 is 1)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Labelled rows outside the held-out third; a null id is outside both."""
    rows = docs.filter(F.crc32(F.col(id_col).cast("string")) % 3 != 1)
    text = F.col(text_col).cast("string")
    return rows.select(F.col(lang_col).cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("th"))
