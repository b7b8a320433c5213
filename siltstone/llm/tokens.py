"""Token counts of documents in flat token files that have no index.

A token file is a run of fixed-width ids in which each document is followed by
an end-of-document id. It is read as blocks, in any order and by any task. Each
block is searched for separators with one vectorised comparison; a prefix scan
over the blocks' summaries then tells where the documents that cross blocks
begin, and which document of the file a block's first separator ends.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import rows_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts a text into pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The id behind the vocabulary's last one.
END_OF_DOCUMENT = 50_256
BLOCK_IDS = 1 << 16
# Blocks in a range of the prefix scan.
RANGE = 1 << 12
WIDTHS = {2: "<u2", 4: "<u4"}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_files(
    docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END_OF_DOCUMENT, width: int = 2,
    id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Tokenize documents into flat files, one per partition, cut into blocks.

    Rows are (file, block, data) with the block's bytes, and (file, ordinal,
    doc_id, th), the order in which the documents went in. Neither holds
    lengths or places. ``vocabulary`` is a path that every executor can read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, file = _encoding(vocabulary), TaskContext.get().partitionId()
        held, n, block, ordinal = [], 0, 0, 0

        def blocks(final: bool) -> Iterator[bytes]:
            nonlocal held, n
            if n >= block_ids or final and n:
                ids = np.concatenate(held)
                cut = len(ids) if final else len(ids) // block_ids * block_ids
                yield from (ids[i:min(i + block_ids, cut)].tobytes() for i in range(0, cut, block_ids))
                held, n = [ids[cut:]], len(ids) - cut

        def rows(data: list[bytes]) -> pa.RecordBatch:
            nonlocal block
            block += len(data)
            none = pa.nulls(len(data), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(data), pa.int32()), pa.array(range(block - len(data), block), pa.int64()),
                 pa.array(data, pa.binary()), none, none, none], names=NAMES)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                ids = np.array([*encoding.encode_ordinary(text or ""), end], WIDTHS[width])
                held.append(ids)
                n += len(ids)
                if n >= 16 * block_ids:
                    yield rows(list(blocks(False)))
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                 pa.array(range(ordinal, ordinal + m), pa.int64()), batch.column("doc_id"), batch.column("th")], names=NAMES)
            ordinal += m
        yield rows(list(blocks(True)))

    return rows_of(docs, id_col, text_col).mapInArrow(
        run, "file int, block long, data binary, ordinal long, doc_id long, th long")


NAMES = ["file", "block", "data", "ordinal", "doc_id", "th"]


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, block, data) of flat binary files under ``path``; ``file`` is the file's path."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width * block_ids
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                raw = data.as_buffer()
                n = -(-raw.size // size)
                for b in range(n):
                    part = raw.slice(b * size, min(size, raw.size - b * size)).to_pybytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([b], pa.int64()), pa.array([part], pa.binary())], names=["file", "block", "data"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "file string, block long, data binary")


def _scan(end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for data in batch.column("data"):
                raw = data.as_buffer()
                ids = np.frombuffer(raw, WIDTHS[width])
                at = np.flatnonzero(ids == end)
                found = (len(ids), int(at[0]) if len(at) else None, int(at[-1]) if len(at) else None,
                         (np.diff(at) - 1) if len(at) else np.zeros(0, np.int64))
                for column, value in zip(out, found):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int64()))],
                names=["file", "block", "n", "head", "last", "inner"])

    return run


def count_tokens(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens, ended) of every document in the blocks (file, block, data).

    ``ordinal`` numbers the documents of a file from 0; separators are not
    counted. Blocks are numbered from 0 without gaps; their sizes may differ, but
    hold whole ids. Two separators in a row enclose an empty document. Ids behind
    the last separator of a file are a document with ``ended`` false. A file
    without ids has no documents.
    """
    kind = dict(blocks.dtypes)["file"]
    found = blocks.select("file", "block", "data").mapInArrow(
        _scan(end, width), f"file {kind}, block long, n long, head long, last long, inner array<long>")
    found = found.withColumns({
        "range": F.floor(F.col("block") / RANGE),
        "seps": F.when(F.col("head").isNull(), F.lit(0)).otherwise(F.size("inner") + 1).cast("long"),
    })
    inside = Window.partitionBy("file", "range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    placed = found.withColumns({
        "place": F.coalesce(F.sum("n").over(inside), zero),
        "number": F.coalesce(F.sum("seps").over(inside), zero),
    })
    placed = placed.withColumn("before", F.max(F.col("place") + F.col("last")).over(inside))
    # The same scan over the ranges, which are few: one row for each 4096 blocks.
    ranges = placed.groupBy("file", "range").agg(
        F.sum("n").alias("ids"), F.sum("seps").alias("seps"), F.max(F.col("place") + F.col("last")).alias("last"),
        F.max("block").alias("top"))
    over = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    ranges = ranges.withColumns({
        "r_place": F.coalesce(F.sum("ids").over(over), zero),
        "r_number": F.coalesce(F.sum("seps").over(over), zero),
        "file_top": F.max("top").over(whole),
    })
    ranges = ranges.withColumn("r_before", F.coalesce(F.max(F.col("r_place") + F.col("last")).over(over), none))
    ranges = ranges.select("file", "range", "r_place", "r_number", "r_before", "file_top")
    told = placed.join(ranges, ["file", "range"]).select(
        "file", "n", "head", "last", "inner", "seps",
        (F.col("r_place") + F.col("place")).alias("place"),
        (F.col("r_number") + F.col("number")).alias("number"),
        F.coalesce(F.col("r_place") + F.col("before"), F.col("r_before")).alias("before"),
        (F.col("block") == F.col("file_top")).alias("final"),
    )
    first = F.col("place") + F.col("head") - F.col("before") - 1
    ended = told.filter("seps > 0").select(
        "file", "number", F.posexplode(F.concat(F.array(first), "inner")).alias("i", "n_tokens"))
    ended = ended.select(
        "file", (F.col("number") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended"))
    rest_from = F.when(F.col("seps") > 0, F.col("place") + F.col("last")).otherwise(F.col("before"))
    rest = F.col("place") + F.col("n") - rest_from - 1
    open_ = told.filter(F.col("final") & (rest > 0)).select(
        "file", (F.col("number") + F.col("seps")).alias("ordinal"), rest.alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_)
