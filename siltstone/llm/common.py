"""Row identity, written intermediate tables, flat text buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import workspace

MASK = 0xFFFFFFFFFFFFFFFF


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, th): the pair (doc_id, th) names a row by its content.

    Other columns are left out, so none can clash with what an operator adds.
    """
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def same_row(left: DataFrame, right: DataFrame, extra: str | None = None) -> Column:
    """Join condition on (doc_id, th) that also matches a null id."""
    on = left["doc_id"].eqNullSafe(right["doc_id"]) & (left["th"] == right["th"])
    return on & left[extra].eqNullSafe(right[extra]) if extra else on


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs no more than its running tasks.
    The folder's owner clears it, as for any checkpoint.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """The tables of an iteration, of which only the newest is kept."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.n = spark, workspace(spark, purpose), 0

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next table and remove the one before, which only ``df`` may have read."""
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        if self.n:
            jvm = self.spark._jvm
            old = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.n - 1}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        self.n += 1
        return self.spark.read.schema(df.schema).parquet(path)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row starts (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if column.type == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
