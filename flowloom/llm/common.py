"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT_FOLD = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(id_column: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, mod 4. A null id is in the learning folds."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == HELD_OUT_FOLD, F.lit(False))


def sample_by_hash(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The `rows` rows with the lowest hash of `key`: a bounded sample that is the same on every run."""
    return df.orderBy(F.xxhash64(key, F.lit(20)), key).limit(rows)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, after which the worker returns unused memory to the system: it waits beside stages that run in the JVM alone."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others keep less
            if trim is not None:
                trim(0)

    return tidied


def slices(batch: pa.RecordBatch, text: int, most_rows: int = 1000, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded rows and bytes of its column `text`; one text may be longer than that."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(max(int(np.searchsorted(ends, before + most_bytes, "right")), at + 1), at + most_rows)
        yield batch.slice(at, to - at)
        at = to
