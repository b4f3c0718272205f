"""Helpers shared by the corpus operators.

Functions that run inside Python workers are shipped by value (see
``rivulet.llm.__init__``), so executors need only the public libraries.
"""

from __future__ import annotations

import sys
import types
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import remove_path, scratch_path

#: Whether Spark removes the shuffle files of a query as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut
    and a lost executor costs only the tasks that read its part files again.
    The shuffle files of the write are removed with its end, as nothing reads them any more."""
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove the files of frames returned by :func:`staged` that no later step reads."""
    for frame in frames:
        remove_path(spark, frame._staged_at)


def document_key(id_col: str, text_col: str) -> Column:
    """The key of a document, in the order earlier to later: NULL ids last; rows that repeat id and text are one."""
    return F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"),
                    F.xxhash64(F.col(text_col)).alias("content"))


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process, so compiled
    tables are built once per worker and not once per task."""
    mod = sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache"))
    return mod.__dict__


def binary_column(batch, name: str):
    """A string column of an Arrow batch as a list of UTF-8 ``bytes`` (None for NULL)."""
    import pyarrow as pa

    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def word_numbers(split: list):
    """(numbers, distinct words, words per list) of lists of words: equal words have equal numbers, counted from 0."""
    import numpy as np

    number = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    return flat, list(number), sizes


def slices(batch, max_bytes: int, name: str) -> Iterator:
    """Cut a batch so that each piece holds about ``max_bytes`` of column
    ``name`` (a longer single row is a piece of its own)."""
    import pyarrow.compute as pc

    col = batch.column(batch.schema.get_field_index(name))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
