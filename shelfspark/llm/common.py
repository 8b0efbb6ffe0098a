"""What the training-data operators share: the text view of a table, stored intermediate tables, and rows to Arrow."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.session import prepare, work_path

#: Upper bound of one Arrow batch on its way to Python; long texts then make short batches.
BATCH_BYTES = 8 << 20


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, a null text as the empty one; other columns, whatever their names, are left behind."""
    ready(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe when executors are lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A stored table of few columns as the lesser side of a join with texts: sent to all tasks if it has at most ``most``
    rows, else hashed in shuffled parts; the texts are never sorted."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df.hint("shuffle_hash")


@contextmanager
def finished_shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove a query's shuffle files when it ends: for steps that end in stored tables, which need them no more."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``work_path`` named, once all its readers are done."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return freed memory of this process to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str, batch: int = 2000) -> DataFrame:
    """``mapInArrow`` for generators that take one column dict per batch and yield column dicts.

    ``rows`` gets an iterator of ``{column: list}`` and yields ``{column: list or array}`` of any length.
    """
    names = [f.name for f in _fields(schema)]
    types = {f.name: f.type for f in _fields(schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        source = (b.slice(i, batch).to_pydict() for b in batches for i in range(0, b.num_rows, batch))
        for out in rows(source):
            yield pa.RecordBatch.from_arrays([pa.array(out[n], types[n]) for n in names], names)
        # The worker lives on and runs other tasks; without this its freed memory would still count as the executor's.
        del source
        give_back()

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return list(to_arrow_schema(StructType.fromDDL(schema)))
