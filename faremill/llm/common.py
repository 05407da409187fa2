"""Helpers shared by the operators: stored intermediate tables, Arrow batches, text rules."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faremill.session import shared_folder

#: Upper-case to lower-case for A-Z alone, for UTF-8 bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_made: list[tuple[SparkSession, str]] = []


def _clean_up() -> None:
    for spark, path in _made:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone; the folder is then the cluster's to sweep
            return


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    This cuts the lineage: losing an executor later costs no recomputation. The folder is removed
    when the driver's Python ends. Large tables of text or hashes take less room as ``zstd``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean_up)
    _made.append((spark, path))
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def by_batch(
    df: DataFrame, schema: str | StructType, work: Callable[[pa.RecordBatch], dict | None], rows: int | None = None
) -> DataFrame:
    """One output batch for each Arrow batch, or each ``rows`` rows of it; ``work`` gives the columns
    by name, in schema order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows or batch.num_rows or 1):
                if (columns := work(batch.slice(start, rows))) is not None:
                    yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


#: Bytes of one Arrow batch that operators take texts in: bounds a worker's memory, not the result.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of the session by bytes; Spark's own bound of 64 MB holds before this."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


#: What operators keep in this Python worker from task to task, by operator: how to let it go.
_kept: dict[str, Callable[[], None]] = {}
_at_work: list[str] = []


def enter(operator: str, let_go: Callable[[], None] | None = None) -> None:
    """Called where an operator's code begins on a worker: what others kept there goes, and freed memory returns.

    A worker outlives its tasks; without this one that has served several operators holds the caches of
    all and the room that their largest batches took.
    """
    if let_go is not None:
        _kept[operator] = let_go
    if _at_work == [operator]:
        return
    _at_work[:] = [operator]
    for other in [o for o in _kept if o != operator]:
        _kept.pop(other)()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def held_out(doc_id: str, modulus: int) -> F.Column:
    """Whether crc32 of the id as text is a multiple of ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == 0
