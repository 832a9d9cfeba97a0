"""Small helpers shared by the training-data operators.

Conventions for every operator of this subpackage:

* the input is a DataFrame with an integer id column and a text column; all other
  columns are ignored, so extra columns may have any name;
* a null text counts as the empty text, and an empty table gives an empty result;
* a row with a null id is kept, and its id stays null in the result;
* repeated rows are all kept and get the same answer.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handed to Python code in slices of about this many bytes.
SLICE_BYTES = 2_000_000


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), without nulls in text."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def mark_of(text: Column) -> Column:
    """A digest of a text, null as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    On a cluster that is ``spark.checkpoint.dir``; a temporary folder is made only
    for local runs in which nothing is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="poolside-"))
    return context.getCheckpointDir().rstrip("/")


#: Folders and tables that operators of this session have made; clean_up() removes them.
_MADE: dict[str, list[str]] = {"folders": [], "tables": []}


def fresh_path(spark: SparkSession, name: str) -> str:
    _MADE["folders"].append(path := f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return path


def fresh_table(spark: SparkSession, name: str) -> str:
    _MADE["tables"].append(table := f"{name}_{uuid.uuid4().hex}")
    return table


def clean_up(spark: SparkSession) -> int:
    """Remove the tables and folders that operators of this session have made, and say how many.

    Results are lazy and may read them: call it when what is wanted has been written.
    """
    removed = 0
    for table in _MADE["tables"]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        removed += 1
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    for folder in _MADE["folders"]:
        path = hadoop(folder)
        removed += int(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))  # noqa: SLF001
    _MADE["tables"].clear()
    _MADE["folders"].clear()
    return removed


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and cut from its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and the next task may need it elsewhere."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_slices(
    df: DataFrame, setup: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str, size_of: str = "text", limit: int = SLICE_BYTES
) -> DataFrame:
    """Apply a function to Arrow slices of bounded size.

    ``setup`` runs once in each task and returns the function, so models and
    caches are loaded on the executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = setup()
        for batch in batches:
            for part in slices(batch, size_of, limit):
                out = apply(part)
                if out is not None:
                    yield out
            give_back()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, size_of: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose values of size_of together have about ``limit`` bytes."""
    column = batch.column(batch.schema.names.index(size_of))
    if batch.num_rows == 0:
        return
    start = total = 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns in blocks that end with a group; rows come sorted by the first column."""
    parts: list[list[np.ndarray]] = []
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(new[0]):
            continue
        change = np.flatnonzero(new[0][1:] != new[0][:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if not cut and parts and parts[-1][0][-1] != new[0][0]:
            yield [np.concatenate(x) for x in zip(*parts, strict=True)]
            parts = []
        if cut:
            parts.append([c[:cut] for c in new])
            yield [np.concatenate(x) for x in zip(*parts, strict=True)]
            parts = []
        parts.append([c[cut:] for c in new])
    if parts:
        yield [np.concatenate(x) for x in zip(*parts, strict=True)]


def utf8_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()
