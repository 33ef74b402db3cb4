"""What the operators share: reading tables, bounded batches, the shared folder."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; with texts of some kilobytes a batch is a few MB.
ARROW_ROWS = 512
#: Bytes of one Arrow batch.
ARROW_BYTES = 16 << 20
#: Characters that an operator works on at once.
CHUNK_CHARS = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_arrow(spark: SparkSession) -> None:
    """Bounds the batches that readers make and Python workers get, by rows and by bytes: a batch of whole texts is large."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; only where it is unset, as in tests, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'tessera-checkpoints')}"
    return found


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the shared one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: what follows neither repeats its work nor depends on lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    schema = df.schema
    df.write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shared(uri: str, blob: bytes) -> None:
    """Writes a file below a shared folder in one step, so that a repeated task leaves it whole."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        path = parts.path
        os.makedirs(os.path.dirname(path), exist_ok=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "wb") as out:
            out.write(blob)
        os.replace(own, path)
        return
    system, path = _file_system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(blob)
    system.move(own, path)


def map_shared(uri: str) -> memoryview:
    """A shared file's bytes: memory-mapped from a mounted folder, else read from its store."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        if not os.path.getsize(parts.path):
            return memoryview(b"")
        with open(parts.path, "rb") as file:
            return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    system, path = _file_system(uri)
    with system.open_input_stream(path) as file:
        return memoryview(file.read())


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", chars: int = CHUNK_CHARS) -> Iterator[pa.Table]:
    """The batches, put together up to about so many bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= chars:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def map_chunks(df: DataFrame, work: Callable[[], Callable[[pa.Table], dict]], schema: str, text: str = "text", chars: int = CHUNK_CHARS) -> DataFrame:
    """mapInArrow over chunks: ``work()`` is made once a task and turns a chunk into columns."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    bounded_arrow(df.sparkSession)
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def run(batches):
        step = work()
        for chunk in chunks(batches, text, chars):
            if chunk.num_rows:
                columns = step(chunk)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else _one(columns[f.name]).cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def filter_rows(df: DataFrame, work: Callable[[], Callable[[list[str]], list[bool]]], text: str = "text") -> DataFrame:
    """The rows, in all their columns, whose text ``work()`` says yes to; a null text is judged as an empty one."""
    bounded_arrow(df.sparkSession)

    def run(batches):
        judge = work()
        for chunk in chunks(batches, text):
            if chunk.num_rows:
                kept = chunk.filter(pa.array([bool(x) for x in judge([x or "" for x in chunk.column(text).to_pylist()])], pa.bool_()))
                yield from kept.to_batches()

    return df.mapInArrow(run, df.schema)


def _one(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def ragged(offsets, lengths, picks):
    """Positions of the picked runs, one after the other; a run i spans offsets[i] to offsets[i] + lengths[i]."""
    import numpy as np

    n = lengths[picks]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offsets[picks] - (ends - n), n) + np.arange(total, dtype=np.int64), n
