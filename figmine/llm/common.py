"""Helpers shared by the operators: shared storage, fixed-width columns, packed chunks."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.sinks.shared import remove, shared_path

#: the paths written by the run that is open in this thread
_RUN: ContextVar[list[str] | None] = ContextVar("figmine_run", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives the loss
    of executors and keeps later branches from computing it again.  Inside ``scratch`` it is deleted at the end."""
    path, run = shared_path(df.sparkSession, name), _RUN.get()
    if run is not None:
        run.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A run: the intermediate tables written inside are deleted at its end, also after a failure, and no
    others.  Runs in other threads, before, after or around this one keep theirs."""
    paths: list[str] = []
    token = _RUN.set(paths)
    try:
        yield
    finally:
        _RUN.reset(token)
        for path in paths:
            remove(spark, path)


#: bounds of what a task holds at once, where the cluster has set none
_BOUNDS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch and the rows of a batch read from Parquet, whose defaults count rows
    by the thousand, where the cluster has set no bound: texts and hash sets of any length then cost a task
    about the same memory."""
    for key, value in _BOUNDS.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)


def n_buckets(spark: SparkSession) -> int:
    """Hash buckets for blob exchanges: four a shuffle partition, which is where a cluster says how finely
    its data must be cut to fit executor memory.  A task holds one bucket at a time, a fourth of its
    partition on average, and buckets are many enough to even out over the partitions."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fold_column(column) -> F.Column:
    """crc32 of the document id as text, modulo 5; fold 0 is held out."""
    return F.crc32(column.cast("string").cast("binary")) % 5


def in_sample(column, share) -> F.Column:
    """Whether the 64-bit hash of a key lies in the first ``share`` of all hashes (all of them from 1 on):
    the same rule at every size of the table."""
    return (share >= 1) | (F.xxhash64(column).cast("double") < share * 2.0**64 - 2.0**63)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken, name = {c.lower() for c in df.columns}, f"__{base}"
    while name in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def to_bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def blobs(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All values of a binary column joined into one array."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype)


def small_ints(a: np.ndarray) -> bytes:
    """A self-describing compact form of an int64 array: base, width and offsets from the base."""
    if len(a) == 0:
        return b""
    base = int(a.min())
    span = int(a.max()) - base
    kind = np.uint8 if span < 1 << 8 else np.uint16 if span < 1 << 16 else np.uint32 if span < 1 << 32 else np.uint64
    head = np.array([base, np.dtype(kind).itemsize], np.int64)
    return head.tobytes() + (a.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)).astype(kind).tobytes()


def read_small_ints(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    base, width = np.frombuffer(raw, np.int64, 2)
    rest = np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[int(width)], offset=16)
    return (rest.astype(np.uint64) + np.uint64(int(base) & (1 << 64) - 1)).astype(np.int64)


PACKED = "chunk long, payload binary"


def pack(df: DataFrame, columns: list[str], chunk_bytes: int) -> DataFrame:
    """Rows packed into chunks of about ``chunk_bytes`` of text: one compressed Arrow payload a
    row, under an id made from its content and place.

    The id is the same each time a branch reads the same stable input; operators that answer
    requests by chunk raise an error if an answer is missing, they never go on without it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        place = (context.partitionId() if context else 0).to_bytes(8, "little")
        held, size, seq = [], 0, 0

        def emit():
            sink = io.BytesIO()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            payload = sink.getvalue()
            digest = hashlib.blake2b(payload + place + seq.to_bytes(8, "little"), digest_size=8).digest()
            return pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(digest, "little", signed=True)], pa.int64()), pa.array([payload], pa.binary())],
                ["chunk", "payload"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = batch.num_rows - at
                if batch.nbytes > chunk_bytes // 4:
                    per_row = max(1, batch.nbytes // batch.num_rows)
                    take = min(take, max(1, (chunk_bytes - size) // per_row))
                held.append(batch.slice(at, take))
                size += held[-1].nbytes
                at += take
                if size >= chunk_bytes:
                    yield emit()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield emit()

    return df.select(*columns).mapInArrow(run, PACKED)


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one table each; a group may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            c = batch.column(k)
            new |= ~np.asarray(pc.fill_null(pc.equal(c.slice(1), c.slice(0, batch.num_rows - 1)), False))
        cut = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            held.append(batch.slice(a, z - a))
            if z < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
