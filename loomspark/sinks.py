"""Where results go: Parquet folders, and a stream's micro-batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.plans.query import ChainResult

#: Arrow bytes after which a task begins another IPC file, since a reader may hold a whole one.
IPC_BYTES = 64 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared one (spark.checkpoint.dir); where that is unset and Spark runs in one process, as in
    tests, a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-chain-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(result: ChainResult, path: str) -> None:
    """blocks/transactions/logs/traces/decoded_logs.parquet below `path`; a table without rows has a file with its schema."""
    for name, df in {**result.tables, "decoded_logs": result.decoded_logs}.items():
        if df is not None:
            df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def _create(uri: str):
    """A file to write: a plain one where the folder is mounted, else through Arrow's file systems."""
    where = urlparse(uri)
    if where.scheme in ("", "file"):
        os.makedirs(os.path.dirname(where.path), exist_ok=True)
        return pa.OSFile(where.path, "wb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_output_stream(path)


def write_arrow_ipc(df: DataFrame, folder: str) -> int:
    """The rows as Arrow IPC files of bounded size in a shared folder, written by the tasks; how many rows there are.

    Files are named by partition and number, so that a task that runs again replaces what its first attempt left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, rows, size = TaskContext.get().partitionId(), 0, 0, 0
        out = writer = None
        for batch in batches:
            if writer is None:
                out = _create(f"{folder}/part-{part:06d}-{files:06d}.arrow")
                writer, files, size = pa.ipc.new_file(out, batch.schema), files + 1, 0
            writer.write_batch(batch)
            rows, size = rows + len(batch), size + batch.nbytes
            if size >= IPC_BYTES:
                writer.close()
                out.close()
                writer = None
        if writer is not None:
            writer.close()
            out.close()
        yield pa.RecordBatch.from_pydict({"rows": [rows]}, schema=pa.schema([("rows", pa.int64())]))

    return df.mapInArrow(run, "rows bigint").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def follow_sink(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Append a stream to Parquet; its progress is the checkpoint, so a restart goes on where it stopped."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
