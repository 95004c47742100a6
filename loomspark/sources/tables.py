"""Stored tables: Parquet folders partitioned by ranges of blocks, Arrow IPC files, and what a source knows of itself."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from loomspark.schema import BLOCK_COLUMN, RANGE, SCHEMAS


def store(tables: dict, path: str) -> None:
    """Write tables below `path`, one folder per table, partitioned by block_range and sorted by block within files.

    Tasks get ranges of blocks of about equal rows, so that a folder with many rows has many files. A frame that is dealt by
    ranges of blocks already is not shuffled again."""
    for t, df in tables.items():
        c = BLOCK_COLUMN[t]
        ranged = df.orderBy(c).withColumn("block_range", F.floor(F.col(c) / RANGE))
        ranged.sortWithinPartitions("block_range", c).write.mode("overwrite").partitionBy("block_range").parquet(f"{path}/{t}")


def scan(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored table; one that isn't there is empty."""
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in SCHEMAS[table]] + [T.StructField("block_range", T.LongType())]
    )
    try:
        return spark.read.schema(schema).parquet(f"{path}/{table}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def scan_arrow_ipc(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of Arrow IPC files in a folder; each file is read by one task, which holds it whole (`write_arrow_ipc` bounds
    its files) and gives it on batch by batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with pa.ipc.open_file(pa.BufferReader(content.as_buffer())) as f:
                    for i in range(f.num_record_batches):
                        yield f.get_batch(i).select(schema.names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, schema)


def archive_height(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.coalesce(F.max("number"), F.lit(0)).cast("bigint").alias("height"))


def chain_id(transactions: DataFrame) -> DataFrame:
    return (
        transactions.where("chain_id is not null")
        .select(F.conv(F.hex("chain_id"), 16, 10).cast("bigint").alias("chain_id"))
        .distinct()
    )
