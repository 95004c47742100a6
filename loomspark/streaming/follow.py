"""Following the head of the chain with Structured Streaming: queries over arriving files, heights, reorganisations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from loomspark.plans.query import ChainQuery, block_range
from loomspark.schema import SCHEMAS


def stream_table(spark: SparkSession, path: str, table: str, files: int = 100) -> DataFrame:
    """New files of a table's folder as a stream, at most `files` in a micro-batch."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMAS[table]])
    return (
        spark.readStream
        .schema(schema)
        .option("maxFilesPerTrigger", files)
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def stream_query(spark: SparkSession, path: str, query: ChainQuery, table: str) -> DataFrame:
    """A query's own rows of one table, as they arrive: range, selections and fields, with no join."""
    df = block_range(stream_table(spark, path, table), table, query.from_block, query.to_block)
    return df.where(query.predicates()[table]).select(
        *(f"`{c}`" for c in query.fields.get(table) or SCHEMAS[table].names)
    )


def heights(spark: SparkSession, path: str) -> DataFrame:
    """The highest block so far, as a streaming aggregate."""
    return stream_table(spark, path, "blocks").agg(F.max("number").alias("height"))


def rollback_guard(blocks: DataFrame) -> DataFrame:
    """What the next page is held against: the last block with its time and hash, the first with its parent's hash."""
    return blocks.agg(
        F.max("number").alias("block_number"),
        F.max_by("timestamp", "number").alias("timestamp"),
        F.max_by("hash", "number").alias("hash"),
        F.min("number").alias("first_block_number"),
        F.min_by("parent_hash", "number").alias("first_parent_hash"),
    )


def detect_reorg(blocks: DataFrame, bucket: int = 1000) -> DataFrame:
    """Blocks whose parent hash isn't the hash of the block before them. Blocks are dealt by buckets of numbers; each
    bucket also gets the last block before it, so that no window holds all blocks."""
    own = blocks.select(
        "number", "hash", "parent_hash", F.floor(F.col("number") / bucket).alias("b"), F.lit(True).alias("own")
    )
    tails = own.groupBy("b").agg(F.max("number").alias("number"), F.max_by("hash", "number").alias("hash"))
    after = tails.select("number", "hash", F.lead("b").over(Window.orderBy("b")).alias("b")).where("b is not null")
    both = own.unionByName(
        after.select("number", "hash", F.lit(None).cast("binary").alias("parent_hash"), "b", F.lit(False).alias("own"))
    )
    w = Window.partitionBy("b").orderBy("number")
    return (
        both.withColumn("before", F.lag("hash").over(w))
        .where(F.col("own") & F.col("before").isNotNull() & (F.col("before") != F.col("parent_hash")))
        .select("number", "parent_hash", F.col("before").alias("stored_hash"))
    )


def follow_with_guard(stream: DataFrame, handle, on_reorg, checkpoint: str, **trigger):
    """Micro-batches of blocks to `handle(batch, epoch)`; when a batch doesn't continue the one before, or breaks within
    itself, `on_reorg(batch, last good block)` comes first.

    Each batch writes its guard, one row, below `checkpoint` beside the stream's own progress (an empty batch passes the
    one before on), reads that of the batch before by its name and removes the one before that: as much work in the
    thousandth batch as in the first. A restart goes on against the last one; a batch that is repeated is held against
    the one before it again.
    """
    spark, guards = stream.sparkSession, f"{checkpoint}/guards"

    def before(epoch: int):
        try:
            return spark.read.parquet(f"{guards}/epoch={epoch - 1}").first() if epoch else None
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return None

    def keep(guard: DataFrame, epoch: int) -> None:
        guard.write.mode("overwrite").parquet(f"{guards}/epoch={epoch}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{guards}/epoch={epoch - 2}")
        old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)

    def step(batch: DataFrame, epoch: int) -> None:
        guard = rollback_guard(batch)
        ends, last = guard.first(), before(epoch)
        if ends.block_number is None:
            if last is not None:
                keep(spark.createDataFrame([last], guard.schema), epoch)
            return
        broken = detect_reorg(batch).agg(F.min("number")).first()[0]
        if last and last.hash != ends.first_parent_hash:
            on_reorg(batch, last.block_number)
        elif broken is not None:
            on_reorg(batch, broken - 1)
        handle(batch, epoch)
        keep(guard, epoch)

    return (
        stream.writeStream
        .foreachBatch(step)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
