"""Clustered tables: slices of blocks of about equal rows, a manifest of their bounds, and filters inside the files.

Blocks are counted first, and a slice is a run of blocks between two multiples of a number of rows, so that hot times
make more slices, not larger files; a slice that is larger still, by one hot block, goes to several files. The manifest
(slice, first and last block, rows) turns a range of blocks into a range of slice folders. Within its files a slice is
ordered by what selections look for (a log's address and first topic), so that row groups drop out by their bounds; the
other columns have Parquet bloom filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.operators.order import BUCKET
from loomspark.schema import BLOCK_COLUMN, SCHEMAS

#: Rows of a slice, and of a file.
ROWS = 4_000_000
#: Up to so many blocks, their slices are broadcast to the rows.
BLOCKS = 500_000
#: What each table is ordered by within its files, before its block, and the columns with a bloom filter.
CLUSTER = {"blocks": [], "transactions": ["from"], "logs": ["address", "topic0"], "traces": ["to"]}
BLOOM = {
    "blocks": ["hash", "miner"],
    "transactions": ["hash", "from", "to", "sighash", "contract_address"],
    "logs": ["transaction_hash", "address", "topic0", "topic1", "topic2", "topic3"],
    "traces": ["transaction_hash", "from", "to", "address", "sighash"],
}
MANIFEST = "slice bigint, first_block bigint, last_block bigint, n_rows bigint"


def slices(df: DataFrame, table: str, rows: int = ROWS) -> DataFrame:
    """(number, slice, n) of each block with rows: the slice is how often `rows` rows lie before the block. Sums have two levels, of
    buckets of blocks and within them, so that no window holds all blocks."""
    counts = df.groupBy(F.col(BLOCK_COLUMN[table]).alias("number")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("b", F.floor(F.col("number") / BUCKET))
    sums = counts.groupBy("b").agg(F.sum("n").alias("s"))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("b", F.coalesce(F.sum("s").over(ahead(Window.orderBy("b"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(ahead(Window.partitionBy("b").orderBy("number"))), F.lit(0))
    return counts.join(base, "b").select("number", F.floor((F.col("base") + inside) / rows).cast("bigint").alias("slice"), "n")


def store_clustered(tables: dict, path: str, rows: int = ROWS, **options: str) -> None:
    """Write tables below `path`, a folder for each with one for each slice, and `<table>.manifest` beside it. `options` are
    options of the Parquet writer."""
    for table, df in tables.items():
        spark, number = df.sparkSession, BLOCK_COLUMN[table]
        slices(df, table, rows).write.mode("overwrite").parquet(f"{path}/{table}.blocks")
        by_block = spark.read.parquet(f"{path}/{table}.blocks")
        manifest = by_block.groupBy("slice").agg(F.min("number").alias("first_block"), F.max("number").alias("last_block"), F.sum("n").alias("n_rows"))
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{table}.manifest")
        of_block = by_block.select(F.col("number").alias(number), "slice")
        of_block = F.broadcast(of_block) if by_block.count() <= BLOCKS else of_block
        # Rows that are dealt by ranges of blocks already, as the order asks for, are not shuffled; others split hot blocks too.
        ordered = df.orderBy(number, *CLUSTER[table]).join(of_block, number).select(*df.columns, "slice")
        # Without a number of values each filter would take a megabyte, however few rows a file has.
        bloom = {f"parquet.bloom.filter.{k}#{c}": v for c in BLOOM[table] for k, v in (("enabled", "true"), ("expected.ndv", str(rows)))}
        ordered.sortWithinPartitions("slice", *CLUSTER[table], number).write.mode("overwrite").options(**bloom, **options).option(
            "maxRecordsPerFile", 2 * rows
        ).partitionBy("slice").parquet(f"{path}/{table}")


def manifest(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/{table}.manifest")


def scan_clustered(spark: SparkSession, path: str, table: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Blocks of [start, end) of a clustered table. The manifest is read for the first and the last slice; folders of others are not."""
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in SCHEMAS[table]), T.StructField("slice", T.LongType())])
    df, number = spark.read.schema(schema).parquet(f"{path}/{table}"), F.col(BLOCK_COLUMN[table])
    if not start and end is None:
        return df.drop("slice")
    inside = manifest(spark, path, table).where(F.col("last_block") >= start)
    inside = inside if end is None else inside.where(F.col("first_block") < end)
    first, last = inside.agg(F.min("slice"), F.max("slice")).first()
    kept = number >= start if end is None else (number >= start) & (number < end)
    return df.where(kept & (F.col("slice").between(first, last) if first is not None else F.lit(False))).drop("slice")
