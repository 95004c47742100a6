"""Tables written between jobs, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its files are known to be no larger than this.
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``; where that is unset and Spark runs in
    one process (tests), a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-loom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def open_shared(uri: str):
    """A file of the shared folder for reading in a task: a plain path where it is mounted, else through Arrow."""
    where = urlparse(uri)
    if where.scheme in ("", "file"):
        return open(unquote(where.path), "rb")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def n_bytes(written_df: DataFrame) -> int:
    """Bytes of the files of a frame that `written` returned, as the file system reports them."""
    jvm = written_df.sparkSession._jvm
    conf = written_df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    total = 0
    for name in {f.rpartition("/")[0] for f in written_df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def maybe_broadcast(written_df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the written frame is small; otherwise leave the join to a shuffle."""
    return F.broadcast(written_df) if n_bytes(written_df) <= limit else written_df


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart where ids are null or repeat: 16 bytes of hash over id and text. Rows equal in both share it."""
    return F.unhex(
        F.concat(
            *(
                F.lpad(F.hex(F.xxhash64(F.lit(seed), doc_id.isNull(), doc_id, text.isNull(), text)), 16, "0")
                for seed in (1, 2)
            )
        )
    )


def unique_ids(keys: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """(key, id) for the few of the distinct `keys` (one column, key) whose 64-bit hash another key has too: ids that
    differ from all others. All other keys go by `hashed(key)`."""
    ids = keys.select("key", hashed("key").alias("id"))
    clash = ids.groupBy("id").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1")
    left = written(ids.join(clash, "id").where("key <> first").select("key"), "clashes")
    found, salt = left.select("key", F.lit(0).cast("bigint").alias("id")).limit(0), 0
    while not left.isEmpty():
        salt += 1
        drawn = left.select("key", F.xxhash64(F.lit(salt), "key").alias("id"))
        again = drawn.groupBy("id").count().where("count > 1").select("id")
        taken = drawn.select("id").join(ids.select("id").union(found.select("id")), "id", "left_semi").union(again).distinct()
        found = written(found.union(drawn.join(taken, "id", "left_anti").select("key", "id")), "fresh-ids")
        left = written(drawn.join(taken, "id", "left_semi").select("key"), "clashes")
    return found


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
