"""Send this package to the executors, so that the functions that run in Python tasks can be imported there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


#: Bytes that one Arrow batch of rows sent to a Python task holds: texts are long, and several batches are held at once.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Add the package to the Python path of the executors, once per application (through Spark's file server),
    and bound the batches that they get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-ship-"), "loomspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("loomspark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)


def shipped(fn):
    """The function (spark, ...) with the package sent first."""

    def run(spark, *args):
        ship(spark)
        return fn(spark, *args)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run
