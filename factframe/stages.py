"""Tables between the steps of a query."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def with_folder(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; where none is set, a folder of our own, in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="factframe-"))


def kept(df: DataFrame) -> DataFrame:
    """df computed once and written to the checkpoint folder, for what is read more than once.

    It keeps its partitioning, so what is grouped by the same key next isn't
    moved again. Spark removes the files once nothing refers to them, if
    spark.cleaner.referenceTracking.cleanCheckpoints is set, as it is in
    session().
    """
    with_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own within the checkpoint folder, on storage that all executors share, gone with all that is in it at the end."""
    with_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
