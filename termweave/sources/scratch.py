"""Cutting lineage with tables written in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables written by this process, in order.
_PATHS: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir; where it is unset, a folder of our own, if all runs in this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="termweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """df stored once as Parquet in the shared folder and read back: lineage ends there, and lost executors lose nothing."""
    path = f"{scratch_dir(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _PATHS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in the order of tables written, for clear()."""
    return len(_PATHS)


def clear(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Deletes the tables written since a mark, but for those that `keep` reads. Results that read the others must be done with."""
    read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in keep.inputFiles()} if keep is not None else set()
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    left = []
    for one in _PATHS[since:]:
        if one.rsplit("/", 1)[-1] in read:
            left.append(one)
        else:
            at = path(one)
            at.getFileSystem(conf).delete(at, True)
    _PATHS[since:] = left
