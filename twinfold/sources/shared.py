"""Tables that a job writes for itself to the folder which a cluster's driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder in spark.checkpoint.dir. Only a local session may lack one, as in tests: it gets a temporary
    one, which goes with the process."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="twinfold-"))
        atexit.register(shutil.rmtree, _local[0], True)
    return f"file://{_local[0]}"


def written(df: DataFrame) -> DataFrame:
    """The rows of df, written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/twinfold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._twinfold_path = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete tables of written() that no later step reads."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._twinfold_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
