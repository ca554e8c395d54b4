"""Keyed store (O1, O2), versioned stores and table loading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir, which a cluster shares; a local session may go without."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared or tempfile.mkdtemp(prefix='keystrata-')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written once to a new scratch folder, and read from there: its lineage ends, its rows are the same for all readers."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder in any store that Spark writes to."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


POINTER = "current"


def _pointers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions published, oldest first: one empty marker file each."""
    files, at = _files(spark, f"{path}/{POINTER}")
    return sorted(int(f.getPath().getName()) for f in files.listStatus(at)) if files.exists(at) else []


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """Write df as the next version of the store at path, then make it the current one; its number.

    Readers find the version by the latest marker, which is made only when all files are there: they never
    see half a store, and df may read the store it replaces. Making a marker fails if another
    writer has made it. The last `keep` versions stay for readers that have begun.
    """
    spark = df.sparkSession
    number = max(_pointers(spark, path), default=0) + 1
    folder = f"{path}/versions/{number}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    files, at = _files(spark, f"{path}/{POINTER}/{number}")
    marker = files.create(at, False)
    marker.writeBytes(folder.rsplit("/", 1)[-1])
    marker.close()
    for old in _pointers(spark, path)[:-keep]:
        files, at = _files(spark, f"{path}/versions")
        for f in files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{old}-*")):
            files.delete(f.getPath(), True)
        files.delete(_files(spark, f"{path}/{POINTER}/{old}")[1], False)
    return number


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The current version of the store at path; without any an empty table."""
    published = _pointers(spark, path)
    if not published:
        return spark.createDataFrame([], schema)
    name = spark.read.text(f"{path}/{POINTER}/{published[-1]}").first()[0]
    return spark.read.schema(schema).parquet(f"{path}/versions/{name}")


def get(store: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """One row with the value of key in a (key, value) table, or the default: absent and null alike."""
    return store.where(F.col("key").eqNullSafe(key)).agg(F.coalesce(F.max("value"), F.lit(default).cast("string")).alias("value"))


def get_column(values: Column, key: str, default: str | None = None) -> Column:
    """The same on a map column."""
    return F.coalesce(F.try_element_at(values, F.lit(key)), F.lit(default).cast("string"))


def put(df: DataFrame, path: str) -> None:
    """Overwrite a store as a whole. Never the path that df reads: write elsewhere and switch."""
    if any(f.rstrip("/").startswith(f"{path.rstrip('/')}/") for f in (x.removeprefix("file://").removeprefix("file:") for x in df.inputFiles())):
        raise ValueError(f"{path} is being read by the rows to be written")
    df.write.mode("overwrite").parquet(path)
