"""Materialised views and progress, both as versioned tables in a shared folder.

A refresh writes a new version beside the old ones and is complete when its
`_SUCCESS` mark is there, so readers never see half a view and a refresh that
dies leaves the last good version in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(hadoop)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[1:]))
    return sorted(found)


def refresh(df: DataFrame, path: str) -> int:
    """Write `df` as the next version of the view and return its number."""
    version = max(_versions(df.sparkSession, path), default=0) + 1
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/v{version}")
    return version


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/v{versions[-1]}")


def record_progress(done: DataFrame, path: str) -> None:
    """Append (key, day) of what is done."""
    done.select("key", "day").write.mode("append").parquet(path)


def remaining(tasks: DataFrame, path: str) -> DataFrame:
    """The tasks (key, day) after the last day done of each key."""
    upto = tasks.sparkSession.read.parquet(path).groupBy("key").agg(F.max("day").alias("upto"))
    return tasks.join(upto, "key", "left").where("upto is null or day > upto").drop("upto")
