"""Set-based writes: insert if absent, keep the latest, upsert, cascade, retention."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def absent(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of `incoming` whose key isn't in `existing`, the first by `order` of each key.

    NULL key parts equal NULL. The incoming rows are reduced to one a key by an
    aggregate before the join, so a key that repeats a million times sends one row.
    """
    first = F.min_by(F.struct(*incoming.columns), F.struct(*order)).alias("__r")
    once = incoming.groupBy(*keys).agg(first).select("__r.*")
    seen = existing.select(*[F.col(k).alias(f"__e_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__e_{k}"))
        on = c if on is None else on & c
    return once.join(seen, on, "left_anti")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row by `order` of each key."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__r")).select("__r.*")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`existing` with the non-NULL, non-empty values of `incoming`, and its new keys."""
    new = incoming.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in columns])
    truthy = lambda c: F.when(F.col(c).cast("string") != "", F.col(c))
    joined = existing.join(new, list(keys), "full_outer")
    return joined.select(*keys, *[F.coalesce(truthy(f"__n_{c}"), F.col(c)).alias(c) for c in columns])


def cascade_counts(parents: DataFrame, key: str, children: Mapping[str, DataFrame]) -> DataFrame:
    """(child, deleted, kept) if the rows of `parents` and all that refer to them went."""
    gone = parents.select(key).distinct().withColumn("__gone", F.lit(True))
    out = None
    for name, child in children.items():
        part = child.join(gone, key, "left").agg(F.count("__gone").alias("deleted"), F.count_if(F.col("__gone").isNull()).alias("kept")).withColumn("child", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def retention_counts(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(name, deleted, kept) by each table's test of what is too old; a NULL test keeps."""
    out = None
    for name, (df, old) in tables.items():
        part = df.agg(F.count_if(old).alias("deleted"), F.count_if(~F.coalesce(old, F.lit(False))).alias("kept")).withColumn("name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def replace_table(df: DataFrame, path: str) -> None:
    """`df`, which may read the table at `path`, written in its place: first beside it, then renamed, so a job that fails leaves the old table."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old = f"{path}-new-{uuid.uuid4().hex}", f"{path}-old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(at(new), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"{new} can't be moved")
    if had:
        fs.delete(at(old), True)
    spark.catalog.refreshByPath(path)


def merge_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`existing` with the rows of `incoming` in place of those of the same key: on a conflict the incoming row wins, of several the last by `order`."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    return latest_by(both, keys, ["__new", *order]).drop("__new")


def delete_cascade(spark: SparkSession, parent: str, children: Mapping[str, str], key: str, gone: Column) -> DataFrame:
    """Delete the parent rows for which `gone` is true and all rows that refer to them from the tables at these paths; returns (child, deleted, kept)."""
    parents = spark.read.parquet(parent)
    leaving = parents.where(gone).select(key).distinct()
    counts = cascade_counts(parents.where(gone), key, {n: spark.read.parquet(p) for n, p in children.items()}).collect()  # a row a table
    for path in children.values():
        replace_table(spark.read.parquet(path).join(leaving, key, "left_anti"), path)
    replace_table(parents.where(~F.coalesce(gone, F.lit(False))), parent)
    return spark.createDataFrame(counts)


def delete_old(spark: SparkSession, tables: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Delete from each table at a path the rows its test finds too old; returns (name, deleted, kept). A NULL test keeps."""
    counts = retention_counts({n: (spark.read.parquet(p), old) for n, (p, old) in tables.items()}).collect()  # a row a table
    for path, old in tables.values():
        replace_table(spark.read.parquet(path).where(~F.coalesce(old, F.lit(False))), path)
    return spark.createDataFrame(counts)
