"""Row numbers within large keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, name: str = "i") -> DataFrame:
    """`df` with the 0-based row number within `keys` by `order`.

    `bucket` must not fall as `order` rises, like the month of a date. Rows are
    numbered within their bucket and the buckets' sizes give the offsets, so no
    task sorts all rows of a hot key.
    """
    df = df.withColumn("__bk", bucket)
    sizes = df.groupBy(*keys, "__bk").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    inner = Window.partitionBy(*keys, "__bk").orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(inner) - 1).join(sizes, [*keys, "__bk"])
    return out.withColumn(name, F.col("__rn") + F.col("__off")).drop("__bk", "__rn", "__off")


def month_of(column: str) -> Column:
    return F.year(column) * 12 + F.month(column)
