"""Indicators of daily series as window expressions.

Every series has at most one row an entity and day (`latest_delivery` sees to
that before any window), so a window group is bounded by the number of days
however many rows an entity is delivered with.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def indexed(df: DataFrame, key: str, order: str) -> DataFrame:
    """`df` with the 0-based row number `i` within `key`."""
    return df.withColumn("i", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def trailing(key: str, n: int) -> WindowSpec:
    return Window.partitionBy(key).orderBy("i").rowsBetween(1 - n, 0)


def exact_mean(value: str | Column, w: WindowSpec | None = None, places: int = 4) -> Column:
    """Mean of values of so many decimals: the sum is rounded back to them, so its order doesn't show in the result."""
    total, n = F.sum(value), F.count(value)
    if w is not None:
        total, n = total.over(w), n.over(w)
    return F.try_divide(F.round(total.cast("double"), places), n)


def plain_zero(column: str | Column, places: int) -> Column:
    """Rounded, and 0 without a sign."""
    c = F.round(column, places)
    return F.when(c == 0, 0.0).otherwise(c)


def recursive_sum(df: DataFrame, key: str, value: Column, ratio: float, name: str) -> DataFrame:
    """`df` with s(i) = ratio * s(i-1) + value(i) over the index `i`; NULL values count as 0.

    Closed form in blocks: within a block ratio^k * sum(value * ratio^-k), plus
    the decayed end of the block before. A block is so long that what lies two
    blocks back has lost more digits than a double has, and so short that
    ratio^-k never overflows, whatever the length of the series.
    """
    block = math.ceil(40 / -math.log(ratio))
    inside = Window.partitionBy(key, "__blk").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    power = lambda e: F.pow(F.lit(ratio), e)
    k = F.col("__k")
    out = df.withColumn("__blk", F.floor(F.col("i") / block)).withColumn("__k", F.pmod("i", F.lit(block)))
    out = out.withColumn("__loc", power(k) * F.sum(F.coalesce(value, F.lit(0.0)) * power(-k)).over(inside))
    carry = F.last(F.when(k == block - 1, F.col("__loc")), ignorenulls=True).over(before)
    out = out.withColumn("__car", F.coalesce(carry, F.lit(0.0)))
    return out.withColumn(name, F.col("__loc") + power(k + 1) * F.col("__car")).drop("__blk", "__k", "__loc", "__car")


def ema(df: DataFrame, key: str, value: str, span: int, name: str) -> DataFrame:
    """Exponential mean of weight 2/(span+1), started at the first value."""
    alpha = 2 / (span + 1)
    return recursive_sum(df, key, F.when(F.col("i") == 0, F.col(value)).otherwise(alpha * F.col(value)), 1 - alpha, name)


def moving_averages(df: DataFrame, key: str, value: str) -> DataFrame:
    for n in (20, 50):
        df = df.withColumn(f"sma_{n}", exact_mean(value, trailing(key, n)))
    return ema(df, key, value, 20, "ema_20")


def rsi(df: DataFrame, key: str, value: str, n: int = 14) -> DataFrame:
    """Relative strength by simple means; NULL before n rows and where nothing moved."""
    change = F.col(value) - F.lag(value).over(Window.partitionBy(key).orderBy("i"))
    df = df.withColumn("__ch", F.coalesce(change, F.lit(0.0)))
    up = F.avg(F.greatest("__ch", F.lit(0.0))).over(trailing(key, n))
    down = F.avg(F.greatest(-F.col("__ch"), F.lit(0.0))).over(trailing(key, n))
    df = df.withColumn("__up", up).withColumn("__down", down)
    rs = F.when(F.col("__down") > 0, 100 - 100 / (1 + F.try_divide("__up", "__down"))).when(F.col("__up") > 0, 100.0)
    return df.withColumn(f"rsi_{n}", F.when(F.col("i") >= n - 1, rs)).drop("__ch", "__up", "__down")


def macd(df: DataFrame, key: str, value: str) -> DataFrame:
    df = ema(ema(df, key, value, 12, "__fast"), key, value, 26, "__slow")
    df = df.withColumn("macd", F.col("__fast") - F.col("__slow")).drop("__fast", "__slow")
    return ema(df, key, "macd", 9, "macd_signal").withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def bollinger(df: DataFrame, key: str, value: str, n: int = 20, width: float = 2.0) -> DataFrame:
    """Mean and mean -/+ width sample deviations; the bands are NULL on the first row."""
    mean, std = exact_mean(value, trailing(key, n)), F.stddev_samp(value).over(trailing(key, n))
    return df.withColumns({"bollinger_middle": mean, "bollinger_upper": mean + width * std, "bollinger_lower": mean - width * std})


def true_range(df: DataFrame, key: str) -> DataFrame:
    prev = F.lag("close").over(Window.partitionBy(key).orderBy("i"))
    return df.withColumn("true_range", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev)))


def atr(df: DataFrame, key: str, n: int = 14) -> DataFrame:
    return true_range(df, key).withColumn(f"atr_{n}", exact_mean("true_range", trailing(key, n)))


def adx(df: DataFrame, key: str, p: int = 14) -> DataFrame:
    """Directional indicators with Wilder's smoothing: plus_di, minus_di and adx.

    0 before p rows. The adx starts as the mean of the strengths of rows p-1 to
    2p-2 (to the last row of a shorter series) and is smoothed from there.
    """
    w, whole = Window.partitionBy(key).orderBy("i"), Window.partitionBy(key)
    df = true_range(df, key)
    up, down = F.col("high") - F.lag("high").over(w), F.lag("low").over(w) - F.col("low")
    df = df.withColumn("__u", up).withColumn("__d", down)
    df = df.withColumn("__pm", F.when((F.col("__u") > F.col("__d")) & (F.col("__u") > 0), F.col("__u")).otherwise(0.0))
    df = df.withColumn("__mm", F.when((F.col("__d") > F.col("__u")) & (F.col("__d") > 0), F.col("__d")).otherwise(0.0))
    for x in ("true_range", "__pm", "__mm"):
        first = F.sum(x).over(trailing(key, p))
        df = df.withColumn("__in", F.when(F.col("i") == p - 1, first).when(F.col("i") >= p, F.col(x)))
        df = recursive_sum(df, key, F.col("__in"), 1 - 1 / p, f"__s{x}").drop("__in")
    for name, x in (("plus_di", "__s__pm"), ("minus_di", "__s__mm")):
        df = df.withColumn(name, F.when((F.col("i") >= p - 1) & (F.col("__strue_range") > 0), 100 * F.try_divide(x, "__strue_range")).otherwise(0.0))
    both = F.col("plus_di") + F.col("minus_di")
    df = df.withColumn("__dx", F.when(both > 0, 100 * F.try_divide(F.abs(F.col("plus_di") - F.col("minus_di")), both)).otherwise(0.0))
    df = df.withColumn("__n", F.count("*").over(whole)).withColumn("__e", F.least(F.lit(2 * p - 2), F.col("__n") - 1))
    df = df.withColumn("__seed", F.avg(F.when((F.col("i") >= p - 1) & (F.col("i") <= F.col("__e")), F.col("__dx"))).over(whole))
    value = F.when(F.col("__n") < p, 0.0).when(F.col("i") == F.col("__e"), F.col("__seed")).when(F.col("i") > F.col("__e"), F.col("__dx") / p)
    df = recursive_sum(df.withColumn("__in", value), key, F.col("__in"), 1 - 1 / p, "adx")
    return df.drop("__u", "__d", "__pm", "__mm", "__strue_range", "__s__pm", "__s__mm", "__dx", "__n", "__e", "__seed", "__in")
