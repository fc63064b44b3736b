"""Matching records of two tables by nearest time.

Tick expansion: each right record is exploded to every tick within the
tolerance, what may be nearest somewhere in the tick is kept for each entity
and tick, and the left rows join their own tick by equality. A hot entity is
cut into its ticks, and no row is compared with more than its tick's few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000


def micros(column: Column) -> Column:
    """Microseconds since 1970 on the column's own clock, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), column.cast("timestamp_ntz"))


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    entity: str,
    left_time: Column,
    right_time: Column,
    carry: Sequence[str],
    prefer: Sequence[Column] = (),
    tolerance_s: int = 30 * 3600,
    tick_s: int = 6 * 3600,
    origin_s: int = 4 * 3600,
    how: str = "left",
) -> DataFrame:
    """Each left row with the right record of its entity that is nearest in time.

    Both times are in microseconds (`micros`). The distance may be at most
    `tolerance_s`, in either direction. Of two equally near records the earlier
    wins; of several at one time the greatest by `prefer`, then by `carry`.

    Result: the columns of `left`, a struct column `nearest` with `carry` (NULL
    where none is in reach; with how="inner" such rows are left out) and
    `distance_us` (right minus left). Rows with a NULL entity or time match
    nothing. Repeated left rows each come out.

    A tick keeps the last record up to its start, the first from its end on,
    and the distinct times inside it; with ticks no wider than the records'
    usual spacing that is a handful.
    """
    tick, tol, origin = tick_s * SECOND, tolerance_s * SECOND, origin_s * SECOND
    tick_of = lambda c: F.floor((c - origin) / tick)
    records = (
        right.select(F.col(entity).alias("__e"), right_time.alias("__t"), F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)], F.struct(*[F.col(c) for c in carry]).alias("c")).alias("__v"))
        .where(F.col("__e").isNotNull() & F.col("__t").isNotNull())
        .groupBy("__e", "__t")
        .agg(F.max("__v").alias("__v"))
        .select("__e", "__t", F.col("__v.c").alias("__c"))
    )
    ticks = records.select("__e", "__t", "__c", F.explode(F.sequence(tick_of(F.col("__t") - tol), tick_of(F.col("__t") + tol))).alias("__k"))
    start = F.col("__k") * tick + origin
    t, rec = F.col("__t"), F.struct("__t", "__c")
    kept = ticks.groupBy("__e", "__k").agg(
        F.max_by(rec, F.when(t <= start, t)).alias("__pred"),
        F.min_by(rec, F.when(t >= start + tick, t)).alias("__succ"),
        F.collect_list(F.when((t > start) & (t < start + tick), rec)).alias("__in"),
    )
    lt = left.withColumns({"__lt": left_time, "__ent": F.col(entity)}).withColumn("__tick", tick_of(F.col("__lt")))
    joined = lt.join(kept, (F.col("__ent") == F.col("__e")) & (F.col("__tick") == F.col("__k")), how)
    candidates = F.filter(F.concat(F.array("__pred", "__succ"), F.col("__in")), lambda r: r.isNotNull() & (F.abs(r["__t"] - F.col("__lt")) <= tol))
    best = F.array_min(F.transform(candidates, lambda r: F.struct(F.abs(r["__t"] - F.col("__lt")).alias("d"), r["__t"].alias("t"), r["__c"].alias("c"))))
    out = joined.withColumn("__best", best)
    if how == "inner":
        out = out.where(F.col("__best").isNotNull())
    return out.select(*[F.col(f"`{c}`") for c in left.columns], F.col("__best.c").alias("nearest"), (F.col("__best.t") - F.col("__lt")).alias("distance_us"))
