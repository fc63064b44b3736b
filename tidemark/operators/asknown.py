"""Attributes as known at event time.

The change log of an entity is cut into periods. For each entity and period
that has events or changes there is one snapshot, the state known at the
period's start, and the log of the changes inside it. An event joins the
snapshot of its period and replays only the period's changes before it. The
join key (entity, period) also cuts the rows of a hot entity into pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.trailing import epoch_day


def as_known(
    events: DataFrame,
    changes: DataFrame,
    entity: str,
    event_date: str,
    known_date: Column,
    precedence: Sequence[Column],
    carry: Sequence[str],
    valid: Column | None = None,
    period_days: int = 32,
    strict: bool = True,
    how: str = "left",
) -> DataFrame:
    """Each event with the change that wins among those known at its date.

    changes: rows known from `known_date` on; of the known ones the greatest by
    `precedence` wins (NULL is smallest). strict: known before the event's date;
    else on it or before. valid: changes for which it isn't true never count.

    Result: the columns of `events` and a struct column `as_known` with `carry`
    (NULL where nothing is known; with how="inner" such events are left out).
    Events with a NULL entity or date know nothing. Changes with a NULL entity
    or known date never count. Repeated events each come out; repeated changes
    change nothing. Columns of `changes` can't clash with those of `events`.
    """
    change_type = changes
    if valid is not None:
        change_type = change_type.where(F.coalesce(valid, F.lit(False)))
    lag = 1 if strict else 0
    # a change counts for events from day __k on
    log = change_type.select(
        F.col(entity).alias("__e"),
        (epoch_day(known_date) + lag).alias("__k"),
        F.struct(*[p.alias(f"p{i}") for i, p in enumerate(precedence)], F.struct(*[F.col(c) for c in carry]).alias("carry")).alias("__v"),
    ).where(F.col("__e").isNotNull() & F.col("__k").isNotNull())
    period = lambda c: F.floor(c / period_days).cast("int")
    by_day = log.groupBy("__e", "__k").agg(F.max("__v").alias("__v"))
    # at most period_days entries, one a day
    logs = by_day.groupBy("__e", period(F.col("__k")).alias("__p")).agg(F.sort_array(F.collect_list(F.struct("__k", "__v"))).alias("__log"), F.max("__v").alias("__top"))

    left = events.withColumns({"__day": epoch_day(event_date), "__ent": F.col(entity)}).withColumn("__per", period(F.col("__day")))
    asked = left.select(F.col("__ent").alias("__e"), F.col("__per").alias("__p")).where("__e is not null and __p is not null").distinct()
    both = logs.unionByName(asked.select("__e", "__p", F.lit(None).cast(logs.schema["__log"].dataType).alias("__log"), F.lit(None).cast(logs.schema["__top"].dataType).alias("__top")))
    # one row an entity and period, so even a hot entity is a short window
    each = both.groupBy("__e", "__p").agg(F.max("__top").alias("__top"), F.first("__log", ignorenulls=True).alias("__log"))
    before = Window.partitionBy("__e").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    snapshots = each.select("__e", "__p", F.max("__top").over(before).alias("__snap"), "__log")
    snapshots = snapshots.where("__snap is not null or __log is not null")

    joined = left.join(snapshots, (F.col("__ent") == F.col("__e")) & (F.col("__per") == F.col("__p")), how)
    replay = F.array_max(F.transform(F.filter("__log", lambda x: x["__k"] <= F.col("__day")), lambda x: x["__v"]))
    won = F.greatest(F.col("__snap"), replay)  # skips NULL
    out = joined.select(*[F.col(f"`{c}`") for c in events.columns], won["carry"].alias("as_known"))
    return out.where(F.col("as_known").isNotNull()) if how == "inner" else out
