"""Totals and averages over trailing periods, quiet days included.

Entities by days are packed into sparse-to-dense numpy blocks and multiplied
by banded window operators. A block covers one tile of days of a bounded
number of entities; the rows of the days before a tile that its windows reach
back to (the halo) are sent along with it, so no tile needs another.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "DATE'1970-01-01'"


def epoch_day(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.datediff(c.cast("date"), F.expr(EPOCH))


def clean_double(column: str) -> Column:
    """A double with NaN as NULL."""
    c = F.col(column).cast("double")
    return F.when(F.isnan(c), None).otherwise(c)


def latest_delivery(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each key: the values of the row that is greatest by `order`.

    An aggregate, not a window: it combines on the map side, so a key that
    holds a third of all rows sends one row a partition. Rows with a NULL key
    form one group, as in any SQL grouping.
    """
    best = F.max(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col(f"__best.v{i}").alias(v) for i, v in enumerate(values)])


def daily_measure(df: DataFrame, entity: str, day: Column, values: dict[str, Column]) -> DataFrame:
    """(__e, __d, m__s, m__c): sum and count of the non-null values of each entity and day."""
    aggs = []
    for name, value in values.items():
        aggs += [F.sum(value).cast("double").alias(f"{name}__s"), F.count(value).cast("double").alias(f"{name}__c")]
    return df.where(F.col(entity).isNotNull() & day.isNotNull()).groupBy(F.col(entity).alias("__e"), day.alias("__d")).agg(*aggs)


def band(width: int, tile: int, halo: int) -> np.ndarray:
    """The (halo + tile) x tile operator that sums the `width` days ending on each day of the tile."""
    back = (np.arange(tile)[None, :] + halo) - np.arange(halo + tile)[:, None]
    return ((back >= 0) & (back < width)).astype(np.float64)


def trailing_windows(
    daily: DataFrame,
    spans: DataFrame,
    measures: Sequence[str],
    windows: Sequence[int] = (7, 30),
    tile_days: int = 256,
    entities_per_block: int = 128,
    decimals: int | None = None,
) -> DataFrame:
    """Trailing totals, counts and averages of each entity and day of its span.

    daily: (__e, __d, m__s, m__c) for each m in `measures`, one row an entity
    and day at most, as made by `daily_measure` (several may be unioned: the
    rows of one entity and day add up). spans: (__e, __first, __last) in days
    since 1970-01-01.

    Result: __e, __d and for each m and window w: m_total_w (0 where the window
    holds no value), m_n_w (values in the window), m_avg_w (NULL where m_n_w is
    0). NULL and NaN values count as absent. Every day from first to last comes
    out, also where whole tiles are empty; days outside the span never do, but
    values before it count in its windows. Empty inputs give an empty result.
    decimals: totals are rounded to that many places before they are divided.
    """
    halo = max(windows) - 1
    entity_type = spans.schema["__e"].dataType.simpleString()
    n_entities = spans.count()
    n_blocks = max(1, -(-n_entities // entities_per_block))
    block = F.pmod(F.xxhash64("__e"), F.lit(n_blocks)).cast("int").alias("__b")
    tile_of = lambda c: F.floor(c / tile_days).cast("int")

    value_columns = [f"{m}__{k}" for m in measures for k in "sc"]
    # a day is in its own tile, and in those after it whose halo reaches it
    tiles = F.sequence(tile_of(F.col("__d")), tile_of(F.col("__d") + halo))
    data = daily.select("__e", F.explode(tiles).alias("__t"), "__d", *value_columns)
    marks = spans.select("__e", F.explode(F.sequence(tile_of(F.col("__first")), tile_of(F.col("__last")))).alias("__t"), "__first", "__last")
    none = F.lit(None)
    rows = data.select("__t", block, "__e", "__d", none.cast("int").alias("__first"), none.cast("int").alias("__last"), *value_columns).unionByName(
        marks.select("__t", block, "__e", none.cast("int").alias("__d"), "__first", "__last", *[none.cast("double").alias(c) for c in value_columns])
    )

    names = [f"{m}_{k}_{w}" for m in measures for w in windows for k in ("total", "n", "avg")]
    schema = f"__e {entity_type}, __d int, " + ", ".join(f"{n} {'long' if n.split('_')[-2] == 'n' else 'double'}" for n in names)
    operators = {w: band(w, tile_days, halo) for w in windows}

    def one_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        start = int(key[0]) * tile_days
        marked = pdf["__first"].notna().to_numpy()
        spans_here = pdf[marked]
        entities = pd.Index(spans_here["__e"])
        values = pdf[~marked]
        at = entities.get_indexer(values["__e"])
        known = at >= 0
        values, at = values[known], at[known]
        day = values["__d"].to_numpy(dtype=np.int64) - start + halo
        first = np.maximum(spans_here["__first"].to_numpy(dtype=np.int64), start) - start
        last = np.minimum(spans_here["__last"].to_numpy(dtype=np.int64), start + tile_days - 1) - start
        days = np.arange(tile_days)
        keep = (days[None, :] >= first[:, None]) & (days[None, :] <= last[:, None])
        e, d = np.nonzero(keep)
        out: dict[str, object] = {"__e": entities.to_numpy()[e], "__d": (d + start).astype(np.int32)}
        for m in measures:
            dense = {}
            for k in "sc":
                dense[k] = np.zeros((len(entities), halo + tile_days))
                np.add.at(dense[k], (at, day), np.nan_to_num(values[f"{m}__{k}"].to_numpy(dtype=np.float64)))
            for w in windows:
                total, n = dense["s"] @ operators[w], np.rint(dense["c"] @ operators[w])
                total, n = total[keep], n[keep]
                total = np.where(n > 0, total, 0.0)
                if decimals is not None:
                    total = np.round(total, decimals) + 0.0
                out[f"{m}_total_{w}"], out[f"{m}_n_{w}"] = total, n.astype(np.int64)
                with np.errstate(invalid="ignore", divide="ignore"):
                    out[f"{m}_avg_{w}"] = pd.Series(np.where(n > 0, total / n, np.nan)).astype("Float64").mask(n == 0)
        return pd.DataFrame(out)

    return rows.groupBy("__t", "__b").applyInPandas(one_block, schema)
