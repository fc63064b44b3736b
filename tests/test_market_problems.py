"""The three general operators against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asknown import as_known
from tidemark.operators.nearest import micros, nearest_in_time
from tidemark.operators.trailing import daily_measure, epoch_day, latest_delivery, trailing_windows

D0 = dt.date(2023, 1, 1)


def day(n: int) -> dt.date:
    return D0 + dt.timedelta(days=n)


def spans_of(df):
    return df.where("e is not null and d is not null").groupBy(F.col("e").alias("__e")).agg(F.min(epoch_day("d")).alias("__first"), F.max(epoch_day("d")).alias("__last"))


@pytest.mark.parametrize("tile", [16, 64, 256])
def test_trailing_equals_brute_force(spark, tile):
    r = random.Random(tile)
    rows = [(r.choice([1, 2, 3, None]), day(r.choice([0, 3, 9, 40, 41, 95, 170, 171])), r.choice([None, 1.5, 2.25, float("nan"), -4.0])) for _ in range(120)] + [(2, None, 1.0), (4, day(5), None)]
    df = spark.createDataFrame(rows, "e int, d date, v double")
    clean = F.when(~F.isnan("v"), F.col("v"))
    out = trailing_windows(daily_measure(df, "e", epoch_day("d"), {"v": clean}), spans_of(df), ["v"], (7, 30), tile_days=tile, entities_per_block=2).collect()
    got = {(x["__e"], x["__d"]): x for x in out}
    epoch = (D0 - dt.date(1970, 1, 1)).days
    want = {}
    for e in {x[0] for x in rows if x[0] is not None}:
        days = [x[1] for x in rows if x[0] == e and x[1]]
        a = min(days)
        while a <= max(days):
            want[e, epoch + (a - D0).days] = {w: [x[2] for x in rows if x[0] == e and x[1] and x[2] is not None and x[2] == x[2] and 0 <= (a - x[1]).days < w] for w in (7, 30)}
            a += dt.timedelta(days=1)
    assert got.keys() == want.keys() and len(out) == len(got)
    for k, w in want.items():
        for n, vals in w.items():
            assert got[k][f"v_n_{n}"] == len(vals)
            assert got[k][f"v_total_{n}"] == pytest.approx(sum(vals))
            assert (got[k][f"v_avg_{n}"] is None) == (not vals)
            if vals:
                assert got[k][f"v_avg_{n}"] == pytest.approx(sum(vals) / len(vals))


def test_trailing_empty_and_value_before_span(spark):
    none = spark.createDataFrame([], "e int, d date, v double")
    assert trailing_windows(daily_measure(none, "e", epoch_day("d"), {"v": F.col("v")}), spans_of(none), ["v"]).count() == 0
    early = spark.createDataFrame([(1, day(0), 5.0)], "e int, d date, v double")
    bars = spark.createDataFrame([(1, day(3), 0.0)], "e int, d date, v double")
    out = trailing_windows(daily_measure(early, "e", epoch_day("d"), {"v": F.col("v")}), spans_of(bars), ["v"], (2, 7)).collect()
    assert [(x["v_n_2"], x["v_total_7"]) for x in out] == [(0, 5.0)]


def test_latest_delivery_takes_the_last_restatement(spark):
    df = spark.createDataFrame([(1, 1, "a", 1.0), (1, 3, "b", None), (1, 2, "c", 3.0), (None, 1, "d", 4.0)], "k int, t int, i string, v double")
    assert {(r["k"], r["v"]) for r in latest_delivery(df, ["k"], ["t", "i"], ["v"]).collect()} == {(1, None), (None, 4.0)}


@pytest.mark.parametrize(("strict", "period"), [(True, 1), (True, 7), (False, 32)])
def test_as_known_equals_brute_force(spark, strict, period):
    r = random.Random(period)
    changes = [(r.choice([1, 2, None]), r.choice([None, *map(day, range(0, 60, 3))]), r.choice([None, *map(day, range(0, 40, 5))]), i, f"x{i}") for i in range(80)]
    events = [(i, r.choice([1, 2, 3, None]), r.choice([None, *map(day, range(0, 90))]), "own") for i in range(150)]
    c = spark.createDataFrame(changes, "e int, known date, rep date, id int, v string")
    ev = spark.createDataFrame(events, "k int, e int, d date, v string")
    out = as_known(ev, c, "e", "d", F.col("known"), [F.col("rep"), F.col("known"), -F.col("id")], ["id", "v"], period_days=period, strict=strict).collect()
    assert len(out) == len(events)
    low = dt.date.min
    for row in out:
        ok = [x for x in changes if x[0] == row["e"] is not None and x[1] and row["d"] and (x[1] < row["d"] if strict else x[1] <= row["d"])]
        best = max(ok, key=lambda x: (x[2] or low, x[1], -x[3])) if ok else None
        assert (row["as_known"]["id"] if row["as_known"] else None) == (best[3] if best else None)
        assert row["v"] == "own"


def test_as_known_empty_sides_and_repeats(spark):
    c = spark.createDataFrame([], "e int, known date, id int")
    ev = spark.createDataFrame([(1, 1, day(3)), (1, 1, day(3))], "k int, e int, d date")
    out = as_known(ev, c, "e", "d", F.col("known"), [F.col("id")], ["id"]).collect()
    assert [r["as_known"] for r in out] == [None, None]
    assert as_known(ev.where("false"), c, "e", "d", F.col("known"), [F.col("id")], ["id"], how="inner").count() == 0


@pytest.mark.parametrize(("tick", "origin"), [(3600, 0), (6 * 3600, 4 * 3600), (90 * 3600, 5)])
def test_nearest_equals_brute_force(spark, tick, origin):
    r = random.Random(tick)
    base = dt.datetime(2023, 1, 1)
    when = lambda: r.choice([None, *[base + dt.timedelta(minutes=r.randrange(0, 20000)) for _ in range(6)]])
    left = [(i, r.choice([1, 2, None]), when(), "l") for i in range(120)]
    right = [(i, r.choice([1, 2, 3, None]), when(), "r") for i in range(40)]
    right += right[:5]
    ld, rd = spark.createDataFrame(left, "k int, e int, t timestamp_ntz, v string"), spark.createDataFrame(right, "id int, e int, t timestamp_ntz, v string")
    out = nearest_in_time(ld, rd, "e", micros(F.col("t")), micros(F.col("t")), ["id", "v"], tolerance_s=30 * 3600, tick_s=tick, origin_s=origin).collect()
    assert len(out) == len(left)
    for row in out:
        ok = [x for x in right if x[1] == row["e"] is not None and x[2] and row["t"] and abs((x[2] - row["t"]).total_seconds()) <= 30 * 3600]
        if not ok:
            assert row["nearest"] is None
            continue
        d, t = min((abs((x[2] - row["t"]).total_seconds()), x[2]) for x in ok)
        assert abs(row["distance_us"]) == round(d * 1e6)
        assert row["nearest"]["id"] == max(x[0] for x in ok if x[2] == t)
        assert row["v"] == "l"


def test_nearest_tolerance_is_inclusive_and_ties_take_the_earlier(spark):
    t = dt.datetime(2023, 1, 5, 12)
    ld = spark.createDataFrame([(1, 1, t)], "k int, e int, t timestamp_ntz")
    rd = spark.createDataFrame([(1, 1, t - dt.timedelta(hours=30)), (2, 1, t + dt.timedelta(hours=30)), (3, 1, t + dt.timedelta(hours=31))], "id int, e int, t timestamp_ntz")
    args = ("e", micros(F.col("t")), micros(F.col("t")), ["id"])
    assert nearest_in_time(ld, rd, *args).first()["nearest"]["id"] == 1
    assert nearest_in_time(ld, rd.where("id > 1"), *args).first()["nearest"]["id"] == 2
    assert nearest_in_time(ld, rd.where("id > 2"), *args, how="inner").count() == 0
    assert nearest_in_time(ld, rd.where("false"), *args).first()["nearest"] is None
