"""Indicators against plain sequential computation, and invariants of the windows."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series as s
from tidemark.operators.ranks import month_of, ordered_index

LENGTHS = [1, 13, 14, 15, 20, 26, 27, 60, 400]


def walk(n: int, seed: int) -> list[tuple[float, float, float]]:
    r, c, out = random.Random(seed), 100.0, []
    for _ in range(n):
        c = max(1.0, c + r.uniform(-3, 3))
        out.append((round(c + r.random(), 4), round(c - r.random(), 4), round(c, 4)))
    return out


@pytest.fixture(scope="module")
def data():
    return {n: walk(n, n) for n in LENGTHS} | {1000: [(5.0, 5.0, 5.0)] * 30}


@pytest.fixture(scope="module")
def frame(spark, data):
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=i), *x, 10) for k, v in data.items() for i, x in enumerate(v)]
    return s.indexed(spark.createDataFrame(rows, "k int, date date, high double, low double, close double, volume long"), "k", "date").cache()


def by_key(df, column):
    out: dict = {}
    for r in df.select("k", "i", column).collect():
        out.setdefault(r["k"], {})[r["i"]] = r[column]
    return out


def ema(xs, span):
    a, out = 2 / (span + 1), []
    for x in xs:
        out.append(x if not out else out[-1] * (1 - a) + a * x)
    return out


def test_ema_and_macd(frame, data):
    got = by_key(s.ema(frame, "k", "close", 20, "e"), "e")
    sig = by_key(s.macd(frame, "k", "close"), "macd_signal")
    for k, v in data.items():
        c = [x[2] for x in v]
        for i, e in enumerate(ema(c, 20)):
            assert got[k][i] == pytest.approx(e, rel=1e-10)
        for i, e in enumerate(ema([a - b for a, b in zip(ema(c, 12), ema(c, 26), strict=True)], 9)):
            assert sig[k][i] == pytest.approx(e, rel=1e-7, abs=1e-9)


def test_recursion_survives_long_series(spark):
    n = 12_000
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("i"), (F.pmod("id", F.lit(17)) + 1.0).alias("x"))
    got = by_key(s.recursive_sum(df, "k", F.col("x"), 0.8, "y"), "y")[1]
    y = 0.0
    for i in range(n):
        y = 0.8 * y + i % 17 + 1
        assert math.isclose(got[i], y, rel_tol=1e-12)


def test_rsi_bollinger_atr(frame, data):
    rsi, up, atr = by_key(s.rsi(frame, "k", "close"), "rsi_14"), by_key(s.bollinger(frame, "k", "close"), "bollinger_upper"), by_key(s.atr(frame, "k"), "atr_14")
    for k, v in data.items():
        c = [x[2] for x in v]
        ch = [0.0] + [b - a for a, b in zip(c, c[1:], strict=False)]
        tr = [max([h - lo] + ([abs(h - c[i - 1]), abs(lo - c[i - 1])] if i else [])) for i, (h, lo, _) in enumerate(v)]
        for i in range(len(v)):
            w = ch[max(0, i - 13) : i + 1]
            gain, loss = sum(x for x in w if x > 0), -sum(x for x in w if x < 0)
            want = None if i < 13 or (not gain and not loss) else 100.0 if not loss else 100 - 100 / (1 + gain / loss)
            assert rsi[k][i] == (pytest.approx(want, abs=1e-8) if want is not None else None)
            w = c[max(0, i - 19) : i + 1]
            assert up[k][i] == (pytest.approx(statistics.mean(w) + 2 * statistics.stdev(w), abs=1e-6) if len(w) > 1 else None)
            assert atr[k][i] == pytest.approx(statistics.mean(tr[max(0, i - 13) : i + 1]), abs=1e-6)


def test_adx_against_sequential_smoothing(frame, data):
    got, plus = by_key(s.adx(frame, "k"), "adx"), by_key(s.adx(frame, "k"), "plus_di")
    p = 14
    for k, v in data.items():
        n = len(v)
        tr, pm, mm = [], [], []
        for i, (h, lo, _) in enumerate(v):
            c = v[i - 1][2] if i else None
            tr.append(h - lo if c is None else max(h - lo, abs(h - c), abs(lo - c)))
            u, d = (h - v[i - 1][0], v[i - 1][1] - lo) if i else (0, 0)
            pm.append(u if u > d and u > 0 else 0)
            mm.append(d if d > u and d > 0 else 0)
        di, dx, adx, sm = [], [], [0.0] * n, {}
        for name, x in (("t", tr), ("p", pm), ("m", mm)):
            out = []
            for i in range(n):
                out.append(None if i < p - 1 else sum(x[:p]) if i == p - 1 else out[-1] * (1 - 1 / p) + x[i])
            sm[name] = out
        for i in range(n):
            a, b = (100 * sm["p"][i] / sm["t"][i], 100 * sm["m"][i] / sm["t"][i]) if i >= p - 1 and sm["t"][i] else (0.0, 0.0)
            di.append(a)
            dx.append(100 * abs(a - b) / (a + b) if a + b else 0.0)
        if n >= p:
            e = min(2 * p - 2, n - 1)
            adx[e] = statistics.mean(dx[p - 1 : e + 1])
            for i in range(e + 1, n):
                adx[i] = (adx[i - 1] * (p - 1) + dx[i]) / p
        for i in range(n):
            assert plus[k][i] == pytest.approx(di[i], abs=1e-7)
            assert got[k][i] == pytest.approx(adx[i], abs=1e-7)


def test_no_look_ahead(frame):
    changed = frame.withColumn("close", F.when(F.col("i") >= 30, F.col("close") * 2).otherwise(F.col("close")))
    a, b = (by_key(s.moving_averages(f, "k", "close"), "ema_20")[60] for f in (frame, changed))
    assert all(a[i] == b[i] for i in range(30))
    assert a[40] != b[40]


def test_ordered_index_is_the_plain_row_number(spark):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2]), dt.date(2022, 1, 1) + dt.timedelta(days=r.randrange(400)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, d date, id int")
    got = {x["id"]: x["i"] for x in ordered_index(df, ["k"], ["d", "id"], month_of("d")).collect()}
    for k in (1, 2):
        for n, (_, _, i) in enumerate(sorted((x for x in rows if x[0] == k), key=lambda x: (x[1], x[2]))):
            assert got[i] == n
