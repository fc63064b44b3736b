"""Readers, writers, normalisers, set-based writes, scoring rules and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scoring as sc
from tidemark.operators.tables import absent, cascade_counts, delete_cascade, delete_old, latest_by, merge_rows, replace_table, upsert
from tidemark.sources import normalise as nz
from tidemark.sources import records
from tidemark.sources.files import read_jsonl, write_jsonl, write_partitioned, write_report
from tidemark.sources.paged import PagedSource
from tidemark.streaming.streams import first_seen, weekly_bars


def fetch_page(page: int, size: int) -> list[dict]:
    return [{"id": i, "v": f"r{i}"} for i in range(page * size, min((page + 1) * size, 23))]


def test_jsonl_round_trip_and_bad_lines(spark, tmp_path):
    lines = [{"messages": [{"role": "user", "content": "ü?"}], "metadata": {"ticker": "A"}}]
    (tmp_path / "x.jsonl").write_text("\n".join([json.dumps(lines[0]), "", "{broken"]))
    assert read_jsonl(spark, str(tmp_path / "x.jsonl"), strict=False).where("messages is not null").count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        read_jsonl(spark, str(tmp_path / "x.jsonl")).collect()
    write_jsonl(read_jsonl(spark, str(tmp_path / "x.jsonl"), strict=False).where("messages is not null"), str(tmp_path / "out"))
    back = read_jsonl(spark, str(tmp_path / "out")).first()
    assert back["messages"][0]["content"] == "ü?"
    assert "ü" in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))


def test_partitioned_and_report_sinks(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2023, 5, 1), 1.5), (dt.date(2024, 5, 1), 2.5)], "d date, v double")
    write_partitioned(df, str(tmp_path / "p"), "d")
    write_partitioned(df.where("v > 2").withColumn("v", F.lit(9.0)), str(tmp_path / "p"), "d")
    assert {(r["year"], r["v"]) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(2023, 1.5), (2024, 9.0)}
    write_report(df.orderBy("d"), str(tmp_path / "r"), "%s: %+.2f", "d", "v")
    assert spark.read.text(str(tmp_path / "r")).first()["value"] == "2023-05-01: +1.50"


def test_paged_source(spark, tmp_path, monkeypatch):
    (tmp_path / "feed.py").write_text("def fetch_page(page, size):\n    return [{'id': i, 'v': f'r{i}'} for i in range(page * size, min((page + 1) * size, 23))]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "feed.py"))
    spark.dataSource.register(PagedSource)
    out = spark.read.format("paged").schema("id long, v string, missing int").option("fetch", "feed:fetch_page").option("pagesize", 5).option("maxpages", 20).load().collect()
    assert sorted(r["id"] for r in out) == list(range(23))
    assert out[0]["missing"] is None


def test_fundamentals_from_nested_maps(spark):
    m = "map<string,map<string,string>>"
    raw = spark.createDataFrame(
        [("abc.us", "150000000000", {"2024-03-31": {"filing_date": "2024-05-01", "totalAssets": "10.9", "cash": "7", "cashAndCashEquivalents": "0", "shortLongTermDebtTotal": "0", "netDebt": "99", "totalDebt": "12", "longTermDebt": "8", "totalLiab": "3", "totalStockholderEquity": "x"}}, {"2024-03-31": {"totalRevenue": "junk"}, "2023-12-31": {"filing_date": "", "netIncome": "5"}}, {"2023-12-31": {"filing_date": "2024-02-01", "freeCashFlow": "-4.7", "totalCashFromOperatingActivities": "6"}}, {"PERatio": "12.5", "EarningsShare": "n/a"})],
        f"symbol string, market_cap string, balance {m}, income {m}, cash {m}, highlights map<string,string>",
    )
    out = {str(r["report_date"]): r for r in nz.fundamentals(raw, "2024-01-01", "2024-12-31").collect()}
    assert set(out) == {"2024-03-31", "2023-12-31"}
    q = out["2024-03-31"]
    assert (q["symbol"], q["market_cap"], q["cash_and_equivalents"], q["total_assets"], q["revenue"]) == ("ABC", 150000000000, 7, 10, None)
    assert (q["total_debt"], q["total_liabilities"], q["stockholder_equity"], q["pe_ratio"], q["eps"], q["cash_json"]) == (12, 3, None, 12.5, None, None)
    assert (out["2023-12-31"]["free_cash_flow"], out["2023-12-31"]["operating_cash_flow"], out["2023-12-31"]["net_income"]) == (-4, 6, 5)
    assert nz.fundamentals(raw, "2024-04-01", "2024-12-31").count() == 1
    assert nz.fundamentals(raw.drop("highlights"), "2024-04-01", "2024-12-31").first()["pe_ratio"] is None


def test_intraday_rows(spark):
    raw = spark.createDataFrame([("2024-03-01 09:30:00", "1.5", "2", "1", "x", "10.7"), ("soon", "1", "1", "1", "1", "1"), (None, None, None, None, None, None)], "datetime string, open string, high string, low string, close string, volume string")
    out = nz.intraday_rows(raw, "abc.US", "5m", "2024-03-01", "2024-03-01").collect()
    assert [(r["symbol"], str(r["date"]), str(r["timestamp"]), r["interval"], r["open"], r["close"], r["volume"]) for r in out] == [("ABC", "2024-03-01", "2024-03-01 09:30:00", "5m", 1.5, None, 10)]
    assert nz.intraday_rows(raw, "abc", "1h").count() == 3


def test_articles_without_url_go_by_headline_and_time(spark):
    from datetime import datetime

    from tidemark.plans.ingest import absent_articles

    at = datetime(2024, 1, 1)
    schema = "news_id long, ticker_id int, url string, headline string, published_at timestamp_ntz"
    old = spark.createDataFrame([(1, 7, None, "stored", at), (2, 7, "u1", "other", at)], schema)
    new = spark.createDataFrame([(3, 7, None, "stored", at), (4, 7, None, "first", at), (5, 7, None, "second", at), (6, 7, "", "second", at), (7, 7, "u1", "third", at), (8, 7, "u2", "fourth", at), (9, 7, "u2", "fifth", at), (10, 8, None, "stored", at)], schema)
    assert {r["news_id"] for r in absent_articles(new, old).collect()} == {4, 5, 8, 10}


def test_normalisers(spark):
    df = spark.createDataFrame([("12.9", 0.5, "pos"), ("-3.7", 0.1, None), ("x", None, None), (None, -0.2, " NEUTRAL ")], "s string, score double, label string")
    rows = df.select(nz.safe_long("s").alias("l"), nz.sentiment_label(F.col("score"), F.col("label")).alias("t")).collect()
    assert [(r["l"], r["t"]) for r in rows] == [(12, "positive"), (-3, "neutral"), (None, None), (None, "neutral")]
    obs = nz.observations(spark.createDataFrame([("A", "2024-01-01", "."), ("A", "2024-01-02", "1.5"), ("B", "2024-01-02", "bad")], "series_id string, date string, value string"), spark.createDataFrame([("A", "Title")], "series_id string, title string"))
    assert {(r["title"], r["value"]) for r in obs.collect()} == {("Title", 1.5), ("B", None)}
    c = spark.createDataFrame([(2, 2, 1), (0, 0, 0)], "a int, b int, c int").select(nz.consensus([("A", F.col("a")), ("B", F.col("b")), ("C", F.col("c"))]).alias("x"))
    assert [r["x"] for r in c.collect()] == ["A", None]


def test_set_based_writes(spark):
    old = spark.createDataFrame([(1, None), (2, "b")], "k int, s string")
    new = spark.createDataFrame([(1, None, 7), (2, "c", 8), (2, "c", 6), (None, "b", 9)], "k int, s string, i int")
    assert {(r["k"], r["s"], r["i"]) for r in absent(new, old, ["k", "s"], ["i"]).collect()} == {(2, "c", 6), (None, "b", 9)}
    assert {r["i"] for r in latest_by(new, ["k"], ["i"]).collect()} == {7, 8, 9}
    up = upsert(old, spark.createDataFrame([(1, "x"), (2, ""), (5, "n")], "k int, s string"), ["k"], ["s"])
    assert {(r["k"], r["s"]) for r in up.collect()} == {(1, "x"), (2, "b"), (5, "n")}
    gone = cascade_counts(old.where("k = 1"), "k", {"child": new.select("k")}).first()
    assert (gone["deleted"], gone["kept"]) == (1, 3)
    assert absent(new.where("false"), old, ["k", "s"], ["i"]).count() == 0


def test_writes_are_read_back(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, active boolean").write.parquet(at("p"))
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (2, None), (None, "2020-01-01")], "k int, day string").write.parquet(at("c"))
    got = {r["child"]: (r["deleted"], r["kept"]) for r in delete_cascade(spark, at("p"), {"c": at("c")}, "k", ~F.col("active")).collect()}
    assert got == {"c": (2, 2)}
    assert {r["k"] for r in spark.read.parquet(at("p")).collect()} == {1, 3}
    assert {(r["k"], r["day"]) for r in spark.read.parquet(at("c")).collect()} == {(1, "2024-01-01"), (None, "2020-01-01")}
    assert delete_old(spark, {"c": (at("c"), F.col("day") < "2021")}).first().asDict() == {"name": "c", "deleted": 1, "kept": 1}
    assert [r["k"] for r in spark.read.parquet(at("c")).collect()] == [1]
    stored = spark.createDataFrame([(1, "a", 5), (2, "b", 9)], "k int, v string, at int")
    replace_table(stored, at("u"))
    incoming = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "k int, v string, at int")
    replace_table(merge_rows(spark.read.parquet(at("u")), incoming, ["k"], ["at"]), at("u"))
    assert {(r["k"], r["v"]) for r in spark.read.parquet(at("u")).collect()} == {(1, "a"), (2, "d"), (3, None)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["c", "p", "u"]


def test_records_from_json(spark):
    lines = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    bars = records.bars_of(lines('{"date": "2024-01-02", "open": 1, "high": "2", "close": "x", "volume": 7.9}', '{"date": "soon"}', "junk", '{"date": "2025-01-02"}'), "abc.US", "2024-01-01", "2024-12-31").collect()
    assert [(r["symbol"], str(r["date"]), r["open"], r["high"], r["close"], r["volume"]) for r in bars] == [("ABC", "2024-01-02", 1.0, 2.0, None, 7)]
    ind = records.indicators_of(lines('{"date": "2024-01-02", "sma": 1.5, "ema": null, "rsi": "n/a"}', '{"sma": 2}'), "abc").collect()
    assert [(r["indicator"], r["value"]) for r in ind] == [("sma", 1.5)]
    nested = '{"Highlights": {"MarketCapitalization": "150000000000", "PERatio": "28.5"}, "Financials": {"Balance_Sheet": {"quarterly": {"2024-03-31": {"filing_date": "2024-05-01", "cash": "40000000000"}}}, "Income_Statement": {"quarterly": {"2024-03-31": {"totalRevenue": "9"}}}}}'
    filings = records.filings_of(spark.createDataFrame([("abc", nested), ("bad", "{")], "symbol string, value string"), "2024-01-01", "2024-12-31").collect()
    assert [(r["symbol"], r["market_cap"], r["pe_ratio"], r["cash_and_equivalents"], r["revenue"]) for r in filings] == [("ABC", 150000000000, 28.5, 40000000000, 9)]
    trades = records.insider_trades_of(lines('{"code": "ABC", "date": "2024-01-02", "transactionCode": "sale", "transactionAmount": "12"}', '{"code": "XYZ"}', "{}"), "ABC").collect()
    assert [(r["code"], r["kind"], r["shares"], r["price"]) for r in trades] == [("ABC", "S", 12, None)]
    macro = records.macro_of(lines('{"CountryCode": "USA", "Indicator": "gdp", "Date": "2024-01-01", "Value": 3}', '{"CountryCode": "USA", "Indicator": "cpi", "Date": "2024-01-01", "Value": 3}', '{"CountryCode": "USA", "Indicator": "gdp", "Date": "2024-04-01"}'), "USA", "gdp").collect()
    assert [(r["series_id"], r["value"]) for r in macro] == [("USA.gdp", 3.0)]
    assert records.bars_of(lines("x").where("false"), "a").count() == 0


def test_scoring_rules(spark):
    df = spark.createDataFrame([("BUY", 2.0), ("strong buy", 2.9), ("Sell ", -2.0), ("hold", 2.5), ("chhold", 0.0)], "a string, x double")
    df = df.withColumn("c", sc.clean_action("a"))
    rows = df.select("c", sc.directional(F.col("c"), F.col("x")).alias("r"), sc.directional(F.col("c"), F.col("x"), "sql").alias("q"), sc.magnitude(F.col("c"), F.col("x")).alias("m")).collect()
    assert [(r["c"], r["r"], r["q"]) for r in rows] == [("buy", True, True), ("strong_buy", False, True), ("sell", True, True), ("hold", False, False), (None, False, False)]
    assert rows[0]["m"] == pytest.approx(2.718281828 ** (-0.1))
    js = spark.createDataFrame([('{"action": "buy"}',), ('text ```json\n{"action": "sell"}\n``` more',), ("so {\"action\": \"hold\"} it is",), ("# markdown only",), (None,)], "t string")
    assert [r["a"] for r in js.select(F.get_json_object(sc.lenient_json(F.col("t")), "$.action").alias("a")).collect()] == ["buy", "sell", "hold", None, None]
    sh = spark.createDataFrame([(1.0, 0.0, 5), (1.0, 2.0, 1), (1.0, 2.0, 5)], "m double, d double, n int").select(sc.sharpe(F.col("m"), F.col("d"), F.col("n")).alias("s"))
    assert [r["s"] for r in sh.collect()] == [0.0, 0.0, 0.5]


def test_streams(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(1, t, "a"), (2, t + dt.timedelta(days=1), "a"), (3, t + dt.timedelta(days=2), "b")]
    spark.createDataFrame(rows, "id int, at timestamp, h string").write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("id int, at timestamp, h string").parquet(str(tmp_path / "in"))
    q = first_seen(src, "at", ["h"]).writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["h"] for r in spark.sql("select h from seen").collect()) == ["a", "b"]
    bars = [("X", t + dt.timedelta(days=i), float(i), float(i) + 1, float(i) - 1, float(i) + 0.5, 10) for i in range(30)]
    spark.createDataFrame(bars, "k string, at timestamp, open double, high double, low double, close double, volume long").write.parquet(str(tmp_path / "b"))
    src = spark.readStream.schema("k string, at timestamp, open double, high double, low double, close double, volume long").parquet(str(tmp_path / "b"))
    q = weekly_bars(src, "k", "at", "1 day").writeStream.format("memory").queryName("weeks").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    first = spark.sql("select * from weeks order by week").first()
    assert (str(first["week"]), first["open"], first["close"], first["volume"]) == ("2024-01-01", 0.0, 6.5, 70)


def test_views_and_progress(spark, tmp_path):
    from tidemark.sources.views import read_view, record_progress, refresh, remaining

    path = str(tmp_path / "view")
    with pytest.raises(FileNotFoundError):
        read_view(spark, path)
    assert refresh(spark.range(3), path) == 1
    (tmp_path / "view" / "v2").mkdir()  # a refresh that died
    assert read_view(spark, path).count() == 3
    assert refresh(spark.range(5), path) == 2
    assert read_view(spark, path).count() == 5
    d = lambda n: dt.date(2024, 1, n)
    record_progress(spark.createDataFrame([("a", d(1)), ("a", d(2))], "key string, day date"), str(tmp_path / "p"))
    left = remaining(spark.createDataFrame([("a", d(2)), ("a", d(3)), ("b", d(1))], "key string, day date"), str(tmp_path / "p"))
    assert {(r["key"], r["day"]) for r in left.collect()} == {("a", d(3)), ("b", d(1))}
