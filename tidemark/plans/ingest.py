"""Normalised and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.tables import absent, latest_by, upsert
from tidemark.operators.trailing import clean_double
from tidemark.plans.backtest import ORACLE_DAY, entry_day
from tidemark.plans.shared import bars
from tidemark.sources import normalise as nz
from tidemark.tables import table

K = "ticker_id"
LOADED_UNTIL = "2024-07-01 00:00:00"


def p01_range_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of the first half of 2024 of the listings on the exchange US."""
    t = table(spark, folder, "tickers").where("exchange = 'US'").select(K)
    b = nz.in_range(table(spark, folder, "market_data"), "date", "2024-01-01", "2024-06-30")
    return b.join(t, K, "left_semi").select("market_data_id", K, "date")


def p02_p03_eod_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Bars as typed rows of a base symbol, an interval, and the day of delivery; NaN is NULL."""
    m = table(spark, folder, "market_data").join(table(spark, folder, "tickers").select(K, "symbol"), K)
    return m.select("market_data_id", nz.base_symbol("symbol").alias("symbol"), F.lit("1d").alias("interval"), nz.safe_double("close").alias("close"), nz.safe_long("volume").alias("volume"), F.to_date("created_at").alias("delivered"))


def p04_indicator_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The stored indicators of each bar as rows (name, value); NULL ones are left out."""
    names = ["sma_20", "sma_50", "ema_20", "rsi_14", "macd", "macd_signal"]
    m = table(spark, folder, "market_data").select("market_data_id", F.create_map(*[x for n in names for x in (F.lit(n), clean_double(n))]).alias("m"))
    return nz.explode_map(m, "m", "indicator", "value", "market_data_id").where("value is not null")


def p07_p12_news_labels(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "news").select("news_id", clean_double("sentiment_score").alias("s"), "sentiment_label")
    return n.select("news_id", nz.sentiment_label(F.col("s"), F.col("sentiment_label")).alias("label"), nz.sentiment_label(F.col("s")).alias("label_by_score"))


def p08_insider_rows(spark: SparkSession, folder: str) -> DataFrame:
    i = table(spark, folder, "insider_transactions")
    price = clean_double("transaction_price")
    return i.select("transaction_id", nz.transaction_kind(F.col("transaction_code")).alias("kind"), "shares", F.when(price > 0, price).alias("price"), F.datediff("filing_date", "transaction_date").alias("days_to_filing"))


def p09_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """The rating most firms gave a ticker in a month; of equals the more positive."""
    a = table(spark, folder, "analyst_recommendations").where("ticker_id is not null and date is not null").withColumn("r", F.lower(F.trim("rating")))
    kinds = ("strong buy", "buy", "hold", "sell", "strong sell")
    counts = [F.count_if(F.col("r") == k).alias(k.replace(" ", "_")) for k in kinds]
    g = a.groupBy(K, F.date_format("date", "yyyy-MM").alias("month")).agg(*counts)
    cols = [(k, F.col(k.replace(" ", "_"))) for k in kinds]
    total = sum((c for _, c in cols), F.lit(0))
    g = g.withColumn("total", total).where("total > 0").withColumn("consensus", nz.consensus(cols))
    return g.select(K, "month", "total", "consensus", F.format_string("%s of %d ratings", F.initcap("consensus"), F.col("total")).alias("summary"))


def p13_dynamic_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Results by optional conditions: here a start and strategies, but no end."""
    r = table(spark, folder, "baseline_results").withColumn("d", F.to_date("entry_date"))
    return nz.in_range(r, "d", start="2024-01-01", key="strategy", keys=["A", "C"]).select("result_id", "strategy", "entry_date")


def _load(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A table's rows delivered until a moment, and those after it."""
    t = table(spark, folder, name)
    old = F.col("created_at") < F.lit(LOADED_UNTIL).cast("timestamp_ntz")
    return t.where(~old), t.where(old)


def s16_absent_bars(spark: SparkSession, folder: str) -> DataFrame:
    new, old = _load(spark, folder, "market_data")
    return absent(new.select("market_data_id", K, "date"), old, [K, "date"], ["market_data_id"])


def s18_absent_news(spark: SparkSession, folder: str) -> DataFrame:
    """New articles whose url isn't loaded, nor their ticker, headline and time."""
    new, old = _load(spark, folder, "news")
    return absent_articles(new.select("news_id", K, "url", "headline", "published_at"), old).select("news_id", K)


def absent_articles(new: DataFrame, old: DataFrame) -> DataFrame:
    """The articles of `new` that aren't in `old`: by url, those without one (NULL or empty) only by ticker, headline and time."""
    known = F.coalesce(F.col("url"), F.lit("")) != ""
    by_url = absent(new.where(known), old.where(known), ["url"], ["news_id"])
    return absent(by_url.unionByName(new.where(~known)), old, [K, "headline", "published_at"], ["news_id"])


def s19_absent_filings(spark: SparkSession, folder: str) -> DataFrame:
    new, old = _load(spark, folder, "fundamentals")
    return absent(new.select("fundamental_id", K, "report_date", "filing_date"), old, [K, "report_date", "filing_date"], ["fundamental_id"]).withColumn("filing_date", F.col("filing_date").cast("string"))


def s20_absent_trades(spark: SparkSession, folder: str) -> DataFrame:
    """New trades with owner, code and date, by five columns of which shares may be NULL."""
    new, old = _load(spark, folder, "insider_transactions")
    keys = [K, "transaction_date", "owner_name", "transaction_code", "shares"]
    return absent(new.dropna(subset=["owner_name", "transaction_code", "transaction_date"]).select("transaction_id", *keys), old, keys, ["transaction_id"]).select("transaction_id", K)


def s21_absent_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """New ratings by their id, without one by ticker, day and firm."""
    new, old = _load(spark, folder, "analyst_recommendations")
    key = F.coalesce(F.col("analyst_insight_id"), F.concat_ws("|", F.col(K).cast("string"), F.col("date").cast("string"), F.coalesce("firm_id", F.lit(""))))
    return absent(new.withColumn("k", key).select("recommendation_id", "k"), old.withColumn("k", key), ["k"], ["recommendation_id"]).select("recommendation_id")


def s22_upsert_tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Listings with a sector for those without: the update wins only where it has a value."""
    t = table(spark, folder, "tickers").select(K, "symbol", "sector")
    update = t.where("sector is null").select(K, F.lit("").alias("symbol"), F.lit("Unclassified").alias("sector"))
    return upsert(t, update, [K], ["symbol", "sector"])


def s24_upsert_results(spark: SparkSession, folder: str) -> DataFrame:
    """The result stored last for each strategy, ticker and day."""
    r = table(spark, folder, "baseline_results").select("result_id", "strategy", "ticker", "entry_date", "created_at")
    return latest_by(r, ["strategy", "ticker", "entry_date"], ["created_at", "result_id"]).select("result_id", "strategy", "ticker", "entry_date")


def s25_upsert_features(spark: SparkSession, folder: str) -> DataFrame:
    """Stored averages brought up to date: the computed value wins, stored bars stay."""
    stored = latest_by(table(spark, folder, "market_data").where("ticker_id is not null").select(K, "date", "created_at", "market_data_id", "sma_20"), [K, "date"], ["created_at", "market_data_id"])
    fresh = bars(spark, folder).select(K, "date", (F.round(F.col("high") + F.col("low") + F.col("close"), 4) / 3).alias("typical"))
    return stored.join(fresh, [K, "date"], "left").select(K, "date", F.round("sma_20", 4).alias("sma_20"), "typical")


def p14_valid_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each example could open a position: a known ticker, a day, a price above 0 and an action, each and all."""
    e = table(spark, folder, "rlvr_examples")
    answer = F.get(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0))["content"]
    e = e.select("example_id", F.col("metadata.ticker").alias("symbol"), entry_day("metadata.entry_date").isNotNull().alias("day_ok"), F.coalesce(F.col("ground_truth.entry_price") > 0, F.lit(False)).alias("price_ok"), (F.coalesce(F.trim(F.get_json_object(answer, "$.action")), F.lit("")) != "").alias("action_ok"))
    e = e.join(table(spark, folder, "tickers").select("symbol", K), "symbol", "left").withColumn("ticker_ok", F.coalesce(F.col(K) > 0, F.lit(False)))
    return e.select("example_id", "ticker_ok", "day_ok", "price_ok", "action_ok", F.expr("ticker_ok and day_ok and price_ok and action_ok").alias("valid"))


def s17_absent_macro(spark: SparkSession, folder: str) -> DataFrame:
    """New observations of a series whose day isn't loaded, the first delivered of each: the orders table as macroeconomic records."""
    o = table(spark, folder, "orders").select(F.substring("o_orderpriority", 1, 1).alias("series_id"), F.to_date("o_orderdate").alias("date"), "o_orderkey", F.col("o_totalprice").alias("value"))
    old = o.where("o_orderkey % 4 <> 0")
    return absent(o.where("o_orderkey % 4 = 0"), old, ["series_id", "date"], ["o_orderkey"])


QUERIES = {f"ingest_{f.__name__}" if f.__name__.startswith("p") else f.__name__: f for f in (
    p01_range_filter, p02_p03_eod_rows, p04_indicator_rows, p07_p12_news_labels, p08_insider_rows, p09_consensus, p13_dynamic_filter, p14_valid_positions, s16_absent_bars, s17_absent_macro, s18_absent_news, s19_absent_filings, s20_absent_trades,
    s21_absent_ratings, s22_upsert_tickers, s24_upsert_results, s25_upsert_features,
)}

_OLD = f"created_at < TIMESTAMP '{LOADED_UNTIL}'"
_BY_SCORE = "CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative' WHEN sentiment_score IS NOT NULL THEN 'neutral' END"
_KEY = "coalesce(analyst_insight_id, concat_ws('|', CAST(ticker_id AS VARCHAR), CAST(date AS VARCHAR), coalesce(firm_id, '')))"


def _absent_sql(name: str, ident: str, keys: list[str], out: str, more: str = "true") -> str:
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    return f"SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ident}) AS rn FROM {name} WHERE NOT {_OLD} AND {more}) n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {name} o WHERE o.{_OLD} AND {same})"


_TRADE = [K, "transaction_date", "owner_name", "transaction_code", "shares"]
ORACLES = {
    "ingest_p01_range_filter": "SELECT market_data_id, ticker_id, date FROM market_data WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-06-30' AND ticker_id IN (SELECT ticker_id FROM tickers WHERE exchange = 'US')",
    "ingest_p02_p03_eod_rows": "SELECT market_data_id, upper(split_part(trim(symbol), '.', 1)) AS symbol, '1d' AS interval, CASE WHEN NOT isnan(close) THEN close END AS close, volume, CAST(m.created_at AS DATE) AS delivered FROM market_data m JOIN tickers t USING (ticker_id)",
    "ingest_p04_indicator_rows": " UNION ALL ".join(f"SELECT market_data_id, '{n}' AS indicator, {n} AS value FROM market_data WHERE {n} IS NOT NULL AND NOT isnan({n})" for n in ("sma_20", "sma_50", "ema_20", "rsi_14", "macd", "macd_signal")),
    "ingest_p07_p12_news_labels": f"""SELECT news_id, CASE WHEN starts_with(lower(trim(sentiment_label)), 'pos') THEN 'positive' WHEN starts_with(lower(trim(sentiment_label)), 'neg') THEN 'negative'
  WHEN starts_with(lower(trim(sentiment_label)), 'neu') THEN 'neutral' ELSE {_BY_SCORE} END AS label, {_BY_SCORE} AS label_by_score FROM news""",
    "ingest_p08_insider_rows": """SELECT transaction_id, CASE WHEN starts_with(upper(trim(transaction_code)), 'SALE') THEN 'S' WHEN starts_with(upper(trim(transaction_code)), 'PURCH') OR starts_with(upper(trim(transaction_code)), 'BUY') THEN 'P'
  ELSE nullif(substr(upper(trim(transaction_code)), 1, 1), '') END AS kind, shares, CASE WHEN transaction_price > 0 THEN transaction_price END AS price, CAST(date_diff('day', transaction_date, filing_date) AS INTEGER) AS days_to_filing FROM insider_transactions""",
    "ingest_p09_consensus": """WITH a AS (SELECT ticker_id, strftime(date, '%Y-%m') AS month, lower(trim(rating)) AS r FROM analyst_recommendations WHERE ticker_id IS NOT NULL AND date IS NOT NULL),
c AS (SELECT ticker_id, month, r, count(*) AS n, CASE r WHEN 'strong buy' THEN 1 WHEN 'buy' THEN 2 WHEN 'hold' THEN 3 WHEN 'sell' THEN 4 ELSE 5 END AS o FROM a WHERE r IN ('strong buy', 'buy', 'hold', 'sell', 'strong sell') GROUP BY 1, 2, 3),
g AS (SELECT ticker_id, month, CAST(sum(n) AS BIGINT) AS total, arg_max(r, (n, -o)) AS consensus FROM c GROUP BY 1, 2)
SELECT *, CASE consensus WHEN 'strong buy' THEN 'Strong Buy' WHEN 'strong sell' THEN 'Strong Sell' ELSE upper(consensus[1]) || consensus[2:] END || ' of ' || total || ' ratings' AS summary FROM g""",
    "ingest_p13_dynamic_filter": "SELECT result_id, strategy, entry_date FROM baseline_results WHERE TRY_CAST(entry_date AS DATE) >= DATE '2024-01-01' AND strategy IN ('A', 'C')",
    "s16_absent_bars": _absent_sql("market_data", "market_data_id", [K, "date"], "market_data_id, ticker_id, date"),
    "s18_absent_news": f"""WITH u AS ({_absent_sql("news", "news_id", ["url"], "news_id, ticker_id, headline, published_at", "coalesce(url, '') <> ''")}
UNION ALL SELECT news_id, ticker_id, headline, published_at FROM news WHERE NOT {_OLD} AND coalesce(url, '') = ''), v AS (SELECT *, row_number() OVER (PARTITION BY ticker_id, headline, published_at ORDER BY news_id) AS rn FROM u)
SELECT news_id, ticker_id FROM v WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM news o WHERE o.{_OLD} AND o.ticker_id IS NOT DISTINCT FROM v.ticker_id AND o.headline IS NOT DISTINCT FROM v.headline AND o.published_at IS NOT DISTINCT FROM v.published_at)""",
    "s17_absent_macro": """WITH o AS (SELECT substr(o_orderpriority, 1, 1) AS series_id, CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice AS value FROM orders)
SELECT series_id, date, o_orderkey, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, date ORDER BY o_orderkey) AS rn FROM o WHERE o_orderkey % 4 = 0) n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey % 4 <> 0 AND o.series_id = n.series_id AND o.date = n.date)""",
    "ingest_p14_valid_positions": f"""WITH e AS (SELECT example_id, metadata.ticker AS symbol, {ORACLE_DAY.format(c="metadata.entry_date")} IS NOT NULL AS day_ok, coalesce(ground_truth.entry_price > 0, false) AS price_ok, list_filter(messages, lambda m: m.role = 'assistant')[1].content AS a FROM rlvr_examples),
x AS (SELECT e.*, coalesce(trim(CASE WHEN json_valid(a) THEN a ->> '$.action' END), '') <> '' AS action_ok, coalesce(ticker_id > 0, false) AS ticker_ok FROM e LEFT JOIN tickers USING (symbol))
SELECT example_id, ticker_ok, day_ok, price_ok, action_ok, ticker_ok AND day_ok AND price_ok AND action_ok AS valid FROM x""",
    "s19_absent_filings": _absent_sql("fundamentals", "fundamental_id", [K, "report_date", "filing_date"], "fundamental_id, ticker_id, report_date, CAST(filing_date AS VARCHAR) AS filing_date"),
    "s20_absent_trades": _absent_sql("insider_transactions", "transaction_id", _TRADE, "transaction_id, ticker_id", "owner_name IS NOT NULL AND transaction_code IS NOT NULL AND transaction_date IS NOT NULL"),
    "s21_absent_ratings": f"WITH k AS (SELECT *, {_KEY} AS k FROM analyst_recommendations) SELECT recommendation_id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY recommendation_id) AS rn FROM k WHERE NOT {_OLD}) n WHERE rn = 1 AND k NOT IN (SELECT k FROM k WHERE {_OLD})",
    "s22_upsert_tickers": "SELECT ticker_id, symbol, coalesce(sector, 'Unclassified') AS sector FROM tickers",
    "s24_upsert_results": "SELECT result_id, strategy, ticker, entry_date FROM (SELECT *, row_number() OVER (PARTITION BY strategy, ticker, entry_date ORDER BY created_at DESC, result_id DESC) AS rn FROM baseline_results) WHERE rn = 1",
    "s25_upsert_features": """SELECT ticker_id, date, round(x.s, 4) AS sma_20, CASE WHEN x.o IS NOT NULL AND x.h IS NOT NULL AND x.l IS NOT NULL AND x.c IS NOT NULL THEN round(x.h + x.l + x.c, 4) / 3 END AS typical
FROM (SELECT ticker_id, date, arg_max(struct_pack(s := sma_20, o := open, h := high, l := low, c := close), (created_at, market_data_id)) AS x FROM market_data WHERE ticker_id IS NOT NULL GROUP BY 1, 2)""",
}
