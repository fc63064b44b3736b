"""What several plans read: bars, articles and filings, each as last delivered; and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.series import indexed
from tidemark.operators.trailing import clean_double, latest_delivery
from tidemark.tables import table

PRICES = ["open", "high", "low", "close"]


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar a ticker and date, as last delivered, with all four prices."""
    raw = table(spark, folder, "market_data").where("ticker_id is not null and date is not null")
    out = latest_delivery(raw, ["ticker_id", "date"], ["created_at", "market_data_id"], [*PRICES, "volume"])
    return out.withColumns({p: clean_double(p) for p in PRICES}).dropna(subset=PRICES)


def series(spark: SparkSession, folder: str) -> DataFrame:
    return indexed(bars(spark, folder), "ticker_id", "date")


def articles(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row an article (url) with a ticker, as last delivered: ticker_id, published_at and what else is asked for.

    Only these are shuffled; an aggregate's struct isn't pruned later.
    """
    raw = table(spark, folder, "news").where("ticker_id is not null").withColumn("url", F.coalesce("url", F.col("news_id").cast("string")))
    return latest_delivery(raw, ["url"], ["created_at", "news_id"], ["ticker_id", "published_at", *columns]).drop("url")


BARS = """bars AS (
  SELECT ticker_id, date, x.open AS open, x.high AS high, x.low AS low, x.close AS close, x.volume AS volume
  FROM (SELECT ticker_id, date, arg_max(struct_pack(open := open, high := high, low := low, close := close, volume := volume), (created_at, market_data_id)) AS x
        FROM market_data WHERE ticker_id IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2)
  WHERE x.open IS NOT NULL AND x.high IS NOT NULL AND x.low IS NOT NULL AND x.close IS NOT NULL)"""
SERIES = BARS + ", s AS (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY ticker_id) AS n FROM bars)"
ARTICLES = """articles AS (
  SELECT x.* FROM (SELECT arg_max(struct_pack(ticker_id := ticker_id, published_at := published_at, headline := headline, source := source, sentiment_score := sentiment_score, news_id := news_id, url := url),
                                  (created_at, news_id)) AS x FROM news WHERE ticker_id IS NOT NULL GROUP BY coalesce(url, CAST(news_id AS VARCHAR))))"""
