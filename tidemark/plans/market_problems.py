"""The general training-data problems on the project's tables: p1, p3 and p5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asknown import as_known
from tidemark.operators.nearest import SECOND, micros, nearest_in_time
from tidemark.operators.trailing import clean_double, daily_measure, epoch_day, latest_delivery, trailing_windows
from tidemark.tables import table

WINDOWS = (7, 30)
BAR_HOUR = 16


def _spans(bars: DataFrame) -> DataFrame:
    d = epoch_day("date")
    return bars.where("ticker_id is not null and date is not null").groupBy(F.col("ticker_id").alias("__e")).agg(F.min(d).alias("__first"), F.max(d).alias("__last"))


def p1_trailing(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing totals and averages of close, volume and sentiment for each ticker and calendar day.

    A re-delivered bar (ticker_id, date) or article (url; without one news_id)
    counts once, as last delivered.
    """
    bars = table(spark, folder, "market_data").select("market_data_id", "ticker_id", "date", "close", "volume", "created_at")
    bars = latest_delivery(bars, ["ticker_id", "date"], ["created_at", "market_data_id"], ["close", "volume"])
    news = table(spark, folder, "news").select("news_id", "ticker_id", "published_at", "url", "sentiment_score", "created_at").where("ticker_id is not null")
    news = news.withColumn("article", F.coalesce("url", F.col("news_id").cast("string")))
    news = latest_delivery(news, ["article"], ["created_at", "news_id"], ["ticker_id", "published_at", "sentiment_score"])
    none = lambda *names: {f"{n}__{k}": F.lit(None).cast("double") for n in names for k in "sc"}
    daily = daily_measure(bars, "ticker_id", epoch_day("date"), {"close": clean_double("close"), "volume": F.col("volume")}).withColumns(none("sentiment")).unionByName(
        daily_measure(news, "ticker_id", epoch_day("published_at"), {"sentiment": clean_double("sentiment_score")}).withColumns(none("close", "volume"))
    )
    out = trailing_windows(daily, _spans(table(spark, folder, "market_data").select("ticker_id", "date")), ["close", "volume", "sentiment"], WINDOWS, decimals=4)
    return out.withColumn("on_date", F.date_add(F.expr("DATE'1970-01-01'"), F.col("__d"))).withColumnRenamed("__e", "ticker_id").drop("__d")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Ticker days whose last 7 days hold no scored article while the last 30 do."""
    news = table(spark, folder, "news").select("ticker_id", "published_at", "sentiment_score")
    daily = daily_measure(news, "ticker_id", epoch_day("published_at"), {"sentiment": clean_double("sentiment_score")})
    out = trailing_windows(daily, _spans(table(spark, folder, "market_data").select("ticker_id", "date")), ["sentiment"], WINDOWS)
    quiet = out.where("sentiment_n_7 = 0 and sentiment_n_30 > 0")
    return quiet.select(F.col("__e").cast("int").alias("ticker_id"), F.date_format(F.date_add(F.expr("DATE'1970-01-01'"), F.col("__d")), "yyyy-MM-dd").alias("on_date"))


FIGURES = ["fundamental_id", "report_date", "filing_date", "eps", "revenue", "net_income"]


def _bars_with_filing(spark: SparkSession, folder: str, columns: list[str], carry: list[str], how: str) -> DataFrame:
    return as_known(
        table(spark, folder, "market_data").select(*columns),
        table(spark, folder, "fundamentals"),
        entity="ticker_id",
        event_date="date",
        known_date=F.col("filing_date"),
        precedence=[F.col("report_date"), F.col("filing_date"), -F.col("fundamental_id")],
        carry=carry,
        valid=F.col("filing_date") >= F.coalesce("report_date", "filing_date"),
        how=how,
    )


def p3_as_known(spark: SparkSession, folder: str) -> DataFrame:
    """Every bar with the figures public before its date; NULL figures where there are none."""
    out = _bars_with_filing(spark, folder, ["market_data_id", "ticker_id", "date", "close"], FIGURES, "left")
    return out.select("market_data_id", "ticker_id", "date", "close", *[(F.col(f"as_known.{c}").cast("string") if c.endswith("_date") else F.col(f"as_known.{c}")).alias(c) for c in FIGURES])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    out = _bars_with_filing(spark, folder, ["market_data_id", "ticker_id", "date"], ["fundamental_id"], "inner")
    return out.select("market_data_id", F.col("as_known.fundamental_id").alias("fundamental_id"))


def _news_with_bar(spark: SparkSession, folder: str, carry: list[str], prefer: list, how: str, columns: list[str]) -> DataFrame:
    return nearest_in_time(
        table(spark, folder, "news").select(*columns),
        table(spark, folder, "market_data"),
        entity="ticker_id",
        left_time=micros(F.col("published_at")),
        right_time=epoch_day("date").cast("long") * (86400 * SECOND) + BAR_HOUR * 3600 * SECOND,
        carry=carry,
        prefer=prefer,
        how=how,
    )


def p5_nearest_bar(spark: SparkSession, folder: str) -> DataFrame:
    """Every news row with its ticker's nearest bar (as last delivered) and the distance in seconds; NULL where none is in reach."""
    out = _news_with_bar(spark, folder, ["date", "close"], [F.col("created_at"), F.col("market_data_id")], "left", ["news_id", "ticker_id", "published_at"])
    return out.select("news_id", "ticker_id", "published_at", F.col("nearest.date").cast("string").alias("bar_date"), F.col("nearest.close").alias("bar_close"), (F.col("distance_us") / SECOND).cast("long").alias("distance_s"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    out = _news_with_bar(spark, folder, ["date"], [], "inner", ["news_id", "ticker_id", "published_at"])
    return out.select("news_id", F.date_format("nearest.date", "yyyy-MM-dd").alias("bar_date"))


QUERIES = {"p1_trailing": p1_trailing, "p1_found": p1_found, "p3_as_known": p3_as_known, "p3_found": p3_found, "p5_nearest_bar": p5_nearest_bar, "p5_found": p5_found}

_NEAREST = """
WITH bars AS (
  SELECT ticker_id, date, arg_max(struct_pack(c := close), (created_at, market_data_id)).c AS close FROM market_data GROUP BY 1, 2),
near AS (
  SELECT n.news_id, b.date AS bar_date, b.close AS bar_close,
         date_diff('second', n.published_at, b.date + INTERVAL 16 HOUR) AS distance_s,
         row_number() OVER (PARTITION BY n.news_id ORDER BY abs(date_diff('second', n.published_at, b.date + INTERVAL 16 HOUR)), b.date) AS rn
  FROM news n JOIN bars b ON n.ticker_id = b.ticker_id
   AND b.date BETWEEN CAST(n.published_at AS DATE) - 3 AND CAST(n.published_at AS DATE) + 3
   AND abs(date_diff('second', n.published_at, b.date + INTERVAL 16 HOUR)) <= 108000)
"""
_KNOWN = """
WITH known AS (
  SELECT m.market_data_id, f.*, row_number() OVER (PARTITION BY m.market_data_id ORDER BY f.report_date DESC NULLS LAST, f.filing_date DESC, f.fundamental_id) AS rn
  FROM market_data m JOIN fundamentals f ON m.ticker_id = f.ticker_id AND f.filing_date < m.date AND f.filing_date >= coalesce(f.report_date, f.filing_date))
"""
_SPINE = """
spans AS (SELECT ticker_id, min(date) AS a, max(date) AS b FROM market_data WHERE ticker_id IS NOT NULL GROUP BY 1),
spine AS (SELECT ticker_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS on_date, a FROM spans)
"""


def _trailing_sql() -> str:
    parts = []
    for m in ("close", "volume", "sentiment"):
        for w in WINDOWS:
            over = f"OVER (PARTITION BY ticker_id ORDER BY on_date RANGE BETWEEN INTERVAL {w - 1} DAY PRECEDING AND CURRENT ROW)"
            total, n = f"round(CAST(coalesce(sum({m}_s) {over}, 0) AS DOUBLE), 4)", f"coalesce(sum({m}_c) {over}, 0)"
            parts += [f"{total} AS {m}_total_{w}", f"CAST({n} AS BIGINT) AS {m}_n_{w}", f"{total} / nullif({n}, 0) AS {m}_avg_{w}"]
    return f"""
WITH {_SPINE},
bars AS (SELECT ticker_id, date AS d, arg_max(struct_pack(c := close, v := volume), (created_at, market_data_id)) AS x FROM market_data GROUP BY 1, 2),
articles AS (SELECT arg_max(struct_pack(t := ticker_id, p := published_at, s := sentiment_score), (created_at, news_id)) AS x FROM news WHERE ticker_id IS NOT NULL GROUP BY coalesce(url, CAST(news_id AS VARCHAR))),
sent AS (SELECT x.t AS ticker_id, CAST(x.p AS DATE) AS d, sum(x.s) AS s, count(x.s) AS c FROM articles GROUP BY 1, 2),
days AS (SELECT ticker_id, on_date, true AS inside FROM spine
         UNION ALL SELECT ticker_id, d, false FROM sent JOIN spans USING (ticker_id) WHERE d < a AND d >= a - 30),
vals AS (SELECT days.ticker_id, on_date, inside, bars.x.c AS close_s, CAST(bars.x.c IS NOT NULL AS INT) AS close_c, CAST(bars.x.v AS DOUBLE) AS volume_s,
                CAST(bars.x.v IS NOT NULL AS INT) AS volume_c, sent.s AS sentiment_s, sent.c AS sentiment_c
         FROM days LEFT JOIN bars ON bars.ticker_id = days.ticker_id AND bars.d = on_date LEFT JOIN sent ON sent.ticker_id = days.ticker_id AND sent.d = on_date),
wins AS (SELECT ticker_id, on_date, inside, {", ".join(parts)} FROM vals)
SELECT * EXCLUDE (inside) FROM wins WHERE inside"""


ORACLES = {
    "p1_trailing": _trailing_sql(),
    "p1_found": f"""
WITH {_SPINE},
sent AS (SELECT ticker_id, CAST(published_at AS DATE) AS d, count(*) AS c FROM news WHERE sentiment_score IS NOT NULL AND ticker_id IS NOT NULL GROUP BY 1, 2),
last AS (SELECT s.ticker_id, s.on_date, max(n.d) AS d FROM spine s JOIN sent n ON n.ticker_id = s.ticker_id AND n.d BETWEEN s.on_date - 29 AND s.on_date GROUP BY 1, 2)
SELECT ticker_id, strftime(on_date, '%Y-%m-%d') AS on_date FROM last WHERE on_date - d >= 7""",
    "p3_as_known": _KNOWN
    + """SELECT m.market_data_id, m.ticker_id, m.date, m.close, k.fundamental_id, CAST(k.report_date AS VARCHAR) AS report_date, CAST(k.filing_date AS VARCHAR) AS filing_date, k.eps, k.revenue, k.net_income
FROM market_data m LEFT JOIN known k ON m.market_data_id = k.market_data_id AND k.rn = 1""",
    "p3_found": _KNOWN + "SELECT market_data_id, fundamental_id FROM known WHERE rn = 1",
    "p5_nearest_bar": _NEAREST
    + """SELECT n.news_id, n.ticker_id, n.published_at, CAST(k.bar_date AS VARCHAR) AS bar_date, k.bar_close, CAST(k.distance_s AS BIGINT) AS distance_s
FROM news n LEFT JOIN near k ON n.news_id = k.news_id AND k.rn = 1""",
    "p5_found": _NEAREST + "SELECT news_id, strftime(bar_date, '%Y-%m-%d') AS bar_date FROM near WHERE rn = 1",
}
