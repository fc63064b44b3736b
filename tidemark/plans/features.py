"""Time-series features: indicators, growth, sentiment, event gaps and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import series as s
from tidemark.operators.trailing import clean_double, latest_delivery
from tidemark.plans.shared import ARTICLES, BARS, SERIES, articles, bars, series
from tidemark.tables import table

K = "ticker_id"


def _rounded(df: DataFrame, names: list[str], means: tuple[str, ...] = ()) -> DataFrame:
    return df.select(K, "date", *[F.col(n) if n in means else s.plain_zero(n, 4).alias(n) for n in names])


def w04_w06_averages(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(s.rsi(s.moving_averages(series(spark, folder), K, "close"), K, "close"), ["sma_20", "sma_50", "ema_20", "rsi_14"], ("sma_20", "sma_50"))


def w07_macd(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(s.macd(series(spark, folder), K, "close"), ["macd", "macd_signal", "macd_histogram"])


def w08_bollinger(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(s.bollinger(series(spark, folder), K, "close"), ["bollinger_middle", "bollinger_upper", "bollinger_lower"], ("bollinger_middle",))


def w09_atr(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(s.atr(series(spark, folder), K), ["true_range", "atr_14"], ("atr_14",))


def w10_adx(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(s.adx(series(spark, folder), K), ["plus_di", "minus_di", "adx"])


def _ema_sql(x: str, span: int, table: str = "s") -> str:
    r = 1 - 2 / (span + 1)
    return f"pow({r!r}, i) * sum(CASE WHEN i = 0 THEN {x} ELSE {2 / (span + 1)!r} * {x} * pow({r!r}, -i) END) OVER (PARTITION BY ticker_id ORDER BY i)"


def _rows(n: int) -> str:
    return f"OVER (PARTITION BY ticker_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _mean(x: str, over: str = "", places: int = 4) -> str:
    return f"round(CAST(sum({x}) {over} AS DOUBLE), {places}) / nullif(count({x}) {over}, 0)"


def _plain(x: str, places: int = 4) -> str:
    return f"CASE WHEN round({x}, {places}) = 0 THEN 0.0 ELSE round({x}, {places}) END"


_TR = f"""tr AS (SELECT *, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS true_range,
  high - lag(high) OVER w AS u, lag(low) OVER w - low AS d FROM s WINDOW w AS (PARTITION BY ticker_id ORDER BY i))"""
_WILDER = "pow(13.0/14, i) * sum({x} * pow(13.0/14, -greatest(i, 13))) OVER (PARTITION BY ticker_id ORDER BY i)"


def fiscal_filings(spark: SparkSession, folder: str) -> DataFrame:
    """The last amendment of each report."""
    raw = table(spark, folder, "fundamentals").where("ticker_id is not null and report_date is not null")
    return latest_delivery(raw, [K, "report_date"], ["created_at", "fundamental_id"], ["fundamental_id", "revenue", "net_income", "eps"])


def w11_w12_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Change against the filing before, and against the same quarter of the year before (fractions)."""
    f = fiscal_filings(spark, folder).withColumn("y", F.year("report_date")).withColumn("q", F.quarter("report_date"))
    w = Window.partitionBy(K).orderBy("report_date")
    prior = f.groupBy(K, (F.col("y") + 1).alias("y"), "q").agg(F.min_by("revenue", "report_date").alias("base"))
    f = f.withColumn("last", F.lag("revenue").over(w)).join(prior, [K, "y", "q"], "left")
    qoq = F.try_divide(F.col("revenue").cast("double"), F.col("last")) - 1
    yoy = F.try_divide((F.col("revenue") - F.col("base")).cast("double"), F.abs("base"))
    return f.select("fundamental_id", K, "report_date", F.round(qoq, 6).alias("revenue_qoq"), F.round(yoy, 6).alias("revenue_yoy"))


def a08_w13_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Daily mean sentiment (NULL counts 0) and its means and counts over the last 7 days with news."""
    daily = articles(spark, folder, "sentiment_score").groupBy(K, F.to_date("published_at").alias("date")).agg(s.exact_mean(F.coalesce(clean_double("sentiment_score"), F.lit(0.0))).alias("m"), F.count("*").alias("article_count"))
    w = Window.partitionBy(K).orderBy("date").rowsBetween(-6, 0)
    return daily.select(K, "date", F.col("m").alias("sentiment"), "article_count", s.exact_mean("m", w, 9).alias("sentiment_7"), F.sum("article_count").over(w).alias("articles_7"))


def j10_w14_days_since(spark: SparkSession, folder: str) -> DataFrame:
    """Days since the ticker's last article and last insider trade up to each bar; rows without either are left out."""
    spine = bars(spark, folder).select(K, "date", F.lit(None).cast("date").alias("n"), F.lit(None).cast("date").alias("t"), F.lit(True).alias("bar"))
    news = table(spark, folder, "news").where("ticker_id is not null").select(K, F.to_date("published_at").alias("date")).distinct()
    trades = table(spark, folder, "insider_transactions").where("ticker_id is not null and transaction_date is not null").select(K, F.col("transaction_date").alias("date")).distinct()
    line = spine.unionByName(news.select(K, "date", F.col("date").alias("n"), F.lit(None).cast("date").alias("t"), F.lit(False).alias("bar"))).unionByName(
        trades.select(K, "date", F.lit(None).cast("date").alias("n"), F.col("date").alias("t"), F.lit(False).alias("bar"))
    )
    w = Window.partitionBy(K).orderBy("date").rangeBetween(Window.unboundedPreceding, 0)
    out = line.select(K, "date", "bar", F.datediff("date", F.max("n").over(w)).alias("days_since_news"), F.datediff("date", F.max("t").over(w)).alias("days_since_insider"))
    return out.where("bar and (days_since_news is not null or days_since_insider is not null)").drop("bar")


def w16_daily_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Returns of the last 30 closes of each ticker, newest first: at most 29."""
    w = Window.partitionBy(K).orderBy(F.desc("date"))
    last = bars(spark, folder).withColumn("rn", F.row_number().over(w)).where("rn <= 30")
    last = last.withColumn("prev", F.lead("close").over(w)).where("prev is not null")
    return last.select(K, "rn", F.round(F.try_divide(F.col("close") - F.col("prev"), "prev") * 100, 6).alias("return_pct"))


def w17_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Trends over each ticker's last 5, 20 and 50 bars, and the state of momentum, volatility and volume; NULL or "Insufficient data" for short series."""
    x = s.macd(s.rsi(series(spark, folder), K, "close"), K, "close")
    w = Window.partitionBy(K)
    x = x.withColumn("n", F.count("*").over(w)).withColumn("back", F.col("n") - 1 - F.col("i")).where("back < 50")
    x = x.withColumn("r", F.when(F.col("back") < 19, F.try_divide("close", F.lag("close").over(w.orderBy("i"))) - 1))
    last = lambda c, at=0: F.max(F.when(F.col("back") == at, F.col(c)))
    tail = lambda c, n: F.when(F.col("back") < n, F.col(c))
    g = x.groupBy(K).agg(
        F.max("n").alias("n"), last("close").alias("c0"), last("close", 4).alias("c4"), F.min_by("close", "i").alias("c49"), F.round(F.regr_slope(tail("close", 20), F.col("i")), 9).alias("slope"),
        last("rsi_14").alias("rsi"), F.round(last("macd") - last("macd_signal"), 9).alias("md"), F.stddev_samp("r").alias("sd"), F.max(tail("high", 20)).alias("hi"), F.min(tail("low", 20)).alias("lo"),
        s.exact_mean(tail("close", 20)).alias("mean"), s.exact_mean(tail("volume", 10), places=0).alias("vm"), last("volume").alias("v0"),
    )
    change = F.try_divide(F.col("c0") - F.col("c49"), "c49") * 100
    few = lambda n, rest: F.when(F.col("n") < n, "Insufficient data").otherwise(rest)
    enough = F.col("n") >= 5
    return g.select(
        K,
        few(5, F.when(F.col("c0") > F.col("c4"), "Uptrend").when(F.col("c0") < F.col("c4"), "Downtrend").otherwise("Sideways")).alias("short_term"),
        few(10, F.when(F.col("slope") > 0.1, "Strong Uptrend").when(F.col("slope") > 0, "Weak Uptrend").when(F.col("slope") < -0.1, "Strong Downtrend").when(F.col("slope") < 0, "Weak Downtrend").otherwise("Sideways")).alias("medium_term"),
        few(20, F.when(change > 10, "Strong Uptrend").when(change > 5, "Moderate Uptrend").when(change < -10, "Strong Downtrend").when(change < -5, "Moderate Downtrend").otherwise("Sideways")).alias("long_term"),
        F.when(F.col("rsi") > 70, "Overbought").when(F.col("rsi") < 30, "Oversold").when(F.col("rsi").isNotNull(), "Neutral").alias("rsi_state"),
        F.when(F.col("md") > 0, "Bullish").otherwise("Bearish").alias("macd_state"),
        F.when(enough, F.round(F.col("sd") * 100, 6)).alias("daily_volatility"),
        F.when(enough, F.round(F.try_divide(F.col("hi") - F.col("lo"), "mean") * 100, 6)).alias("recent_range"),
        F.when(enough, F.when(F.col("vm") > 0, F.round(F.try_divide("v0", "vm"), 6)).otherwise(0.0)).alias("volume_ratio"),
        F.when(enough, F.when(F.col("v0") > F.col("vm"), "Increasing").otherwise("Decreasing")).alias("volume_trend"),
    )


def w18_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Each ticker's last bar against the one before and its indicators, as one line of five remarks."""
    x = s.bollinger(s.macd(s.rsi(s.moving_averages(series(spark, folder), K, "close"), K, "close"), K, "close"), K, "close")
    x = x.withColumn("pc", F.coalesce(F.lag("close").over(Window.partitionBy(K).orderBy("i")), "close")).withColumn("n", F.count("*").over(Window.partitionBy(K))).where("i = n - 1")
    c, short, long = F.col("close"), F.round("sma_20", 6), F.round("sma_50", 6)
    state = F.when(F.col("rsi_14") > 70, "Overbought").when(F.col("rsi_14") < 30, "Oversold").otherwise("Neutral")
    upper, lower = F.round("bollinger_upper", 6), F.round("bollinger_lower", 6)
    rules = [
        F.format_string("Price Change: %+.2f%%", s.plain_zero(F.try_divide(c - F.col("pc"), "pc") * 100, 6)),
        F.when(F.col("rsi_14").isNotNull(), F.format_string("RSI: %.1f (%s)", F.round("rsi_14", 6), state)),
        F.when(F.round(F.col("macd") - F.col("macd_signal"), 9) > 0, "MACD: Bullish (MACD > Signal)").otherwise("MACD: Bearish (MACD < Signal)"),
        F.when(upper.isNotNull(), F.when(c > upper, "Price: Above Bollinger Upper Band (Overbought)").when(c < lower, "Price: Below Bollinger Lower Band (Oversold)").otherwise("Price: Within Bollinger Bands (Normal)")),
        F.when((c > short) & (short > long), "Moving Averages: Bullish Alignment").when((c < short) & (short < long), "Moving Averages: Bearish Alignment").otherwise("Moving Averages: Mixed Signals"),
    ]
    return x.select(K, "date", F.concat_ws(" | ", *rules).alias("insights"))


def w19_changed_values(spark: SparkSession, folder: str) -> DataFrame:
    """Filings that bring something new: a later report than any seen, or another value than the last."""
    f = table(spark, folder, "fundamentals").where("ticker_id is not null and filing_date is not null and report_date is not null")
    w = Window.partitionBy(K).orderBy("filing_date", "fundamental_id")
    seen = F.max("report_date").over(w.rowsBetween(Window.unboundedPreceding, -1))
    last = F.lag("revenue").over(w)
    f = f.withColumn("newer", seen.isNull() | (F.col("report_date") > seen)).withColumn("changed", ~F.col("revenue").eqNullSafe(last))
    return f.where("newer or changed").select("fundamental_id", K, "newer", "changed")


def _weekly(df: DataFrame, *bucket: Column) -> DataFrame:
    return df.groupBy(K, *bucket)


def a09_weekly_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks from Monday: first open, highest, lowest, last close, whole mean volume and change."""
    g = _weekly(bars(spark, folder), F.to_date(F.date_trunc("week", F.col("date").cast("timestamp_ntz"))).alias("week")).agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "date").alias("close"),
        F.floor(F.avg(F.coalesce("volume", F.lit(0)))).cast("long").alias("volume"), F.count("*").alias("days"),
    )
    return g.withColumn("change_pct", F.round(F.try_divide(F.col("close") - F.col("open"), "open") * 100, 4))


def a10_chunk_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of five bars: first open, highest, lowest, last close, summed volume."""
    return _weekly(series(spark, folder), F.floor(F.col("i") / 5).alias("chunk")).agg(
        F.min("date").alias("first_date"), F.min_by("open", "i").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "i").alias("close"),
        F.sum("volume").alias("volume"),
    )


def a11_weekly_change(spark: SparkSession, folder: str) -> DataFrame:
    g = _weekly(bars(spark, folder), F.to_date(F.date_trunc("week", F.col("date").cast("timestamp_ntz"))).alias("week")).agg(
        F.min_by("close", "date").alias("a"), F.max_by("close", "date").alias("b"), s.exact_mean("volume", places=0).alias("v")
    )
    return g.select(K, "week", F.round(F.try_divide(F.col("b") - F.col("a"), "a") * 100, 4).alias("change_pct"), F.col("v").alias("mean_volume"))


def a12_a13_weekly_news(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly article counts by sign at 0.1, means with and without NULL as 0, and the headline of the strongest score."""
    a = articles(spark, folder, "headline", "sentiment_score", "news_id").withColumn("sentiment_score", clean_double("sentiment_score"))
    strongest = F.struct(F.coalesce(F.abs("sentiment_score"), F.lit(-1.0)), F.col("news_id"))
    return a.groupBy(K, F.to_date(F.date_trunc("week", "published_at")).alias("week")).agg(
        F.count("*").alias("articles"),
        F.count_if(F.col("sentiment_score") > 0.1).alias("positive"),
        F.count_if(F.col("sentiment_score") < -0.1).alias("negative"),
        F.count_if(F.coalesce(F.abs("sentiment_score") <= 0.1, F.lit(True))).alias("neutral"),
        s.exact_mean("sentiment_score").alias("mean_score"),
        s.exact_mean(F.coalesce("sentiment_score", F.lit(0.0))).alias("mean_with_nulls"),
        F.max_by("headline", strongest).alias("top_headline"),
    )


def a14_a15_weekly_insider(spark: SparkSession, folder: str) -> DataFrame:
    code = F.upper(F.trim("transaction_code"))
    t = table(spark, folder, "insider_transactions").where("ticker_id is not null and transaction_date is not null").withColumn("code", code)
    return t.groupBy(K, F.to_date(F.date_trunc("week", F.col("transaction_date").cast("timestamp_ntz"))).alias("week")).agg(
        F.count_if(F.col("code") == "P").alias("purchases"),
        F.count_if(F.col("code") == "S").alias("sales"),
        F.coalesce(F.sum(F.when(F.col("code").isin("P", "A"), F.col("shares"))), F.lit(0)).alias("bought"),
        F.coalesce(F.sum(F.when(F.col("code").isin("S", "D"), F.col("shares"))), F.lit(0)).alias("sold"),
        s.exact_mean(F.when(F.col("transaction_price") > 0, F.col("transaction_price"))).alias("mean_price"),
    )


def a18_a19_price_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Levels, total and mean daily return, deviation and trend of each ticker."""
    w = Window.partitionBy(K).orderBy("i")
    x = series(spark, folder).withColumn("r", F.try_divide(F.col("close") - F.lag("close").over(w), F.lag("close").over(w)) * 100)
    g = x.groupBy(K).agg(
        F.max("high").alias("high"), F.min("low").alias("low"), F.min_by("close", "i").alias("first"), F.max_by("close", "i").alias("last"),
        F.round(F.avg("r"), 6).alias("mean_return"), F.round(F.stddev_samp("r"), 6).alias("deviation"), F.count("*").alias("bars"),
    )
    total = F.try_divide(F.col("last") - F.col("first"), "first") * 100
    return g.select(
        K, "bars", "high", "low", "last", F.round(F.try_divide(F.col("high") - F.col("low"), "low") * 100, 6).alias("range_pct"), F.round(total, 6).alias("total_return"), "mean_return", "deviation",
        F.when(total > 5, "up").when(total < -5, "down").otherwise("flat").alias("trend"),
    )


def a20_long_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Change over the last 60 bars, over 30 where there are fewer, and the drift of the 50-bar mean."""
    w = Window.partitionBy(K).orderBy("i")
    x = s.moving_averages(series(spark, folder), K, "close")
    x = x.withColumns({"b60": F.lag("close", 59).over(w), "b30": F.lag("close", 29).over(w), "s0": F.first("sma_50").over(w), "n": F.count("*").over(Window.partitionBy(K))}).where("i = n - 1")
    base = F.coalesce("b60", "b30")
    return x.select(K, s.plain_zero(F.try_divide(F.col("close") - base, base) * 100, 6).alias("change_pct"), s.plain_zero(F.try_divide(F.col("sma_50") - F.col("s0"), "s0") * 100, 6).alias("sma_drift_pct"))


def a21_volatility(spark: SparkSession, folder: str) -> DataFrame:
    """Population deviation and mean size of returns, mean daily range, and the lower nearest-rank 90th percentile.

    The percentile is a rank within the ticker's days, not a collected list.
    """
    w = Window.partitionBy(K).orderBy("i")
    x = series(spark, folder).withColumn("r", F.try_divide(F.col("close") - F.lag("close").over(w), F.lag("close").over(w)) * 100)
    x = x.withColumn("m", F.abs("r")).withColumn("range", F.try_divide(F.col("high") - F.col("low"), "low") * 100)
    ranked = x.withColumn("n", F.count("m").over(Window.partitionBy(K))).withColumn("rk", F.row_number().over(Window.partitionBy(K).orderBy(F.asc_nulls_last("m"), "i")) - 1)
    return ranked.groupBy(K).agg(
        F.round(F.stddev_pop("r"), 6).alias("deviation"), F.round(F.avg("m"), 6).alias("mean_move"), F.round(F.avg("range"), 6).alias("mean_range"),
        F.round(F.max(F.when(F.col("rk") == F.floor((F.col("n") - 1) * F.lit(9) / F.lit(10)), F.col("m"))), 6).alias("p90_move"),
    )


def a16_a17_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings of each ticker: counts of kinds of action and the mean of targets that are set."""
    a = table(spark, folder, "analyst_recommendations").where("ticker_id is not null").withColumn("act", F.lower("action"))
    return a.groupBy(K, F.lower(F.trim("rating")).alias("rating")).agg(
        F.count("*").alias("n"), F.count_if(F.col("act").contains("upgrade")).alias("upgrades"), F.count_if(F.col("act").contains("downgrade")).alias("downgrades"),
        F.count_if(F.col("act").contains("maintain") | F.col("act").contains("reiterate")).alias("maintained"), s.exact_mean(F.when(F.col("target_price") > 0, F.col("target_price"))).alias("mean_target"),
    )


def a22_sentiment_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Each ticker's monthly mean sentiment with its direction against the month before, at 0.05."""
    a = articles(spark, folder, "sentiment_score").groupBy(K, F.to_date(F.date_trunc("month", "published_at")).alias("month")).agg(s.exact_mean(clean_double("sentiment_score")).alias("m"))
    prev = F.lag("m").over(Window.partitionBy(K).orderBy("month"))
    a = a.withColumn("d", F.col("m") - prev)
    return a.select(K, "month", F.col("m").alias("mean_score"), F.when(F.col("d") > 0.05, "improving").when(F.col("d") < -0.05, "worsening").when(F.col("d").isNotNull(), "stable").alias("direction"))


def d35_d36_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Each ticker's three latest articles as lines of text, with the sentiment in words at 0.2 and 0.6."""
    a = articles(spark, folder, "headline", "sentiment_score", "news_id").withColumn("s", clean_double("sentiment_score"))
    level = F.when(F.col("s") >= 0.6, "very positive").when(F.col("s") >= 0.2, "positive").when(F.col("s") <= -0.6, "very negative").when(F.col("s") <= -0.2, "negative").when(F.col("s").isNotNull(), "neutral").otherwise("unrated")
    order = [F.desc("published_at"), F.desc("news_id")]
    # three a day suffice of each day, so no hot ticker is sorted whole
    a = a.withColumn("r", F.row_number().over(Window.partitionBy(K, F.to_date("published_at")).orderBy(*order))).where("r <= 3")
    a = a.withColumn("rn", F.row_number().over(Window.partitionBy(K).orderBy(*order))).where("rn <= 3")
    line = F.concat(F.lit("- "), F.coalesce("headline", F.lit("")), F.lit(" ("), level, F.lit(")"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("rn", line.alias("l")))), lambda x: x["l"])
    return a.groupBy(K).agg(F.array_join(lines, "\n").alias("summary"), F.floor(F.length(F.array_join(lines, "\n")) / 4).alias("tokens_estimated"))


QUERIES = {f.__name__: f for f in (
    d35_d36_summaries,
    w04_w06_averages, w07_macd, w08_bollinger, w09_atr, w10_adx, w11_w12_growth, a08_w13_sentiment, j10_w14_days_since, w16_daily_returns, w17_labels, w18_insights, w19_changed_values,
    a09_weekly_bars, a10_chunk_bars, a11_weekly_change, a12_a13_weekly_news, a14_a15_weekly_insider, a16_a17_ratings, a18_a19_price_summary, a20_long_trend, a21_volatility, a22_sentiment_trend,
)}

_AVERAGES = f"""
WITH {SERIES}, d AS (SELECT *, coalesce(close - lag(close) OVER (PARTITION BY ticker_id ORDER BY i), 0) AS ch FROM s),
g AS (SELECT *, {_mean("close", _rows(20))} AS sma_20, {_mean("close", _rows(50))} AS sma_50, {_ema_sql("close", 20)} AS ema_20,
  avg(greatest(ch, 0)) {_rows(14)} AS up, avg(greatest(-ch, 0)) {_rows(14)} AS down FROM d),
x AS (SELECT *, CASE WHEN i >= 13 THEN CASE WHEN down > 0 THEN 100 - 100 / (1 + up / down) WHEN up > 0 THEN 100.0 END END AS rsi_14 FROM g)"""

ORACLES = {
    "d35_d36_summaries": f"""WITH {ARTICLES}, r AS (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY published_at DESC, news_id DESC) AS rn FROM articles),
l AS (SELECT ticker_id, rn, '- ' || coalesce(headline, '') || ' (' || CASE WHEN sentiment_score >= 0.6 THEN 'very positive' WHEN sentiment_score >= 0.2 THEN 'positive' WHEN sentiment_score <= -0.6 THEN 'very negative'
  WHEN sentiment_score <= -0.2 THEN 'negative' WHEN sentiment_score IS NOT NULL THEN 'neutral' ELSE 'unrated' END || ')' AS l FROM r WHERE rn <= 3), g AS (SELECT ticker_id, string_agg(l, chr(10) ORDER BY rn) AS summary FROM l GROUP BY 1)
SELECT ticker_id, summary, CAST(floor(length(summary) / 4) AS BIGINT) AS tokens_estimated FROM g""",
    "w04_w06_averages": _AVERAGES + " SELECT ticker_id, date, sma_20, sma_50, round(ema_20, 4) AS ema_20, round(rsi_14, 4) AS rsi_14 FROM x",
    "w07_macd": f"""WITH {SERIES}, m AS (SELECT *, {_ema_sql("close", 12)} - {_ema_sql("close", 26)} AS macd FROM s), g AS (SELECT *, {_ema_sql("macd", 9)} AS sig FROM m)
SELECT ticker_id, date, {_plain("macd")} AS macd, {_plain("sig")} AS macd_signal, {_plain("macd - sig")} AS macd_histogram FROM g""",
    "w08_bollinger": f"""WITH {SERIES}, g AS (SELECT *, {_mean("close", _rows(20))} AS m, stddev_samp(close) {_rows(20)} AS sd FROM s)
SELECT ticker_id, date, m AS bollinger_middle, round(m + 2 * sd, 4) AS bollinger_upper, round(m - 2 * sd, 4) AS bollinger_lower FROM g""",
    "w09_atr": f"WITH {SERIES}, {_TR} SELECT ticker_id, date, round(true_range, 4) AS true_range, {_mean("true_range", _rows(14))} AS atr_14 FROM tr",
    "w10_adx": f"""WITH {SERIES}, {_TR}, dm AS (SELECT *, CASE WHEN u > d AND u > 0 THEN u ELSE 0 END AS pm, CASE WHEN d > u AND d > 0 THEN d ELSE 0 END AS mm FROM tr),
w AS (SELECT *, {_WILDER.format(x="true_range")} AS st, {_WILDER.format(x="pm")} AS sp, {_WILDER.format(x="mm")} AS sm FROM dm),
di AS (SELECT *, CASE WHEN i >= 13 AND st > 0 THEN 100 * sp / st ELSE 0 END AS plus_di, CASE WHEN i >= 13 AND st > 0 THEN 100 * sm / st ELSE 0 END AS minus_di, least(26, n - 1) AS e FROM w),
dx AS (SELECT *, CASE WHEN plus_di + minus_di > 0 THEN 100 * abs(plus_di - minus_di) / (plus_di + minus_di) ELSE 0 END AS dx FROM di),
sd AS (SELECT *, avg(dx) FILTER (i BETWEEN 13 AND e) OVER (PARTITION BY ticker_id) AS seed FROM dx),
a AS (SELECT *, CASE WHEN n < 14 OR i < e THEN 0 ELSE pow(13.0/14, i) * sum(CASE WHEN i = e THEN seed WHEN i > e THEN dx / 14 ELSE 0 END * pow(13.0/14, -i)) OVER (PARTITION BY ticker_id ORDER BY i) END AS adx FROM sd)
SELECT ticker_id, date, round(plus_di, 4) AS plus_di, round(minus_di, 4) AS minus_di, round(adx, 4) AS adx FROM a""",
    "w11_w12_growth": """WITH f AS (SELECT ticker_id, report_date, arg_max(struct_pack(fundamental_id := fundamental_id, revenue := revenue), (created_at, fundamental_id)) AS x FROM fundamentals
  WHERE ticker_id IS NOT NULL AND report_date IS NOT NULL GROUP BY 1, 2),
g AS (SELECT x.fundamental_id, ticker_id, report_date, x.revenue AS revenue, lag(x.revenue) OVER (PARTITION BY ticker_id ORDER BY report_date) AS last FROM f),
p AS (SELECT ticker_id, year(report_date) + 1 AS y, quarter(report_date) AS q, arg_min(x.revenue, report_date) AS base FROM f WHERE x.revenue IS NOT NULL GROUP BY 1, 2, 3)
SELECT fundamental_id, g.ticker_id, report_date, round(revenue / nullif(CAST(last AS DOUBLE), 0) - 1, 6) AS revenue_qoq,
  round((revenue - base) / nullif(CAST(abs(base) AS DOUBLE), 0), 6) AS revenue_yoy
FROM g LEFT JOIN p ON p.ticker_id = g.ticker_id AND p.y = year(report_date) AND p.q = quarter(report_date)""",
    "a08_w13_sentiment": f"""WITH {ARTICLES}, d AS (SELECT ticker_id, CAST(published_at AS DATE) AS date, {_mean("coalesce(sentiment_score, 0)")} AS m, count(*) AS c FROM articles GROUP BY 1, 2)
SELECT ticker_id, date, m AS sentiment, c AS article_count, {_mean("m", "OVER w", 9)} AS sentiment_7, CAST(sum(c) OVER w AS BIGINT) AS articles_7
FROM d WINDOW w AS (PARTITION BY ticker_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "j10_w14_days_since": f"""WITH {BARS}, n AS (SELECT DISTINCT ticker_id, CAST(published_at AS DATE) AS d FROM news WHERE ticker_id IS NOT NULL), t AS (SELECT DISTINCT ticker_id, transaction_date AS d FROM insider_transactions WHERE transaction_date IS NOT NULL),
x AS (SELECT b.ticker_id, b.date, date_diff('day', n.d, b.date) AS a, date_diff('day', t.d, b.date) AS c FROM bars b ASOF LEFT JOIN n ON n.ticker_id = b.ticker_id AND n.d <= b.date ASOF LEFT JOIN t ON t.ticker_id = b.ticker_id AND t.d <= b.date)
SELECT ticker_id, date, CAST(a AS INTEGER) AS days_since_news, CAST(c AS INTEGER) AS days_since_insider FROM x WHERE a IS NOT NULL OR c IS NOT NULL""",
    "w16_daily_returns": f"""WITH {BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY date DESC) AS rn FROM bars)
SELECT a.ticker_id, CAST(a.rn AS INTEGER) AS rn, round((a.close - b.close) / nullif(b.close, 0) * 100, 6) AS return_pct FROM r a JOIN r b ON b.ticker_id = a.ticker_id AND b.rn = a.rn + 1 AND b.rn <= 30""",
    "w17_labels": _AVERAGES
    + f""", m AS (SELECT *, {_ema_sql("close", 12, "x")} - {_ema_sql("close", 26, "x")} AS macd, n - 1 - i AS back FROM x), y AS (SELECT *, {_ema_sql("macd", 9)} AS sig, lag(close) OVER (PARTITION BY ticker_id ORDER BY i) AS pc FROM m),
t AS (SELECT *, CASE WHEN back < 19 THEN close / nullif(pc, 0) - 1 END AS r FROM y WHERE back < 50),
h AS (SELECT ticker_id, max(n) AS n, max(close) FILTER (back = 0) AS c0, max(close) FILTER (back = 4) AS c4, arg_min(close, i) AS c49, round(regr_slope(close, i) FILTER (back < 20), 9) AS slope, max(rsi_14) FILTER (back = 0) AS rsi,
  round(max(macd - sig) FILTER (back = 0), 9) AS md, stddev_samp(r) AS sd, max(high) FILTER (back < 20) AS hi, min(low) FILTER (back < 20) AS lo, {_mean("CASE WHEN back < 20 THEN close END")} AS mean,
  {_mean("CASE WHEN back < 10 THEN volume END", places=0)} AS vm, max(volume) FILTER (back = 0) AS v0 FROM t GROUP BY 1), k AS (SELECT *, (c0 - c49) / nullif(c49, 0) * 100 AS ch FROM h)
SELECT ticker_id, CASE WHEN n < 5 THEN 'Insufficient data' WHEN c0 > c4 THEN 'Uptrend' WHEN c0 < c4 THEN 'Downtrend' ELSE 'Sideways' END AS short_term,
  CASE WHEN n < 10 THEN 'Insufficient data' WHEN slope > 0.1 THEN 'Strong Uptrend' WHEN slope > 0 THEN 'Weak Uptrend' WHEN slope < -0.1 THEN 'Strong Downtrend' WHEN slope < 0 THEN 'Weak Downtrend' ELSE 'Sideways' END AS medium_term,
  CASE WHEN n < 20 THEN 'Insufficient data' WHEN ch > 10 THEN 'Strong Uptrend' WHEN ch > 5 THEN 'Moderate Uptrend' WHEN ch < -10 THEN 'Strong Downtrend' WHEN ch < -5 THEN 'Moderate Downtrend' ELSE 'Sideways' END AS long_term,
  CASE WHEN rsi > 70 THEN 'Overbought' WHEN rsi < 30 THEN 'Oversold' WHEN rsi IS NOT NULL THEN 'Neutral' END AS rsi_state, CASE WHEN md > 0 THEN 'Bullish' ELSE 'Bearish' END AS macd_state,
  CASE WHEN n >= 5 THEN round(sd * 100, 6) END AS daily_volatility, CASE WHEN n >= 5 THEN round((hi - lo) / nullif(mean, 0) * 100, 6) END AS recent_range,
  CASE WHEN n >= 5 THEN CASE WHEN vm > 0 THEN round(v0 / vm, 6) ELSE 0.0 END END AS volume_ratio, CASE WHEN n >= 5 THEN CASE WHEN v0 > vm THEN 'Increasing' ELSE 'Decreasing' END END AS volume_trend FROM k""",
    "w18_insights": _AVERAGES
    + f""", m AS (SELECT *, {_ema_sql("close", 12)} - {_ema_sql("close", 26)} AS macd, {_mean("close", _rows(20))} AS bm, stddev_samp(close) {_rows(20)} AS sd, coalesce(lag(close) OVER (PARTITION BY ticker_id ORDER BY i), close) AS pc FROM x),
y AS (SELECT *, {_ema_sql("macd", 9)} AS sig FROM m), z AS (SELECT *, round(bm + 2 * sd, 6) AS up2, round(bm - 2 * sd, 6) AS lo2, round(sma_20, 6) AS a, round(sma_50, 6) AS b FROM y WHERE i = n - 1)
SELECT ticker_id, date, concat_ws(' | ', 'Price Change: ' || printf('%+.2f', {_plain("(close - pc) / nullif(pc, 0) * 100", 6)}::DOUBLE) || '%', CASE WHEN rsi_14 IS NOT NULL THEN 'RSI: ' || printf('%.1f', round(rsi_14, 6)) || ' (' || CASE WHEN rsi_14 > 70 THEN 'Overbought' WHEN rsi_14 < 30 THEN 'Oversold' ELSE 'Neutral' END || ')' END,
  CASE WHEN round(macd - sig, 9) > 0 THEN 'MACD: Bullish (MACD > Signal)' ELSE 'MACD: Bearish (MACD < Signal)' END,
  CASE WHEN up2 IS NOT NULL THEN CASE WHEN close > up2 THEN 'Price: Above Bollinger Upper Band (Overbought)' WHEN close < lo2 THEN 'Price: Below Bollinger Lower Band (Oversold)' ELSE 'Price: Within Bollinger Bands (Normal)' END END,
  CASE WHEN close > a AND a > b THEN 'Moving Averages: Bullish Alignment' WHEN close < a AND a < b THEN 'Moving Averages: Bearish Alignment' ELSE 'Moving Averages: Mixed Signals' END) AS insights FROM z""",
    "w19_changed_values": """WITH f AS (SELECT *, max(report_date) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, lag(revenue) OVER w AS last, row_number() OVER w AS k
  FROM fundamentals WHERE ticker_id IS NOT NULL AND filing_date IS NOT NULL AND report_date IS NOT NULL WINDOW w AS (PARTITION BY ticker_id ORDER BY filing_date, fundamental_id)),
g AS (SELECT fundamental_id, ticker_id, seen IS NULL OR report_date > seen AS newer, revenue IS DISTINCT FROM last AS changed FROM f) SELECT * FROM g WHERE newer OR changed""",
    "a09_weekly_bars": f"""WITH {BARS} SELECT ticker_id, CAST(date_trunc('week', date) AS DATE) AS week, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
  CAST(floor(avg(coalesce(volume, 0))) AS BIGINT) AS volume, count(*) AS days, round((arg_max(close, date) - arg_min(open, date)) / nullif(arg_min(open, date), 0) * 100, 4) AS change_pct FROM bars GROUP BY 1, 2""",
    "a10_chunk_bars": f"""WITH {SERIES} SELECT ticker_id, CAST(floor(i / 5) AS BIGINT) AS chunk, min(date) AS first_date, arg_min(open, i) AS open, max(high) AS high, min(low) AS low, arg_max(close, i) AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM s GROUP BY 1, 2""",
    "a11_weekly_change": f"""WITH {BARS} SELECT ticker_id, CAST(date_trunc('week', date) AS DATE) AS week, round((arg_max(close, date) - arg_min(close, date)) / nullif(arg_min(close, date), 0) * 100, 4) AS change_pct,
  {_mean("volume", places=0)} AS mean_volume FROM bars GROUP BY 1, 2""",
    "a12_a13_weekly_news": f"""WITH {ARTICLES} SELECT ticker_id, CAST(date_trunc('week', published_at) AS DATE) AS week, count(*) AS articles, count(*) FILTER (sentiment_score > 0.1) AS positive, count(*) FILTER (sentiment_score < -0.1) AS negative,
  count(*) FILTER (coalesce(abs(sentiment_score) <= 0.1, true)) AS neutral, {_mean("sentiment_score")} AS mean_score, {_mean("coalesce(sentiment_score, 0)")} AS mean_with_nulls,
  arg_max(headline, (coalesce(abs(sentiment_score), -1.0), news_id)) AS top_headline FROM articles GROUP BY 1, 2""",
    "a14_a15_weekly_insider": f"""WITH t AS (SELECT *, upper(trim(transaction_code)) AS code FROM insider_transactions WHERE ticker_id IS NOT NULL AND transaction_date IS NOT NULL)
SELECT ticker_id, CAST(date_trunc('week', transaction_date) AS DATE) AS week, count(*) FILTER (code = 'P') AS purchases, count(*) FILTER (code = 'S') AS sales,
  CAST(coalesce(sum(shares) FILTER (code IN ('P', 'A')), 0) AS BIGINT) AS bought, CAST(coalesce(sum(shares) FILTER (code IN ('S', 'D')), 0) AS BIGINT) AS sold,
  {_mean("CASE WHEN transaction_price > 0 THEN transaction_price END")} AS mean_price FROM t GROUP BY 1, 2""",
    "a16_a17_ratings": f"""SELECT ticker_id, lower(trim(rating)) AS rating, count(*) AS n, count(*) FILTER (contains(lower(action), 'upgrade')) AS upgrades, count(*) FILTER (contains(lower(action), 'downgrade')) AS downgrades,
  count(*) FILTER (contains(lower(action), 'maintain') OR contains(lower(action), 'reiterate')) AS maintained, {_mean("CASE WHEN target_price > 0 THEN target_price END")} AS mean_target
FROM analyst_recommendations WHERE ticker_id IS NOT NULL GROUP BY 1, 2""",
    "a18_a19_price_summary": f"""WITH {SERIES}, r AS (SELECT *, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100 AS r FROM s WINDOW w AS (PARTITION BY ticker_id ORDER BY i)),
g AS (SELECT ticker_id, count(*) AS bars, max(high) AS high, min(low) AS low, arg_min(close, i) AS f, arg_max(close, i) AS last, round(avg(r), 6) AS mean_return, round(stddev_samp(r), 6) AS deviation FROM r GROUP BY 1),
t AS (SELECT *, (last - f) / nullif(f, 0) * 100 AS total FROM g)
SELECT ticker_id, bars, high, low, last, round((high - low) / nullif(low, 0) * 100, 6) AS range_pct, round(total, 6) AS total_return, mean_return, deviation, CASE WHEN total > 5 THEN 'up' WHEN total < -5 THEN 'down' ELSE 'flat' END AS trend FROM t""",
    "a20_long_trend": f"""WITH {SERIES}, g AS (SELECT *, {_mean("close", _rows(50))} AS sma FROM s), h AS (SELECT *, coalesce(lag(close, 59) OVER w, lag(close, 29) OVER w) AS base, first(sma) OVER w AS s0 FROM g WINDOW w AS (PARTITION BY ticker_id ORDER BY i))
SELECT ticker_id, {_plain("(close - base) / nullif(base, 0) * 100", 6)} AS change_pct, {_plain("(sma - s0) / nullif(s0, 0) * 100", 6)} AS sma_drift_pct FROM h WHERE i = n - 1""",
    "a21_volatility": f"""WITH {SERIES}, r AS (SELECT *, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100 AS r FROM s WINDOW w AS (PARTITION BY ticker_id ORDER BY i))
SELECT ticker_id, round(stddev_pop(r), 6) AS deviation, round(avg(abs(r)), 6) AS mean_move, round(avg((high - low) / nullif(low, 0) * 100), 6) AS mean_range,
  round(list_sort(list(abs(r)) FILTER (r IS NOT NULL))[CAST(floor((count(r) - 1) * 9 / 10) AS INTEGER) + 1], 6) AS p90_move FROM r GROUP BY 1""",
    "a22_sentiment_trend": f"""WITH {ARTICLES}, m AS (SELECT ticker_id, CAST(date_trunc('month', published_at) AS DATE) AS month, {_mean("sentiment_score")} AS m FROM articles GROUP BY 1, 2), d AS (SELECT *, m - lag(m) OVER (PARTITION BY ticker_id ORDER BY month) AS d FROM m)
SELECT ticker_id, month, m AS mean_score, CASE WHEN d > 0.05 THEN 'improving' WHEN d < -0.05 THEN 'worsening' WHEN d IS NOT NULL THEN 'stable' END AS direction FROM d""",
}
