"""Point-in-time assembly: what was known about a ticker before a day, and how complete the data are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.asknown import as_known
from tidemark.operators.ranks import month_of, ordered_index
from tidemark.operators.series import indexed, plain_zero
from tidemark.operators.trailing import clean_double, epoch_day, latest_delivery
from tidemark.plans.features import ORACLES as FEATURES
from tidemark.plans.features import a08_w13_sentiment
from tidemark.plans.shared import ARTICLES, BARS, PRICES, SERIES, articles, bars, series
from tidemark.tables import table

K = "ticker_id"
AS_OF = "2024-12-31"
INDICATORS = ["sma_20", "sma_50", "ema_20", "rsi_14", "macd", "macd_signal", "bollinger_upper", "bollinger_lower"]
FILING = [
    "report_date", "filing_date", "market_cap", "pe_ratio", "eps", "revenue", "net_income", "operating_income", "total_assets", "total_liabilities", "stockholder_equity", "total_debt", "cash_and_equivalents", "revenue_qoq_pct",
    "revenue_yoy_pct",
]
SECTIONS = ["technical", "recent_articles", "older_articles", "sentiment_features", "macro", "insider_transactions", "analyst_recommendations"]


# Filings dated before their report can't be true: as in p3_found they never count, nor do those without either date.
_TRUE = "f.filing_date >= f.report_date"


def spine(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker_id, as_of): the days on which something was recommended."""
    return table(spark, folder, "analyst_recommendations").where("ticker_id is not null and date is not null").select(K, F.col("date").alias("as_of")).distinct()


def _last_index(asks: DataFrame, rows: DataFrame, day: str) -> DataFrame:
    """`asks` with `last`, the index `i` of the ticker's last row before as_of; without one it is left out."""
    found = as_known(asks, rows, K, "as_of", F.col(day), [F.col("i")], ["i"], how="inner")
    return found.withColumn("last", F.col("as_known.i").cast("long")).drop("as_known")


def _last_rows(asks: DataFrame, rows: DataFrame, day: str, n: int) -> DataFrame:
    """The last n rows before as_of: the index is exploded, and joined by equality."""
    asked = _last_index(asks, rows, day)
    asked = asked.withColumn("i", F.explode(F.sequence(F.greatest(F.col("last") - n + 1, F.lit(0)), F.col("last"))))
    return asked.join(rows.withColumn("i", F.col("i").cast("long")), [K, "i"])


def t01_last_bars(spark: SparkSession, folder: str) -> DataFrame:
    """The 30 bars before each ticker and day."""
    out = _last_rows(spine(spark, folder), series(spark, folder), "date", 30)
    return out.select(K, "as_of", "date", "close", (F.col("last") - F.col("i")).cast("int").alias("bars_back"))


def _news_days(spark: SparkSession, folder: str) -> DataFrame:
    days = _dated_articles(spark, folder).select(K, "day").distinct()
    return indexed(days, K, "day")


def _dated_articles(spark: SparkSession, folder: str) -> DataFrame:
    return articles(spark, folder, "news_id", "sentiment_score").select(K, F.to_date("published_at").alias("day"), "news_id", "published_at", clean_double("sentiment_score").alias("score"))


def t02_recent_news(spark: SparkSession, folder: str) -> DataFrame:
    """All articles of the three last days with articles before each ticker and day."""
    days = _last_rows(spine(spark, folder), _news_days(spark, folder), "day", 3).select(K, "as_of", "day")
    return days.join(_dated_articles(spark, folder), [K, "day"]).select(K, "as_of", "news_id")


def t03_older_news(spark: SparkSession, folder: str) -> DataFrame:
    """Of the 30 days up to the third last day with articles, the 75 best scored ones (NULL last, then latest)."""
    days = _last_rows(spine(spark, folder), _news_days(spark, folder), "day", 3).groupBy(K, "as_of").agg(F.min("day").alias("oldest"))
    start, end = F.date_sub("as_of", 30), F.date_sub("oldest", 1)
    asked = days.where(start <= end).withColumn("day", F.explode(F.sequence(start, end)))
    w = Window.partitionBy(K, "as_of").orderBy(F.desc_nulls_last("score"), F.desc("published_at"), F.desc("news_id"))
    # 75 of a day suffice: no hot day repeats more than these for every as_of
    order = [F.desc_nulls_last("score"), F.desc("published_at"), F.desc("news_id")]
    best = _dated_articles(spark, folder).withColumn("r1", F.row_number().over(Window.partitionBy(K, "day").orderBy(*order))).where("r1 <= 75").drop("r1")
    out = asked.join(best, [K, "day"]).withColumn("rn", F.row_number().over(w)).where("rn <= 75")
    return out.select(K, "as_of", "news_id", "rn")


def t04_last_insider(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 insider trades before each ticker and day, latest first."""
    t = table(spark, folder, "insider_transactions").where("ticker_id is not null and transaction_date is not null").select(K, "transaction_date", "transaction_id")
    t = ordered_index(t, [K], ["transaction_date", "transaction_id"], month_of("transaction_date"))
    out = _last_rows(spine(spark, folder), t, "transaction_date", 20)
    return out.select(K, "as_of", "transaction_id", (F.col("last") - F.col("i") + 1).cast("int").alias("rn"))


def t04_last_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 recommendations of the 90 days before each ticker and day, latest first."""
    t = table(spark, folder, "analyst_recommendations").where("ticker_id is not null and date is not null").select(K, "date", "recommendation_id")
    t = ordered_index(t, [K], ["date", "recommendation_id"], month_of("date"))
    out = _last_rows(spine(spark, folder), t, "date", 50).where(F.col("date") >= F.date_sub("as_of", 90))
    return out.select(K, "as_of", "recommendation_id", (F.col("last") - F.col("i") + 1).cast("int").alias("rn"))


def j09_inclusive_filing(spark: SparkSession, folder: str) -> DataFrame:
    """The filing of the latest filing date up to and on each day."""
    f = table(spark, folder, "fundamentals").where("filing_date >= report_date")
    out = as_known(spine(spark, folder), f, K, "as_of", F.col("filing_date"), [F.col("filing_date"), F.col("fundamental_id")], ["fundamental_id", "revenue"], strict=False)
    return out.select(K, "as_of", F.col("as_known.fundamental_id").alias("fundamental_id"), F.col("as_known.revenue").alias("revenue"))


def _observations(spark: SparkSession, folder: str) -> DataFrame:
    """Five daily series (series_id, date, value): the orders table as macroeconomic observations."""
    o = table(spark, folder, "orders")
    return o.groupBy(F.substring("o_orderpriority", 1, 1).alias("series_id"), F.to_date("o_orderdate").alias("date")).agg(F.round(F.avg("o_totalprice"), 4).alias("value"))


def j08_w15_macro(spark: SparkSession, folder: str) -> DataFrame:
    """For each calendar day and series the latest value, and its change against the one known 30 days before."""
    obs = _observations(spark, folder)
    days = obs.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("as_of"))
    asks = days.select("as_of", F.explode(F.array(*[F.lit(str(i)) for i in range(1, 6)])).alias("series_id"))
    now = as_known(asks, obs, "series_id", "as_of", F.col("date"), [F.col("date")], ["value"], strict=False)
    now = now.select("as_of", "series_id", F.col("as_known.value").alias("value"), F.date_sub("as_of", 30).alias("back"))
    then = as_known(now, obs, "series_id", "back", F.col("date"), [F.col("date")], ["value"], strict=False)
    return then.select("as_of", "series_id", "value", F.round(F.try_divide(F.col("value") - F.col("as_known.value"), F.col("as_known.value")), 6).alias("change_30"))


# Which of the five series stands for which.
MACRO = {"ten_year": "1", "two_year": "2", "cpi": "3", "gdp": "4", "unemployment": "5"}


def w15_macro_features(spark: SparkSession, folder: str) -> DataFrame:
    """For each calendar day: the ten- less the two-year yield, monthly and (times 12) yearly inflation, growth over 90 days, and the change of unemployment."""
    obs = _observations(spark, folder)
    days = obs.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    # each ask once for the day itself and once for the day it is compared with
    back = F.create_map(*[F.lit(v) for v in (MACRO["cpi"], 30, MACRO["gdp"], 90, MACRO["unemployment"], 30)])
    asks = days.select("day", F.explode(F.array(*[F.lit(v) for v in MACRO.values()])).alias("series_id")).withColumn("before", F.explode(F.array(F.lit(0), F.try_element_at(back, F.col("series_id"))))).where("before is not null")
    asks = asks.withColumn("as_of", F.date_sub("day", F.col("before")))
    known = as_known(asks, obs, "series_id", "as_of", F.col("date"), [F.col("date")], ["value"], strict=False).withColumn("value", F.col("as_known.value"))
    value = lambda name, then=False: F.max(F.when((F.col("series_id") == MACRO[name]) & ((F.col("before") > 0) == then), F.col("value")))
    g = known.groupBy("day").agg(*[value(n).alias(n) for n in MACRO], *[value(n, True).alias(f"{n}_then") for n in ("cpi", "gdp", "unemployment")])
    cpi = F.try_divide(F.col("cpi") - F.col("cpi_then"), F.col("cpi_then"))
    return g.select("day", F.round(F.col("ten_year") - F.col("two_year"), 4).alias("yield_spread"), F.round(cpi, 6).alias("cpi_monthly"), F.round(cpi * 12, 6).alias("cpi_yearly"), F.round(F.try_divide(F.col("gdp") - F.col("gdp_then"), F.abs("gdp_then")), 6).alias("gdp_growth"), F.round(F.col("unemployment") - F.col("unemployment_then"), 4).alias("unemployment_change"))


def j11_d01_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """The outcome of holding each bar three bars: out early on the first of bars 2 and 3 whose rating isn't a buy any more.

    A rating counts on its own day; only entries rated buy can be left early.
    """
    rated = table(spark, folder, "analyst_recommendations").where("ticker_id is not null").groupBy(K, "date").agg(F.max_by(F.lower(F.trim("rating")), "recommendation_id").alias("rating"))
    x = series(spark, folder).join(rated, [K, "date"], "left")
    w = Window.partitionBy(K).orderBy("i")
    at = lambda c, n: F.lead(c, n).over(w)
    out = ["hold", "sell", "strong sell"]
    x = x.withColumns({f"c{n}": at("close", n) for n in (2, 3)} | {f"d{n}": at("date", n) for n in (2, 3)} | {f"r{n}": at("rating", n) for n in (2, 3)})
    held = F.when(F.col("rating").isin("buy", "strong buy") & F.col("r2").isin(*out), 2).when(F.col("c3").isNotNull(), 3)
    early = F.col("rating").isin("buy", "strong buy") & ((F.col("held") == 2) | ((F.col("held") == 3) & F.col("r3").isin(*out)))
    x = x.withColumn("held", held).where("held is not null")
    price, day = F.when(F.col("held") == 2, F.col("c2")).otherwise(F.col("c3")), F.when(F.col("held") == 2, F.col("d2")).otherwise(F.col("d3"))
    return x.select(K, "date", "rating", day.alias("exit_date"), F.col("held").alias("days_held"), F.coalesce(early, F.lit(False)).alias("early_exit"), plain_zero(F.try_divide(price - F.col("close"), "close") * 100, 4).alias("return_pct"))


def j13_d06_calendar_exit(spark: SparkSession, folder: str) -> DataFrame:
    """The return to the third next trading day of the whole market, where the ticker has a bar that day; big moves are flagged."""
    b = bars(spark, folder)
    days = b.select("date").distinct().withColumn("d", F.year("date"))
    # the market's calendar: one row a day, numbered
    days = indexed(days.withColumn("one", F.lit(1)), "one", "date").select("date", "i")
    exits = days.select(F.col("date").alias("exit_date"), (F.col("i") - 3).alias("i"))
    x = b.join(days, "date").join(exits, "i").select(K, "date", "close", "exit_date")
    x = x.join(b.select(K, F.col("date").alias("exit_date"), F.col("close").alias("exit_price")), [K, "exit_date"])
    r = F.round(F.try_divide(F.col("exit_price") - F.col("close"), "close") * 100, 4)
    return x.select(K, "date", "exit_date", F.when(r == 0, 0.0).otherwise(r).alias("return_pct"), (F.abs(r) >= 5).alias("big_move"), F.datediff("exit_date", "date").alias("calendar_days"))


def a07_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """First day, last day and rows of each ticker in each kind of data."""
    kinds = {"bars": ("market_data", "date"), "filings": ("fundamentals", "filing_date"), "news": ("news", "published_at"), "insider": ("insider_transactions", "transaction_date"), "ratings": ("analyst_recommendations", "date")}
    out = None
    for kind, (name, day) in kinds.items():
        part = table(spark, folder, name).where("ticker_id is not null").groupBy(K).agg(F.to_date(F.min(day)).alias("first_day"), F.to_date(F.max(day)).alias("last_day"), F.count("*").alias("n")).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def d31_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """How stale each ticker's data are on AS_OF, by what was there before it: filings after 90 days, news after 30, bars after 7."""
    limits = {"filings": ("fundamentals", "filing_date", 90), "news": ("news", "published_at", 30), "bars": ("market_data", "date", 7)}
    as_of = F.lit(AS_OF).cast("date")
    asks = table(spark, folder, "tickers").select(K, F.explode(F.array(*[F.lit(k) for k in limits])).alias("kind"))
    last = None
    for kind, (name, day, _) in limits.items():
        part = table(spark, folder, name).where(F.to_date(day) < as_of).groupBy(K).agg(F.to_date(F.max(day)).alias("last_day")).withColumn("kind", F.lit(kind))
        last = part if last is None else last.unionByName(part)
    x = asks.join(last, [K, "kind"], "left").withColumn("days", F.datediff(as_of, "last_day"))
    limit = F.create_map(*[F.lit(v) for k, (_, _, n) in limits.items() for v in (k, n)])[F.col("kind")]
    return x.select(K, "kind", "days", F.when(F.col("days").isNull(), "missing").when(F.col("days") <= limit, "fresh").otherwise("stale").alias("state"))


def _weekday_index(day: Column) -> Column:
    """Weekdays since Monday 1970-01-05, for a weekday."""
    d = F.datediff(day, F.expr("DATE'1970-01-05'"))
    return F.floor(d / 7) * 5 + F.pmod(d, F.lit(7))


def a32_d32_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of weekdays without a bar between each ticker's first and last: islands of the weekday calendar."""
    b = bars(spark, folder).select(K, "date")
    spans = b.groupBy(K).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = spans.select(K, F.explode(F.sequence("a", "b")).alias("date")).where(F.weekday("date") < 5)
    missing = days.join(b, [K, "date"], "left_anti").withColumn("k", _weekday_index(F.col("date")))
    missing = missing.withColumn("run", F.col("k") - F.row_number().over(Window.partitionBy(K).orderBy("date")))
    return missing.groupBy(K, "run").agg(F.min("date").alias("gap_start"), F.max("date").alias("gap_end"), F.count("*").alias("weekdays")).drop("run")


def d33_news_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Articles before each ticker and day by the trading day they fall after: the last 1-3, 4-10 and 11-30."""
    rows = series(spark, folder).select(K, "date", F.col("i").cast("long").alias("i"))
    news = as_known(_dated_articles(spark, folder), rows, K, "day", F.col("date"), [F.col("i")], ["i"], strict=False, how="inner")
    per_bar = news.groupBy(K, F.col("as_known.i").alias("i"), "day").agg(F.count("*").alias("n"))
    asked = _last_index(spine(spark, folder), rows, "date").withColumn("i", F.explode(F.sequence(F.greatest(F.col("last") - 29, F.lit(0).cast("long")), F.col("last"))))
    hit = asked.join(per_bar, [K, "i"]).where("day < as_of").withColumn("back", F.col("last") - F.col("i") + 1)
    part = lambda lo, hi: F.coalesce(F.sum(F.when(F.col("back").between(lo, hi), F.col("n"))), F.lit(0))
    return hit.groupBy(K, "as_of").agg(part(1, 3).alias("recent"), part(4, 10).alias("middle"), part(11, 30).alias("older"))


def j16_d34_last_days(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of the market's last 11 trading days (membership in a set of dates)."""
    b = bars(spark, folder)
    last = b.select("date").distinct().orderBy(F.desc("date")).limit(11)
    return b.join(last, "date", "left_semi").select(K, "date", "close")


def j15_windowed_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """Articles and mean score of the 7, 30 and 90 days before each ticker and day.

    Scores are summed by day first; days with articles and days asked for are
    one line a ticker, two rows a day at most, under range windows. Days asked
    for aren't exploded: Spark takes an exploded side for as small as it was
    before, and would gather it on the driver for a broadcast join.
    """
    daily = _dated_articles(spark, folder).where("day is not null").groupBy(K, "day").agg(F.count("*").alias("n"), F.sum("score").alias("s"), F.count("score").alias("c"))
    line = daily.unionByName(spine(spark, folder).withColumn("day", F.col("as_of")), allowMissingColumns=True)
    out = []
    for d in (7, 30, 90):
        w = Window.partitionBy(K).orderBy(epoch_day("day")).rangeBetween(-d, -1)
        out += [F.coalesce(F.sum("n").over(w), F.lit(0)).alias(f"articles_{d}"), F.try_divide(F.round(F.sum("s").over(w), 4), F.sum("c").over(w)).alias(f"mean_score_{d}")]
    return line.select(K, "as_of", *out).where("as_of is not null and articles_90 > 0")


def d27_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each distinct content (headline, time, summary)."""
    n = table(spark, folder, "news").withColumn("content_hash", F.sha2(F.concat(F.coalesce("headline", F.lit("")), F.lit("|"), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"), F.lit("|"), F.coalesce("summary", F.lit(""))), 256))
    return n.groupBy("content_hash").agg(F.min("news_id").alias("news_id"), F.count("*").alias("copies"))


def d28_age_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of each ticker by age at the end and against its latest article."""
    a = _dated_articles(spark, folder)
    latest = a.groupBy(K).agg(F.max("day").alias("latest"))
    age, own = F.datediff(F.lit(AS_OF).cast("date"), "day"), F.datediff("latest", "day")
    tier = lambda c, *b: F.when(c <= 7, "recent").when(c <= 30, "medium").when(c <= b[0], "historical") if b else F.when(c <= 7, "recent").when(c <= 30, "medium").otherwise("historical")
    x = a.join(latest, K).select(K, tier(age, 90).alias("tier"), tier(own).alias("own_tier"))
    return x.where("tier is not null").groupBy(K, "tier", "own_tier").count().withColumnRenamed("count", "n")


def d29_point_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """One record a ticker and day: the last 30 bars, the filing known, the last trades and the recent articles, nothing of the day itself or later."""
    asks = spine(spark, folder)
    f = table(spark, folder, "fundamentals").where("filing_date >= report_date")
    filing = as_known(asks, f, K, "as_of", F.col("filing_date"), [F.col("filing_date"), F.col("fundamental_id")], ["fundamental_id"]).select(K, "as_of", F.col("as_known.fundamental_id").alias("fundamental_id"))
    technical = t01_last_bars(spark, folder).groupBy(K, "as_of").agg(F.count("*").alias("n_bars"), F.max_by("close", "date").alias("last_close"), F.max("date").cast("string").alias("last_bar"))
    trades = t04_last_insider(spark, folder).groupBy(K, "as_of").agg(F.array_join(F.transform(F.sort_array(F.collect_list("transaction_id")), lambda x: x.cast("string")), ",").alias("trades"))
    news = t02_recent_news(spark, folder).groupBy(K, "as_of").agg(F.count("*").alias("n_news"), F.max("news_id").alias("last_news"))
    out = filing.join(technical, [K, "as_of"], "left").join(trades, [K, "as_of"], "left").join(news, [K, "as_of"], "left")
    return out


def point_in_time_records(spark: SparkSession, folder: str) -> DataFrame:
    """One nested record a ticker and day, nothing of the day itself or later.

    technical: the last 30 bars with their indicators; fundamentals: the filing
    known; recent_articles with their content and older_articles with their
    summary; sentiment_features: the days with news of the last 7; macro: the
    latest value of each series; the last 20 insider_transactions and up to 50
    analyst_recommendations. Lists start with `pos` and are empty where nothing
    is known; all but the older articles, the best scored first, go from the
    latest back.
    """
    asks = spine(spark, folder)
    numbered = lambda *order: F.row_number().over(Window.partitionBy(K, "as_of").orderBy(*order)).alias("pos")

    def gathered(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(K, "as_of").agg(F.sort_array(F.collect_list(F.struct("pos", *[c for c in rows.columns if c not in (K, "as_of", "pos")]))).alias(name))

    raw = table(spark, folder, "market_data").where("ticker_id is not null and date is not null")
    full = latest_delivery(raw, [K, "date"], ["created_at", "market_data_id"], [*PRICES, "volume", *INDICATORS])
    full = full.withColumns({c: clean_double(c) for c in [*PRICES, *INDICATORS]})
    technical = t01_last_bars(spark, folder).select(K, "as_of", "date", (F.col("bars_back") + 1).alias("pos")).join(full, [K, "date"])

    filings = table(spark, folder, "fundamentals").where("filing_date >= report_date")
    out = as_known(asks, filings, K, "as_of", F.col("filing_date"), [F.col("filing_date"), F.col("fundamental_id")], ["fundamental_id", *FILING]).withColumnRenamed("as_known", "fundamentals")

    n = table(spark, folder, "news").select("news_id", "published_at", "headline", "source", "url", clean_double("sentiment_score").alias("sentiment_score"), "sentiment_label", "summary")
    recent = t02_recent_news(spark, folder).join(n.withColumnRenamed("summary", "content"), "news_id")
    recent = recent.select("*", numbered(F.desc("published_at"), F.desc("news_id")))
    older = t03_older_news(spark, folder).withColumnRenamed("rn", "pos").join(n, "news_id")

    week = asks.withColumn("date", F.explode(F.sequence(F.date_sub("as_of", 7), F.date_sub("as_of", 1))))
    sentiment = week.join(a08_w13_sentiment(spark, folder).select(K, "date", "sentiment_7", "articles_7", "article_count"), [K, "date"])
    sentiment = sentiment.select("*", numbered(F.desc("date")))

    obs = _observations(spark, folder)
    days = asks.select("as_of").distinct().select("as_of", F.explode(F.array(*[F.lit(str(i)) for i in range(1, 6)])).alias("series_id"))
    macro = as_known(days, obs, "series_id", "as_of", F.col("date"), [F.col("date")], ["date", "value"], how="inner")
    macro = macro.groupBy("as_of").agg(F.sort_array(F.collect_list(F.struct(F.col("series_id").cast("int").alias("pos"), "series_id", "as_known.date", "as_known.value"))).alias("macro"))

    t = table(spark, folder, "insider_transactions").select("transaction_id", "transaction_date", "owner_name", "transaction_code", "shares", "transaction_price", "transaction_amount", "shares_owned_after")
    trades = t04_last_insider(spark, folder).withColumnRenamed("rn", "pos").join(t, "transaction_id")
    r = table(spark, folder, "analyst_recommendations").select("recommendation_id", "date", "firm", "firm_id", "action", "rating", "target_price", "analyst_insights", "updated_timestamp")
    ratings = t04_last_ratings(spark, folder).withColumnRenamed("rn", "pos").join(r, "recommendation_id")

    for rows, name in ((technical, "technical"), (recent, "recent_articles"), (older, "older_articles"), (sentiment, "sentiment_features"), (trades, "insider_transactions"), (ratings, "analyst_recommendations")):
        out = out.join(gathered(rows, name), [K, "as_of"], "left")
    out = out.join(macro, "as_of", "left")
    return out.select(K, "as_of", "fundamentals", *[F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c) for c in SECTIONS])


def d29_d30_record_items(spark: SparkSession, folder: str) -> DataFrame:
    """The point-in-time records, one row for each entry of a list and for the filing, with its text and two of its numbers."""
    number = lambda c: c.cast("double")
    text = lambda *cs: F.concat_ws("|", *cs)

    def item(section: str, pos: Column, key: Column, day: Column, words: Column, value: Column, other: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), pos.cast("int").alias("pos"), key.cast("string").alias("item"), day.cast("date").alias("day"), words.cast("string").alias("text"), number(value).alias("value"), number(other).alias("other"))

    none = F.lit(None)
    parts = {
        "technical": lambda x: item("technical", x["pos"], x["date"], x["date"], none, x["close"], x["rsi_14"]),
        "recent_articles": lambda x: item("recent_articles", x["pos"], x["news_id"], x["published_at"], text(x["headline"], x["source"], x["content"]), x["sentiment_score"], none),
        "older_articles": lambda x: item("older_articles", x["pos"], x["news_id"], x["published_at"], text(x["headline"], x["source"], x["summary"]), x["sentiment_score"], none),
        "sentiment_features": lambda x: item("sentiment_features", x["pos"], x["date"], x["date"], none, x["sentiment_7"], x["article_count"]),
        "macro": lambda x: item("macro", x["pos"], x["series_id"], x["date"], none, x["value"], none),
        "insider_transactions": lambda x: item("insider_transactions", x["pos"], x["transaction_id"], x["transaction_date"], text(x["owner_name"], x["transaction_code"]), x["shares"], x["transaction_price"]),
        "analyst_recommendations": lambda x: item("analyst_recommendations", x["pos"], x["recommendation_id"], x["date"], text(x["firm"], x["rating"], x["analyst_insights"]), x["target_price"], none),
    }
    f = F.col("fundamentals")
    filing = F.when(f.isNotNull(), F.array(item("fundamentals", F.lit(1), f["fundamental_id"], f["filing_date"], none, f["revenue"], f["eps"])))
    lists = [F.coalesce(filing, F.filter(F.array(item("fundamentals", F.lit(1), none, none, none, none, none)), lambda x: F.lit(False))), *[F.transform(c, parts[c]) for c in SECTIONS]]
    return point_in_time_records(spark, folder).select(K, "as_of", F.explode(F.concat(*lists)).alias("x")).select(K, "as_of", "x.*")


QUERIES = {f.__name__: f for f in (
    t01_last_bars, t02_recent_news, t03_older_news, t04_last_insider, t04_last_ratings, j09_inclusive_filing, j08_w15_macro, w15_macro_features, j11_d01_outcomes, j13_d06_calendar_exit, j15_windowed_lookback, j16_d34_last_days,
    a07_coverage, a32_d32_gaps, d27_first_seen, d28_age_tiers, d29_point_in_time, d29_d30_record_items, d31_freshness, d33_news_buckets,
)}

_SPINE = "spine AS (SELECT DISTINCT ticker_id, date AS as_of FROM analyst_recommendations WHERE ticker_id IS NOT NULL AND date IS NOT NULL)"
_DATED = ARTICLES + ", art AS (SELECT ticker_id, CAST(published_at AS DATE) AS day, news_id, published_at, sentiment_score AS score FROM articles)"
_LAST_BARS = f"""{BARS}, {_SPINE}, lb AS (SELECT s.ticker_id, s.as_of, b.date, b.close, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY b.date DESC) AS rn
  FROM spine s JOIN bars b ON b.ticker_id = s.ticker_id AND b.date < s.as_of)"""
_DAYS3 = f"""{_DATED}, days AS (SELECT DISTINCT ticker_id, day FROM art),
d3 AS (SELECT s.ticker_id, s.as_of, d.day, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY d.day DESC) AS rn FROM spine s JOIN days d ON d.ticker_id = s.ticker_id AND d.day < s.as_of)"""
_TRADES = """tr AS (SELECT s.ticker_id, s.as_of, t.transaction_id, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY t.transaction_date DESC, t.transaction_id DESC) AS rn
  FROM spine s JOIN insider_transactions t ON t.ticker_id = s.ticker_id AND t.transaction_date < s.as_of)"""
_OBS = """obs AS (SELECT substr(o_orderpriority, 1, 1) AS series_id, CAST(o_orderdate AS DATE) AS date, round(avg(o_totalprice), 4) AS value FROM orders GROUP BY 1, 2)"""
_COVER = " UNION ALL ".join(
    f"SELECT '{k}' AS kind, ticker_id, CAST(min({d}) AS DATE) AS first_day, CAST(max({d}) AS DATE) AS last_day, count(*) AS n FROM {t} WHERE ticker_id IS NOT NULL GROUP BY ticker_id"
    for k, t, d in (("bars", "market_data", "date"), ("filings", "fundamentals", "filing_date"), ("news", "news", "published_at"), ("insider", "insider_transactions", "transaction_date"), ("ratings", "analyst_recommendations", "date"))
)
ORACLES = {
    "t01_last_bars": f"WITH {_LAST_BARS} SELECT ticker_id, as_of, date, close, CAST(rn - 1 AS INTEGER) AS bars_back FROM lb WHERE rn <= 30",
    "t02_recent_news": f"WITH {_SPINE}, {_DAYS3} SELECT d3.ticker_id, as_of, news_id FROM d3 JOIN art USING (ticker_id, day) WHERE rn <= 3",
    "t03_older_news": f"""WITH {_SPINE}, {_DAYS3}, o AS (SELECT ticker_id, as_of, min(day) AS oldest FROM d3 WHERE rn <= 3 GROUP BY 1, 2),
r AS (SELECT o.ticker_id, as_of, news_id, row_number() OVER (PARTITION BY o.ticker_id, as_of ORDER BY score DESC NULLS LAST, published_at DESC, news_id DESC) AS rn
  FROM o JOIN art ON art.ticker_id = o.ticker_id AND art.day < o.oldest AND art.day >= o.as_of - 30) SELECT ticker_id, as_of, news_id, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 75""",
    "t04_last_insider": f"WITH {_SPINE}, {_TRADES} SELECT ticker_id, as_of, transaction_id, CAST(rn AS INTEGER) AS rn FROM tr WHERE rn <= 20",
    "t04_last_ratings": f"""WITH {_SPINE}, r AS (SELECT s.ticker_id, s.as_of, t.recommendation_id, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY t.date DESC, t.recommendation_id DESC) AS rn
  FROM spine s JOIN analyst_recommendations t ON t.ticker_id = s.ticker_id AND t.date < s.as_of AND t.date >= s.as_of - 90) SELECT ticker_id, as_of, recommendation_id, CAST(rn AS INTEGER) AS rn FROM r WHERE rn <= 50""",
    "j09_inclusive_filing": f"""WITH {_SPINE}, r AS (SELECT s.ticker_id, s.as_of, f.fundamental_id, f.revenue, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY f.filing_date DESC NULLS LAST, f.fundamental_id DESC) AS rn
  FROM spine s LEFT JOIN fundamentals f ON f.ticker_id = s.ticker_id AND f.filing_date <= s.as_of AND {_TRUE}) SELECT ticker_id, as_of, fundamental_id, revenue FROM r WHERE rn = 1""",
    "j08_w15_macro": f"""WITH {_OBS}, d AS (SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS as_of FROM obs),
a AS (SELECT as_of, as_of - 30 AS back, CAST(k AS VARCHAR) AS series_id FROM d, range(1, 6) t(k)),
n AS (SELECT a.*, o.value FROM a ASOF LEFT JOIN obs o ON o.series_id = a.series_id AND o.date <= a.as_of), p AS (SELECT n.*, o.value AS prev FROM n ASOF LEFT JOIN obs o ON o.series_id = n.series_id AND o.date <= CAST(n.back AS DATE))
SELECT as_of, series_id, value, round((value - prev) / nullif(prev, 0), 6) AS change_30 FROM p""",
    "w15_macro_features": f"""WITH {_OBS}, d AS (SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM obs),
a AS (SELECT day, CAST(k AS VARCHAR) AS series_id, day - b AS as_of, b FROM d, (VALUES (1, 0), (2, 0), (3, 0), (3, 30), (4, 0), (4, 90), (5, 0), (5, 30)) v(k, b)), n AS (SELECT a.*, o.value FROM a ASOF LEFT JOIN obs o ON o.series_id = a.series_id AND o.date <= CAST(a.as_of AS DATE)),
p AS (SELECT day, {", ".join(f"max(value) FILTER (series_id = '{k}' AND {'b > 0' if t else 'b = 0'}) AS v{k}{t}" for k, t in (("1", ""), ("2", ""), ("3", ""), ("3", "p"), ("4", ""), ("4", "p"), ("5", ""), ("5", "p")))} FROM n GROUP BY 1)
SELECT day, round(v1 - v2, 4) AS yield_spread, round((v3 - v3p) / nullif(v3p, 0), 6) AS cpi_monthly, round((v3 - v3p) / nullif(v3p, 0) * 12, 6) AS cpi_yearly, round((v4 - v4p) / nullif(abs(v4p), 0), 6) AS gdp_growth, round(v5 - v5p, 4) AS unemployment_change FROM p""",
    "j11_d01_outcomes": f"""WITH {SERIES}, ra AS (SELECT ticker_id, date, arg_max(struct_pack(r := lower(trim(rating))), recommendation_id).r AS rating FROM analyst_recommendations WHERE ticker_id IS NOT NULL GROUP BY 1, 2),
x AS (SELECT s.*, ra.rating AS rating FROM s LEFT JOIN ra USING (ticker_id, date)),
y AS (SELECT *, lead(close, 2) OVER w AS c2, lead(close, 3) OVER w AS c3, lead(date, 2) OVER w AS d2, lead(date, 3) OVER w AS d3, lead(rating, 2) OVER w AS r2, lead(rating, 3) OVER w AS r3 FROM x WINDOW w AS (PARTITION BY ticker_id ORDER BY i)),
z AS (SELECT *, coalesce(rating IN ('buy', 'strong buy'), false) AS bought, CASE WHEN rating IN ('buy', 'strong buy') AND r2 IN ('hold', 'sell', 'strong sell') THEN 2 WHEN c3 IS NOT NULL THEN 3 END AS held FROM y),
v AS (SELECT *, CASE held WHEN 2 THEN c2 ELSE c3 END AS p FROM z WHERE held IS NOT NULL)
SELECT ticker_id, date, rating, CASE held WHEN 2 THEN d2 ELSE d3 END AS exit_date, CAST(held AS INTEGER) AS days_held, bought AND (held = 2 OR coalesce(r3 IN ('hold', 'sell', 'strong sell'), false)) AS early_exit,
  CASE WHEN round((p - close) / nullif(close, 0) * 100, 4) = 0 THEN 0.0 ELSE round((p - close) / nullif(close, 0) * 100, 4) END AS return_pct FROM v""",
    "j13_d06_calendar_exit": f"""WITH {BARS}, d AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM bars)),
x AS (SELECT b.ticker_id, b.date, b.close, e.date AS exit_date, y.close AS p FROM bars b JOIN d ON d.date = b.date JOIN d e ON e.i = d.i + 3 JOIN bars y ON y.ticker_id = b.ticker_id AND y.date = e.date),
r AS (SELECT *, round((p - close) / nullif(close, 0) * 100, 4) AS r FROM x)
SELECT ticker_id, date, exit_date, CASE WHEN r = 0 THEN 0.0 ELSE r END AS return_pct, abs(r) >= 5 AS big_move, CAST(date_diff('day', date, exit_date) AS INTEGER) AS calendar_days FROM r""",
    "j15_windowed_lookback": f"""WITH {_SPINE}, {_DATED}, h AS (SELECT s.ticker_id, s.as_of, score, date_diff('day', day, s.as_of) AS back FROM spine s JOIN art ON art.ticker_id = s.ticker_id AND art.day < s.as_of AND art.day >= s.as_of - 90)
SELECT ticker_id, as_of, {", ".join(f"count(*) FILTER (back <= {d}) AS articles_{d}, round(sum(score) FILTER (back <= {d}), 4) / nullif(count(score) FILTER (back <= {d}), 0) AS mean_score_{d}" for d in (7, 30, 90))} FROM h GROUP BY 1, 2""",
    "j16_d34_last_days": f"WITH {BARS} SELECT ticker_id, date, close FROM bars WHERE date IN (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 11)",
    "a07_coverage": _COVER,
    "a32_d32_gaps": f"""WITH {BARS}, sp AS (SELECT ticker_id, min(date) AS a, max(date) AS b FROM bars GROUP BY 1), d AS (SELECT ticker_id, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM sp),
k AS (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY date) AS k FROM d WHERE isodow(date) < 6), m AS (SELECT k.*, k - row_number() OVER (PARTITION BY ticker_id ORDER BY date) AS run FROM k ANTI JOIN bars USING (ticker_id, date))
SELECT ticker_id, min(date) AS gap_start, max(date) AS gap_end, count(*) AS weekdays FROM m GROUP BY ticker_id, run""",
    "d27_first_seen": "SELECT sha256(coalesce(headline, '') || '|' || strftime(published_at, '%Y-%m-%d %H:%M:%S') || '|' || coalesce(summary, '')) AS content_hash, min(news_id) AS news_id, count(*) AS copies FROM news GROUP BY 1",
    "d28_age_tiers": f"""WITH {_DATED}, l AS (SELECT *, max(day) OVER (PARTITION BY ticker_id) AS latest FROM art), t AS (SELECT ticker_id, date_diff('day', day, DATE '{AS_OF}') AS age, date_diff('day', day, latest) AS own FROM l)
SELECT ticker_id, CASE WHEN age <= 7 THEN 'recent' WHEN age <= 30 THEN 'medium' ELSE 'historical' END AS tier, CASE WHEN own <= 7 THEN 'recent' WHEN own <= 30 THEN 'medium' ELSE 'historical' END AS own_tier, count(*) AS n FROM t WHERE age <= 90 GROUP BY 1, 2, 3""",
    "d29_point_in_time": f"""WITH {_LAST_BARS}, {_DAYS3}, {_TRADES}, f AS (SELECT s.ticker_id, s.as_of, arg_max(f.fundamental_id, (f.filing_date, f.fundamental_id)) AS fundamental_id FROM spine s LEFT JOIN fundamentals f ON f.ticker_id = s.ticker_id AND f.filing_date < s.as_of AND {_TRUE} GROUP BY 1, 2),
t AS (SELECT ticker_id, as_of, count(*) AS n_bars, arg_max(close, date) AS last_close, CAST(max(date) AS VARCHAR) AS last_bar FROM lb WHERE rn <= 30 GROUP BY 1, 2), i AS (SELECT ticker_id, as_of, string_agg(CAST(transaction_id AS VARCHAR), ',' ORDER BY transaction_id) AS trades FROM tr WHERE rn <= 20 GROUP BY 1, 2),
n AS (SELECT d3.ticker_id, as_of, count(*) AS n_news, max(news_id) AS last_news FROM d3 JOIN art USING (ticker_id, day) WHERE rn <= 3 GROUP BY 1, 2)
SELECT * FROM f LEFT JOIN t USING (ticker_id, as_of) LEFT JOIN i USING (ticker_id, as_of) LEFT JOIN n USING (ticker_id, as_of)""",
    "d29_d30_record_items": f"""WITH {_LAST_BARS}, {_DAYS3}, {_TRADES}, {_OBS},
o AS (SELECT ticker_id, as_of, min(day) AS oldest FROM d3 WHERE rn <= 3 GROUP BY 1, 2),
old AS (SELECT o.ticker_id, as_of, news_id, row_number() OVER (PARTITION BY o.ticker_id, as_of ORDER BY score DESC NULLS LAST, published_at DESC, news_id DESC) AS rn
  FROM o JOIN art ON art.ticker_id = o.ticker_id AND art.day < o.oldest AND art.day >= o.as_of - 30),
rec AS (SELECT d3.ticker_id, as_of, news_id, row_number() OVER (PARTITION BY d3.ticker_id, as_of ORDER BY published_at DESC, news_id DESC) AS rn FROM d3 JOIN art USING (ticker_id, day) WHERE d3.rn <= 3),
full_bars AS (SELECT ticker_id, date, arg_max(struct_pack(v := rsi_14), (created_at, market_data_id)).v AS rsi_14 FROM market_data WHERE ticker_id IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
fil AS (SELECT s.ticker_id, s.as_of, f.*, row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY f.filing_date DESC, f.fundamental_id DESC) AS rn FROM spine s JOIN fundamentals f ON f.ticker_id = s.ticker_id AND f.filing_date < s.as_of AND {_TRUE}),
rat AS (SELECT s.ticker_id, s.as_of, t.* EXCLUDE (ticker_id), row_number() OVER (PARTITION BY s.ticker_id, s.as_of ORDER BY t.date DESC, t.recommendation_id DESC) AS rn
  FROM spine s JOIN analyst_recommendations t ON t.ticker_id = s.ticker_id AND t.date < s.as_of AND t.date >= s.as_of - 90),
feat AS ({FEATURES["a08_w13_sentiment"]}), mac AS (SELECT a.as_of, o.* FROM (SELECT as_of, CAST(k AS VARCHAR) AS series_id FROM (SELECT DISTINCT as_of FROM spine), range(1, 6) t(k)) a ASOF JOIN obs o ON o.series_id = a.series_id AND o.date < a.as_of)
SELECT ticker_id, as_of, 'technical' AS section, CAST(rn AS INTEGER) AS pos, CAST(date AS VARCHAR) AS item, date AS day, NULL::VARCHAR AS text, close AS value, rsi_14 AS other FROM lb JOIN full_bars USING (ticker_id, date) WHERE rn <= 30
UNION ALL SELECT rec.ticker_id, as_of, 'recent_articles', CAST(rn AS INTEGER), CAST(news_id AS VARCHAR), CAST(published_at AS DATE), concat_ws('|', headline, source, summary), sentiment_score, NULL FROM rec JOIN news USING (news_id)
UNION ALL SELECT old.ticker_id, as_of, 'older_articles', CAST(rn AS INTEGER), CAST(news_id AS VARCHAR), CAST(published_at AS DATE), concat_ws('|', headline, source, summary), sentiment_score, NULL FROM old JOIN news USING (news_id) WHERE rn <= 75
UNION ALL SELECT s.ticker_id, as_of, 'sentiment_features', CAST(row_number() OVER (PARTITION BY s.ticker_id, as_of ORDER BY date DESC) AS INTEGER), CAST(date AS VARCHAR), date, NULL, sentiment_7, article_count
  FROM spine s JOIN feat ON feat.ticker_id = s.ticker_id AND feat.date < s.as_of AND feat.date >= s.as_of - 7
UNION ALL SELECT s.ticker_id, s.as_of, 'macro', CAST(series_id AS INTEGER), series_id, date, NULL, value, NULL FROM spine s JOIN mac USING (as_of)
UNION ALL SELECT tr.ticker_id, as_of, 'insider_transactions', CAST(rn AS INTEGER), CAST(transaction_id AS VARCHAR), transaction_date, concat_ws('|', owner_name, transaction_code), shares, transaction_price FROM tr JOIN insider_transactions USING (transaction_id) WHERE rn <= 20
UNION ALL SELECT ticker_id, as_of, 'analyst_recommendations', CAST(rn AS INTEGER), CAST(recommendation_id AS VARCHAR), date, concat_ws('|', firm, rating, analyst_insights), target_price, NULL FROM rat WHERE rn <= 50
UNION ALL SELECT ticker_id, as_of, 'fundamentals', 1, CAST(fundamental_id AS VARCHAR), filing_date, NULL, revenue, eps FROM fil WHERE rn = 1""",
    "d31_freshness": f"""WITH c AS (SELECT 'filings' AS kind, ticker_id, filing_date AS d FROM fundamentals UNION ALL SELECT 'news', ticker_id, CAST(published_at AS DATE) FROM news UNION ALL SELECT 'bars', ticker_id, date FROM market_data),
a AS (SELECT ticker_id, kind, lim FROM tickers, (VALUES ('filings', 90), ('news', 30), ('bars', 7)) v(kind, lim)), x AS (SELECT a.ticker_id, a.kind, lim, CAST(date_diff('day', max(d), DATE '{AS_OF}') AS INTEGER) AS days FROM a LEFT JOIN c ON c.ticker_id = a.ticker_id AND c.kind = a.kind AND d < DATE '{AS_OF}' GROUP BY 1, 2, 3)
SELECT ticker_id, kind, days, CASE WHEN days IS NULL THEN 'missing' WHEN days <= lim THEN 'fresh' ELSE 'stale' END AS state FROM x""",
    "d33_news_buckets": f"""WITH {SERIES}, {_SPINE}, {_DATED}, l AS (SELECT sp.ticker_id, sp.as_of, max(s.i) AS last FROM spine sp JOIN s ON s.ticker_id = sp.ticker_id AND s.date < sp.as_of GROUP BY 1, 2),
n AS (SELECT art.ticker_id, art.day, s.i FROM art ASOF JOIN s ON s.ticker_id = art.ticker_id AND s.date <= art.day), h AS (SELECT l.ticker_id, l.as_of, l.last - n.i + 1 AS back FROM l JOIN n ON n.ticker_id = l.ticker_id AND n.day < l.as_of AND n.i BETWEEN l.last - 29 AND l.last)
SELECT ticker_id, as_of, count(*) FILTER (back BETWEEN 1 AND 3) AS recent, count(*) FILTER (back BETWEEN 4 AND 10) AS middle, count(*) FILTER (back BETWEEN 11 AND 30) AS older FROM h GROUP BY 1, 2""",
}
