"""Reporting views, health checks, and the joins and set operations they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scoring as sc
from tidemark.operators.ranks import month_of, ordered_index
from tidemark.operators.series import exact_mean
from tidemark.operators.tables import cascade_counts, latest_by, retention_counts
from tidemark.operators.trailing import clean_double
from tidemark.plans.shared import BARS, bars
from tidemark.tables import table

K = "ticker_id"
AS_OF = "2024-12-31"


def _actions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "baseline_results").withColumn("act", sc.clean_action("predicted_action"))


def a01_action_view(spark: SparkSession, folder: str) -> DataFrame:
    """Filtered aggregates of each strategy: counts, means and extremes by action, right ones over all."""
    r = _actions(spark, folder)
    on = lambda a: F.when(F.col("act") == a, F.col("actual_return"))
    return r.groupBy("strategy").agg(
        F.count("*").alias("n"), F.count_if(F.col("act") == "buy").alias("buys"), F.count_if(F.col("act") == "sell").alias("sells"),
        F.round(F.avg(on("buy")), 6).alias("mean_buy"), F.round(F.stddev_samp(on("sell")), 6).alias("deviation_sell"), F.min(on("hold")).alias("least_hold"), F.max(on("hold")).alias("most_hold"),
        F.round(F.try_divide(F.count_if("correct"), F.count("correct")), 6).alias("accuracy"),
    )


def a02_dataset_stats(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "rlvr_examples")
    return e.groupBy("dataset_split", "source").agg(
        F.count("*").alias("n"), F.countDistinct("metadata.ticker").alias("tickers"), F.round(F.avg("ground_truth.actual_return_pct"), 6).alias("mean_return"),
        F.min("metadata.entry_date").alias("first_date"), F.max("metadata.entry_date").alias("last_date"), F.round(F.avg(F.length(F.element_at("messages", 2)["content"])) / 1024, 6).alias("mean_kb"),
    )


def a03_pivot_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Per ticker: answers, those that succeeded, failed or name no action, the share that succeeded in percent, and how many of these say each action."""
    r = _actions(spark, folder)
    good = F.col("error").isNull() & F.col("act").isNotNull()
    return r.groupBy("ticker").agg(
        F.count("*").alias("total"), F.count_if(good).alias("successful"), F.count("error").alias("errors"), F.count_if(F.col("error").isNull() & F.col("act").isNull()).alias("invalid"),
        F.round(F.count_if(good) / F.count("*") * 100, 2).alias("success_rate_pct"), *[F.count_if(good & (F.col("act") == a)).alias(f"n_{a}") for a in sc.EXPECTED],
    )


def a04_action_performance(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy, returns and return over deviation of each action, in the order strong buy to strong sell."""
    r = _actions(spark, folder).where("actual_return is not null and act is not null")
    position = sc.choose(F.col("act"), {a: float(i) for i, a in enumerate(sc.EXPECTED, 1)}).cast("int")
    g = r.groupBy("act", position.alias("position")).agg(F.count("*").alias("n"), F.count_if("correct").alias("correct"), F.avg("actual_return").alias("m"), F.stddev_samp("actual_return").alias("sd"))
    g = g.select("act", "position", "n", "correct", F.round(F.col("correct") / F.col("n") * 100, 2).alias("accuracy_pct"), F.round("m", 4).alias("mean_return"), F.round("sd", 4).alias("deviation"), F.round(F.try_divide("m", "sd"), 6).alias("ratio"))
    return g.orderBy("position")


def a05_daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    r = _actions(spark, folder)
    return r.groupBy(F.to_date(F.date_trunc("day", "created_at")).alias("day")).agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"), F.count("error").alias("errors"), F.sum("usage.total_tokens").alias("tokens"))


def a06_j17_ticker_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Each ticker with counts and latest values of its data: pre-aggregated, then joined."""
    t = table(spark, folder, "tickers").select(K, "symbol", "sector")
    news = table(spark, folder, "news").groupBy(K).agg(F.count("*").alias("articles"), F.to_date(F.max("published_at")).cast("string").alias("last_article"))
    last = latest_by(table(spark, folder, "fundamentals").where("filing_date is not null").select(K, "filing_date", "fundamental_id", "revenue"), [K], ["filing_date", "fundamental_id"])
    trades = table(spark, folder, "insider_transactions").groupBy(K).agg(F.count("*").alias("trades"), F.countDistinct("owner_name").alias("owners"))
    out = t.join(news, K, "left").join(last.select(K, F.col("fundamental_id").alias("last_filing"), "revenue"), K, "left").join(trades, K, "left")
    return out.fillna(0, ["articles", "trades", "owners"])


def a27_filings_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "fundamentals").groupBy(F.year("report_date").alias("year")).agg(F.count("*").alias("n"), F.countDistinct(K).alias("tickers"))


def a27_top_tickers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "news").where("ticker_id is not null").groupBy(K).agg(F.count("*").alias("n")).orderBy(F.desc("n"), K).limit(10)


def j04_stale_tickers(spark: SparkSession, folder: str) -> DataFrame:
    """Tickers whose last filing is old (semi join with a HAVING)."""
    old = table(spark, folder, "fundamentals").groupBy(K).agg(F.max("filing_date").alias("m")).where(F.col("m") < F.lit("2024-10-01").cast("date"))
    return table(spark, folder, "tickers").join(old, K, "left_semi").select(K, "symbol")


def a29_counts(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for name in ("tickers", "market_data", "fundamentals", "news", "insider_transactions", "analyst_recommendations", "rlvr_examples", "baseline_results"):
        part = table(spark, folder, name).agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def a30_health(spark: SparkSession, folder: str) -> DataFrame:
    """Five checks as rows (check, status, details): active tickers, recent bars, answers of the last week, open and all examples."""
    as_of = F.lit(AS_OF).cast("date")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("No data"))
    status = lambda ok, bad="WARNING": F.when(ok, "OK").otherwise(bad)
    n = F.count("*")
    last = F.max("date")
    split = lambda x: F.count_if(F.col("dataset_split") == x).cast("string")
    checks = [
        ("active_tickers", table(spark, folder, "tickers").where("is_active"), status(n > 0), F.concat(F.lit("Active tickers: "), text(n))),
        ("recent_market_data", table(spark, folder, "market_data"), status(last >= F.date_sub(as_of, 7)), F.concat(F.lit("Latest date: "), text(last))),
        ("answers", table(spark, folder, "baseline_results").where(F.col("created_at") >= F.date_sub(as_of, 7).cast("timestamp_ntz")), status(n > 0), F.concat(F.lit("Recent answers: "), text(n))),
        ("open_examples", table(spark, folder, "rlvr_examples").where("ground_truth is null"), F.lit("INFO"), F.concat(F.lit("Open examples: "), text(n))),
        ("rlvr_examples", table(spark, folder, "rlvr_examples"), status(n > 0, "INFO"), F.concat(F.lit("Total examples: "), text(n), F.lit(" (train: "), split("train"), F.lit(", test: "), split("test"), F.lit(")"))),
    ]
    out = None
    for name, df, state, details in checks:
        part = df.agg(state.alias("status"), details.alias("details")).select(F.lit(name).alias("check"), "status", "details")
        out = part if out is None else out.unionByName(part)
    return out


def a30_data_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Five more, a row each: what is looked for, whether it is fine, and how many offend."""
    m, n, f, i, t = (table(spark, folder, x) for x in ("market_data", "news", "fundamentals", "insider_transactions", "tickers"))
    checks = {
        "null prices": m.where("close is null"), "high below low": m.where("high < low"), "news without ticker": n.where("ticker_id is null"),
        "filings before reports": f.where("filing_date < report_date"), "trades of unknown tickers": i.join(t, K, "left_anti"),
    }
    out = None
    for name, bad in checks.items():
        part = bad.agg(F.count("*").alias("offending")).select(F.lit(name).alias("check"), F.when(F.col("offending") == 0, "ok").otherwise("warning").alias("status"), "offending")
        out = part if out is None else out.unionByName(part)
    return out


def j01_usable_results(spark: SparkSession, folder: str) -> DataFrame:
    """Examples with their listing, but for those whose stored answer (JSON) says that it was cleared."""
    e = table(spark, folder, "rlvr_examples")
    answer = F.get(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0))["content"]
    e = e.select("example_id", F.col("metadata.ticker").alias("symbol"), answer.alias("answer")).where(F.coalesce(F.get_json_object("answer", "$.cleared"), F.lit("")) != "true")
    return e.join(table(spark, folder, "tickers").select("symbol", K, "sector"), "symbol").select("example_id", K, "sector")


def j02_j03_without_filing(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "tickers").join(table(spark, folder, "fundamentals").select(K).distinct(), K, "left_anti").select(K, "symbol")


def j02_unmatched_results(spark: SparkSession, folder: str) -> DataFrame:
    """Results of a ticker and day that no bar has (anti join on two columns)."""
    t = table(spark, folder, "tickers").select("symbol", K)
    r = table(spark, folder, "baseline_results").join(t, F.col("ticker") == F.col("symbol")).select("result_id", K, F.to_date("entry_date").alias("date"))
    return r.join(bars(spark, folder).select(K, "date"), [K, "date"], "left_anti").select("result_id", K)


def j05_j06_rating_coverage(spark: SparkSession, folder: str) -> DataFrame:
    t, a = table(spark, folder, "tickers").select(K, "symbol"), table(spark, folder, "analyst_recommendations").select(K, "firm", "recommendation_id")
    return t.join(a, K, "left").groupBy(K, "symbol").agg(F.count("recommendation_id").alias("n"), F.countDistinct("firm").alias("firms"))


def w01_lag_delta(spark: SparkSession, folder: str) -> DataFrame:
    w = Window.partitionBy(K).orderBy("date")
    b = bars(spark, folder).withColumn("prev", F.lag("close").over(w))
    return b.select(K, "date", "prev", F.round(F.col("close") - F.col("prev"), 4).alias("delta"))


def w02_renumber(spark: SparkSession, folder: str) -> DataFrame:
    """Each ticker's trades renumbered by day; only those whose number isn't their id's."""
    t = table(spark, folder, "insider_transactions").where("ticker_id is not null and transaction_date is not null").select(K, "transaction_date", "transaction_id")
    t = ordered_index(t, [K], ["transaction_date", "transaction_id"], month_of("transaction_date"))
    return t.select("transaction_id", K, (F.col("i") + 1).alias("seq")).where("seq <> transaction_id")


def w03_latest_rating(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "analyst_recommendations").where("ticker_id is not null").select(K, "firm", "date", "recommendation_id", "rating")
    return latest_by(a, [K, "firm"], ["date", "recommendation_id"]).select(K, "firm", "recommendation_id", "rating")


def w20_recency(spark: SparkSession, folder: str) -> DataFrame:
    days = F.datediff(F.lit(AS_OF).cast("date"), F.to_date("published_at"))
    bucket = F.when(days <= 3, "3 days").when(days <= 10, "10 days").when(days <= 30, "30 days").otherwise("older")
    return table(spark, folder, "news").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), exact_mean(clean_double("sentiment_score")).alias("mean_score"))


def t05_top_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The 15 latest, then strongest articles of each ticker."""
    n = table(spark, folder, "news").where("ticker_id is not null").select(K, "news_id", "published_at", F.abs(clean_double("sentiment_score")).alias("s"))
    # 15 a day suffice of each day: a first cut that no hot ticker can outgrow
    order = [F.desc("published_at"), F.desc_nulls_last("s"), F.desc("news_id")]
    n = n.withColumn("r1", F.row_number().over(Window.partitionBy(K, F.to_date("published_at")).orderBy(*order))).where("r1 <= 15")
    return n.withColumn("rn", F.row_number().over(Window.partitionBy(K).orderBy(*order))).where("rn <= 15").select(K, "news_id", "rn")


def t06_last_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """The four latest quarters that were filed before AS_OF, each as filed last by then; filings dated before their report don't count."""
    f = table(spark, folder, "fundamentals").where("ticker_id is not null and report_date is not null and filing_date >= report_date").where(F.col("filing_date") < F.lit(AS_OF).cast("date"))
    f = latest_by(f.select(K, "report_date", "filing_date", "fundamental_id"), [K, "report_date"], ["filing_date", "fundamental_id"])
    w = Window.partitionBy(K).orderBy(F.desc("report_date"))
    return f.withColumn("rn", F.row_number().over(w)).where("rn <= 4").select(K, "report_date", "fundamental_id", "rn")


def t10_display_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The ten latest trades of each ticker as one line of text."""
    t = table(spark, folder, "insider_transactions").where("ticker_id is not null and transaction_date is not null").select(K, "transaction_date", "transaction_id", "shares")
    # ten a day suffice of each day: a first cut that no hot ticker can outgrow
    order = [F.desc("transaction_date"), F.desc("transaction_id")]
    t = t.withColumn("r1", F.row_number().over(Window.partitionBy(K, "transaction_date").orderBy(*order))).where("r1 <= 10")
    t = t.withColumn("rn", F.row_number().over(Window.partitionBy(K).orderBy(*order))).where("rn <= 10")
    line = F.concat(F.col("transaction_date").cast("string"), F.lit(" "), F.coalesce(F.col("shares").cast("string"), F.lit("?")))
    return t.groupBy(K).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", line.alias("line")))), lambda x: x["line"]), "; ").alias("trades"))


def t08_systematic_days(spark: SparkSession, folder: str) -> DataFrame:
    """Of each ticker's days before the last the latest seven, and of the older ones every third from the oldest."""
    w = Window.partitionBy(K)
    b = bars(spark, folder).select(K, "date").withColumn("up", F.row_number().over(w.orderBy("date")) - 1).withColumn("n", F.count("*").over(w) - 1).where("up < n")
    return b.where((F.col("up") >= F.col("n") - 7) | (F.pmod("up", F.lit(3)) == 0)).select(K, "date")


def t09_first_results(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "baseline_results").orderBy("entry_date", "result_id").limit(50).select("result_id", "entry_date")


def u03_holidays(spark: SparkSession, folder: str) -> DataFrame:
    """Weekdays on which no ticker at all traded: the calendar less the trading days."""
    b = bars(spark, folder)
    days = b.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day")).where(F.weekday("day") < 5)
    return days.exceptAll(b.select(F.col("date").alias("day")).distinct())


def u01_u05_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """All quarters in which something was reported or filed, sorted."""
    f = table(spark, folder, "fundamentals")
    q = lambda c: F.date_format(F.date_trunc("quarter", F.col(c).cast("timestamp_ntz")), "yyyy-MM-dd").alias("quarter")
    return f.where("report_date is not null").select(q("report_date")).union(f.where("filing_date is not null").select(q("filing_date"))).distinct().orderBy("quarter")


def u04_new_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days with articles of a ticker but without a bar."""
    n = table(spark, folder, "news").where("ticker_id is not null").select(K, F.to_date("published_at").alias("day")).distinct()
    return n.join(bars(spark, folder).select(K, F.col("date").alias("day")), [K, "day"], "left_anti")


def s26_cascade(spark: SparkSession, folder: str) -> DataFrame:
    children = {n: table(spark, folder, n).select(K) for n in ("market_data", "fundamentals", "news", "insider_transactions", "analyst_recommendations")}
    return cascade_counts(table(spark, folder, "tickers").where("not is_active"), K, children)


def s27_retention(spark: SparkSession, folder: str) -> DataFrame:
    cut = lambda c, days: F.to_date(c) < F.date_sub(F.lit(AS_OF).cast("date"), days)
    return retention_counts({"news": (table(spark, folder, "news"), cut("published_at", 90)), "baseline_results": (table(spark, folder, "baseline_results"), cut("created_at", 180))})


QUERIES = {f.__name__: f for f in (
    a01_action_view, a02_dataset_stats, a03_pivot_counts, a04_action_performance, a05_daily_metrics, a06_j17_ticker_summary, a27_filings_by_year, a27_top_tickers, a29_counts, a30_health, a30_data_checks, j01_usable_results,
    j02_j03_without_filing, j02_unmatched_results, j04_stale_tickers, j05_j06_rating_coverage, w01_lag_delta, w02_renumber, w03_latest_rating, w20_recency, t05_top_articles, t06_last_quarters, t10_display_lists, t08_systematic_days,
    t09_first_results, u01_u05_quarters, u03_holidays, u04_new_days, s26_cascade, s27_retention,
)}

_NAMED = "regexp_replace(lower(trim(predicted_action)), '[\\s\\-]+', '_', 'g')"
_FIVE = ("strong_buy", "buy", "hold", "sell", "strong_sell")
_ACT = f"r AS (SELECT *, CASE WHEN {_NAMED} IN {_FIVE} THEN {_NAMED} END AS act FROM baseline_results)"
ORACLES = {
    "a01_action_view": f"""WITH {_ACT} SELECT strategy, count(*) AS n, count(*) FILTER (act = 'buy') AS buys, count(*) FILTER (act = 'sell') AS sells, round(avg(actual_return) FILTER (act = 'buy'), 6) AS mean_buy,
  round(stddev_samp(actual_return) FILTER (act = 'sell'), 6) AS deviation_sell, min(actual_return) FILTER (act = 'hold') AS least_hold, max(actual_return) FILTER (act = 'hold') AS most_hold,
  round(count(*) FILTER (correct) / nullif(count(correct), 0), 6) AS accuracy FROM r GROUP BY 1""",
    "a02_dataset_stats": """SELECT dataset_split, source, count(*) AS n, count(DISTINCT metadata.ticker) AS tickers, round(avg(ground_truth.actual_return_pct), 6) AS mean_return, min(metadata.entry_date) AS first_date, max(metadata.entry_date) AS last_date,
  round(avg(length(messages[2].content)) / 1024, 6) AS mean_kb FROM rlvr_examples GROUP BY 1, 2""",
    "a03_pivot_counts": f"""WITH {_ACT} SELECT ticker, count(*) AS total, count(*) FILTER (error IS NULL AND act IS NOT NULL) AS successful, count(error) AS errors, count(*) FILTER (error IS NULL AND act IS NULL) AS invalid,
  round(count(*) FILTER (error IS NULL AND act IS NOT NULL) / count(*) * 100, 2) AS success_rate_pct, {", ".join(f"count(*) FILTER (error IS NULL AND act = '{a}') AS n_{a}" for a in _FIVE)} FROM r GROUP BY 1""",
    "a04_action_performance": f"""WITH {_ACT} SELECT act, CAST(list_position({list(_FIVE)}, act) AS INTEGER) AS position, count(*) AS n, count(*) FILTER (correct) AS correct, round(count(*) FILTER (correct) / count(*) * 100, 2) AS accuracy_pct,
  round(avg(actual_return), 4) AS mean_return, round(stddev_samp(actual_return), 4) AS deviation, round(avg(actual_return) / nullif(stddev_samp(actual_return), 0), 6) AS ratio FROM r WHERE actual_return IS NOT NULL AND act IS NOT NULL GROUP BY 1""",
    "a05_daily_metrics": "SELECT CAST(date_trunc('day', created_at) AS DATE) AS day, count(*) AS n, count(DISTINCT ticker) AS tickers, count(error) AS errors, CAST(sum(usage.total_tokens) AS BIGINT) AS tokens FROM baseline_results GROUP BY 1",
    "a06_j17_ticker_summary": """SELECT t.ticker_id, t.symbol, t.sector, (SELECT count(*) FROM news n WHERE n.ticker_id = t.ticker_id) AS articles, CAST((SELECT max(published_at)::DATE FROM news n WHERE n.ticker_id = t.ticker_id) AS VARCHAR) AS last_article,
  f.fundamental_id AS last_filing, f.revenue AS revenue, (SELECT count(*) FROM insider_transactions i WHERE i.ticker_id = t.ticker_id) AS trades, (SELECT count(DISTINCT owner_name) FROM insider_transactions i WHERE i.ticker_id = t.ticker_id) AS owners
FROM tickers t LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY filing_date DESC, fundamental_id DESC) AS rn FROM fundamentals WHERE filing_date IS NOT NULL) f ON f.ticker_id = t.ticker_id AND f.rn = 1""",
    "a27_filings_by_year": "SELECT CAST(year(report_date) AS INTEGER) AS year, count(*) AS n, count(DISTINCT ticker_id) AS tickers FROM fundamentals GROUP BY 1",
    "a27_top_tickers": "SELECT ticker_id, count(*) AS n FROM news WHERE ticker_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, ticker_id LIMIT 10",
    "a29_counts": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in ("tickers", "market_data", "fundamentals", "news", "insider_transactions", "analyst_recommendations", "rlvr_examples", "baseline_results")),
    "a30_health": f"""SELECT 'active_tickers' AS "check", CASE WHEN count(*) > 0 THEN 'OK' ELSE 'WARNING' END AS status, 'Active tickers: ' || count(*) AS details FROM tickers WHERE is_active
UNION ALL SELECT 'recent_market_data', CASE WHEN max(date) >= DATE '{AS_OF}' - 7 THEN 'OK' ELSE 'WARNING' END, 'Latest date: ' || coalesce(CAST(max(date) AS VARCHAR), 'No data') FROM market_data
UNION ALL SELECT 'answers', CASE WHEN count(*) > 0 THEN 'OK' ELSE 'WARNING' END, 'Recent answers: ' || count(*) FROM baseline_results WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
UNION ALL SELECT 'open_examples', 'INFO', 'Open examples: ' || count(*) FROM rlvr_examples WHERE ground_truth IS NULL
UNION ALL SELECT 'rlvr_examples', CASE WHEN count(*) > 0 THEN 'OK' ELSE 'INFO' END, 'Total examples: ' || count(*) || ' (train: ' || count(*) FILTER (dataset_split = 'train') || ', test: ' || count(*) FILTER (dataset_split = 'test') || ')' FROM rlvr_examples""",
    "a30_data_checks": "SELECT c AS \"check\", CASE WHEN n = 0 THEN 'ok' ELSE 'warning' END AS status, n AS offending FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, count(*) AS n FROM {w}"
        for c, w in (("null prices", "market_data WHERE close IS NULL"), ("high below low", "market_data WHERE high < low"), ("news without ticker", "news WHERE ticker_id IS NULL"), ("filings before reports", "fundamentals WHERE filing_date < report_date"), ("trades of unknown tickers", "insider_transactions ANTI JOIN tickers USING (ticker_id)"))
    )
    + ")",
    "j01_usable_results": """WITH e AS (SELECT example_id, metadata.ticker AS symbol, list_filter(messages, lambda m: m.role = 'assistant')[1].content AS a FROM rlvr_examples)
SELECT example_id, ticker_id, sector FROM e JOIN tickers USING (symbol) WHERE coalesce(CASE WHEN json_valid(a) THEN a ->> '$.cleared' END, '') <> 'true'""",
    "j02_j03_without_filing": "SELECT ticker_id, symbol FROM tickers WHERE ticker_id NOT IN (SELECT DISTINCT ticker_id FROM fundamentals WHERE ticker_id IS NOT NULL)",
    "j02_unmatched_results": f"WITH {BARS} SELECT result_id, t.ticker_id FROM baseline_results b JOIN tickers t ON b.ticker = t.symbol LEFT JOIN bars x ON x.ticker_id = t.ticker_id AND x.date = TRY_CAST(b.entry_date AS DATE) WHERE x.date IS NULL",
    "j04_stale_tickers": "SELECT ticker_id, symbol FROM tickers WHERE ticker_id IN (SELECT ticker_id FROM fundamentals GROUP BY 1 HAVING max(filing_date) < DATE '2024-10-01')",
    "j05_j06_rating_coverage": "SELECT ticker_id, symbol, count(recommendation_id) AS n, count(DISTINCT firm) AS firms FROM tickers LEFT JOIN analyst_recommendations USING (ticker_id) GROUP BY 1, 2",
    "w01_lag_delta": f"WITH {BARS} SELECT ticker_id, date, lag(close) OVER w AS prev, round(close - lag(close) OVER w, 4) AS delta FROM bars WINDOW w AS (PARTITION BY ticker_id ORDER BY date)",
    "w02_renumber": "SELECT * FROM (SELECT transaction_id, ticker_id, row_number() OVER (PARTITION BY ticker_id ORDER BY transaction_date, transaction_id) AS seq FROM insider_transactions WHERE ticker_id IS NOT NULL AND transaction_date IS NOT NULL) WHERE seq <> transaction_id",
    "w03_latest_rating": "SELECT DISTINCT ON (ticker_id, firm) ticker_id, firm, recommendation_id, rating FROM analyst_recommendations WHERE ticker_id IS NOT NULL ORDER BY ticker_id, firm, date DESC, recommendation_id DESC",
    "w20_recency": f"""WITH d AS (SELECT sentiment_score, date_diff('day', CAST(published_at AS DATE), DATE '{AS_OF}') AS d FROM news)
SELECT CASE WHEN d <= 3 THEN '3 days' WHEN d <= 10 THEN '10 days' WHEN d <= 30 THEN '30 days' ELSE 'older' END AS bucket, count(*) AS n, round(sum(sentiment_score), 4) / nullif(count(sentiment_score), 0) AS mean_score FROM d GROUP BY 1""",
    "t05_top_articles": "SELECT ticker_id, news_id, CAST(rn AS INTEGER) AS rn FROM (SELECT ticker_id, news_id, row_number() OVER (PARTITION BY ticker_id ORDER BY published_at DESC, abs(sentiment_score) DESC NULLS LAST, news_id DESC) AS rn FROM news WHERE ticker_id IS NOT NULL) WHERE rn <= 15",
    "t06_last_quarters": f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY ticker_id, report_date ORDER BY filing_date DESC, fundamental_id DESC) AS k FROM fundamentals
  WHERE ticker_id IS NOT NULL AND report_date IS NOT NULL AND filing_date < DATE '{AS_OF}' AND filing_date >= report_date)
SELECT ticker_id, report_date, fundamental_id, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY report_date DESC) AS rn FROM f WHERE k = 1) WHERE rn <= 4""",
    "t10_display_lists": """SELECT ticker_id, string_agg(transaction_date || ' ' || coalesce(CAST(shares AS VARCHAR), '?'), '; ' ORDER BY transaction_date DESC, transaction_id DESC) AS trades
FROM (SELECT *, row_number() OVER (PARTITION BY ticker_id ORDER BY transaction_date DESC, transaction_id DESC) AS rn FROM insider_transactions WHERE ticker_id IS NOT NULL AND transaction_date IS NOT NULL) WHERE rn <= 10 GROUP BY 1""",
    "t08_systematic_days": f"""WITH {BARS}, k AS (SELECT ticker_id, date, row_number() OVER (PARTITION BY ticker_id ORDER BY date) - 1 AS up, count(*) OVER (PARTITION BY ticker_id) - 1 AS n FROM bars)
SELECT ticker_id, date FROM k WHERE up < n AND (up >= n - 7 OR up % 3 = 0)""",
    "t09_first_results": "SELECT result_id, entry_date FROM baseline_results ORDER BY entry_date NULLS FIRST, result_id LIMIT 50",
    "u01_u05_quarters": "SELECT DISTINCT strftime(date_trunc('quarter', d), '%Y-%m-%d') AS quarter FROM (SELECT report_date AS d FROM fundamentals UNION ALL SELECT filing_date FROM fundamentals) WHERE d IS NOT NULL ORDER BY 1",
    "u03_holidays": f"WITH {BARS}, d AS (SELECT CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM bars) SELECT day FROM d WHERE isodow(day) < 6 EXCEPT SELECT date FROM bars",
    "u04_new_days": f"WITH {BARS} SELECT DISTINCT n.ticker_id, CAST(n.published_at AS DATE) AS day FROM news n WHERE n.ticker_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker_id = n.ticker_id AND b.date = CAST(n.published_at AS DATE))",
    "s26_cascade": " UNION ALL ".join(
        f"SELECT '{n}' AS child, count(*) FILTER (g.ticker_id IS NOT NULL) AS deleted, count(*) FILTER (g.ticker_id IS NULL) AS kept FROM {n} c LEFT JOIN (SELECT ticker_id FROM tickers WHERE NOT is_active) g ON g.ticker_id = c.ticker_id"
        for n in ("market_data", "fundamentals", "news", "insider_transactions", "analyst_recommendations")
    ),
    "s27_retention": f"""SELECT 'news' AS name, count(*) FILTER (CAST(published_at AS DATE) < DATE '{AS_OF}' - 90) AS deleted, count(*) FILTER (NOT coalesce(CAST(published_at AS DATE) < DATE '{AS_OF}' - 90, false)) AS kept FROM news
UNION ALL SELECT 'baseline_results', count(*) FILTER (CAST(created_at AS DATE) < DATE '{AS_OF}' - 180), count(*) FILTER (NOT coalesce(CAST(created_at AS DATE) < DATE '{AS_OF}' - 180, false)) FROM baseline_results""",
}
