"""Predictions, rewards, strategies and their statistics; training examples and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scoring as sc
from tidemark.operators.ranks import ordered_index
from tidemark.operators.series import plain_zero
from tidemark.operators.trailing import clean_double
from tidemark.tables import table


def results(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "baseline_results")
    return r.select("result_id", "strategy", "ticker", "entry_date", sc.clean_action("predicted_action").alias("action"), clean_double("actual_return").alias("actual"), "reasoning", "support", "error")


def d18_d19_strategies(spark: SparkSession, folder: str) -> DataFrame:
    """Returns of three strategies (long only, long and short, weighted) and whether the direction was right."""
    r = results(spark, folder).where("error is null and action is not null and actual is not null")
    a, x = F.col("action"), F.col("actual")
    long = F.when(a.isin("buy", "strong_buy"), x).otherwise(0.0)
    both = F.when(a.isin("buy", "strong_buy"), x).when(a.isin("sell", "strong_sell"), -x).otherwise(0.0)
    out = r.select("result_id", "action", sc.directional(a, x).alias("correct"), sc.directional(a, x, "sql").alias("correct_sign"), plain_zero(long, 4).alias("long_only"), plain_zero(both, 4).alias("long_short"), plain_zero(x * sc.choose(a, sc.WEIGHTS, 0.0), 4).alias("weighted"))
    return out


def a23_action_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Per strategy and action: predictions, right ones, mean and deviation of the return (0 for a single one)."""
    r = results(spark, folder).where("error is null and action is not null and actual is not null").withColumn("ok", sc.directional(F.col("action"), F.col("actual")))
    g = r.groupBy("strategy", "action").agg(F.count("*").alias("n"), F.count_if("ok").alias("correct"), F.avg("actual").alias("m"), F.stddev_samp("actual").alias("sd"))
    return g.select("strategy", "action", "n", "correct", F.round(F.try_divide("correct", "n"), 6).alias("accuracy"), F.round("m", 6).alias("mean_return"), F.round(F.coalesce("sd", F.lit(0.0)), 6).alias("deviation"))


def a24_a25_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """Per strategy: mean, median, deviation, extremes, sum, signs and Sharpe ratio of its own returns, beside buying everything."""
    x, a = F.col("actual"), F.col("action")
    own = F.when(F.col("strategy") == "A", F.when(a.isin("buy", "strong_buy"), x).otherwise(0.0)).when(F.col("strategy") == "B", F.when(a.isin("buy", "strong_buy"), x).when(a.isin("sell", "strong_sell"), -x).otherwise(0.0)).otherwise(x * sc.choose(a, sc.WEIGHTS, 0.0))
    r = results(spark, folder).where("error is null and action is not null and actual is not null").withColumn("p", own)
    # the one or two rows in the middle of each strategy's, by row numbers in two levels
    placed = ordered_index(r.select("strategy", "result_id", "p"), ["strategy"], ["p", "result_id"], F.floor(F.col("p") * 4)).join(r.groupBy("strategy").agg(F.count("*").alias("n")), "strategy")
    median = placed.where("i = (n - 1) div 2 or i = n div 2").groupBy("strategy").agg(F.avg("p").alias("median"))
    g = r.groupBy("strategy").agg(
        F.count("*").alias("n"), F.avg("p").alias("m"), F.stddev_samp("p").alias("sd"), F.min("p").alias("least"), F.max("p").alias("most"), F.sum("p").alias("total"),
        F.count_if(F.col("p") > 0).alias("up"), F.count_if(F.col("p") < 0).alias("down"), F.avg("actual").alias("hold_mean"), F.stddev_samp("actual").alias("hold_sd"),
    ).join(median, "strategy")
    return g.select(
        "strategy", "n", F.round("m", 6).alias("mean_return"), plain_zero("median", 4).alias("median_return"), F.round("sd", 6).alias("deviation"), F.round("least", 4).alias("least"), F.round("most", 4).alias("most"),
        F.round("total", 4).alias("total"), "up", "down", F.round(sc.sharpe(F.col("m"), F.col("sd"), F.col("n")), 6).alias("sharpe"), F.round(sc.sharpe(F.col("hold_mean"), F.col("hold_sd"), F.col("n")), 6).alias("hold_sharpe"),
    )


def a26_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Strategies side by side: differences of accuracy and mean return to strategy A."""
    r = results(spark, folder).where("error is null and action is not null and actual is not null").withColumn("ok", sc.directional(F.col("action"), F.col("actual")))
    g = r.groupBy("strategy").agg(F.avg(F.col("ok").cast("double")).alias("acc"), F.avg("actual").alias("m"))
    w = Window.partitionBy(F.lit(0))  # one row a strategy
    base = lambda c: F.max(F.when(F.col("strategy") == "A", F.col(c))).over(w)
    return g.select("strategy", plain_zero(F.col("acc") - base("acc"), 6).alias("accuracy_delta"), plain_zero(F.col("m") - base("m"), 6).alias("return_delta"))


def d20_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Per strategy: all rows, errors, unusable actions, and what is evaluated."""
    r = results(spark, folder)
    return r.groupBy("strategy").agg(
        F.count("*").alias("rows"), F.count("error").alias("errors"), F.count_if(F.col("error").isNull() & F.col("action").isNull()).alias("unusable"),
        F.count_if(F.col("error").isNull() & F.col("action").isNotNull() & F.col("actual").isNotNull()).alias("evaluated"),
    )


def rewards(r: DataFrame, sharpe_score: Column) -> DataFrame:
    """`r` (action, actual, reasoning, support, ok) with the parts of each answer's reward and the reward; where ok isn't true all are 0."""
    a, x, ok = F.col("action"), F.col("actual"), F.col("ok")
    correct = sc.directional(a, x)
    confidence = F.when(a.isin("strong_buy", "strong_sell"), 1.0).when(a.isin("buy", "sell"), 0.75).otherwise(0.5)
    parts = {"direction": F.when(correct, 1.0).otherwise(0.0), "magnitude": sc.magnitude(a, x), "sharpe": sharpe_score, "calibration": sc.calibration(correct, confidence), "downside": sc.downside(a, x), "reasonable": sc.reasonableness(F.col("reasoning"), F.col("support"))}
    r = r.withColumns({k: F.when(ok, v).otherwise(0.0) for k, v in parts.items()})
    total = (0.40 * F.col("direction") + 0.25 * F.col("magnitude") + 0.20 * F.col("sharpe") + 0.10 * F.col("calibration") + 0.05 * (1 - F.col("downside"))) * (0.5 + 0.5 * F.col("reasonable"))
    reward = F.when(ok, F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))).otherwise(0.0)
    return r.select(r.columns[0], *[F.round(k, 6).alias(k) for k in parts], F.round(reward, 6).alias("reward"))


def d10_d16_rewards(spark: SparkSession, folder: str) -> DataFrame:
    """The parts of each stored answer's reward and the reward. These have no past returns, so the Sharpe part is that of an empty list, sigmoid(0)."""
    r = results(spark, folder)
    ok = F.col("action").isNotNull() & F.col("actual").isNotNull() & F.col("error").isNull()
    return rewards(r.withColumn("ok", ok), F.lit(0.5))


def d10_d17_example_rewards(spark: SparkSession, folder: str) -> DataFrame:
    """The reward of the last answer of each example, read as JSON, with the Sharpe ratio of the example's past returns."""
    e = table(spark, folder, "rlvr_examples").where(F.exists("messages", lambda m: m["role"] == "assistant"))
    text = F.element_at(F.filter("messages", lambda m: m["role"] == "assistant"), -1)["content"]
    e = e.select("example_id", F.col("ground_truth.actual_return_pct").alias("actual"), F.col("metadata.historical_returns").alias("h"), sc.lenient_json(text).alias("doc"))
    e = e.select("example_id", "actual", "h", *[F.get_json_object("doc", f"$.{k}").alias(k) for k in ("action", "reasoning", "support")]).withColumn("action", sc.clean_action("action"))
    n, mean, deviation = sc.history_sharpe(F.col("h"))
    e = e.withColumn("sharpe_score", 1 / (1 + F.exp(-sc.sharpe(mean, deviation, n)))).withColumn("ok", F.col("action").isNotNull() & F.col("actual").isNotNull())
    return rewards(e, F.col("sharpe_score"))


def d15_history_sharpe(spark: SparkSession, folder: str) -> DataFrame:
    """Sharpe ratio of each example's past returns and its sigmoid; 0 and 0.5 for fewer than two or none spread."""
    n, mean, deviation = sc.history_sharpe(F.col("metadata.historical_returns"))
    s = sc.sharpe(mean, deviation, n)
    return table(spark, folder, "rlvr_examples").select("example_id", F.round(s, 6).alias("sharpe"), F.round(1 / (1 + F.exp(-s)), 6).alias("sigmoid"))


def d03_capped_sharpe(spark: SparkSession, folder: str) -> DataFrame:
    """Mean, deviation, capped ratio and score of each example's past returns."""
    n, mean, deviation = sc.history_sharpe(F.col("metadata.historical_returns"))
    ratio, score = sc.capped_sharpe(n, mean, deviation)
    return table(spark, folder, "rlvr_examples").select("example_id", n.alias("n"), F.round(F.when(n >= 2, mean), 6).alias("mean_return"), F.round(deviation, 6).alias("deviation"), F.round(ratio, 6).alias("sharpe"), F.round(score, 4).alias("score"))


def d17_d21_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The last answer of each example, read as JSON: whole, from a fence, or from first to last brace."""
    e = table(spark, folder, "rlvr_examples")
    text = F.element_at(F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: m["content"]), -1)
    e = e.select("example_id", F.when(F.exists("messages", lambda m: m["role"] == "assistant"), text).alias("t")).where("t is not null")
    doc = sc.lenient_json(F.col("t"))
    return e.select("example_id", F.lower(F.trim(F.get_json_object(doc, "$.action"))).alias("action"), F.length(F.get_json_object(doc, "$.reasoning")).alias("reasoning_length"), F.get_json_object(doc, "$.action").isNotNull().alias("usable"))


def entry_day(column: str) -> Column:
    """A date written 2024-01-31, 2024/01/31, 20240131 or with a time after it."""
    digits = F.regexp_replace(F.substring(F.split_part(column, F.lit("T"), F.lit(1)), 1, 10), r"[^0-9]", "")
    return F.to_date(F.try_to_timestamp(F.when(F.length(digits) == 8, digits), F.lit("yyyyMMdd")))


def d22_chronological_split(spark: SparkSession, folder: str) -> DataFrame:
    """Training examples are those dated up to the date at four fifths of the sorted list, that date included."""
    e = table(spark, folder, "rlvr_examples").select("example_id", entry_day("metadata.entry_date").alias("day")).where("day is not null")
    per_day = e.groupBy("day").agg(F.count("*").alias("c"))
    # counts by day are a short list, however many examples there are
    one = Window.partitionBy(F.lit(0))
    per_day = per_day.withColumn("upto", F.sum("c").over(one.orderBy("day"))).withColumn("total", F.sum("c").over(one))
    cut = per_day.where(F.col("upto") > F.floor(F.col("total") * F.lit(4) / F.lit(5))).agg(F.min("day")).first()[0]  # one date
    return e.select("example_id", "day", F.when(F.col("day") <= F.lit(cut), "train").otherwise("dev").alias("new_split"))


SYSTEM = "You are a financial analyst. Answer as JSON with reasoning, action and support."
LINE = "messages array<struct<role:string,content:string>>, ground_truth struct<actual_return_pct:double,days_held:int>, metadata struct<ticker:string,entry_date:string>"


def example_lines(df: DataFrame) -> DataFrame:
    """(result_id, form, line): each row of results as one JSON line, in the form of training examples (system, user) before 2024-07-01, with the answer as third message from then on; both with ground truth and metadata."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    answer = F.to_json(F.struct("reasoning", "action", "support"), {"ignoreNullFields": "false"})
    asked = [message("system", F.lit(SYSTEM)), message("user", F.col("prompt"))]
    train = F.col("entry_date") < "2024-07-01"
    messages = F.when(train, F.array(*asked)).otherwise(F.array(*asked, message("assistant", answer)))
    line = F.to_json(F.struct(messages.alias("messages"), F.struct(F.col("actual").alias("actual_return_pct"), "days_held").alias("ground_truth"), F.struct("ticker", "entry_date").alias("metadata")))
    return df.select("result_id", F.when(train, "train").otherwise("dev").alias("form"), line.alias("line"))


def d23_assembly(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all usable results, read back from their JSON: an exact round trip of all parts."""
    r = table(spark, folder, "baseline_results").where("error is null and prompt is not null and entry_date is not null").withColumn("action", sc.clean_action("predicted_action")).where("action is not null")
    lines = example_lines(r.select("result_id", "prompt", "reasoning", "action", "support", clean_double("actual_return").alias("actual"), "days_held", "ticker", "entry_date"))
    x = lines.select("result_id", "form", F.from_json("line", LINE).alias("x")).select("result_id", "form", "x.*")
    said = F.get(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0))["content"]
    return x.select(
        "result_id", "form", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.md5(F.get("messages", F.lit(1))["content"]).alias("prompt_md5"), F.get_json_object(said, "$.action").alias("answer"),
        F.md5(F.get_json_object(said, "$.reasoning")).alias("reasoning_md5"), F.md5(F.get_json_object(said, "$.support")).alias("support_md5"), "ground_truth.actual_return_pct", "ground_truth.days_held", "metadata.ticker", "metadata.entry_date",
    )


def d24_example_errors(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with each example by the form of its split, as a list joined by commas; only those with something wrong."""
    e = table(spark, folder, "rlvr_examples")
    n, train = F.size("messages"), F.col("dataset_split") == "train"
    at = lambda i: F.get("messages", F.lit(i))
    blank = lambda i: F.coalesce(at(i)["content"], F.lit("")) == ""
    third = ~train & (n > 2)
    rules = [
        F.when(F.col("messages").isNull(), "no messages"),
        F.when(train & (n != 2), "train needs 2 messages"), F.when(~train & (n != 3), "dev needs 3 messages"),
        F.when((n > 0) & ~at(0)["role"].eqNullSafe(F.lit("system")), "first isn't system"), F.when((n > 0) & blank(0), "empty system message"),
        F.when((n > 1) & ~at(1)["role"].eqNullSafe(F.lit("user")), "second isn't user"), F.when((n > 1) & blank(1), "empty user message"),
        F.when(train & F.exists("messages", lambda m: m["role"] == "assistant"), "answer in training"),
        F.when(third & ~at(2)["role"].eqNullSafe(F.lit("assistant")), "third isn't assistant"), F.when(third & blank(2), "empty answer"),
        *[F.when(third & ~blank(2), error) for error in sc.answer_errors(at(2)["content"])],
        F.when(F.col("ground_truth").isNull(), "no ground truth"),
        *[F.when(F.col("ground_truth").isNotNull() & F.col(f"ground_truth.{c}").isNull(), f"no {c}") for c in ("actual_return_pct", "exit_date", "days_held")],
        F.when(F.col("metadata").isNull(), "no metadata"), *[F.when(F.col("metadata").isNotNull() & F.col(f"metadata.{c}").isNull(), f"no {c}") for c in ("ticker", "entry_date")],
    ]
    return e.select("example_id", F.array_join(F.array_compact(F.array(*rules)), ",").alias("errors")).where("errors <> ''")


def a31_d25_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "rlvr_examples")
    return e.groupBy("dataset_split").agg(
        F.count("*").alias("n"), F.count_if(F.col("ground_truth").isNull()).alias("no_truth"), F.count_if(F.col("ground_truth.early_exit")).alias("early"),
        F.round(F.avg("ground_truth.actual_return_pct"), 6).alias("mean_return"), F.countDistinct("metadata.ticker").alias("tickers"), (F.count("*") >= 100).alias("enough"),
    )


def d04_a28_past_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Each example's last 30 dated returns of its ticker as written before it, oldest first."""
    e = table(spark, folder, "rlvr_examples").select("example_id", F.col("metadata.ticker").alias("ticker"), entry_day("metadata.entry_date").alias("day"), F.col("ground_truth.actual_return_pct").alias("r")).where("ticker is not null and day is not null and r is not null")
    e = ordered_index(e, ["ticker"], ["day", "example_id"], F.year("day") * 12 + F.month("day"))
    back = e.select("ticker", F.col("i").alias("j"), "r")
    asked = e.where("i > 0").withColumn("j", F.explode(F.sequence(F.greatest(F.col("i") - 30, F.lit(0)), F.col("i") - 1)))
    return asked.drop("r").join(back, ["ticker", "j"]).groupBy("example_id").agg(F.count("*").alias("n"), F.round(F.sum("r"), 4).alias("total"), F.max_by("r", "j").alias("newest"), F.min_by("r", "j").alias("oldest"))


def d26_adapter(spark: SparkSession, folder: str) -> DataFrame:
    """Structured answers flattened: action, whole reasoning and whole support. The stored ones are put in sections first, as none of the tables has any."""
    e = table(spark, folder, "baseline_results").where("reasoning is not null")
    wanted = F.initcap(F.replace(sc.clean_action("predicted_action"), F.lit("_"), F.lit(" ")))
    conclusion = F.struct(wanted.alias("recommendation"), F.col("reasoning"), F.lit(0.75).alias("confidence"))
    answer = F.to_json(F.struct(conclusion.alias("conclusion"), F.struct(F.col("support").alias("assessment")).alias("valuation")))
    return e.select("result_id", sc.flat_answer(answer).alias("x")).select("result_id", "x.*")


QUERIES = {f.__name__: f for f in (
    d18_d19_strategies, a23_action_stats, a24_a25_portfolio, a26_comparison, d20_errors, d10_d16_rewards, d10_d17_example_rewards, d15_history_sharpe, d03_capped_sharpe, d17_d21_predictions, d22_chronological_split, d23_assembly, d24_example_errors,
    a31_d25_split_counts, d04_a28_past_returns, d26_adapter,
)}

_CLEAN = "CASE WHEN regexp_replace(lower(trim({c})), '[\\s\\-]+', '_', 'g') IN ('strong_buy', 'buy', 'hold', 'sell', 'strong_sell') THEN regexp_replace(lower(trim({c})), '[\\s\\-]+', '_', 'g') END"
_RES = f"res AS (SELECT *, {_CLEAN.format(c='predicted_action')} AS action, actual_return AS actual FROM baseline_results)"
_USED = _RES + ", u AS (SELECT * FROM res WHERE error IS NULL AND action IS NOT NULL AND actual IS NOT NULL)"
_BUY, _SELL = "action IN ('buy', 'strong_buy')", "action IN ('sell', 'strong_sell')"
_RIGHT = "coalesce(CASE action WHEN 'strong_buy' THEN actual >= 3 WHEN 'buy' THEN actual >= 2 WHEN 'hold' THEN abs(actual) <= 2 WHEN 'sell' THEN actual <= -2 WHEN 'strong_sell' THEN actual <= -3 END, false)"
_SIGN = f"coalesce(CASE WHEN {_BUY} THEN actual >= 0 WHEN {_SELL} THEN actual <= 0 WHEN action = 'hold' THEN abs(actual) <= 1 END, false)"
_LONG, _BOTH = f"CASE WHEN {_BUY} THEN actual ELSE 0.0 END", f"CASE WHEN {_BUY} THEN actual WHEN {_SELL} THEN -actual ELSE 0.0 END"
_WEIGHT = "actual * CASE action WHEN 'strong_buy' THEN 2.0::DOUBLE WHEN 'buy' THEN 1.0::DOUBLE WHEN 'sell' THEN -1.0::DOUBLE WHEN 'strong_sell' THEN -2.0::DOUBLE ELSE 0.0::DOUBLE END"
_ZERO = "CASE WHEN round({x}, {n}) = 0 THEN 0.0 ELSE round({x}, {n}) END"
ORACLE_DAY = "try_strptime(CASE WHEN length(regexp_replace(substr(split_part({c}, 'T', 1), 1, 10), '[^0-9]', '', 'g')) = 8 THEN regexp_replace(substr(split_part({c}, 'T', 1), 1, 10), '[^0-9]', '', 'g') END, '%Y%m%d')::DATE"
_TERMS = " + ".join(f"CASE WHEN contains(b, '{t}') THEN 1 ELSE 0 END" for t in sc.FINANCIAL_TERMS)
_ANSWERS = """t AS (SELECT example_id, list_filter(messages, lambda m: m.role = 'assistant')[-1].content AS t FROM rlvr_examples),
j AS (SELECT example_id, coalesce(CASE WHEN starts_with(trim(t), '{') THEN TRY_CAST(trim(t) AS JSON) END, TRY_CAST(nullif(regexp_extract(t, '```(?:json)?\\s*(\\{.*?\\})\\s*```', 1, 's'), '') AS JSON), TRY_CAST(nullif(regexp_extract(t, '(\\{.*\\})', 1, 's'), '') AS JSON)) AS j FROM t WHERE t IS NOT NULL)"""


def _reward_sql(key: str) -> str:
    return f"""a AS (SELECT *, {_RIGHT} AS c, lower(concat_ws(' ', reasoning, support)) AS b, coalesce(length(reasoning), 0) AS n, coalesce(length(support), 0) AS m FROM z),
p AS (SELECT {key}, ok, CASE WHEN ok THEN sharpe_score ELSE 0 END AS sharpe, CASE WHEN ok AND c THEN 1.0::DOUBLE ELSE 0 END AS direction, CASE WHEN ok THEN exp(-abs(CASE action WHEN 'strong_buy' THEN 4.0::DOUBLE WHEN 'buy' THEN 2.5 WHEN 'sell' THEN -2.5 WHEN 'strong_sell' THEN -4.0 ELSE 0 END - actual) / 5) ELSE 0 END AS magnitude,
  CASE WHEN NOT ok THEN 0::DOUBLE WHEN c THEN 0.5::DOUBLE + 0.5::DOUBLE * conf ELSE 1 - conf END AS calibration,
  CASE WHEN NOT ok THEN 0::DOUBLE WHEN {_BUY} AND actual < -5 THEN least(1.0, abs(actual) / 10) WHEN {_SELL} AND actual > 5 THEN least(0.5, actual / 20) WHEN action = 'hold' AND abs(actual) > 5 THEN least(0.3, abs(actual) / 30) ELSE 0 END AS downside,
  CASE WHEN ok THEN least(1.0::DOUBLE, CASE WHEN n >= 100 THEN 0.3::DOUBLE WHEN n >= 50 THEN 0.15 ELSE 0 END + CASE WHEN m >= 50 THEN 0.2::DOUBLE WHEN m >= 25 THEN 0.1 ELSE 0 END + CASE WHEN t >= 3 THEN 0.3::DOUBLE WHEN t >= 2 THEN 0.2 WHEN t >= 1 THEN 0.1 ELSE 0 END
   + CASE WHEN regexp_matches(b, '\\d+\\.?\\d*%') THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN regexp_matches(b, '\\$\\d+') THEN 0.1::DOUBLE ELSE 0 END) ELSE 0 END AS reasonable
  FROM (SELECT *, {_TERMS} AS t, CASE WHEN action IN ('strong_buy', 'strong_sell') THEN 1.0::DOUBLE WHEN action IN ('buy', 'sell') THEN 0.75 ELSE 0.5 END AS conf FROM a))
SELECT {key}, direction, round(magnitude, 6) AS magnitude, round(sharpe, 6) AS sharpe, calibration, round(downside, 6) AS downside, round(reasonable, 6) AS reasonable,
  round(CASE WHEN ok THEN least(1, greatest(0, (0.40::DOUBLE * direction + 0.25::DOUBLE * magnitude + 0.20::DOUBLE * sharpe + 0.10::DOUBLE * calibration + 0.05::DOUBLE * (1 - downside)) * (0.5::DOUBLE + 0.5::DOUBLE * reasonable))) ELSE 0 END, 6) AS reward FROM p"""


ORACLES = {
    "d18_d19_strategies": f"WITH {_USED} SELECT result_id, action, {_RIGHT} AS correct, {_SIGN} AS correct_sign, {_ZERO.format(x=_LONG, n=4)} AS long_only, {_ZERO.format(x=_BOTH, n=4)} AS long_short, {_ZERO.format(x=_WEIGHT, n=4)} AS weighted FROM u",
    "a23_action_stats": f"""WITH {_USED} SELECT strategy, action, count(*) AS n, count(*) FILTER ({_RIGHT}) AS correct, round(count(*) FILTER ({_RIGHT}) / count(*), 6) AS accuracy, round(avg(actual), 6) AS mean_return,
  round(coalesce(stddev_samp(actual), 0), 6) AS deviation FROM u GROUP BY 1, 2""",
    "a24_a25_portfolio": f"""WITH {_USED}, p AS (SELECT *, CASE strategy WHEN 'A' THEN {_LONG} WHEN 'B' THEN {_BOTH} ELSE {_WEIGHT} END AS p FROM u)
SELECT strategy, count(*) AS n, round(avg(p), 6) AS mean_return, {_ZERO.format(x="quantile_cont(p, 0.5)", n=4)} AS median_return, round(stddev_samp(p), 6) AS deviation, round(min(p), 4) AS least, round(max(p), 4) AS most, round(sum(p), 4) AS total,
  count(*) FILTER (p > 0) AS up, count(*) FILTER (p < 0) AS down, round(CASE WHEN count(*) < 2 OR stddev_samp(p) = 0 THEN 0 ELSE avg(p) / stddev_samp(p) END, 6) AS sharpe,
  round(CASE WHEN count(*) < 2 OR stddev_samp(actual) = 0 THEN 0 ELSE avg(actual) / stddev_samp(actual) END, 6) AS hold_sharpe FROM p GROUP BY 1""",
    "a26_comparison": f"""WITH {_USED}, g AS (SELECT strategy, avg(CASE WHEN {_RIGHT} THEN 1.0::DOUBLE ELSE 0.0 END) AS a, avg(actual) AS m FROM u GROUP BY 1), d AS (SELECT g.strategy, g.a - x.a AS da, g.m - x.m AS dm FROM g, (SELECT * FROM g WHERE strategy = 'A') x)
SELECT strategy, {_ZERO.format(x="da", n=6)} AS accuracy_delta, {_ZERO.format(x="dm", n=6)} AS return_delta FROM d""",
    "d20_errors": f"WITH {_RES} SELECT strategy, count(*) AS rows, count(error) AS errors, count(*) FILTER (error IS NULL AND action IS NULL) AS unusable, count(*) FILTER (error IS NULL AND action IS NOT NULL AND actual IS NOT NULL) AS evaluated FROM res GROUP BY 1",
    "d10_d16_rewards": f"WITH {_RES}, z AS (SELECT *, 0.5::DOUBLE AS sharpe_score, action IS NOT NULL AND actual IS NOT NULL AND error IS NULL AS ok FROM res), {_reward_sql('result_id')}",
    "d10_d17_example_rewards": f"""WITH {_ANSWERS}, h AS (SELECT example_id, ground_truth.actual_return_pct AS actual, coalesce(metadata.historical_returns, []) AS h FROM rlvr_examples),
res AS (SELECT example_id, actual, {_CLEAN.format(c="(j ->> '$.action')")} AS action, j ->> '$.reasoning' AS reasoning, j ->> '$.support' AS support, CASE WHEN len(h) < 2 OR list_stddev_samp(h) = 0 THEN 0 ELSE list_avg(h) / list_stddev_samp(h) END AS s FROM j JOIN h USING (example_id)),
z AS (SELECT *, 1 / (1 + exp(-s)) AS sharpe_score, action IS NOT NULL AND actual IS NOT NULL AS ok FROM res), {_reward_sql("example_id")}""",
    "d03_capped_sharpe": """WITH h AS (SELECT example_id, coalesce(metadata.historical_returns, []) AS h FROM rlvr_examples), s AS (SELECT example_id, CAST(len(h) AS INTEGER) AS n, list_avg(h) AS m, list_stddev_samp(h) AS sd FROM h),
r AS (SELECT *, CASE WHEN n < 2 THEN NULL WHEN sd <= abs(m) * 1e-12 THEN CASE WHEN m > 0 THEN 999.99::DOUBLE ELSE 0 END ELSE m / sd END AS s FROM s)
SELECT example_id, n, CASE WHEN n >= 2 THEN round(m, 6) END AS mean_return, CASE WHEN n >= 2 THEN round(sd, 6) END AS deviation, round(s, 6) AS sharpe, round(CASE WHEN n < 2 OR s < 1 THEN 0 ELSE 1 / (1 + exp(1 - s)) END, 4) AS score FROM r""",
    "d15_history_sharpe": """WITH h AS (SELECT example_id, coalesce(metadata.historical_returns, []) AS h FROM rlvr_examples), s AS (SELECT example_id, len(h) AS n, list_avg(h) AS m, list_stddev_samp(h) AS sd FROM h),
r AS (SELECT example_id, CASE WHEN n < 2 OR sd = 0 THEN 0 ELSE m / sd END AS s FROM s) SELECT example_id, round(s, 6) AS sharpe, round(1 / (1 + exp(-s)), 6) AS sigmoid FROM r""",
    "d17_d21_predictions": f"WITH {_ANSWERS} SELECT example_id, lower(trim(j ->> '$.action')) AS action, CAST(length(j ->> '$.reasoning') AS INTEGER) AS reasoning_length, (j ->> '$.action') IS NOT NULL AS usable FROM j",
    "d22_chronological_split": f"""WITH e AS (SELECT example_id, {ORACLE_DAY.format(c="metadata.entry_date")} AS day FROM rlvr_examples), k AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS k, count(*) OVER () AS n FROM e WHERE day IS NOT NULL),
c AS (SELECT day AS cut FROM k WHERE k = (n * 4) // 5) SELECT example_id, day, CASE WHEN day <= cut THEN 'train' ELSE 'dev' END AS new_split FROM k, c""",
    "d23_assembly": f"""WITH {_RES}, x AS (SELECT *, entry_date < '2024-07-01' AS early FROM res WHERE error IS NULL AND prompt IS NOT NULL AND entry_date IS NOT NULL AND action IS NOT NULL)
SELECT result_id, CASE WHEN early THEN 'train' ELSE 'dev' END AS form, CASE WHEN early THEN 'system,user' ELSE 'system,user,assistant' END AS roles, md5(prompt) AS prompt_md5, CASE WHEN NOT early THEN action END AS answer,
  CASE WHEN NOT early THEN md5(reasoning) END AS reasoning_md5, CASE WHEN NOT early THEN md5(support) END AS support_md5, actual AS actual_return_pct, days_held, ticker, entry_date FROM x""",
    "d24_example_errors": f"""WITH m AS (SELECT *, dataset_split = 'train' AS train, len(messages) AS n, messages[3].content AS a, coalesce(messages[3].content, '') <> '' AS given FROM rlvr_examples),
k AS (SELECT *, NOT train AND n > 2 AND given AS asked, coalesce(json_valid(a), false) AS good FROM m), w AS (SELECT *, good AND {" AND ".join(f"(CASE WHEN good THEN a END -> '$.{x}') IS NOT NULL" for x in sc.SECTIONS)} AS whole, CASE WHEN good THEN a ->> '$.conclusion.recommendation' END AS said FROM k),
r AS (SELECT example_id, concat_ws(',', CASE WHEN messages IS NULL THEN 'no messages' END, CASE WHEN train AND n <> 2 THEN 'train needs 2 messages' END, CASE WHEN NOT train AND n <> 3 THEN 'dev needs 3 messages' END,
  CASE WHEN n > 0 AND messages[1].role IS DISTINCT FROM 'system' THEN 'first isn''t system' END, CASE WHEN n > 0 AND coalesce(messages[1].content, '') = '' THEN 'empty system message' END,
  CASE WHEN n > 1 AND messages[2].role IS DISTINCT FROM 'user' THEN 'second isn''t user' END, CASE WHEN n > 1 AND coalesce(messages[2].content, '') = '' THEN 'empty user message' END,
  CASE WHEN train AND len(list_filter(messages, lambda x: x.role = 'assistant')) > 0 THEN 'answer in training' END, CASE WHEN NOT train AND n > 2 AND messages[3].role IS DISTINCT FROM 'assistant' THEN 'third isn''t assistant' END,
  CASE WHEN NOT train AND n > 2 AND NOT given THEN 'empty answer' END, CASE WHEN asked AND NOT good THEN 'answer isn''t JSON' END, CASE WHEN asked AND whole AND said IS NULL THEN 'no recommendation' END, CASE WHEN asked AND whole AND said NOT IN {tuple(sc.RECOMMENDATIONS)} THEN 'unknown recommendation' END,
  {", ".join(f"CASE WHEN asked AND good AND NOT whole AND (CASE WHEN good THEN a ->> '$.{x}' END) IS NULL THEN 'answer without {x}' END" for x in ("reasoning", "action", "support"))},
  CASE WHEN ground_truth IS NULL THEN 'no ground truth' END, {", ".join(f"CASE WHEN ground_truth IS NOT NULL AND ground_truth.{c} IS NULL THEN 'no {c}' END" for c in ("actual_return_pct", "exit_date", "days_held"))},
  CASE WHEN metadata IS NULL THEN 'no metadata' END, {", ".join(f"CASE WHEN metadata IS NOT NULL AND metadata.{c} IS NULL THEN 'no {c}' END" for c in ("ticker", "entry_date"))}) AS errors FROM w)
SELECT * FROM r WHERE errors <> ''""",
    "a31_d25_split_counts": """SELECT dataset_split, count(*) AS n, count(*) FILTER (ground_truth IS NULL) AS no_truth, count(*) FILTER (ground_truth.early_exit) AS early, round(avg(ground_truth.actual_return_pct), 6) AS mean_return,
  count(DISTINCT metadata.ticker) AS tickers, count(*) >= 100 AS enough FROM rlvr_examples GROUP BY 1""",
    "d04_a28_past_returns": f"""WITH e AS (SELECT example_id, metadata.ticker AS ticker, {ORACLE_DAY.format(c="metadata.entry_date")} AS day, ground_truth.actual_return_pct AS r FROM rlvr_examples), f AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day, example_id) AS i FROM e WHERE ticker IS NOT NULL AND day IS NOT NULL AND r IS NOT NULL)
SELECT a.example_id, count(*) AS n, round(sum(b.r), 4) AS total, arg_max(b.r, b.i) AS newest, arg_min(b.r, b.i) AS oldest FROM f a JOIN f b ON a.ticker = b.ticker AND b.i BETWEEN a.i - 30 AND a.i - 1 GROUP BY 1""",
    "d26_adapter": f"""WITH {_RES} SELECT result_id, coalesce(action, 'hold') AS action,
  coalesce(nullif(reasoning, '') || coalesce(chr(10) || chr(10) || 'Additional Analysis:' || chr(10) || 'Valuation: ' || nullif(support, ''), ''), 'Valuation: ' || nullif(support, ''), 'No detailed reasoning provided') AS reasoning,
  concat_ws(chr(10), nullif(reasoning, ''), 'Confidence: 0.75') AS support FROM res WHERE reasoning IS NOT NULL""",
}
