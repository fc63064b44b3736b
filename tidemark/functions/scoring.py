"""Scalar rules of evaluation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms whose presence speaks for a reasoned answer.
FINANCIAL_TERMS = ["price", "trend", "momentum", "support", "resistance", "volume", "rsi", "moving average", "earnings", "revenue", "growth", "valuation", "p/e", "fundamental", "technical"]
# Expected return of each action, and its weight in a weighted strategy.
EXPECTED = {"strong_buy": 4.0, "buy": 2.5, "hold": 0.0, "sell": -2.5, "strong_sell": -4.0}
WEIGHTS = {"strong_buy": 2.0, "buy": 1.0, "hold": 0.0, "sell": -1.0, "strong_sell": -2.0}


def clean_action(column: str) -> Column:
    """One of five actions, or NULL: case, blanks and separators don't matter."""
    c = F.regexp_replace(F.lower(F.trim(column)), r"[\s\-]+", "_")
    return F.when(c.isin(*EXPECTED), c)


def choose(column: Column, values: dict[str, float], other: float | None = None) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for k, v in values.items():
        out = out.when(column == k, F.lit(v))
    return out if other is None else out.otherwise(F.lit(other))


def directional(action: Column, actual: Column, rule: str = "reward") -> Column:
    """Whether the return went the action's way: by sign and +-1 ("sql"), or by 3, 2 and +-2 ("reward")."""
    if rule == "sql":
        ok = F.when(action.isin("buy", "strong_buy"), actual >= 0).when(action.isin("sell", "strong_sell"), actual <= 0).when(action == "hold", F.abs(actual) <= 1)
    else:
        ok = F.when(action == "strong_buy", actual >= 3).when(action == "buy", actual >= 2).when(action == "hold", F.abs(actual) <= 2).when(action == "sell", actual <= -2).when(action == "strong_sell", actual <= -3)
    return F.coalesce(ok, F.lit(False))


def magnitude(action: Column, actual: Column) -> Column:
    """exp(-|expected - actual| / 5)."""
    return F.exp(-F.abs(choose(action, EXPECTED, 0.0) - actual) / 5)


def calibration(correct: Column, confidence: Column) -> Column:
    return F.when(correct, 0.5 + 0.5 * confidence).otherwise(1 - confidence)


def downside(action: Column, actual: Column) -> Column:
    buys, sells = action.isin("buy", "strong_buy"), action.isin("sell", "strong_sell")
    return (
        F.when(buys & (actual < -5), F.least(F.lit(1.0), F.abs(actual) / 10))
        .when(sells & (actual > 5), F.least(F.lit(0.5), actual / 20))
        .when((action == "hold") & (F.abs(actual) > 5), F.least(F.lit(0.3), F.abs(actual) / 30))
        .otherwise(0.0)
    )


def reasonableness(reasoning: Column, support: Column) -> Column:
    """0 to 1 by the lengths of both texts, the financial terms named, and figures given."""
    both = F.lower(F.concat_ws(" ", reasoning, support))
    terms = sum((F.when(both.contains(t), 1).otherwise(0) for t in FINANCIAL_TERMS), F.lit(0))
    n, m = F.coalesce(F.length(reasoning), F.lit(0)), F.coalesce(F.length(support), F.lit(0))
    score = F.when(n >= 100, 0.3).when(n >= 50, 0.15).otherwise(0.0) + F.when(m >= 50, 0.2).when(m >= 25, 0.1).otherwise(0.0)
    score = score + F.when(terms >= 3, 0.3).when(terms >= 2, 0.2).when(terms >= 1, 0.1).otherwise(0.0)
    score = score + F.when(both.rlike(r"\d+\.?\d*%"), 0.1).otherwise(0.0) + F.when(both.rlike(r"\$\d+"), 0.1).otherwise(0.0)
    return F.least(F.lit(1.0), score)


def sharpe(mean: Column, deviation: Column, n: Column) -> Column:
    """Mean over sample deviation; 0 for fewer than two values or none spread."""
    return F.when((n < 2) | deviation.isNull() | (deviation == 0), 0.0).otherwise(F.try_divide(mean, deviation))


def lenient_json(text: Column) -> Column:
    """The first of three candidates that is a JSON object: the text, what a code fence holds, first brace to last."""
    fence = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    brace = F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))
    whole = F.when(F.trim(text).startswith("{"), F.trim(text))
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    return F.coalesce(valid(whole), valid(fence), valid(brace))


def history_sharpe(returns: Column) -> tuple[Column, Column, Column]:
    """(values, mean, sample deviation) of an array of returns; NULL counts as no array, the deviation of fewer than two is NULL."""
    h = F.coalesce(returns, F.array().cast("array<double>"))
    n = F.size(h)
    mean = F.try_divide(F.aggregate(h, F.lit(0.0), lambda acc, v: acc + v), n)
    squares = F.aggregate(h, F.struct(F.lit(0.0).alias("s"), mean.alias("m")), lambda acc, v: F.struct((acc["s"] + (v - acc["m"]) * (v - acc["m"])).alias("s"), acc["m"].alias("m")))["s"]
    return n, mean, F.when(n >= 2, F.sqrt(F.try_divide(squares, n - 1)))


def capped_sharpe(n: Column, mean: Column, deviation: Column, risk_free: float = 0.0) -> tuple[Column, Column]:
    """(ratio, score): NULL and 0 for fewer than two values; 999.99 for a mean above the risk-free rate without any spread, else 0; the score is 0 below a ratio of 1, from there sigmoid(ratio - 1)."""
    # values all alike have a deviation of 0 but for rounding
    flat = deviation <= F.abs(mean) * 1e-12
    ratio = F.when(n < 2, None).when(flat, F.when(mean > risk_free, 999.99).otherwise(0.0)).otherwise(F.try_divide(mean - risk_free, deviation))
    return ratio, F.when((n < 2) | (ratio < 1), 0.0).otherwise(1 / (1 + F.exp(1 - ratio)))


# The sections of an answer, and its recommendations by action.
SECTIONS = ["fundamentals", "technical", "news", "valuation", "risk_assessment", "macro", "conclusion"]
RECOMMENDATIONS = {"Strong Buy": "strong_buy", "Buy": "buy", "Hold": "hold", "Sell": "sell", "Strong Sell": "strong_sell"}


def flat_answer(answer: Column) -> Column:
    """An answer of seven sections (JSON text) as struct (action, reasoning, support).

    The action is the conclusion's recommendation, `hold` where that is none of
    the five. The conclusion's reasoning comes first, then what the other
    sections say, in their order; of news, risks and macro 200 characters and
    `...` are shown. Support is the conclusion's reasoning, confidence, target
    price and horizon and the key metrics, a line each. NULL and junk have the
    action `hold` and say so.
    """
    at = lambda path: F.nullif(F.get_json_object(answer, f"$.{path}"), F.lit(""))
    # concat gives NULL where its value is missing, and concat_ws leaves that out
    said = lambda label, path: F.concat(F.lit(label), at(path))
    start = lambda label, path: F.concat(F.lit(label), F.substring(at(path), 1, 200), F.lit("..."))
    section = lambda label, *parts: F.concat(F.lit(label), F.nullif(F.concat_ws(" | ", *parts), F.lit("")))
    parts = F.array_compact(F.array(
        section("Fundamentals: ", said("Balance Sheet: ", "fundamentals.balance_sheet_strength"), said("Income: ", "fundamentals.income_performance"), said("Cash Flow: ", "fundamentals.cash_flow")),
        section("Technical: ", said("Price Action: ", "technical.price_action"), said("Momentum: ", "technical.momentum")),
        section("News: ", said("Sentiment: ", "news.sentiment_summary"), start("Recent News: ", "news.recent_3_days")),
        said("Valuation: ", "valuation.assessment"), start("Risks: ", "risk_assessment.ticker_specific_risks"), start("Macro: ", "macro.impact"),
    ))
    own = at("conclusion.reasoning")
    reasoning = F.when(own.isNotNull(), F.concat(own, F.when(F.size(parts) > 0, F.concat(F.lit("\n\nAdditional Analysis:\n"), F.array_join(parts, "\n"))).otherwise(""))).when(F.size(parts) > 0, F.array_join(parts, "\n\n")).otherwise("No detailed reasoning provided")
    metrics = F.from_json(F.get_json_object(answer, "$.fundamentals.key_metrics"), "map<string,string>")
    shown = F.nullif(F.array_join(F.transform(F.filter(F.map_entries(metrics), lambda e: e["value"].isNotNull()), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), ", "), F.lit(""))
    confidence = F.get_json_object(answer, "$.conclusion.confidence").try_cast("double")
    support = F.concat_ws("\n", own, F.when(confidence.isNotNull(), F.format_string("Confidence: %.2f", confidence)), said("Target Price: ", "conclusion.target_price"), said("Time Horizon: ", "conclusion.time_horizon"), F.concat(F.lit("Key Metrics: "), shown))
    action = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in RECOMMENDATIONS.items() for x in kv]), at("conclusion.recommendation")), F.lit("hold"))
    struct = lambda a, r, s: F.struct(a.alias("action"), r.alias("reasoning"), s.alias("support"))
    junk = F.coalesce(~F.ltrim(answer).startswith("{"), F.lit(True)) | F.try_parse_json(answer).isNull()
    return F.when(junk, struct(F.lit("hold"), F.lit("Invalid response format"), F.lit(""))).otherwise(struct(action, reasoning, support))


def answer_errors(answer: Column) -> list[Column]:
    """What is wrong with an answer (JSON text), each NULL if it isn't: seven sections with a recommendation, or reasoning, action and support."""
    has = lambda path: F.get_json_object(answer, f"$.{path}").isNotNull()
    parsed = F.coalesce(F.try_parse_json(answer).isNotNull(), F.lit(False))
    whole = has(SECTIONS[0])
    for name in SECTIONS[1:]:
        whole = whole & has(name)
    said = F.get_json_object(answer, "$.conclusion.recommendation")
    return [
        F.when(~parsed, "answer isn't JSON"),
        F.when(parsed & whole & said.isNull(), "no recommendation"),
        F.when(parsed & whole & ~said.isin(*RECOMMENDATIONS), "unknown recommendation"),
        *[F.when(parsed & ~whole & ~has(k), f"answer without {k}") for k in ("reasoning", "action", "support")],
    ]
