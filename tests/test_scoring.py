"""Answers, Sharpe ratios and example lines by literal cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scoring as sc
from tidemark.plans.backtest import example_lines


def flat(spark, *answers):
    rows = [(i, a if a is None or isinstance(a, str) else json.dumps(a)) for i, a in enumerate(answers)]
    out = spark.createDataFrame(rows, "i int, a string").select("i", sc.flat_answer(F.col("a")).alias("x")).orderBy("i").collect()
    return [tuple(r["x"]) for r in out]


def test_flat_answers(spark):
    long = "n" * 300
    full = {
        "fundamentals": {"balance_sheet_strength": "strong", "income_performance": "", "cash_flow": "fine", "key_metrics": {"P/E": 12, "ROE": None}}, "technical": {"momentum": "up"},
        "news": {"sentiment_summary": "good", "recent_3_days": long}, "valuation": {"assessment": "fair"}, "risk_assessment": {"ticker_specific_risks": "few"}, "macro": {},
        "conclusion": {"recommendation": "Strong Buy", "reasoning": "All of it.", "confidence": 0.8, "target_price": "120", "time_horizon": "3 days"},
    }
    whole, bare, odd, junk, none = flat(spark, full, {"valuation": {"assessment": "fair"}, "macro": {"impact": "low"}}, {"conclusion": {"recommendation": "maybe"}}, "no json", None)
    parts = ["Fundamentals: Balance Sheet: strong | Cash Flow: fine", "Technical: Momentum: up", "News: Sentiment: good | Recent News: " + "n" * 200 + "...", "Valuation: fair", "Risks: few..."]
    assert whole == ("strong_buy", "All of it.\n\nAdditional Analysis:\n" + "\n".join(parts), "All of it.\nConfidence: 0.80\nTarget Price: 120\nTime Horizon: 3 days\nKey Metrics: P/E: 12")
    assert bare == ("hold", "Valuation: fair\n\nMacro: low...", "")
    assert odd == ("hold", "No detailed reasoning provided", "")
    assert junk == none == ("hold", "Invalid response format", "")


def test_answer_errors(spark):
    seven = {s: {"x": 1} for s in sc.SECTIONS}
    cases = ["{broken", {"action": "buy"}, {"reasoning": "r", "action": "a", "support": "s"}, seven, {**seven, "conclusion": {"recommendation": "Hold"}}, {**seven, "conclusion": {"recommendation": "Maybe"}}]
    df = spark.createDataFrame([(i, c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(cases)], "i int, a string")
    out = df.select("i", F.array_compact(F.array(*sc.answer_errors(F.col("a")))).alias("e")).orderBy("i").collect()
    assert [r["e"] for r in out] == [["answer isn't JSON"], ["answer without reasoning", "answer without support"], [], ["no recommendation"], [], ["unknown recommendation"]]


@pytest.mark.parametrize(
    ("returns", "ratio", "score"),
    [(None, None, 0.0), ([], None, 0.0), ([1.0], None, 0.0), ([2.0, 2.0], 999.99, 1.0), ([0.1, 0.1, 0.1], 999.99, 1.0), ([-1.0, -1.0], 0.0, 0.0), ([0.0, 0.0], 0.0, 0.0), ([1.0, 3.0], 1.414214, 0.6021), ([1.0, -3.0], -0.353553, 0.0)],
)
def test_capped_sharpe(spark, returns, ratio, score):
    df = spark.createDataFrame([(returns,)], "h array<double>")
    got = df.select(*[F.round(c, 6).alias(n) for n, c in zip("rs", sc.capped_sharpe(*sc.history_sharpe(F.col("h"))), strict=True)]).first()
    assert got["r"] == ratio
    assert round(got["s"], 4) == score


def test_lines_of_both_forms(spark):
    rows = [(1, "p \"q\" \n ü", "r", "buy", None, 1.5, 3, "AAA", "2024-01-02"), (2, "p2", "why", "sell", "s", -2.0, 2, "BBB", "2024-08-02")]
    df = spark.createDataFrame(rows, "result_id long, prompt string, reasoning string, action string, support string, actual double, days_held int, ticker string, entry_date string")
    train, dev = [json.loads(r["line"]) for r in example_lines(df).orderBy("result_id").collect()]
    assert [m["role"] for m in train["messages"]] == ["system", "user"] and train["messages"][1]["content"] == "p \"q\" \n ü"
    assert [m["role"] for m in dev["messages"]] == ["system", "user", "assistant"]
    assert json.loads(dev["messages"][2]["content"]) == {"reasoning": "why", "action": "sell", "support": "s"}
    assert dev["ground_truth"] == {"actual_return_pct": -2.0, "days_held": 2} and train["metadata"] == {"ticker": "AAA", "entry_date": "2024-01-02"}
