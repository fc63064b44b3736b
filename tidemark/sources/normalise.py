"""Raw records to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_symbol(column: str | Column) -> Column:
    """`aapl.US` to `AAPL`."""
    return F.upper(F.split_part(F.trim(column), F.lit("."), F.lit(1)))


def safe_double(column: str | Column) -> Column:
    """A double, or NULL for junk and NaN."""
    c = F.col(column) if isinstance(column, str) else column
    d = c.cast("string").try_cast("double")
    return F.when(~F.isnan(d), d)


def safe_long(column: str | Column) -> Column:
    """The whole part of a number, or NULL for junk and what doesn't fit."""
    d = safe_double(column)
    return F.when(F.abs(d) < 9.2e18, F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d))).cast("long")


def first_truthy(*columns: Column) -> Column:
    """The first that is neither NULL nor 0."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in columns])


def in_range(df: DataFrame, date: str, start: str | None = None, end: str | None = None, key: str | None = None, keys: Sequence | None = None) -> DataFrame:
    """Rows within both dates, these included, and of the given keys; what is None doesn't filter."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    if keys is not None:
        df = df.where(F.col(key).isin(list(keys)))
    return df


def sentiment_label(score: Column, label: Column | None = None) -> Column:
    """positive, negative or neutral: the label as given if it is one of them in any spelling, else by the score at +-0.1; NULL without either."""
    by_score = F.when(score > 0.1, "positive").when(score < -0.1, "negative").when(score.isNotNull(), "neutral")
    if label is None:
        return by_score
    c = F.lower(F.trim(label))
    given = F.when(c.startswith("pos"), "positive").when(c.startswith("neg"), "negative").when(c.startswith("neu"), "neutral")
    return F.coalesce(given, by_score)


def transaction_kind(code: Column) -> Column:
    """The one-letter code: upper case, and words by their meaning."""
    c = F.upper(F.trim(code))
    return F.when(c.startswith("SALE"), "S").when(c.startswith("PURCH") | c.startswith("BUY"), "P").when(F.length(c) == 1, c).otherwise(F.nullif(F.substring(c, 1, 1), F.lit("")))


def consensus(counts: Sequence[tuple[str, Column]]) -> Column:
    """The name with the greatest count, of equals the first; NULL if all are 0."""
    most = F.greatest(*[c for _, c in counts])
    out = F.when(most <= 0, None)
    for name, c in counts:
        out = out.when(c == most, F.lit(name))
    return out


def explode_map(df: DataFrame, column: str, key: str, value: str, *keep: str) -> DataFrame:
    """A map of indicators to rows."""
    return df.select(*keep, F.explode(column).alias(key, value))


def intraday_rows(raw: DataFrame, symbol: str, interval: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Intraday records (datetime, open, high, low, close, volume) of one symbol as typed rows, within both days; an unreadable time is NULL and left out by a range."""
    at = F.try_to_timestamp("datetime").cast("timestamp_ntz")
    rows = raw.select(base_symbol(F.lit(symbol)).alias("symbol"), F.to_date(at).alias("date"), at.alias("timestamp"), F.lit(interval).alias("interval"), *[safe_double(c).alias(c) for c in ("open", "high", "low", "close")], safe_long("volume").alias("volume"))
    return in_range(rows, "date", start, end)


# The items of each statement, as they are delivered, by the column they become; of several the first that is neither absent nor 0.
ITEMS = {
    "income": {"revenue": "totalRevenue", "net_income": "netIncome", "operating_income": "operatingIncome", "gross_profit": "grossProfit", "ebitda": "ebitda"},
    "balance": {
        "total_assets": "totalAssets", "total_liabilities": "totalLiab", "stockholder_equity": "totalStockholderEquity",
        "cash_and_equivalents": "cashAndCashEquivalents cash cashAndShortTermInvestments", "total_debt": "shortLongTermDebtTotal totalDebt longTermDebt",
    },
    "cash": {"operating_cash_flow": "totalCashFromOperatingActivities", "free_cash_flow": "freeCashFlow"},
}
HIGHLIGHTS = {"pe_ratio": "PERatio", "eps": "EarningsShare", "book_value": "BookValue"}


def fundamentals(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Quarters of nested filings to rows.

    raw: symbol, market_cap, balance, income, cash and, if there, highlights:
    the three statements are maps of quarter to a map of item to text,
    highlights is a map of item to text. A quarter is in the result if any of
    the statements has it, its filing date (the first given, in this order)
    exists and lies within both dates. Junk numbers are NULL. The statements
    come out as JSON too, NULL where a quarter has none.
    """

    def part(name: str) -> DataFrame:
        return raw.select("symbol", F.explode(name).alias("quarter", name))

    highlights = F.col("highlights") if "highlights" in raw.columns else F.lit(None).cast("map<string,string>")
    heads = raw.select("symbol", "market_cap", highlights.alias("highlights"))
    joined = heads.join(part("balance").join(part("income"), ["symbol", "quarter"], "full_outer").join(part("cash"), ["symbol", "quarter"], "full_outer"), "symbol")
    item = lambda m, k: F.try_element_at(m, F.lit(k))
    filing = F.coalesce(*[F.nullif(item(m, "filing_date"), F.lit("")) for m in ("balance", "income", "cash")])

    def figure(m: str, names: str) -> Column:
        found = [safe_long(item(m, k)) for k in names.split()]
        return found[0] if len(found) == 1 else first_truthy(*found)

    out = joined.select(
        base_symbol("symbol").alias("symbol"),
        F.to_date("quarter").alias("report_date"),
        F.to_date(filing).alias("filing_date"),
        safe_long("market_cap").alias("market_cap"),
        *[safe_double(item("highlights", k)).alias(c) for c, k in HIGHLIGHTS.items()],
        *[figure(m, names).alias(c) for m, items in ITEMS.items() for c, names in items.items()],
        *[F.to_json(F.when(F.size(m) > 0, F.col(m))).alias(f"{m}_json") for m in ("balance", "income", "cash")],
    )
    return in_range(out.where("filing_date is not null"), "filing_date", start, end)


def observations(raw: DataFrame, metadata: DataFrame) -> DataFrame:
    """Macroeconomic observations with their series' title (its id where there is none); the mark `.` for a missing value is left out."""
    values = raw.where("trim(value) <> '.'").select("series_id", F.to_date("date").alias("date"), safe_double("value").alias("value"))
    return values.join(metadata, "series_id", "left").select("series_id", F.coalesce(F.nullif("title", F.lit("")), "series_id").alias("title"), "date", "value")
