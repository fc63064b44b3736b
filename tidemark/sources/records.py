"""Delivered JSON records, one a row of a column `value`, to the normalisers' input.

Bad JSON gives NULL fields; what a record needs to be told apart (a day, a
quarter) and hasn't, is left out by the function that reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import normalise as nz

STATEMENT = "struct<quarterly:map<string,map<string,string>>>"
FILINGS = f"Highlights map<string,string>, Financials struct<Balance_Sheet:{STATEMENT},Income_Statement:{STATEMENT},Cash_Flow:{STATEMENT}>"


def bars_of(raw: DataFrame, symbol: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily bars of one symbol, within both days; prices that are no numbers are NULL, records without a day are left out."""
    names = ("open", "high", "low", "close", "adjusted_close", "volume")
    r = raw.select(F.from_json("value", "date string, " + ", ".join(f"{n} string" for n in names)).alias("r")).select("r.*")
    rows = r.select(nz.base_symbol(F.lit(symbol)).alias("symbol"), F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))).alias("date"), F.lit("1d").alias("interval"), *[nz.safe_double(n).alias(n) for n in names[:-1]], nz.safe_long("volume").alias("volume"))
    return nz.in_range(rows.where("date is not null"), "date", start, end)


def indicators_of(raw: DataFrame, symbol: str) -> DataFrame:
    """(symbol, date, indicator, value): each figure of each record of indicators; absent and NULL ones are left out."""
    r = raw.select(F.from_json("value", "map<string,string>").alias("m"))
    rows = r.select(nz.base_symbol(F.lit(symbol)).alias("symbol"), F.to_date(F.try_to_timestamp(F.try_element_at("m", F.lit("date")), F.lit("yyyy-MM-dd"))).alias("date"), F.explode(F.map_filter("m", lambda k, v: k != "date")).alias("indicator", "text"))
    return rows.select("symbol", "date", "indicator", nz.safe_double("text").alias("value")).where("date is not null and value is not null")


def filings_of(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Quarters of nested filings (columns `symbol` and `value`) as rows; see `normalise.fundamentals`."""
    r = raw.select("symbol", F.from_json("value", FILINGS).alias("r"))
    quarters = lambda name: F.col(f"r.Financials.{name}.quarterly")
    nested = r.select("symbol", F.try_element_at("r.Highlights", F.lit("MarketCapitalization")).alias("market_cap"), quarters("Balance_Sheet").alias("balance"), quarters("Income_Statement").alias("income"), quarters("Cash_Flow").alias("cash"), F.col("r.Highlights").alias("highlights"))
    return nz.fundamentals(nested, start, end)


def insider_trades_of(raw: DataFrame, symbol: str) -> DataFrame:
    """The trades whose `code` is the symbol: what is delivered may hold others' too."""
    r = raw.select(F.from_json("value", "code string, date string, ownerName string, transactionCode string, transactionAmount string, transactionPrice string").alias("r")).select("r.*")
    return r.where(F.col("code") == symbol).select("code", F.to_date(F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))).alias("date"), F.col("ownerName").alias("owner_name"), nz.transaction_kind(F.col("transactionCode")).alias("kind"), nz.safe_long("transactionAmount").alias("shares"), nz.safe_double("transactionPrice").alias("price"))


def macro_of(raw: DataFrame, country: str, indicator: str) -> DataFrame:
    """(series_id, date, value) of one country's indicator, named country.indicator; records without a day or value are left out."""
    r = raw.select(F.from_json("value", "CountryCode string, Indicator string, Date string, Value string").alias("r")).select("r.*")
    rows = r.where((F.col("CountryCode") == country) & (F.col("Indicator") == indicator)).select(F.lit(f"{country}.{indicator}").alias("series_id"), F.to_date(F.try_to_timestamp("Date", F.lit("yyyy-MM-dd"))).alias("date"), nz.safe_double("Value").alias("value"))
    return rows.where("date is not null and value is not null")
