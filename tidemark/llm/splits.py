"""Splits that keep related records together."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.session import cut_lineage

# What may follow a company's name to tell its listings apart.
SHARE_CLASS = r"(?i)[\s,\-–(]*\b(?:class|cl|series|ser)\b[.\s]*[a-z0-9]{1,2}\b[\s.)]*(?:shares?|stock)?[\s.)]*$"
# Fixed values: `exchange:` before a symbol and a country after it.
SYMBOL_PREFIX, SYMBOL_SUFFIX = r"^[A-Z]{2,8}:", r"\.(?:US|UK|CA|DE|FR)$"


def name_key(column: str | Column) -> Column:
    """A company's name without case, spacing, punctuation and share class."""
    c = F.regexp_replace(F.trim(column), SHARE_CLASS, "")
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", ""), F.lit(""))


def symbol_key(column: str | Column) -> Column:
    """A ticker symbol in one way of writing: upper case, `.` before the share class, no `$`, exchange or country."""
    c = F.upper(F.regexp_replace(column, r"[\s\u00A0\u200B]", ""))
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^\$", ""), SYMBOL_PREFIX, ""), SYMBOL_SUFFIX, "")
    return F.nullif(F.regexp_replace(c, r"[.\-/_]+", "."), F.lit(""))


def water_fill(deficits: Sequence[float], size: float, count: int) -> list[int]:
    """How many of `count` groups of one size each split gets if every group goes to the split furthest below target.

    Closed form of the one-by-one greedy: all splits are filled to one level,
    and the few groups left over are dealt singly.
    """
    n = len(deficits)
    low, high = min(deficits) - size * (count + 1), max(deficits)
    for _ in range(100):
        mid = (low + high) / 2
        if sum(max(0, math.floor((d - mid) / size)) for d in deficits) > count:
            low = mid
        else:
            high = mid
    given = [max(0, math.floor((d - high) / size)) for d in deficits]
    left = [d - g * size for d, g in zip(deficits, given, strict=True)]
    for _ in range(count - sum(given)):
        at = max(range(n), key=lambda i: (left[i], -i))
        given[at] += 1
        left[at] -= size
    return given


def quotas(sizes: Sequence[tuple[int, int]], shares: Sequence[float]) -> list[tuple[int, list[int]]]:
    """(size, groups for each split), largest size first, from (size, number of groups)."""
    total = sum(s * c for s, c in sizes)
    deficits = [share * total for share in shares]
    out = []
    for size, count in sorted(sizes, reverse=True):
        given = water_fill(deficits, size, count)
        deficits = [d - g * size for d, g in zip(deficits, given, strict=True)]
        out.append((size, given))
    return out


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, buckets: int = 256) -> DataFrame:
    """`df` with the 0-based rank of each row within `keys`, in a hash order of `order`.

    Two levels, so that no key's rows meet in one task: rows are ranked within
    (keys, hash bucket), and the buckets' sizes give the offsets.
    """
    df = df.withColumn("__h", F.xxhash64(*order)).withColumn("__hb", F.pmod("__h", F.lit(buckets)))
    inner = Window.partitionBy(*keys, "__hb").orderBy("__h", *order)
    outer = Window.partitionBy(*keys).orderBy("__hb").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys, "__hb").count().withColumn("__off", F.coalesce(F.sum("count").over(outer), F.lit(0))).drop("count")
    out = df.withColumn("__rn", F.row_number().over(inner) - 1).join(sizes, [*keys, "__hb"])
    return out.withColumn(name, F.col("__rn") + F.col("__off")).drop("__h", "__hb", "__rn", "__off")


def assign_splits(groups: DataFrame, group: str, size: str, shares: Mapping[str, float]) -> DataFrame:
    """(group, split): whole groups dealt largest first to the split furthest below its share.

    Groups of one size are interchangeable, so the greedy runs over the
    histogram of sizes (of N records at most sqrt(2 N) rows reach the driver)
    and the groups take their place in it by rank. The NULL group is a group
    like any other; an empty input gives no rows.
    """
    spark = groups.sparkSession
    groups = cut_lineage(groups.select(F.col(group).alias("g"), F.col(size).alias("s")), "groups")
    histogram = [(int(r["s"]), int(r["n"])) for r in groups.groupBy("s").agg(F.count("*").alias("n")).collect()]
    names = list(shares)
    rows = []
    for s, given in quotas(histogram, [shares[n] for n in names]):
        start = 0
        for n, k in zip(names, given, strict=True):
            if k:
                rows.append((s, start, start + k, n))
            start += k
    places = spark.createDataFrame(rows, "s long, lo long, hi long, split string")
    placed = ranked(groups, ["s"], ["g"], "r", max(256, sum(n for _, n in histogram) // 500_000)).join(places, "s").where("r >= lo and r < hi")
    return placed.select(F.col("g").alias(group), "split")


def issuers(tickers: DataFrame) -> DataFrame:
    """(ticker_id, issuer): listings whose names agree apart from case, spacing, punctuation and share class, named by their least ticker_id."""
    listed = tickers.where("ticker_id is not null").select("ticker_id", F.concat(F.lit("t"), F.col("ticker_id").cast("string")).alias("a"), F.concat(F.lit("n"), name_key("company_name")).alias("b"))
    edges = listed.select("a", F.coalesce("b", "a").alias("b"))
    members = listed.select("ticker_id", F.col("a").alias("node")).distinct().join(connected_components(edges), "node")
    least = members.groupBy("root").agg(F.min("ticker_id").alias("issuer"))
    return members.join(least, "root").select("ticker_id", "issuer")


def user_message(column: str = "messages") -> Column:
    """The first message of role user; NULL without one."""
    return F.get(F.filter(column, lambda m: m["role"] == "user"), F.lit(0))["content"]


HEADING = r"^[^:\n]*:[\s\u00A0]*([^\s\u00A0(/]+)[\s\u00A0]*[(/][\s\u00A0]*([^)\n]*)"


def example_issuers(examples: DataFrame, tickers: DataFrame) -> DataFrame:
    """(example_id, ticker_id): each example with its issuer, by metadata.ticker, else the prompt's heading.

    A symbol no listing has falls back to the heading's symbol and then its
    company name; an example that none of them resolves gets NULL. Repeated rows
    of one example_id come out once.
    """
    known = issuers(tickers)
    lookup = (
        tickers.join(known, "ticker_id")
        .select("issuer", F.explode(F.array(F.concat(F.lit("s"), symbol_key("symbol")), F.concat(F.lit("n"), name_key("company_name")))).alias("key"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.min("issuer").alias("issuer"))
    )
    lookup = cut_lineage(lookup, "symbols")
    prompt = user_message()
    asked = examples.select(
        "example_id",
        F.concat(F.lit("s"), symbol_key("metadata.ticker")).alias("k0"),
        F.concat(F.lit("s"), symbol_key(F.nullif(F.regexp_extract(prompt, HEADING, 1), F.lit("")))).alias("k1"),
        F.concat(F.lit("n"), name_key(F.nullif(F.regexp_extract(prompt, HEADING, 2), F.lit("")))).alias("k2"),
    )
    for i in range(3):
        asked = asked.join(lookup.select(F.col("key").alias(f"k{i}"), F.col("issuer").alias(f"i{i}")), f"k{i}", "left")
    return asked.groupBy("example_id").agg(*[F.min(f"i{i}").alias(f"i{i}") for i in range(3)]).select("example_id", F.coalesce("i0", "i1", "i2").cast("int").alias("ticker_id"))
