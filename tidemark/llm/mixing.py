"""Mixing sources to target weights."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.session import cut_lineage

RANKS = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: 2^31 divided by the golden ratio, odd: its multiples modulo 2^31 are evenly spread
GOLDEN, PERIOD = 1327217885, 1 << 31


def token_counter(path: str = RANKS):
    """A column function: tokens of a text by a public rank file (0 for null and empty texts)."""

    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken

        from tidemark.llm.encode import WORDS

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("mixing", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(own.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count


def mix_sources(sizes: DataFrame, weights: DataFrame, block_tokens: int = 1024, total_tokens: int | None = None, rounds: int = 8, close: float = 0.002) -> tuple[DataFrame, DataFrame]:
    """A mix in which each source has its target share of the tokens, and the shares reached.

    sizes: (doc_id, source, n_tokens), doc_id unique. weights: (source,
    target_share, max_repeats). Texts are used whole. total_tokens: size of the
    mix; by default the largest at which no source needs more than its repeats.
    With a larger one, sources that run out fall short, and the report says so.

    Slots 0, 1, 2, ... fall on the sources by a golden-ratio sequence through
    their cumulative weights, so every stretch of the mix has the target shares.
    A source's wanted tokens are cut into as many equal blocks as it has slots:
    its texts in a hash order, pass after pass, are laid along them, and a text
    belongs to the block it starts in. A last text that is too long is left out;
    the gap is filled with the texts after it as far as they fit, then, in at
    most `rounds` rounds, with the largest text not yet used in that pass which
    fits, until what is missing is less than the part `close` of the source's
    tokens. So a source misses its share by that or by its least unused text,
    not by part of a long one.

    Returns (slot, source, doc_id, copy, n_tokens) and (source, target_share,
    actual_share, tokens, texts, most_copies, max_repeats). Rows with a NULL
    source, one without weight, or no tokens aren't used; sources without texts
    get no slots and actual share 0. Only sums, one row a source, reach the
    driver.
    """
    spark = sizes.sparkSession
    usable = sizes.where("n_tokens > 0 and source is not null").join(weights.where("target_share > 0 and max_repeats > 0").select("source"), "source", "left_semi").select("doc_id", "source", "n_tokens")
    usable = cut_lineage(usable, "sizes")
    totals = {r["source"]: r["t"] for r in usable.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    wanted = [(r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in weights.where("target_share > 0 and max_repeats > 0").orderBy("source").collect()]
    plan = [w for w in wanted if w[0] in totals]
    if not plan:
        mix = spark.createDataFrame([], "slot long, source string, doc_id long, copy int, n_tokens long")
    else:
        norm = sum(w for _, w, _ in plan)
        size = total_tokens or min(totals[s] * m / (w / norm) for s, w, m in plan)
        asked = {s: min(round(w / norm * size), totals[s] * m) for s, w, m in plan}
        slots = _schedule(spark, [(s, w / norm) for s, w, _ in plan], max(1, round(size / block_tokens)))
        uses = _uses(usable, asked, totals, rounds, close)
        number = slots.groupBy("source").agg(F.count("*").alias("slots"))
        # a source may be too small for a slot of its own: its texts go to the first
        placed = uses.join(F.broadcast(number), "source", "left")  # one row a source
        placed = placed.withColumn("r", F.least(F.floor(F.col("x") * F.col("slots") / F.col("asked")), F.col("slots") - 1))
        mix = placed.join(slots, ["source", "r"], "left").select(F.coalesce("slot", F.lit(0)).alias("slot"), "source", "doc_id", "copy", "n_tokens")
    used = mix.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("texts"), F.max("copy").alias("most_copies"))
    share = F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(0))), F.lit(0))  # one row a source
    report = weights.join(used, "source", "left").fillna(0, ["tokens", "texts", "most_copies"])
    report = report.select("source", "target_share", F.coalesce(share, F.lit(0.0)).alias("actual_share"), "tokens", "texts", "most_copies", "max_repeats")
    return mix, report


def _schedule(spark: SparkSession, shares: list[tuple[str, float]], n: int) -> DataFrame:
    """(slot, source, r): n slots dealt by the golden ratio; r counts a source's slots."""
    edges, upto = [], 0.0
    for _, share in shares:
        upto += share
        edges.append(min(PERIOD, round(PERIOD * upto)))
    edges[-1] = PERIOD
    names = F.array(*[F.lit(s) for s, _ in shares])
    slots = spark.range(n).withColumn("p", F.expr(f"pmod(pmod(id, {PERIOD}) * {GOLDEN}, {PERIOD})"))
    slots = slots.select(F.col("id").alias("slot"), F.get(names, F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col("p")))).alias("source"))
    # within stretches of slots first, then the stretches' offsets
    slots = slots.withColumn("stretch", F.floor(F.col("slot") / 65536))
    counts = slots.groupBy("source", "stretch").count()
    counts = counts.withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    slots = slots.withColumn("r", F.row_number().over(Window.partitionBy("source", "stretch").orderBy("slot")) - 1).join(counts, ["source", "stretch"])
    return slots.select("slot", "source", (F.col("r") + F.col("before")).alias("r"))


def _uses(usable: DataFrame, asked: dict[str, int], totals: dict[str, int], rounds: int, close: float) -> DataFrame:
    """(source, doc_id, n_tokens, copy, x, asked): each use of a text with its first token among those the source is asked for."""
    spark = usable.sparkSession
    facts = spark.createDataFrame([(s, a, totals[s]) for s, a in asked.items()], "source string, asked long, total long")
    rows = usable.count()
    laid = cut_lineage(_starts(usable, max(256, rows // 500_000)).join(F.broadcast(facts), "source"), "laid")  # one row a source
    whole = F.expr("asked div total")
    laid = laid.withColumn("fits", F.expr("start + n_tokens <= asked % total"))
    spare = laid.where("not fits and asked % total > 0")
    gaps = {s: a % totals[s] for s, a in asked.items() if a % totals[s]}
    for r in laid.where("fits").groupBy("source").agg(F.sum("n_tokens").alias("t")).collect():
        gaps[r["source"]] -= r["t"]
    still = lambda: F.broadcast(spark.createDataFrame([(s, g) for s, g in gaps.items() if g > close * asked[s]], "source string, gap long"))  # noqa: E731, one row a source
    picked = spare.select("source", "doc_id", "n_tokens").where("false")
    if any(g > close * asked[s] for s, g in gaps.items()):
        # the texts after the one that was too long, as far as they fit: a range of tokens that one long text bounds
        near = spare.join(still(), "source").where("n_tokens <= gap and start < asked % total + 64 * gap")
        upto = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
        picked = cut_lineage(near.withColumn("upto", upto).where("upto <= gap").select("source", "doc_id", "n_tokens"), "picked")
        for r in picked.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect():
            gaps[r["source"]] -= r["t"]
    taken: list[tuple[str, int, int]] = []
    one_by_one = lambda: spark.createDataFrame(taken, "source string, doc_id long, n_tokens long")  # noqa: E731, at most a row a source and round
    for _ in range(rounds):
        if not any(g > close * asked[s] for s, g in gaps.items()):
            break
        left = spare.join(still(), "source").where("n_tokens <= gap").join(picked.unionByName(one_by_one()).select("doc_id"), "doc_id", "left_anti")
        found = left.groupBy("source").agg(F.max(F.struct("n_tokens", "doc_id")).alias("x")).select("source", "x.*").collect()
        if not found:
            break
        for r in found:
            gaps[r["source"]] -= r["n_tokens"]
            taken.append((r["source"], r["doc_id"], r["n_tokens"]))
    columns = ["source", "doc_id", "n_tokens", "asked"]
    passes = F.when(F.col("fits"), whole + 1).otherwise(whole)
    out = laid.where(passes > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), passes))).select(*columns, F.col("copy").cast("int").alias("copy"), ((F.col("copy") - 1) * F.col("total") + F.col("start")).alias("x"))
    filled = spare.join(picked.unionByName(one_by_one()).select("doc_id"), "doc_id", "left_semi")
    out = out.unionByName(filled.select(*columns, (whole + 1).cast("int").alias("copy"), (F.col("asked") - 1).alias("x")))
    return out


def _starts(usable: DataFrame, buckets: int = 256) -> DataFrame:
    """Each text's first token in its source's hash order: sums within hash buckets, then the buckets' offsets."""
    d = usable.withColumn("h", F.xxhash64("doc_id", F.lit(17))).withColumn("hb", F.pmod("h", F.lit(buckets)))
    inner = Window.partitionBy("source", "hb").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("source").orderBy("hb").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("source", "hb").agg(F.sum("n_tokens").alias("t")).withColumn("off", F.coalesce(F.sum("t").over(outer), F.lit(0))).drop("t")
    d = d.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(sums, ["source", "hb"])
    return d.select("source", "doc_id", "n_tokens", (F.col("inner") + F.col("off")).alias("start"))



