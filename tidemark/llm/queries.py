"""Queries and SQL of the training-data operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.encode import encode_column
from tidemark.llm.mixing import mix_sources, token_counter
from tidemark.llm.names import link_spellings, spelling_pairs
from tidemark.llm.overlap import cross_split_overlaps, overlap_pairs
from tidemark.llm.pairs import defective_pairs
from tidemark.llm.quality import STATISTICS, document_kinds
from tidemark.llm.splits import assign_splits, example_issuers, user_message
from tidemark.session import cut_lineage
from tidemark.tables import table

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def spread(df: DataFrame) -> DataFrame:
    """`df` on all cores if its files make fewer tasks than that; larger tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    firms = table(spark, folder, "analyst_recommendations").select(F.lit("firm:0").alias("scope"), F.col("firm").alias("name"))
    owners = table(spark, folder, "insider_transactions").where("ticker_id is not null").select(F.concat(F.lit("owner_name:"), F.col("ticker_id").cast("string")).alias("scope"), F.col("owner_name").alias("name"))
    return link_spellings(firms.unionByName(owners))


def _scoped(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(F.split_part("scope", F.lit(":"), F.lit(1)).alias("name_field"), F.split_part("scope", F.lit(":"), F.lit(2)).cast("int").alias("ticker_id"), *rest)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _scoped(spelling_pairs(_linked(spark, folder)), "name_a", "name_b")


def p2_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct spelling with the class of its entity."""
    return _scoped(_linked(spark, folder), "name", "entity")


def _overlaps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    examples = table(spark, folder, "rlvr_examples")
    records = examples.where("dataset_split is not null").select(F.col("example_id").alias("id"), (F.col("dataset_split") == "train").alias("train"), user_message().alias("text"))
    return cross_split_overlaps(records)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = overlap_pairs(*_overlaps(spark, folder))
    return pairs.select(F.least("id_train", "id_other").alias("id_a"), F.greatest("id_train", "id_other").alias("id_b")).distinct()


def _covered(spark: SparkSession, folder: str) -> DataFrame:
    """Each example outside training with its best similarity and coverage, NULL without a partner."""
    examples = table(spark, folder, "rlvr_examples").where("dataset_split <> 'train'").select(F.col("example_id").alias("id_other"), "dataset_split", "source")
    best = overlap_pairs(*_overlaps(spark, folder)).groupBy("id_other").agg(F.max("similarity").alias("similarity"), F.max("coverage_other").alias("coverage"), F.count("*").alias("partners"))
    return examples.join(best, "id_other", "left")


def p4_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """For each example outside training: how much of it a training record covers at most, 0 without a near one, and how many are near."""
    return _covered(spark, folder).select(F.col("id_other").alias("example_id"), "dataset_split", "source", F.round(F.coalesce("coverage", F.lit(0.0)), 6).alias("coverage"), F.coalesce("partners", F.lit(0)).alias("partners"))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """For each split and source outside training: its records, how many of them are in training exactly or nearly, and their mean coverage."""
    return _covered(spark, folder).groupBy("dataset_split", "source").agg(
        F.count("*").alias("records"), F.count(F.when(F.col("similarity") == 1, 1)).alias("exact"), F.count(F.when(F.col("similarity") < 1, 1)).alias("near"), F.round(F.count("similarity") / F.count("*"), 6).alias("share"),
        F.round(F.avg(F.coalesce("coverage", F.lit(0.0))), 6).alias("mean_coverage"),
    )


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return example_issuers(table(spark, folder, "rlvr_examples").select("example_id", "messages", "metadata"), table(spark, folder, "tickers"))


def p6_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Every example with its issuer and its new split; unresolved examples are a group each."""
    grouped = p6_found(spark, folder).withColumn("grp", F.coalesce(F.col("ticker_id").cast("string"), F.concat(F.lit("e"), F.col("example_id").cast("string"))))
    grouped = cut_lineage(grouped, "issuers")
    dealt = assign_splits(grouped.groupBy("grp").agg(F.count("*").alias("n")), "grp", "n", SHARES)
    return grouped.join(dealt, "grp").select("example_id", "ticker_id", F.col("split").alias("new_split"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return defective_pairs(spread(table(spark, folder, "baseline_results").select("result_id", "prompt", "reasoning", "error", "predicted_action")), "result_id", "prompt", "reasoning", "error", "predicted_action")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_column(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text")


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sizes = table(spark, folder, "documents").select("doc_id", "source", token_counter()("text").alias("n_tokens"))
    return mix_sources(sizes, table(spark, folder, "source_weights"))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix: one row for each use of a text."""
    return _mix(spark, folder)[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares the mix reaches, one row a source."""
    return _mix(spark, folder)[1]


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The statistics and the kind of every document; NULL where it has no words."""
    out = document_kinds(spread(table(spark, folder, "documents").select("doc_id", "text")), wanted=STATISTICS)
    return out.select("doc_id", *[F.round(F.col(f"stats.{s}"), 6).alias(s) for s in STATISTICS], "doc_kind")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return document_kinds(spread(table(spark, folder, "documents").select("doc_id", "text"))).where("doc_kind <> 'prose'").select("doc_id", "doc_kind")


QUERIES = {"p2_found": p2_found, "p2_entities": p2_entities, "p7_found": p7_found, "p10_found": p10_found, "p10_statistics": p10_statistics, "p4_found": p4_found, "p4_coverage": p4_coverage, "p4_report": p4_report, "p6_found": p6_found, "p6_splits": p6_splits, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares}
ORACLES: dict[str, str] = {}
ORACLES["p6_found"] = r"""
WITH t AS (SELECT ticker_id, regexp_replace(lower(regexp_replace(trim(company_name), '[\s,\-–(]*\b(class|cl|series|ser)\b[.\s]*[a-z0-9]{1,2}\b[\s.)]*$', '', 'i')), '[^a-z0-9]', '', 'g') AS nk,
             regexp_replace(upper(symbol), '[.\-/_]+', '.') AS sk FROM tickers),
i AS (SELECT sk, min(ticker_id) OVER (PARTITION BY nk) AS issuer FROM t),
e AS (SELECT example_id, coalesce(metadata.ticker, regexp_extract(list_filter(messages, lambda m: m.role = 'user')[1].content, '^[^:\n]*:[\s\x{a0}]*([^\s\x{a0}(/]+)', 1)) AS raw FROM rlvr_examples),
k AS (SELECT example_id, regexp_replace(regexp_replace(regexp_replace(upper(regexp_replace(raw, '[\s\x{a0}]', '', 'g')), '^\$|^[A-Z]{2,8}:', ''), '\.US$', ''), '[.\-/_]+', '.') AS sk FROM e)
SELECT k.example_id, CAST(i.issuer AS INTEGER) AS ticker_id FROM k LEFT JOIN i USING (sk)"""
