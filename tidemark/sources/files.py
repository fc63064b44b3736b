"""Line-delimited JSON and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
EXAMPLE = T.StructType(
    [
        T.StructField("messages", T.ArrayType(MESSAGE)),
        T.StructField(
            "ground_truth",
            T.StructType(
                [
                    T.StructField("actual_return_pct", T.DoubleType()),
                    T.StructField("exit_date", T.StringType()),
                    T.StructField("days_held", T.IntegerType()),
                    T.StructField("early_exit", T.BooleanType()),
                    T.StructField("entry_price", T.DoubleType()),
                    T.StructField("exit_price", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("metadata", T.StructType([T.StructField("ticker", T.StringType()), T.StructField("entry_date", T.StringType()), T.StructField("historical_returns", T.ArrayType(T.DoubleType()))])),
    ]
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = EXAMPLE, strict: bool = True) -> DataFrame:
    """JSON lines by a given schema; strict fails on a bad line, else bad and blank lines are skipped."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def write_jsonl(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """One compact JSON object a row, letters kept as they are; NULL fields are left out."""
    df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value")).write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, path: str, date: str) -> None:
    """Parquet by year of `date`, as range partitions; only the years written are replaced."""
    (df.withColumn("year", F.year(date)).repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path))


def write_report(df: DataFrame, path: str, line: str, *columns: str) -> None:
    """A text summary: one formatted line a row."""
    kinds = dict(df.dtypes)
    values = [F.col(c).cast("string") if kinds[c] in ("date", "timestamp", "timestamp_ntz") else F.col(c) for c in columns]
    df.select(F.format_string(line, *values).alias("value")).coalesce(1).write.mode("overwrite").text(path)
