"""Session settings and the small runtime helpers shared by the operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    `spark.checkpoint.dir` is taken from the session. Only where it is unset
    and the master is a single local JVM is a temporary folder made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: written tables still there, by session
_WRITTEN: dict[str, SparkSession] = {}


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` to the shared folder once and return it read back.

    A lost executor costs nothing but a re-read: the files are outside it. The
    table stays until `discard`, or until the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_discard_all)
    df.write.parquet(path)
    _WRITTEN[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `cut_lineage` that no frame reads any more."""
    for df in tables:
        path = df._tidemark_path
        _delete(_WRITTEN.pop(path), path)


def _discard_all() -> None:
    for path, spark in list(_WRITTEN.items()):
        if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            break
        _delete(spark, path)
    _WRITTEN.clear()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True
