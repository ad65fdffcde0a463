"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: How many bytes an Arrow batch holds before it is sent; Spark's default is 64 MB.
BATCH_BOUND, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """All clock arithmetic here is defined in UTC; pin it for a session made elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def bound_batches(spark: SparkSession) -> None:
    """Texts go to Python workers 2 MB at a time, where a session does not name its own bound.

    Each task holds a batch on both sides, and an idle worker keeps the room it once took.
    """
    if spark.conf.get(BATCH_BOUND, None) is None:
        spark.conf.set(BATCH_BOUND, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would be invisible to the other machines.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="headway-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/headway/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a checkpoint, and keeps column pruning and file
    statistics for the readers, which a checkpointed RDD would lose.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
