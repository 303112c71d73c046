"""Session construction and the shared folder for tables that outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def build_session(app: str = "stationhour", master: str | None = None, partitions: int | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # the summary has many small groups per task; keep hashing instead of sorting them
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
        # months and files are given as paths: list some hundred on the driver, more in some tasks instead of one task each
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "256",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; local mode alone may fall back to its own."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="stationhour-")
    return _LOCAL_ROOT[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, unique to this call."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and return the written table.

    The planner knows the size of a written table: as one side of a join it is broadcast below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above, without a hint.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
