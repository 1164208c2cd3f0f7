"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


PARALLEL = 6


def together(jobs: Iterable[Callable[[], object]]) -> list[object]:
    """Independent steps, a few at a time; Spark shares its executors. Their results, in the order of the steps."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def local_session(name: str = "fleetmart", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Local folders are listed faster than a job for it starts.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Texts without a zone and months of creation are meant in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a session without that setting (a test on one machine) gets a folder
    of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetmart-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/fleetmart/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, fixes values that depend on task layout, and lets a lost
    executor be replaced without redoing the work behind it.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
