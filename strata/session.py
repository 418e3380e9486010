"""Session helpers: a Spark session configured for these jobs, and the
shared scratch folder used to cut lineage or stage files."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps are naive wall-clock values
# (TIMESTAMP_NTZ), so results do not depend on the cluster time zone; the
# session zone is still pinned so date functions on TIMESTAMP inputs agree.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# written tables: the fastest level of zstd; on these tables it is no larger than the next ones or delta encodings
PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Where it is unset, a local session (tests)
    gets a folder of our own, and any other master is refused: intermediate
    data on machine-local disks would be lost to the other executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions expose no SparkContext
        sc = None
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    current = sc.getCheckpointDir() or configured
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "strata", f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """The session with another setting; None leaves it as it is."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its lineage is cut there,
    and the shuffle files of what led to it go when it is written."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("error").options(**PARQUET).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
