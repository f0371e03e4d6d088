"""SparkSession builder with the settings every test and bench run shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_TEMPORARY: dict[str, str] = {}


def build_session(app: str = "quillstone", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submitter's own configuration wins over these defaults."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one for the application where it is unset (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _TEMPORARY:
        _TEMPORARY[app] = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, _TEMPORARY[app], ignore_errors=True)
    return _TEMPORARY[app]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends; else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
