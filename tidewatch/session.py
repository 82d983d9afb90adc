"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_spark(
    app: str = "tidewatch", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the project's settings; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return plan_by_rows(builder.getOrCreate())


PLANNED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def plan_by_rows(spark: SparkSession) -> SparkSession:
    """Broadcasts are planned below 1 MB of files, and below the usual 10 MB once a side was measured.

    Files are compressed: ten megabytes of them may be a hundred of rows in the driver, and adaptive execution keeps a
    broadcast that was planned. It does make one of a shuffle that turns out small. A threshold set elsewhere stays.
    """
    usual = "10485760b"
    if spark.conf.get(PLANNED) == usual and spark.conf.get(MEASURED, None) in (None, "<undefined>", usual):
        spark.conf.set(PLANNED, "1m")
        spark.conf.set(MEASURED, usual)
    return spark


_shipped: set[str] = set()
_made: list[str] = []


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, wherever the job was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidewatch-ship-")), "tidewatch.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Settings that results depend on, applied to a session made elsewhere."""
    ship(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return plan_by_rows(spark)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one that the cluster names.

    Streaming checkpoints and written intermediate tables live here, so they must be
    readable from every executor. Only a local session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, f"{purpose}-{uuid.uuid4().hex[:12]}")
    _made.append(path)
    return path


def remove_work(spark: SparkSession) -> int:
    """Remove the working folders that this process made; results that still read them become void.

    A job calls it after its last result is written. Returns the number of folders removed.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
