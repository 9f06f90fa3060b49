"""Session helpers: building a session, written intermediate tables and sides of known size.

Everything here is cluster-safe: intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir``.  A private folder is created only when that setting is absent and the
master is local (tests); elsewhere a missing setting is an error.  Nothing is broadcast by hint: a
small side is written first, and Catalyst decides by the bytes of the files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Session with the settings the library is tuned for (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster; a private one only on a local master without the setting."""
    try:
        configured = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key
        configured = None
    try:
        jsc = spark.sparkContext._jsc.sc()
    except Exception:  # noqa: BLE001 - remote session: the server owns the checkpoint folder
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return configured
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = configured or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return jsc.getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written intermediate tables."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def reliable_checkpoint(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    The lineage is cut, the files survive the executors that wrote them, later scans read only the
    columns they need, and Catalyst knows the size.  The output partitioning of ``df`` is not kept.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end_with_their_job(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of every finished write go at once; otherwise they stay until the driver happens to collect
    its garbage.  What is returned to be run later, perhaps twice, is planned outside."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


# Rows of one task of a sort, a join or a window: their number of tasks follows the rows.
ROWS_PER_TASK = 1_000_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Partitions for so many rows; None where the session's own number is enough."""
    n = -(-rows // ROWS_PER_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def sized_side(df: DataFrame) -> DataFrame:
    """A join side whose size Catalyst can see: written, so that it is broadcast if its files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled (with skew splitting) beyond."""
    return reliable_checkpoint(df, "side")
