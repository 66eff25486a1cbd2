"""Session settings and durable intermediate results.

Iterative operators cut lineage through reliable checkpoints only.  The folder is the one the
cluster names in ``spark.checkpoint.dir``; a private one is chosen only where the setting is
absent, as in tests on one machine.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The checkpoint folder of a session that names none (local mode only), made on first use.
_fallback_dir: str | None = None


def session(app: str = "corpusloom", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the benchmark use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, from the session where it names one; a session of several machines must."""
    global _fallback_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    return _fallback_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there: it survives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared one, deleted when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop_path)
    system.deleteOnExit(hadoop_path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read from there, so that each reader takes only its columns."""
    path = f"{scratch_folder(df.sparkSession, 'stored')}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Delete the folder of a table that ``stored`` has written, once nobody reads it any more."""
    for folder in {f.rpartition("/rows/")[0] for f in rows.inputFiles() if "/stored-" in f}:
        path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a batch that goes to a Python worker, unless the session says otherwise: rows can be long.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Applications whose executors have the package.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's source to the executors, whose Python need not have it installed.

    Batches to Python are bounded in bytes as well, where the session leaves that open.
    """
    context = spark.sparkContext
    if not context.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom_source.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def release(spark: SparkSession, wait: bool = False) -> None:
    """Let Spark drop the shuffle files of plans nobody refers to any more.

    The context cleaner acts when the driver's JVM collects garbage, which a driver with little to
    do may not do for a long time; large operators call this between their phases.  Python tells the
    JVM of dropped plans from a thread that wakes once a second; ``wait`` waits for it, a few seconds
    at most, where what is dropped is large.
    """
    gc.collect()
    waiting = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    until = time.monotonic() + 4
    while wait and waiting and time.monotonic() < until:
        time.sleep(0.05)
    if wait:
        time.sleep(0.1)
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
