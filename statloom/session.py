"""Session helpers: local session for tests and benches, durable scratch space."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders that intermediate tables of the open scopes were written to.
_scopes: list[list[str]] = []


def local_session(cores: int | str = 8, name: str = "statloom") -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Feature tables have several hundred columns; above 100 Spark drops generated code.
        .config("spark.sql.codegen.maxFields", "2000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="statloom-"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from spark.checkpoint.dir.

    Where that is unset, a session that runs in one process on one machine gets a
    temporary folder; on a cluster it is an error, for executors would not see it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="statloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table this run writes and reads back."""
    path = f"{shared_dir(spark)}/statloom-{label}-{uuid.uuid4().hex}"
    for written in _scopes:
        written.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside, once the results have been used or saved."""
    written: list[str] = []
    _scopes.append(written)
    try:
        yield
    finally:
        _scopes.remove(written)
        jvm = spark.sparkContext._jvm
        for path in written:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, label: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    For tables that several later passes read a few columns or, by ``partition_by``, a few
    parts of. Rows keep their order inside a file.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more.

    It does so when the driver collects garbage, which an idle heap puts off until the disks are full.
    Some tables are only found to be free after others have gone, so one round is not enough.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()
        time.sleep(0.1)


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions, before a table that much work follows is stored.

    Inputs such as JSON arrays or files of one row group come as few, uneven tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
