"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder every lineage cut goes to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "tidelog",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, build the session with
    the cluster's own settings instead; the library only needs UTC time."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the
    context). Without the setting, a session whose executors are threads of the
    driver (``local[n]``) gets a new local folder, which is shared by all of
    them; any other session raises, since its executors would not share it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="tidelog-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; any failure to find out raises."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


#: Names of the folders of intermediate tables, which ``sweep`` may delete.
INTERMEDIATE = ("stored", "ranged", "pipeline")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder's path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared checkpoint folder and read again: later
    steps start from files that outlive any executor, and a plan used twice
    is computed once."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, older_than_s: float, parent: str | None = None) -> list[str]:
    """Delete intermediate tables that were last written more than
    ``older_than_s`` seconds ago, and return their paths. Frames read them until
    their last action, so the age must exceed the longest job's. ``parent`` is
    the folder that ``spark.checkpoint.dir`` names: every session makes its own
    folder in it, and those of ended sessions are swept too."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(parent or checkpoint_dir(spark))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    limit = jvm.java.lang.System.currentTimeMillis() - int(older_than_s * 1000)
    gone: list[str] = []

    def walk(folder, deeper: bool) -> None:
        for f in fs.listStatus(folder):
            name = f.getPath().getName()
            if not f.isDirectory():
                continue
            if name.split("-")[0] in INTERMEDIATE:
                if f.getModificationTime() < limit:
                    fs.delete(f.getPath(), True)
                    gone.append(f.getPath().toString())
            elif deeper:
                walk(f.getPath(), False)

    walk(at, parent is not None)
    return gone
