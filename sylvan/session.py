"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans joins at run
# time (broadcast conversion, skew splitting, partition coalescing); ANSI
# mode stays on, the operators use try_cast / try_divide where R is lenient.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs a later shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "sylvan",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when None.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster it must be set by the deployment (``spark.checkpoint.dir``);
    only a local-mode session (tests, benchmarks) gets a scratch folder here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder shared by the cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sylvan-ckpt-"))
    return sc.getCheckpointDir()


def _fresh(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediates."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{_fresh(name)}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system Spark finds it in."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Entry(NamedTuple):
    """A file or folder in a listing; ``modified`` in seconds of the epoch."""

    name: str
    path: str
    is_folder: bool
    modified: float


def list_folder(spark: SparkSession, path: str) -> list[Entry]:
    """What a folder holds, in whatever file system Spark finds it in (a folder
    that is not there holds nothing)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    found = system.listStatus(target)
    return [Entry(e.getPath().getName(), e.getPath().toString(), e.isDirectory(), e.getModificationTime() / 1000) for e in found]


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless ``target`` exists (then False). One step on HDFS;
    a local file system looks first and renames then, and an object store is
    only as good as its connector's rename."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    system = new.getFileSystem(conf)
    system.mkdirs(new.getParent())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    qualified = new.makeQualified(system.getUri(), system.getWorkingDirectory())
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf).rename(old, new, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def write_intermediate(df, name: str, scratch: Scratch | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts lineage, survives executor loss, and the re-read table has no
    known partitioning, so a join on it gets its own shuffle stage. With
    ``scratch`` the table goes when that scope is closed."""
    spark = df.sparkSession
    path = f"{scratch.root}/{_fresh(name)}" if scratch else shared_scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written intermediates of one job, under the shared checkpoint folder.

    ``save`` writes a table and reads it back (lineage is cut, a lost executor
    costs nothing that was saved); ``drop`` deletes one table as soon as its
    last reader has run, ``close`` deletes the rest. Use it as a context
    manager where the result is consumed inside the block.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_scratch(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df, name: str):
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        delete_path(self.spark, self.path(name))

    def close(self) -> None:
        delete_path(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
