"""Session settings and the shared work folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tillworks", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, pass in the session you have."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", "8g")
        # Local data is small: cut it finer than the cluster defaults, so that every core has work.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.sql.files.maxRecordsPerFile", "25000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which every executor must reach.

    Where the session names none, the one set with setCheckpointDir counts. Without that too, a
    temporary folder is made, but only for a local master: on a cluster a machine-local folder
    would be lost with its executor.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.applicationId not in _local_folders and context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tillworks-")
    return _local_folders[context.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable in this session."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def saved(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back, so that the planner knows its size.

    A join to the result is broadcast exactly when its files are under the broadcast threshold.
    Joined as a plan, its size would be guessed, and the other side be shuffled before the guess
    could be put right.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tillworks/{spark.sparkContext.applicationId}/saved/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
