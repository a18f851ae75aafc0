"""Session settings and the shared folder for data that must outlive an executor."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus="*", name="spendguard", **conf) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python call site of every column operation doubles the time to build plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="spendguard-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Reliable checkpoint: cuts the lineage with files every executor can read again."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def _files(spark: SparkSession, path: str):
    """The store that ``path`` is in, and the path there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _files(spark, path)
    return store.exists(place)


def make_folder(spark: SparkSession, path: str):
    store, place = _files(spark, path)
    store.mkdirs(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, place = _files(spark, path)
    return [f.getPath().getName() for f in store.listStatus(place)] if store.exists(place) else []


def delete(spark: SparkSession, path: str):
    store, place = _files(spark, path)
    store.delete(place, True)
