"""Session settings and the shared working folder.

Nothing here overrides a setting the cluster already made: ``build_session``
fills in defaults, and ``shared_root`` reads ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start wide and let AQE merge: a fixed small number cannot hold 100 TB, and a fixed
    # large one would leave thousands of tiny tasks on a daily delta.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # State of streaming deduplication and closes outgrows the heap; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpointed key sets are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
#: Since Spark 4.1: a query's shuffle files are removed when it ends, not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How stored tables are compressed: polls and rows of one capture time after the other take a quarter of what Spark's default does.
COMPRESSION = "zstd"


def build_session(
    app_name: str = "tidemark", master: str | None = None, shuffle_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """A session with the defaults above; ``overrides`` use ``__`` for dots.

    ``shuffle_bytes``, the size of the largest shuffle to expect, sets how many partitions
    AQE starts from. It can merge small ones at run time but not split a shuffle written
    too coarsely, and Spark's default of 200 would make 100 TB into half-terabyte tasks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_bytes is not None:
        partitions = max(200, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    settings.update({key.replace("__", "."): value for key, value in overrides.items()})
    # What the cluster or the caller submitted stays; only the caller's own words override it.
    submitted = SparkConf()
    for key, value in settings.items():
        if key.replace(".", "__") in overrides or not submitted.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster a
    machine-local folder would vanish with its executor.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if context.getCheckpointDir() is not None:
        # setCheckpointDir makes a folder of its own below the one it was given.
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made inside leave no shuffle files behind, unless the cluster has its own setting for that.

    Steps that follow each other would else hold the shuffles of all of them on disk.
    """
    if spark.sparkContext.getConf().contains(FREE_SHUFFLES):
        yield
        return
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def frees_shuffles(step: Callable) -> Callable:
    """A function of a session or a DataFrame that runs within ``freed_shuffles``."""

    @wraps(step)
    def run(*args, **options):
        given = next(a for a in (*args, *options.values()) if isinstance(a, (SparkSession, DataFrame)))
        with freed_shuffles(given if isinstance(given, SparkSession) else given.sparkSession):
            return step(*args, **options)

    return run


def input_bytes(df: DataFrame) -> int:
    """Bytes of the stored tables that ``df`` is made from; rows that come from elsewhere, whose size Spark cannot tell, count for nothing."""
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [found.apply(i) for i in range(found.size())]
    stored = [leaf for leaf in leaves if leaf.nodeName().endswith("Relation") and leaf.nodeName() != "LocalRelation" or leaf.nodeName().startswith("Relation")]
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in stored)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all below it, if it is there, on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, in one listing; none if there is no such folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jvm_path))


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Rename the data files directly in ``source`` into ``target``, with ``prefix`` before their names.

    Calling it again goes on where an earlier call was lost.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target))
    for name in list_folder(spark, source):
        if not name.startswith(("_", ".")) and not system.rename(path(f"{source}/{name}"), path(f"{target}/{prefix}{name}")):
            raise OSError(f"could not move {source}/{name} to {target}")
