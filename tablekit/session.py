"""Session helpers: settings, shared scratch folders and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def get_spark(app_name: str = "tablekit", cores: int | str = "*") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session given to you."""
    parallel = os.cpu_count() or 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def _setting(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    return value or None


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a cluster a
    machine-local folder would be lost with its executor.
    """
    base = _setting(spark, "spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not (_setting(spark, "spark.master") or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = _setting(spark, "spark.app.id") or "local"
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tablekit-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)  # made here, so removed here
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder, among the stages of this application."""
    return f"{_stages(spark)}/{label}-{uuid.uuid4().hex}"


def _stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tablekit/{_setting(spark, 'spark.app.id') or 'local'}"


def clear_stages(spark: SparkSession) -> bool:
    """Delete the stages this application has written; call it when no frame made from them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stages(spark))
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_few_files(df: DataFrame) -> DataFrame:
    """``df`` in at most twice as many partitions as run at a time, for slim rows of which each partition becomes a file.

    Without native libraries Hadoop starts a process for each permission it sets on a local file.
    """
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


#: Spark's setting for the bytes of an Arrow batch, and what it is set to.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few megabytes from here on, unless the session has a size of its own.

    Spark counts rows only, and ten thousand long texts are held several times over by the JVM and the Python of a task.
    """
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)


def release(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def concurrently(spark: SparkSession, items: Iterable[Item], run: Callable[[SparkSession, Item], Result],
                 width: int = 8) -> Iterator[Result]:
    """``run(session, item)`` for every item, ``width`` at a time, results in the order of the items.

    For statements that a catalog takes one by one. Items may come from an iterator; only a few are held. Each runs in a
    session of its own (same catalog, own settings) and in one of ``width`` scheduler pools, which share the cluster
    evenly under the FAIR scheduler.
    """
    def one(place: int, item: Item) -> Result:
        session = spark.newSession()
        session.sparkContext.setLocalProperty("spark.scheduler.pool", f"tablekit-{place % width}")
        return run(session, item)

    with ThreadPoolExecutor(width) as threads:
        waiting: deque = deque()
        for place, item in enumerate(items):
            waiting.append(threads.submit(inheritable_thread_target(spark)(one), place, item))
            if len(waiting) >= 2 * width:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()
