"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# The JVM does not compile methods above 8000 bytes: a wide projection beyond that
# runs ten times faster as split expressions than as one interpreted method. Loops over
# the 65 account columns that stay below it run slowly too, so the bound is half of that.
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "4000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that the wide account tables need."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: str = "*", app: str = "riskloom", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only and would be lost with it.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="riskloom-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and continue from there.

    Used where two branches must see one and the same set of rows (for instance
    after a range partitioning, whose bounds come from a sample).
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def at_once(spark: SparkSession, work: Callable, items: Iterable, threads: int = 4) -> list:
    """Run independent jobs from several driver threads, results in order.

    An iterative fit is a chain of short jobs; several chains fill the cluster
    better than one. MLlib's cross-validation does the same.
    """
    items = list(items)
    with ThreadPool(min(threads, max(len(items), 1))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)
