"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import logging
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs rely on. All of them can be changed on a running session, and
# none overrides sizes that belong to a cluster (memory, cores, shuffle partitions).
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Two lookups on the same key share one stage; without this a skewed first join stays unsplit
    # because splitting it costs the second join one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A dimension too large to broadcast still has small partitions: hash each of them (up to this
    # measured size) rather than sort the whole fact table for a merge.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"
# What a query shuffled goes when it has ended, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

logger = logging.getLogger(__name__)

_local_folder: str | None = None
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "assay", cores: int | str = "*", **settings: str) -> SparkSession:
    """A single-machine session, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder of its own. On a cluster a machine-local path would
    be invisible to other executors and lost with its machine, so an unset value is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="assay-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This fixes values that depend on how Spark happened to split the data, cuts the lineage, and
    survives lost executors. Parquet rather than ``checkpoint()``: later reads prune columns. The
    files stay until removed, by ``scratch`` or by the caller. What the write shuffled is of no use
    once it is done, and its files go at once.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    inside = _scratch.get()
    if inside is not None:
        inside.append(path)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what ``make`` returns, and remove what was staged on the way there."""
    with noted() as paths:
        made = stage(make(), label)
    *used, kept = paths
    inside = _scratch.get()
    if inside is not None:
        inside.append(kept)
    for path in used:
        remove(made.sparkSession, path)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/assay-{label}-{uuid.uuid4().hex}"


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths that ``stage`` writes inside, for the caller to ``remove`` once they have served."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield paths
    finally:
        _scratch.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving what ``stage`` wrote inside, once the results are in tables."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; a leftover must not fail the run."""
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception:
        logger.warning("could not remove %s", path, exc_info=True)
