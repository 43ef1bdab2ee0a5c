"""Session defaults and durable cut points."""

import atexit
import contextlib
import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tidewatch", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The JIT skips methods beyond 8000 bytes of bytecode; wide rows run faster in smaller ones.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers of ``spark``, once per application.

    Workers import the functions they run by name. Spark serves the driver's archive to each
    executor, also to those that join later, so nothing has to be installed on the cluster.
    """
    context = spark.sparkContext
    if not getattr(context, "_tidewatch_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="tidewatch-package-")
        context.addPyFile(shutil.make_archive(os.path.join(folder, "tidewatch-package"), "zip", root, "tidewatch"))
        context._tidewatch_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables that every executor can read.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master without that setting
    gets a temporary folder; on a cluster a missing setting is an error, because a machine-local
    folder would be lost with its executor.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_scratched: list[tuple[SparkSession, str]] = []
_own = threading.local()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed with its scope or when Python ends."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if getattr(_own, "scopes", None):
        _own.scopes[-1].append(path)
    else:
        if not _scratched:
            atexit.register(_remove_scratched)
        _scratched.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _remove_scratched() -> None:
    for spark, path in _scratched:
        with contextlib.suppress(Exception):  # the session may have stopped; then nothing can be removed
            remove(spark, path)


@contextlib.contextmanager
def scope(spark: SparkSession):
    """Cuts made inside go when the block ends; what is kept must have been written elsewhere."""
    _own.scopes = [*getattr(_own, "scopes", []), []]
    try:
        yield
    finally:
        for path in _own.scopes.pop():
            remove(spark, path)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is written inside go when it has been written, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    Cuts the lineage where a result is read several times or where later branches must agree on
    physical part numbers. A parquet table rather than a checkpoint: later passes read only the
    columns they need, and the planner knows its size.
    """
    path = scratch(df.sparkSession, "cut")
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
