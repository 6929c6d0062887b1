"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", partitions: int = 8, app: str = "tickloom", **extra) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def use_utc(spark: SparkSession) -> SparkSession:
    """Tick times are UTC instants; pin the session zone so that they print as such."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Workers unpickle the functions of the Python operators by their module, so they need the package
    wherever the driver found it. The same as ``--py-files tickloom.zip`` at submission.
    """
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if context.applicationId not in _SHIPPED and os.path.isdir(package):
        archive = os.path.join(tempfile.mkdtemp(prefix="tickloom-"), "tickloom.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or the one set on the context.

    A cluster has to name one that every executor can reach. Only a local session may
    go without; it gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="tickloom-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


# Folders of the innermost open scope of this thread.
_SCOPE: ContextVar[list[str] | None] = ContextVar("work_scope", default=None)


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    folder = f"{shared_folder(spark)}/tickloom/{label}-{uuid.uuid4().hex}"
    if _SCOPE.get() is not None:
        _SCOPE.get().append(folder)
    return folder


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Work tables that are made inside are removed at the end; for functions that have written their results by then."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        folders = _SCOPE.get()
        _SCOPE.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared work folder and go on from there.

    For frames that are dear to compute and read more than once. The table also cuts
    the lineage: a lost executor costs re-reading, never recomputing.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, label)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
