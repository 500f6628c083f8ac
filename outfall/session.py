"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

import outfall

_sent: dict[str, str] = {}
#: Of each thread, in ``made``: the folders made in each open ``temporary_folders``.
_open = threading.local()


def local_session(cores: str = "8", app_name: str = "outfall") -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster, pass in your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OUTFALL_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def send_code_with_tasks(spark: SparkSession) -> None:
    """Let Python tasks import this package, for workers that do not have it installed.

    Spark hands the archive to every worker, once per application.
    """
    context = spark.sparkContext
    if _sent.get("application") == context.applicationId:
        return
    home = os.path.dirname(os.path.abspath(outfall.__file__))
    # The driver serves the file for as long as it runs.
    folder = tempfile.TemporaryDirectory(prefix="outfall-code-")
    atexit.register(folder.cleanup)
    archive = os.path.join(folder.name, f"outfall-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for path, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(path, name)
                    packed.write(file, os.path.relpath(file, os.path.dirname(home)))
    context.addPyFile(archive)
    _sent["application"] = context.applicationId


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one named by ``spark.checkpoint.dir``.

    All executors must see that folder, so a machine-local temporary one is made only for a
    local master, where driver and executors share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="outfall-")
        spark.sparkContext.setCheckpointDir(base)
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    made = getattr(_open, "made", [])
    if made:
        made[-1].append(folder)
    return folder


@contextmanager
def temporary_folders(spark: SparkSession) -> Iterator[None]:
    """Remove, also after a fault, all folders that ``shared_dir`` and ``settle`` make meanwhile.

    For a batch or term whose results are written elsewhere before it ends.
    """
    _open.made = [*getattr(_open, "made", []), []]
    try:
        yield
    finally:
        for folder in _open.made.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    path = shared_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
