"""Session-level helpers: lineage cuts that survive lost executors, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast up to this many bytes as measured; larger sides are shuffled.
BROADCAST_BYTES = 32 * 1024 * 1024


def ship(spark: SparkSession) -> None:
    """Gives this package to all executors, once per context, so that they need no copy of it in their path."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    folder = shared_folder(spark)
    local = folder.removeprefix("file://") if folder.startswith(("file:///", "/")) else tempfile.gettempdir()  # the driver's own; it serves the file
    Path(local).mkdir(parents=True, exist_ok=True)
    packed = Path(local) / f"millrace-{uuid.uuid4().hex}" / "millrace.zip"
    packed.parent.mkdir()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    context.addPyFile(str(packed))  # served by the driver
    context._millrace_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; a temporary one only where it is unset on one machine, as in tests.

    On a cluster without the setting every executor would write to its own disk, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder in the shared one; it is deleted when the application ends, or by ``release``."""
    folder = f"{shared_folder(spark).rstrip('/')}/millrace-{spark.sparkContext.applicationId}"
    marked = spark.sparkContext.__dict__.setdefault("_millrace_marked", set())
    if folder not in marked:
        path, files = _file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        marked.add(folder)
    return folder


def _file_system(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def release(spark: SparkSession) -> None:
    """Deletes all tables this application has written to cut lineage; DataFrames that read them can't be used afterwards."""
    path, files = _file_system(spark, scratch_folder(spark))
    files.delete(path, True)
    files.mkdirs(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there, and column pruning still works."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_bytes(df: DataFrame) -> int:
    """Size of a DataFrame that reads files, as the optimizer knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, factor: float = 4.0) -> DataFrame:
    """``df`` with a broadcast hint if its known size times ``factor`` (parquet to memory) is within ``limit``; else unchanged, to be shuffled."""
    return F.broadcast(df) if written_bytes(df) * factor <= limit else df
