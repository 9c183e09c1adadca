"""A folder that all executors share, for tables that a query writes and reads back."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; on a local master, where it is unset, a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="millpulse-scratch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_root(spark: SparkSession, name: str) -> str:
    """A new folder, deleted when the session ends."""
    root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, root))
    return root


@atexit.register
def _delete_all() -> None:
    for spark, root in _made:
        try:
            if spark.sparkContext._jsc is not None:
                path = spark._jvm.org.apache.hadoop.fs.Path(root)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is scratch
            pass
