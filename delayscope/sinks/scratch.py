"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_root: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder the session names.

    The folder is ``spark.checkpoint.dir``. Without it only a local session may go on,
    in a temporary folder of its own machine that goes away with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="delayscope-"))
        atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
    return f"{_local_root[0]}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
