"""Where jobs keep tables between their steps."""

from __future__ import annotations

import functools
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallymill-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder of ``spark.checkpoint.dir``.

    A folder of this machine is used only where the setting is missing and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/tallymill/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that jobs have written, wherever it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of any number of callers one gets True.

    Hadoop's local file system looks before it creates, so there the system's own exclusive creation is used.
    """
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(file.getParent())
    try:
        if system.getUri().getScheme() == "file":
            local = jvm.java.io.File(system.makeQualified(file).toUri().getPath())
            return local.createNewFile()
        system.create(file, False).close()
        return True
    except Py4JJavaError as error:
        if system.exists(file):
            return False
        raise error


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files below a folder by name with their sizes, told by the file system; hidden ones are left out."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(folder).toString()
    found, waiting = {}, [folder]
    while waiting:
        for status in system.listStatus(waiting.pop()):
            if status.getPath().getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                waiting.append(status.getPath())
            else:
                found[status.getPath().toString().removeprefix(root)] = status.getLen()
    return found
