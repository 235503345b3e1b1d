"""Where a query may write a table that it reads back."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's scratch folder; see :func:`scratch_folder`."""
    return f"{scratch_folder(spark)}/{name}-{uuid4().hex}"


def scratch_folder(spark: SparkSession) -> str:
    """The application's own folder under ``spark.checkpoint.dir``, for tables between steps.

    It is deleted with all that is in it when the application ends, and before that by
    :func:`clear_scratch`. Without the setting, a local session gets a temporary folder. On a
    cluster, where executors do not share the driver's disk, it raises.
    """
    application = spark.sparkContext.applicationId
    if application not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.conf.get("spark.master", "").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.gettempdir()
        folder = f"{base.rstrip('/')}/ledgerlift-{application}-{uuid4().hex[:8]}"
        path, files = _at(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[application] = folder
    return _folders[application]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch folder now. Tables that were read from it are gone."""
    folder = _folders.pop(spark.sparkContext.applicationId, None)
    if folder:
        path, files = _at(spark, folder)
        files.delete(path, True)


def _at(spark: SparkSession, folder: str):
    """The folder and its file system, whichever kind the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
