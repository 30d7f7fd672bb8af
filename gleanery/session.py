"""Session settings and shared scratch tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "gleanery", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gleanery-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session inside this one process may
    go without, as in tests: there every task sees the same disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a scratch table and read it back.

    Used where several branches read the same costly intermediate. Unlike a
    cache, the table outlives lost executors, gives the optimiser real sizes
    to choose joins by, and still prunes columns. Tables with texts are better
    off with a stronger ``compression`` than the session's.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path, compression=compression)
    return spark.read.schema(schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def list_files(spark: SparkSession, path: str, folders: bool = False) -> list:
    """[name, size, time] of all files below a path or pattern, in order of name; with ``folders`` the names of what is directly in it."""
    fs, folder = _file_system(spark, path)
    if folders:
        return sorted(s.getPath().toString() for s in (fs.listStatus(folder) if fs.exists(folder) else []))
    found = []
    for top in fs.globStatus(folder) or []:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return sorted(found)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, once nothing lazy reads them any more."""
    remove_path(spark, scratch_dir(spark))
