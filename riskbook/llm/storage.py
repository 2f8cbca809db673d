"""Tables and files that one job writes and others read, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
from uuid import uuid4

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Unset, a temporary folder serves in local mode (tests); on a cluster that is an error,
    since no other folder is known to be shared.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="riskbook-llm-")
        spark.conf.set(SETTING, root)
    return f"{root.rstrip('/')}/llm/{uuid4().hex}"


def store(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write a table once and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}"
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `store` returned, once all that was made of them is stored."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sweep(table: DataFrame) -> None:
    """Have Spark delete the shuffle files that no plan holds any more; else it waits for the driver's garbage collection."""
    table.sparkSession._jvm.System.gc()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or URI; usable inside tasks."""
    return pafs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def put_file(uri: str, name: str, parts) -> str:
    """Write a file under a passing name, then rename it.

    A task that is run again, or twice at once, leaves one whole file of the same content.
    """
    fs, folder = open_folder(uri)
    fs.create_dir(folder, recursive=True)
    passing, final = f"{folder}/.{name}.{uuid4().hex}", f"{folder}/{name}"
    with fs.open_output_stream(passing) as out:
        for part in parts:
            out.write(part)
    fs.move(passing, final)
    return final


def get_file(uri: str, name: str) -> bytes:
    fs, folder = open_folder(uri)
    with fs.open_input_file(f"{folder}/{name}") as source:
        return source.read()


def get_range(uri: str, name: str, start: int, length: int) -> bytes:
    """Bytes of a file; a negative start counts from its end."""
    fs, folder = open_folder(uri)
    with fs.open_input_file(f"{folder}/{name}") as source:
        source.seek(start if start >= 0 else source.size() + start)
        return source.read(length)
