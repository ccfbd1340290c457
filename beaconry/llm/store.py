"""Files and tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; local sessions without one get a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="beaconry-llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet into the shared folder and read again: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it; usable on executors."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_file(folder: str, name: str, parts: list[bytes]) -> int:
    """Write one file; its bytes."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        for part in parts:
            out.write(part)
    return sum(map(len, parts))
