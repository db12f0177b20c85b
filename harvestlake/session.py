"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "harvestlake", master: str | None = None, **conf: str):
    """A session with the settings the plans rely on.

    Partition counts are left to adaptive execution: on a cluster set
    ``spark.sql.shuffle.partitions`` high (it is coalesced at run time), locally
    pass a small number.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Capturing a call site per column expression makes building wide plans slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own, deleted at
    exit: on a cluster other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="harvestlake-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


_local_root: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/harvestlake/{uuid.uuid4().hex}/{name}"


#: Bytes of a row group that one task reads.
ROW_GROUP = 1 << 24


def stage(df: DataFrame, name: str = "stage", path: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several outputs hang on one expensive parent: the parent is
    computed once, later readers prune columns, and a lost executor costs a
    re-read rather than a recomputation. With a folder per value of ``by``, a reader of
    one value reads no other rows; row groups are small there, so that many tasks can share a folder.
    """
    path = path or scratch_path(df.sparkSession, name)
    if by:
        df.write.partitionBy(by).option("parquet.block.size", ROW_GROUP).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table; unlike one made of an empty list it starts no Python worker."""
    return spark.range(0, 0, 1, 1).select(F.from_json(F.lit(None), schema).alias("row")).select("row.*")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it; a missing one is fine."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str | None:
    """The path with its scheme, as file sources report it; None if nothing is there."""
    folder, files = _folder(spark, path)
    return files.makeQualified(folder).toString().rstrip("/") if files.exists(folder) else None


def folder_names(spark: SparkSession, path: str, prefix: str = "", finished: bool = False) -> list[str]:
    """Names of the entries in a folder that begin with ``prefix``, without it.

    ``finished`` asks for those that a Spark write has completed. A missing folder has none.
    """
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    names = [n for n in names if n.startswith(prefix)]
    if finished:
        done = lambda n: files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0])
        names = [n for n in names if done(n)]
    return [n.removeprefix(prefix) for n in names]


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``stage`` for the length of a block; what it wrote is deleted afterwards.

    Only for blocks that finish all reads of the staged frames inside.
    """
    root = scratch_path(spark, "block")
    try:
        yield lambda df, name, **by: stage(df, name, f"{root}/{name}", **by)
    finally:
        delete_folder(spark, root)
