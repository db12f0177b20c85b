"""The files of a download folder as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.session import qualified

INVENTORY = "path STRING, length BIGINT, modified TIMESTAMP"


def read_inventory(spark: SparkSession, root: str, output_dir: str = "downloads") -> DataFrame:
    """One row per file below ``root``: path, length in bytes and time of the last change.

    Paths begin with ``output_dir``, as those of a work list do. The listing is Spark's own; no file is
    opened, as the content isn't selected, and tasks ask for length and time. While it lists, the
    driver holds one status per file, so a folder of very many files is best read by
    repository: ``read_inventory(spark, f"{root}/zenodo", "downloads/zenodo")``. Empty files, and names
    that begin with ``_`` or ``.``, are not listed, as by every Spark source: a work list fetches such
    files again. A missing folder has no files.
    """
    base = qualified(spark, root)
    if base is None:
        return spark.createDataFrame([], INVENTORY)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.substring("path", len(base) + 1, 2**31 - 1)
    return listed.select(
        F.concat(F.lit(output_dir.rstrip("/")), below).alias("path"), "length", F.col("modificationTime").alias("modified")
    )
