"""Shared scratch tables.

Intermediate results that are read more than once are written to the folder the cluster names in
``spark.checkpoint.dir`` and read back. The written table cuts the lineage, survives the loss of any
executor, and gives the next plan real file statistics and column pruning.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# the folders handed out in this process, for remove_scratch
_WRITTEN: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one only for an unconfigured local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_ROOTS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared root that nothing else uses; the folder itself is not created."""
    _WRITTEN.append(f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def materialize(df: DataFrame, label: str, options: Mapping[str, int | str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared root, with the writer's ``options``, and return a scan of it."""
    path = new_folder(df.sparkSession, label)
    df.write.mode("errorifexists").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> int:
    """Delete what the library has written under the shared root in this session; the number of folders.

    DataFrames that still read those tables can no longer be computed, so this belongs at the end of a job.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
