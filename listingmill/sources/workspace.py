"""Where jobs keep intermediate tables: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application under ``spark.checkpoint.dir``.

    Only a session in local mode may do without that setting; it then gets a
    fresh temporary folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
            "spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="listingmill-")
        _roots[app] = f"{base.rstrip('/')}/listingmill-{app}-{uuid.uuid4().hex[:8]}"
    return _roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def close(spark: SparkSession) -> None:
    """Delete everything this application has stored; DataFrames that read it end with it."""
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage on storage that outlives executors, and gives the planner
    the true size of the table, so that it alone decides between a broadcast
    and a shuffled join.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
