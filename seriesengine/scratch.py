"""Written intermediate tables that cut lineage and are read several times.

They live in the folder the cluster shares (``spark.checkpoint.dir``), so a lost
executor costs a re-read and not a re-run of the plan behind the table.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not shared:
        shared = context.getCheckpointDir()
    app = context.applicationId
    if shared:
        return f"{shared.rstrip('/')}/seriesengine/{app}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="seriesengine-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other table uses."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(
    df: DataFrame, name: str, **metrics: Column
) -> tuple[DataFrame, dict[str, object]]:
    """Write ``df`` once and return the frame that reads it back.

    ``metrics`` are aggregates observed during the write, so they cost no job.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    observed: dict[str, object] = {}
    if metrics:
        observation = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(observation, *[m.alias(k) for k, m in metrics.items()])
        df.write.parquet(path)
        observed = observation.get
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), observed


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
