"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Month keys are text; reading them back as numbers would lose that.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

_local_scratch: dict[str, str] = {}


def build_session(app: str = "lakeward", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def small_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A few rows of code or arguments as a table whose size the optimizer knows."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder that the cluster sets aside for checkpoints.

    Only a local session without that setting gets a temporary folder of its own, which goes with the process.
    """
    return f"{_scratch_base(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_base(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch.get(context.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="lakeward-")
            _local_scratch[context.applicationId] = base
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/lakeward-{context.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, when no frame that reads them is needed any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_base(spark))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def settled(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table: computed once, and the same for the whole run
    even if the folder it lists changes meanwhile."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled_observed(df: DataFrame, label: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """The frame as a written table, and aggregates of its rows taken while it is written."""
    seen = Observation()
    written = settled(df.observe(seen, *[value.alias(name) for name, value in aggregates.items()]), label)
    return written, seen.get
