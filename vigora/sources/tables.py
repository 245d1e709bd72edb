"""Reading the project's Parquet tables and where intermediate results are kept."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of Parquet tables; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; where that is unset, a local one, but only on a local master."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors can read")
        folder = tempfile.mkdtemp(prefix="vigora-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: later stages re-read the shared folder if an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
