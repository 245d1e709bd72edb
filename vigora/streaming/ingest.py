"""Documents that keep arriving: units parsed from a stream of files and kept, the last wording of each id first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigora.operators.retrieval import last_delivered


def arriving(spark: SparkSession, folder: str, schema: str, files: int = 64) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder, ``files`` per trigger at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def distinct_arrivals(stream: DataFrame, key: str = "id", at: str = "loaded_at", late: str = "30 days") -> DataFrame:
    """Each key and arrival once, within a watermark of ``late``; state older than it is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key, at])


def arrivals_per_day(stream: DataFrame, at: str = "loaded_at", late: str = "30 days") -> DataFrame:
    window = F.window(at, "1 day")
    counted = stream.withWatermark(at, late).groupBy(window, "norma").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("day"), "norma", "n")


def keep_last(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Upsert by micro-batch: each batch is reduced to its last rows and written to a folder of its own epoch.

    A batch that runs again writes the same folder again. ``last_kept`` merges the epochs, ``compact`` makes one of them.
    """

    def upsert(batch: DataFrame, epoch: int) -> None:
        last_delivered(batch).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_kept(spark: SparkSession, folder: str) -> DataFrame:
    """One row per id over all epochs of ``keep_last``: the last delivered; of equal times the one of the later epoch."""
    rows = spark.read.parquet(folder)
    cols = [c for c in rows.columns if c not in ("id", "loaded_at", "epoch")]
    best = rows.where("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct("loaded_at", *cols), F.struct("loaded_at", "epoch")).alias("r"))
    return best.select("id", "r.*")


def compact(spark: SparkSession, folder: str, target: str) -> None:
    """The merged epochs as one epoch of a new folder, from which a later stream goes on."""
    if folder.rstrip("/") == target.rstrip("/"):
        raise ValueError("a folder cannot be compacted onto itself")
    last_kept(spark, folder).write.mode("overwrite").parquet(f"{target}/epoch=-1")
