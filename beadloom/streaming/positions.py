"""Clusters from a folder that fills up with chunks of positions: the incremental form of the cluster build.

New files are read as they come; a checkpoint remembers which were read, so that a restart goes on where it stopped. A
position seen again within the watermark is dropped by its key, and labels are recomputed from the table of positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clusters


def arriving(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """Positions of Parquet files as they arrive in a folder, with the time of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder).withColumn("arrived", F.current_timestamp())


def distinct_positions(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each position once while its state is kept, which is as long as `late` after it was first seen."""
    return stream.withWatermark("arrived", late).dropDuplicatesWithinWatermark(clusters.POSITION)


def append_to(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived and stop; the next call reads what is new."""
    return stream.drop("arrived").writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
