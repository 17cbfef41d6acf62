"""The filter over files as they arrive: a file source, and one batch of output for each trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.filtering import judged, normalize
from ..sources.config import Source


def start(spark: SparkSession, folder: str, schema: T.StructType, source: Source, output: str, checkpoint: str, pattern: str = "*.parquet") -> StreamingQuery:
    """Filters what folder holds and ends (availableNow); started again with the same checkpoint, it takes new files only. A batch
    writes its own folder, so that a batch that is run again replaces what it wrote before."""
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)

    def put(batch: DataFrame, number: int) -> None:
        out = judged(normalize(batch, source), source.policy).where("reason is null").drop("reason")
        out.write.mode("overwrite").option("compression", "zstd").parquet(f"{output}/batch={number}")

    return arriving.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
