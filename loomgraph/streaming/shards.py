"""Document shards that arrive as files: sentences as a stream, an index that grows with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomgraph.operators import cooccur
from loomgraph.sources import literature


def stream_documents(spark: SparkSession, folder: str, files_a_batch: int = 64) -> DataFrame:
    """Parsed documents of PubTator shards as they arrive, with content and sentences."""
    raw = spark.readStream.option("lineSep", "\n\n").option("maxFilesPerTrigger", files_a_batch).text(folder)
    return cooccur.with_sentences(literature.parse_documents(raw).where("error is null").drop("error"))


def grow_index(docs: DataFrame, tag: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's mention index to ``target``, once per batch: a batch that is run again replaces its own part."""

    def write(batch: DataFrame, number: int) -> None:
        cooccur.mention_index(batch, tag(batch)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
