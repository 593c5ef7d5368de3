"""The batch loads as incremental jobs: each run takes only what is new.

The decoders and the merge are those of the batch jobs. Progress is kept in the
checkpoint folder of the stream, so a day's load no longer reads the whole topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.plans.jobs import load_batch, load_messages
from tickloom.schemas import TOPIC
from tickloom.sources.files import LINES, dated_by_path
from tickloom.sources.paths import days_glob


def stream_lines(
    spark: SparkSession, root: str, max_files: int | None = None
) -> DataFrame:
    """Raw lines of the files that arrive under `root/dt=…`: `value`, `dt`, `landed`.

    Landing an hour again replaces its files. The stream passes over a replaced
    file it had not read yet, and reads the file in its place.
    """
    reader = spark.readStream.schema(LINES).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return dated_by_path(reader.text(days_glob(root, None)))


def stream_topic(
    spark: SparkSession, source: str | dict[str, str], max_files: int | None = None
) -> DataFrame:
    """Messages that arrive in a topic, or in a parquet folder of the same shape."""
    if isinstance(source, dict):
        options = {"startingOffsets": "earliest", **source}
        return spark.readStream.format("kafka").options(**options).load()
    reader = spark.readStream.schema(TOPIC)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source)


def stream_batch_layer(
    lines: DataFrame, out: str, checkpoint: str, zone: str, quarantine: str | None = None
) -> StreamingQuery:
    """Merges new raw lines into the batch table, then stops.

    A repeated micro-batch changes nothing: the merges append only missing rows.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, out, zone, quarantine, rewrite=False)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_warehouse(
    messages: DataFrame, out: str, checkpoint: str, zone: str, quarantine: str | None = None
) -> StreamingQuery:
    """Merges new messages into a warehouse table of all days, then stops.

    The table is that of `daily_load`, and both may write it, one after the other: a repeated
    micro-batch changes nothing, and no log of files stands beside the table. Messages without a
    usable time go to `quarantine`, under the day on which they arrived.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_messages(batch, out, zone, quarantine)

    return (
        messages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
