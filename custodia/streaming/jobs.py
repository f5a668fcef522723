"""Event-log operators on Structured Streaming, sharing the batch expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.operators.observability import metric_series
from custodia.operators.scd2 import Scd2
from custodia.sources.versions import VersionedTable


def event_stream(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """File-source stream of a parquet table: a folder of part files, or one file.

    The path goes in as a glob that matches nothing else, which the source takes for a file as well.
    """
    path = path.rstrip("/")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")


def series_stream(
    events: DataFrame, ts_col: str, metric: str, value, delay: str = "10 minutes", period: str = "5 minutes"
) -> DataFrame:
    """Tumbling series of a stream; windows are emitted once the watermark has passed them.

    State is one row per open window and metric, dropped behind the watermark.
    """
    timed = events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)
    return metric_series(timed, ts_col, metric, value, period)


def write_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available, append to ``out`` exactly once, stop."""
    query: StreamingQuery = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()


def _each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_log_stream(stream: DataFrame, log: str, checkpoint: str) -> None:
    """Append run-log patches; each batch owns one folder, so a repeated batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    _each_batch(stream, checkpoint, handle)


def apply_changes_stream(
    stream: DataFrame, table: VersionedTable, layout: Scd2, as_of: Callable[[int], str], checkpoint: str, actor: str,
    default_reason: str | None = None, default_source: str | None = None,
) -> None:
    """Apply each batch of staged changes as one new version.

    A repeated batch finds its changes already current and changes nothing. When
    a batch holds several changes of one key, the last one by ``loaded_at`` counts.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c != layout.key]
        last = batch.groupBy(layout.key).agg(
            F.max_by(F.struct(*rest), F.struct("loaded_at", *[F.col(a) for a in layout.attributes])).alias("r")
        )
        stage = last.select(layout.key, "r.*")
        at = as_of(batch_id)
        table.overwrite(layout.apply(table.read(), stage, at, actor, default_reason, default_source), at)

    _each_batch(stream, checkpoint, handle)
