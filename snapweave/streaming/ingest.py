"""Incremental ingest: each input file is processed once, however often the ingest runs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQueryListener

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


_ANY_AGE = "36500d"
_REPORT_SECONDS = 300


class _RowCount(StreamingQueryListener):
    """Rows read by each run of a query, from all its progress reports.

    The reports a query keeps itself are only the last ones.
    """

    def __init__(self) -> None:
        self.rows: dict[str, int] = defaultdict(int)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def _limited(reader: DataStreamReader, files_per_batch: int | None) -> DataStreamReader:
    """Files count as new by the ledger alone, not by their age, which Spark would also look at."""
    reader = reader.option("maxFileAge", _ANY_AGE)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    ledger: str,
    *,
    format: str,
    schema: T.StructType | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Append the rows of files not seen before to the Parquet table ``target``.

    ``ledger`` is the stream's checkpoint folder: it remembers the files, so a run that was cut
    short goes on where it stopped and a repeated run finds nothing to do.  ``files_per_batch``
    sets how much is done between two entries of the ledger.  Returns the number of rows read in
    this run.
    """
    reader = _limited(spark.readStream.format(format).options(**options), files_per_batch)
    rows = (reader.schema(schema) if schema is not None else reader).load(source)
    rows = transform(rows) if transform else rows
    writer = rows.writeStream.format("parquet").option("checkpointLocation", ledger)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    count = _RowCount()
    spark.streams.addListener(count)
    try:
        query = writer.trigger(availableNow=True).start(target)
        query.awaitTermination()
        run = str(query.runId)
        if not count.ended[run].wait(_REPORT_SECONDS):
            raise TimeoutError("the ingest ended, but its count of rows was not reported")
        return count.rows[run]
    finally:
        spark.streams.removeListener(count)


def ingest_batches(
    spark: SparkSession,
    source: str,
    ledger: str,
    process: Callable[[DataFrame], None],
    *,
    pattern: str,
    files_per_batch: int | None = None,
) -> int:
    """Hand the paths of files not seen before to ``process``; returns how many there were.

    Files are told apart by name.  A batch that failed is handed over again, so ``process`` should
    replace what it wrote for the same files.
    """
    handled: list[int] = []

    def batch(files: DataFrame, _: int) -> None:
        paths = files.select("path")
        process(paths)
        handled.append(paths.count())

    listing = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", pattern)
    listing = listing.option("fileNameOnly", True)
    files = _limited(listing, files_per_batch).load(source).select("path")
    query = (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", ledger)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(handled)


def pending(files: DataFrame, ledger: DataFrame, path: str = "path") -> DataFrame:
    """Files whose path is not in a ledger table, for ingests that keep their own."""
    seen = ledger.select(F.col(path).alias("__seen")).distinct()
    return files.join(seen, files[path] == seen["__seen"], "left_anti")
