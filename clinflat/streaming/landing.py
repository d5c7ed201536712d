"""Incremental flattening of a landing folder with Structured Streaming.

A view without recursion keeps no state: each record gives its rows and is forgotten, so
the batch code runs on a stream unchanged. The checkpoint remembers which files were read,
and the Parquet sink writes each file's rows exactly once.

Many views share one stream: a batch of files is read and sorted by type once, each type is
parsed once, and every view writes its rows of the batch to a folder named by the batch. A batch
that is run again after a failure replaces its own folders, so no row is written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from clinflat.operators.flatten import FlatView
from clinflat.sources.resources import FILE_PATTERN, may_hold
from clinflat.session import remove_folder
from clinflat.sources.router import read_routed, typed_lines, write_by_type
from clinflat.sources.schemas import resource_schema
from clinflat.sources.sinks import view_name, write_parquet


def stream_resources(
    spark: SparkSession,
    folder: str,
    resource_type: str,
    schema: T.StructType | str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Resources of one type from files as they arrive in a folder."""
    reader = spark.readStream.schema(schema or resource_schema(resource_type)).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    named = reader.option("pathGlobFilter", FILE_PATTERN).json(folder)
    return named.filter(may_hold(resource_type)).filter(F.col("resourceType") == resource_type)


def flatten_stream(
    view: FlatView,
    resources: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the view's rows to Parquet. With ``available_now`` the query takes what is
    there and ends; otherwise it keeps running."""
    writer = (
        view.apply(resources)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


class StreamReport(StreamingQueryListener):
    """Counts of a stream of many views: lines read and seconds from its progress, rows per view and
    records per type from its batches. A batch that is run again replaces its counts."""

    def __init__(self) -> None:
        self.lines: dict[int, int] = {}
        self.seconds: dict[int, float] = {}
        self.counts: dict[int, list[tuple[str, str, int, int]]] = {}
        self.query_id: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.id) == self.query_id and progress.batchId in self.counts:
            self.lines[progress.batchId] = progress.numInputRows
            self.seconds[progress.batchId] = progress.batchDuration / 1000

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per batch and view: batch, resource, name, rows, resources, lines, seconds."""
        found = [
            (batch, *count, self.lines.get(batch), self.seconds.get(batch))
            for batch, counts in sorted(self.counts.items())
            for count in counts
        ]
        schema = "batch bigint, resource string, name string, rows bigint, resources bigint, lines bigint, seconds double"
        return spark.createDataFrame(found, schema)


def flatten_folder(
    spark: SparkSession,
    views: Sequence[FlatView],
    folder: str,
    out: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    available_now: bool = True,
    report: StreamReport | None = None,
) -> StreamingQuery:
    """Flatten the files of a landing folder with many views as they arrive, in one stream.

    Each batch reads its files once, whatever number of types and views they hold, and keeps their
    lines by type in a folder below ``out`` until its views are written. A type with several views
    is parsed once onto the executors' disks; what a lost executor held is parsed again. Rows of a view go to ``out/<name>/batch=<number>``, so ``spark.read.parquet`` of a
    view's folder has the batch as a column; a batch without rows writes an empty file. Lines
    whose file or record names a type that no view wants are skipped. ``report`` collects counts;
    with it the stream's query needs to be the only one that reports to it.
    """
    names = [view_name(v) for v in views]
    if len(set(names)) < len(names):
        raise ValueError("views of one stream need different names")
    types = list(dict.fromkeys(v.resource for v in views))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        layout = f"{out.rstrip('/')}/_lines/batch-{batch_id}"
        write_by_type(batch, layout)
        counts = []
        for resource in types:
            own = [v for v in views if v.resource == resource]
            records = read_routed(spark, layout, resource)
            if len(own) > 1:
                records = records.persist(StorageLevel.DISK_ONLY)
            seen, written = Observation(f"records_{resource}"), []
            counted = records.observe(seen, F.count(F.lit(1)).alias("n"))
            for i, view in enumerate(own):
                rows = Observation(f"rows_{view_name(view)}")
                flat = view.apply(records if i else counted).observe(rows, F.count(F.lit(1)).alias("n"))
                write_parquet(flat, f"{out.rstrip('/')}/{view_name(view)}/batch={batch_id}")
                written.append((view_name(view), rows))
            if len(own) > 1:
                records.unpersist()
            counts += [(resource, name, rows.get["n"], seen.get["n"]) for name, rows in written]
        remove_folder(spark, layout)
        if report is not None:
            report.counts[batch_id] = counts

    reader = spark.readStream.option("pathGlobFilter", FILE_PATTERN)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = typed_lines(reader.text(folder)).filter(F.col("type").isin(types))
    if report is not None:
        spark.streams.addListener(report)
    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if report is not None:
        report.query_id = str(query.id)
    return query
