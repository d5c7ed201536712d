"""A table of resources kept up to date from incremental exports.

Every load reads what was updated since the last one and writes it as a run of its own; nothing
else is rewritten. The table is the latest version of each id over the committed runs, by an
aggregate that is reduced before its shuffle. A load is committed by a mark, which names the run
and the time to read from next; marks are numbered files that appear whole or not at all, so a
load that fails leaves the table as it was and is simply run again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.sources.resources import changed_since, read_resources
from clinflat.sources.schemas import resource_schema


def update_time() -> Column:
    return F.col("meta.lastUpdated").try_cast("timestamp")


def latest_versions(df: DataFrame) -> DataFrame:
    """One row per id: the one updated last. A row without an update time comes before all others;
    rows updated at once are told apart by a hash of their JSON text, so that reruns agree."""
    row = F.struct(*df.columns)
    order = F.struct(update_time(), F.xxhash64(F.to_json(row)))
    return df.groupBy("id").agg(F.max_by(row, order).alias("__r")).select("__r.*")


@dataclass(frozen=True)
class Mark:
    """What is committed: runs from ``base`` to ``run``, and the time of the newest update in them, in
    microseconds since 1970."""

    number: int
    base: int
    run: int
    since: int | None


class IncrementalTable:
    """Resources of one type below ``folder``, on whatever file system it lies."""

    def __init__(self, spark: SparkSession, folder: str, resource_type: str, schema: T.StructType | None = None):
        self.spark, self.folder, self.resource_type = spark, folder.rstrip("/"), resource_type
        self.schema = schema or resource_schema(resource_type)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._system = self._hadoop.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- marks -----------------------------------------------------------------------

    def mark(self) -> Mark | None:
        """The newest mark, None before the first load."""
        marks = self._hadoop.Path(f"{self.folder}/marks")
        if not self._system.exists(marks):
            return None
        names = [f.getPath().getName() for f in self._system.listStatus(marks)]
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return None
        text = self.spark.read.text(f"{self.folder}/marks/{max(numbers)}").first()[0]
        return Mark(**json.loads(text))

    def _commit(self, mark: Mark) -> None:
        """Write a mark under another name and rename it: it is there whole or not at all. A mark of
        this number that is there already was committed by someone else, which is an error."""
        draft = self._hadoop.Path(f"{self.folder}/marks/.draft-{uuid.uuid4().hex}")
        stream = self._system.create(draft, True)
        stream.write(bytearray(json.dumps(asdict(mark)).encode()))
        stream.close()
        target = self._hadoop.Path(f"{self.folder}/marks/{mark.number}")
        if self._system.exists(target) or not self._system.rename(draft, target):
            raise RuntimeError(f"another load has committed {target}")

    # -- loads -----------------------------------------------------------------------

    def _run(self, run: int) -> str:
        return f"{self.folder}/runs/run={run:08d}"

    def load(self, source: str) -> Mark:
        """Read what a folder of exports has that was updated at or after the newest known update,
        everything at first, and commit it. Rows that were read before do no harm. Later loads
        leave out rows without an update time."""
        last = self.mark() or Mark(0, 1, 0, None)
        records = read_resources(self.spark, source, self.resource_type, self.schema)
        if last.since is not None:
            records = changed_since(records, F.timestamp_micros(F.lit(last.since)))
        run = last.run + 1
        records.write.mode("overwrite").parquet(self._run(run))
        written = self.spark.read.schema(self.schema).parquet(self._run(run))
        newest = written.agg(F.unix_micros(F.max(update_time()))).first()[0]
        mark = Mark(last.number + 1, last.base, run, last.since if newest is None else newest)
        self._commit(mark)
        return mark

    def current(self) -> DataFrame:
        """The latest version of every resource of the committed loads."""
        mark = self.mark()
        if mark is None:
            return self.spark.createDataFrame([], self.schema)
        runs = [self._run(k) for k in range(mark.base, mark.run + 1)]
        return latest_versions(self.spark.read.schema(self.schema).parquet(*runs))

    def compact(self) -> Mark | None:
        """Make the latest versions a run of their own, from which later reads start."""
        mark = self.mark()
        if mark is None or mark.base == mark.run:
            return mark
        self.current().write.mode("overwrite").parquet(self._run(mark.run + 1))
        compacted = Mark(mark.number + 1, mark.run + 1, mark.run + 1, mark.since)
        self._commit(compacted)
        return compacted
