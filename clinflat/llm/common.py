"""Helpers shared by the operators: reading, staging in the shared folder, word splitting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinflat.session import remove_folder, shuffles_cleared

#: Applications that have been sent this library.
_SENT: set[str] = set()
#: The white space that separates words, as a Java pattern and as SQL text.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a folder is made, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="clinflat-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder. Its files stay there for the owner of the folder
    to clear, unless spark.cleaner.referenceTracking.cleanCheckpoints lets Spark remove them."""
    shared_folder(df.sparkSession)
    with shuffles_cleared(df.sparkSession):
        # another DataFrame, as how shuffles are cleared is settled when one is made
        return df.select("*").checkpoint(eager=True)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_cleared(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet into the shared folder and read again. Callers own the files."""
    return _written(df, name)[0]


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like :func:`staged`, whose files are removed at the end: for tables that only
    what is staged or checkpointed within is made of."""
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        out, path = _written(df, name)
        paths.append(path)
        return out

    try:
        yield stage
    finally:
        for path in paths:
            remove_folder(spark, path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


#: Bits of a place in a text; the number of the row stands above them. Groups of an id's rows that are numbered alone.
PLACE_BITS = 32
ROW_GROUPS = 256


def numbered(docs: DataFrame, id_col: str, text_col: str, name: str = "row") -> DataFrame:
    """docs with the number (long) of a row among those of its id, an integer: 0 where it is alone or has none.

    Rows of one id are numbered in an order of their texts' hashes, so that reruns agree; rows of
    one text follow each other in any order. Only rows of repeated ids are sorted for it.
    """
    key = F.col(id_col).cast("long")
    counts = docs.where(key.isNotNull()).groupBy(key.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = checkpointed(counts.where("_n > 1").select("_id"))
    alone = F.lit(0).cast("long").alias(name)
    if repeated.isEmpty():
        return docs.select("*", alone)
    hashed = F.xxhash64(text_of(text_col))
    group = F.pmod(hashed, F.lit(ROW_GROUPS))
    order = Window.partitionBy(key, group).orderBy(hashed, text_of(text_col))
    several = docs.join(repeated, key == F.col("_id"), "left_semi")
    several = several.select("*", ((F.row_number().over(order) - 1) * ROW_GROUPS + group).cast("long").alias(name))
    return docs.join(repeated, key == F.col("_id"), "left_anti").select("*", alone).unionByName(several)


def in_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Get ready for Python tasks: bound the texts that a worker holds, send it this library."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    send_library(spark)


def send_library(spark: SparkSession) -> None:
    """Send this library to the Python workers of the application, once."""
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        top = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="clinflat-")) / "clinflat_library.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(top.rglob("*.py")):
                out.write(file, file.relative_to(top.parent))
        context.addPyFile(str(archive))
        _SENT.add(context.applicationId)
