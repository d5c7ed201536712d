"""Records of files whose names tell no type, sorted by type in one pass.

Such a file may hold any type, so reading it for one type parses every line of it, and reading
it for each of many types parses it as often. Here its lines are read once, each with the type
that it names, and kept in a layout of one folder per type. A read of a type then touches that
folder only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.sources.resources import FILE_PATTERN, file_type, is_file
from clinflat.sources.schemas import resource_schema

BROKEN = "a line is not a JSON record"


def line_type(value: Column, name: Column) -> Column:
    """Type of a line: that of its file's name, else what the record says; a broken line is an error."""
    told = F.get_json_object(value, "$.resourceType")
    whole = F.get_json_object(value, "$").isNotNull()
    own = F.when(told.isNotNull(), told).when(~whole, F.raise_error(F.lit(BROKEN)))
    return F.coalesce(file_type(name), own)


def typed_lines(lines: DataFrame) -> DataFrame:
    """Lines of resource files as text, to value and type; blank lines are skipped."""
    kept = lines.filter(F.trim(F.regexp_replace("value", r"\s", "")) != "")
    return kept.select("value", line_type(F.col("value"), F.col("_metadata.file_name")).alias("type"))


def write_by_type(lines: DataFrame, layout: str) -> None:
    """Write lines with their types as text, a folder per type; a layout that is there is replaced.

    Each task writes a file per type that it meets; nothing shuffles. Large splits
    (spark.sql.files.maxPartitionBytes) make fewer, larger files.
    """
    typed = lines.filter(F.col("type").isNotNull()).select("value", F.col("type").alias("record_type"))
    typed.write.mode("overwrite").partitionBy("record_type").text(layout)


def untyped_files(spark: SparkSession, source: str) -> DataFrame:
    """Lines of the files of a folder whose names tell no type. The condition reads the name only,
    so that other files are left out of the scan."""
    lines = spark.read.option("pathGlobFilter", FILE_PATTERN).text(source)
    return lines.filter(file_type(F.col("_metadata.file_name")).isNull())


def has_untyped_files(spark: SparkSession, source: str) -> bool:
    return not is_file(spark, source) and not untyped_files(spark, source).isEmpty()


def route_resources(spark: SparkSession, source: str, layout: str) -> None:
    """Write the records of a folder's untyped files to ``layout``, a folder per type, in one scan."""
    write_by_type(typed_lines(untyped_files(spark, source)), layout)


def read_routed(
    spark: SparkSession, layout: str, resource_type: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Records of one type from a layout of :func:`write_by_type`; other types' folders are not read.
    Values are parsed from the lines themselves, so numbers keep their digits."""
    schema = schema or resource_schema(resource_type)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    of_layout = T.StructType([*schema.fields, T.StructField("record_type", T.StringType())])
    records = spark.read.schema(of_layout).option("mode", "FAILFAST").json(layout)
    wanted = (F.col("record_type") == resource_type) & (F.col("resourceType") == resource_type)
    return records.filter(wanted).drop("record_type")
