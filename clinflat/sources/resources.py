"""Readers for resource files, bundles and terminology."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.operators.joins import never_broadcast
from clinflat.sources.schemas import BUNDLE_SCHEMA, resource_schema

FILE_PATTERN = "*{.ndjson,.ndjson.gz,.jsonl}"


#: A file name that starts with a type, as in Patient.001.ndjson.
TYPED_NAME = r"^(\p{Lu}\p{L}*)[._-]"


def file_type(name: Column) -> Column:
    """The type that a file name starts with, null where it tells none."""
    return F.nullif(F.regexp_extract(name, TYPED_NAME, 1), F.lit(""))


def may_hold(resource_type: str) -> Column:
    """Whether a file may hold a type: its name starts with the type or does not tell one.

    The condition reads nothing but the file name, so Spark leaves the other files out of
    the scan when it plans it, in batches and in streams.
    """
    name = F.col("_metadata.file_name")
    return name.rlike(f"^{resource_type}[._-]") | ~name.rlike(TYPED_NAME)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path names one existing file, on whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    if any(c in path for c in "*?[{"):
        return False
    place = hadoop.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(place) and not system.getFileStatus(place).isDirectory()


def read_resources(
    spark: SparkSession,
    source: str | Sequence[str],
    resource_type: str,
    schema: T.StructType | str | None = None,
    typed_only: bool = False,
) -> DataFrame:
    """Resources of one type from newline-delimited JSON, plain or gzip.

    ``source`` is a folder, of which names with a resource suffix that may hold the type are
    read, or a file or a list of files, which are read whatever their names. ``typed_only``
    leaves out files of a folder whose names tell no type. Blank lines are skipped, broken
    lines and values that do not fit the declared schema are errors.
    """
    reader = spark.read.schema(schema or resource_schema(resource_type)).option("mode", "FAILFAST")
    if isinstance(source, str) and not is_file(spark, source):
        named = F.col("_metadata.file_name").rlike(f"^{resource_type}[._-]")
        wanted = named if typed_only else may_hold(resource_type)
        df = reader.option("pathGlobFilter", FILE_PATTERN).json(source).filter(wanted)
    else:
        df = reader.json(source if isinstance(source, str) else list(source))
    return df.filter(F.col("resourceType") == resource_type)


def changed_since(df: DataFrame, since: str | Column) -> DataFrame:
    """Resources last updated at or after a point in time; those without one are left out."""
    limit = F.lit(since) if isinstance(since, str) else since
    updated = F.col("meta.lastUpdated").try_cast("timestamp")
    return df.filter(updated >= limit.cast("timestamp"))


def read_resources_since(
    spark: SparkSession, source: str, resource_type: str, since: str, schema: T.StructType | str | None = None
) -> DataFrame:
    return changed_since(read_resources(spark, source, resource_type, schema), since)


def latest_update(df: DataFrame) -> DataFrame:
    """One row: the newest update time, to be kept as the next ``since``."""
    updated = F.col("meta.lastUpdated").try_cast("timestamp")
    return df.agg(F.max(updated).alias("transaction_time"))


def read_bundles(spark: SparkSession, source: str | Sequence[str]) -> DataFrame:
    """Bundle files, one JSON object per file, with the file name."""
    reader = spark.read.schema(BUNDLE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    return reader.json(source).withColumn("file", F.input_file_name())


def explode_bundles(bundles: DataFrame) -> DataFrame:
    """One row per entry that carries a resource: its position, type and JSON text, and
    the number of entries of its bundle. Other columns of ``bundles`` are kept."""
    keep = [c for c in bundles.columns if c not in ("resourceType", "type", "entry")]
    entries = bundles.select(*keep, F.size("entry").alias("entry_count"), F.posexplode("entry"))
    resource = F.col("col.resource")
    return entries.filter(resource.isNotNull()).select(
        *keep,
        "entry_count",
        F.col("pos").alias("entry_index"),
        F.get_json_object(resource, "$.resourceType").alias("resourceType"),
        resource.alias("resource"),
    )


def bundle_resources(entries: DataFrame, resource_type: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Typed resources of one type from exploded bundle entries."""
    schema = schema or resource_schema(resource_type)
    parsed = F.from_json("resource", schema, {"mode": "FAILFAST"})
    return (
        entries.filter(F.col("resourceType") == resource_type)
        .select(parsed.alias("r"))
        .select("r.*")
    )


#: A reference by search: type, system and value of an identifier.
SEARCH = r"(?s)^([A-Za-z]+)\?identifier=([^|]*)\|(.*)$"


def reference_index(targets: Mapping[str, DataFrame]) -> DataFrame:
    """One index of the identifiers of many types: type, system, value and the smallest id that
    carries them. ``targets`` maps a type to its resources with id and identifier."""
    entries = [
        target.select(F.lit(name).alias("type"), "id", F.explode("identifier").alias("i"))
        .select("type", "i.system", "i.value", "id")
        .filter(F.col("system").isNotNull() & F.col("value").isNotNull())
        for name, target in targets.items()
    ]
    return reduce(DataFrame.unionByName, entries).groupBy("type", "system", "value").agg(F.min("id").alias("id"))


def resolve_references(df: DataFrame, reference: str, index: DataFrame) -> DataFrame:
    """Replace references such as ``Practitioner?identifier=system|value`` by ``Type/id``.

    ``reference`` is a text column of ``df``, ``index`` comes from :func:`reference_index`. Other
    references, and searches that the index does not answer, stay as they are. Only rows with a
    search of an indexed form meet the index; all others pass by without a shuffle. A search that
    very many rows share is split by adaptive execution, as both sides come from a shuffle.
    """
    ref = F.col(reference)
    is_search = F.coalesce(ref.rlike(SEARCH), F.lit(False))
    type_, system, value = (F.regexp_extract(ref, SEARCH, k) for k in (1, 2, 3))
    keys = index.select(*[F.col(c).alias(f"__{c}") for c in ("type", "system", "value", "id")])
    searches = df.filter(is_search).select("*", type_.alias("__t"), system.alias("__s"), value.alias("__v"))
    matches = (
        (F.col("__t") == F.col("__type"))
        & (F.col("__s") == F.col("__system"))
        & (F.col("__v") == F.col("__value"))
    )
    joined = searches.join(never_broadcast(keys), matches, "left")
    found = F.coalesce(F.concat("__type", F.lit("/"), "__id"), ref)
    return df.filter(~is_search).unionByName(joined.withColumn(reference, found).select(*df.columns))


def resolve_conditional_refs(df: DataFrame, reference: str, target: DataFrame, target_type: str) -> DataFrame:
    """:func:`resolve_references` with the identifiers of one type."""
    return resolve_references(df, reference, reference_index({target_type: target}))


def read_code_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Terminology table from CSV files with a header line."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
